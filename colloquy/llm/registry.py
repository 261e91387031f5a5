"""Queries of the corpus operators and their DuckDB oracles. Operators without an
oracle fit a model, draw random numbers or close over links; ``tests/llm`` checks
them against brute force."""

from __future__ import annotations

from colloquy.llm.decontaminate import op1
from colloquy.llm.fim import OP13_SQL, op13
from colloquy.llm.langid import op5
from colloquy.llm.minhash import op4
from colloquy.llm.mixing import OP7_SQL, op7
from colloquy.llm.pii import op2
from colloquy.llm.quality import OP12_SQL, op12
from colloquy.llm.resample import OP11_SQL, op11
from colloquy.llm.secrets import OP6_SQL, op6
from colloquy.llm.sharding import op8
from colloquy.llm.substrings import op10
from colloquy.llm.toxicity import op3
from colloquy.llm.vectors import op9

QUERIES = {
    "op1_greedy_tiling_leaks": op1,
    "op2_weak_supervision_pii": op2,
    "op3_nearest_examples_toxicity": op3,
    "op4_fast_sketch_near_dups": op4,
    "op5_word_first_language": op5,
    "op6_trigram_secret_scan": op6,
    "op7_pfair_mixing": op7,
    "op8_hypergeometric_shuffle": op8,
    "op9_product_quantised_near_dups": op9,
    "op10_seed_extend_substrings": op10,
    "op11_radix_importance_resampling": op11,
    "op12_suffix_array_quality": op12,
    "op13_chunked_fill_in_middle": op13,
}

ORACLES = {
    "op6_trigram_secret_scan": OP6_SQL,
    "op7_pfair_mixing": OP7_SQL,
    "op11_radix_importance_resampling": OP11_SQL,
    "op12_suffix_array_quality": OP12_SQL,
    "op13_chunked_fill_in_middle": OP13_SQL,
}

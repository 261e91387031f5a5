"""Operators 11 to 13 against their definitions on small texts, and on odd rows."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import fim, quality, resample

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# --- op11 ----------------------------------------------------------------

def ordered(spark, rows, monkeypatch, bits=4, block=16):
    monkeypatch.setattr(resample, "DIGIT_BITS", bits)
    monkeypatch.setattr(resample, "BLOCK_ROWS", block)
    df = spark.createDataFrame(rows, "a long, b long").repartition(5, "a", "b").withColumn("row", F.monotonically_increasing_id())
    return [(r["a"], r["b"], r["place"]) for r in resample.radix_order(df, ["a", "b"]).orderBy("place").collect()]


def test_radix_order_is_the_sorted_order(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.randrange(40), rng.randrange(300)) for _ in range(400)]
    got = ordered(spark, rows, monkeypatch)
    assert [x[:2] for x in got] == sorted(rows)
    assert [x[2] for x in got] == list(range(len(rows)))


def test_radix_order_of_one_hot_key_and_wide_keys(spark, monkeypatch):
    rows = [(7, 3)] * 100 + [(7, 2**62 + i) for i in range(5)] + [(2**40, 0)]
    got = ordered(spark, rows, monkeypatch, bits=12)
    assert [x[:2] for x in got] == sorted(rows)
    assert ordered(spark, [(1, 1)], monkeypatch) == [(1, 1, 0)]


def test_rows_that_cannot_be_drawn_are_left_out_and_no_other(spark, monkeypatch):
    monkeypatch.setattr(resample, "DIGIT_BITS", 3)
    df = spark.createDataFrame([(k,) for k in [0, 1, 1, 9, 60, 61, 63, 63]], "k long")
    for want in range(1, 9):
        kept = sorted(r["k"] for r in resample.lead(df, "k", want).collect())
        assert kept[:want] == [0, 1, 1, 9, 60, 61, 63, 63][:want]
    assert len(resample.lead(df, "k", 2).collect()) == 3


def test_ties_go_to_smaller_ids_and_nulls_last(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(i, text) for i in (5, -3, 2**60, None, None, 5)] + [(1, "too short"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = resample.resample(df, spark.createDataFrame([("w1 w2",)], "text string"), percent=100).collect()
    drawn = sorted((r["rank"], r["score"], r["doc_id"]) for r in got if r["rank"])
    assert [r[0] for r in drawn] == [1, 2, 3, 4, 5, 6]
    key = [(-s, d is None, d or 0) for _, s, d in drawn]
    assert key == sorted(key)
    assert {r["rank"] for r in got if r["doc_id"] in (1, 2)} == {None}
    assert [r["weight"] for r in got if r["doc_id"] == 2] == [0]


def test_words_are_folded_byte_by_byte():
    assert b"A1-b\xc3\x89.Z".translate(resample.FOLD).split() == [b"a1", b"b\xc3\x89", b"z"]


# --- op12 ----------------------------------------------------------------

def repeated_cover(words, k):
    seen = collections.Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return len({j for i in range(len(words) - k + 1) if seen[tuple(words[i:i + k])] > 1 for j in range(i, i + k)})


def longest_repeat(words):
    best = 0
    for k in range(5, len(words)):
        if len({tuple(words[i:i + k]) for i in range(len(words) - k + 1)}) < len(words) - k + 1:
            best = k
    return best


def all_maximal_repeats(words, least):
    out = set()
    for k in range(least, len(words)):
        places = collections.defaultdict(list)
        for i in range(len(words) - k + 1):
            places[tuple(words[i:i + k])].append(i)
        for at in places.values():
            after = [words[i + k] if i + k < len(words) else ("end", i) for i in at]
            before = [words[i - 1] if i else ("start", i) for i in at]
            if len(at) > 1 and len(set(after)) > 1 and len(set(before)) > 1:
                out.add((k, tuple(at)))
    return out


def test_repeats_equal_the_definition():
    rng = random.Random(3)
    for _ in range(200):
        texts = [[rng.choice([b"a", b"b", b"c"][:rng.choice([1, 2, 3])]) for _ in range(rng.choice([0, 1, 4, 9, 30, 60]))]
                 for _ in range(rng.randrange(1, 6))]
        block = quality.Block(texts)
        for k in (5, 8):
            assert list(block.covered_words(k)) == [repeated_cover(t, k) for t in texts]
        assert list(block.longest()) == [longest_repeat(t) for t in texts]
        got = {(t, w, tuple(block.places(lo, hi).tolist())) for t, w, lo, hi in block.repeats(5)}
        assert got == {(n, *r) for n, t in enumerate(texts) for r in all_maximal_repeats(t, 5)}


def test_texts_do_not_meet_at_block_ends(monkeypatch):
    texts = ["a b c d e f " * 4, "a b c d e f g", " ".join(f"w{i}" for i in range(50)), "", "a b c d e f g"]
    whole = [list(x) for x in quality.measure(texts)]
    monkeypatch.setattr(quality, "BLOCK_WORDS", 1)
    assert [list(x) for x in quality.measure(texts)] == whole
    assert whole[4] == [24, 0, 0, 0, 0]


def test_repetitive_long_text_is_linear():
    got = quality.measure([" ".join(["x"] * 200_000), " ".join("ab"[i % 2] for i in range(200_000))])
    assert [list(x) for x in got][-2] == [199_999, 199_998]


def test_verdicts(spark):
    clean = " ".join(f"w{i}" for i in range(400))
    passage = " ".join(f"p{i}" for i in range(51))
    rows = [(1, clean), (2, f"{clean} {passage} {clean.replace('w', 'v')} {passage}"), (3, "few words"), (4, None),
            (5, f"{clean} {passage[:150]} x {passage[:150]}"), (6, " ".join(["a b c d e f g h i j"] * 30)),
            (7, "x\n\nx \nx\n" + clean + "\n" + clean.replace("w", "#"))]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["kept"] for i in range(1, 8)] == [True, False, False, False, False, False, True]
    assert [got[i]["base_failed"] for i in range(1, 8)] == [False, False, True, True, False, True, False]
    assert got[2]["longest_repeat"] == 51 and got[2]["n_repeats"] == 1 and got[2]["n_covered"] == 102
    assert got[7]["n_dup_lines"] == 1 and got[7]["n_symbols"] == 400


# --- op13 ----------------------------------------------------------------

def test_units_equal_the_pattern():
    rng, cache = random.Random(1), fim.ChunkCache(5000)
    for k in range(600):
        n = rng.choice([0, 1, 2, 5, 40, 300, 3000, 9000])
        text = "x" * n if k % 7 == 0 else "".join(rng.choice("ab \n\t\xe9\U0001d11e\xa0\x85") for _ in range(n))
        if k % 5 == 0:
            text = text[:50] * (n // 50 + 1)
        units, want = fim.Units(text, cache), UNIT.findall(text)
        assert units.n == len(want)
        for j in {0, units.n} | {rng.randrange(units.n + 1) for _ in range(3)}:
            assert units.end(j) == len("".join(want[:j]))
    assert cache.hits and cache.held <= 5000 + fim.LONGEST_CHUNK


def test_chunks_depend_on_content_alone():
    rng = random.Random(2)
    shared = "".join(rng.choice("abcdef ") for _ in range(6000))
    cuts = []
    for lead in ("", "some other beginning of a text. "):
        text = lead + shared
        ends = fim.chunk_ends(text).tolist()
        cuts.append({text[s:e] for s, e in zip([0, *ends[:-1]], ends)})
    assert len(cuts[0] & cuts[1]) >= len(cuts[0]) - 2
    cache = fim.ChunkCache()
    fim.Units(shared, cache)
    before = cache.misses
    fim.Units("a new start " + shared, cache)
    assert cache.misses - before <= 2


@pytest.mark.parametrize("rate,spm", [(100, 0), (100, 100), (50, 80), (0, 0)])
def test_round_trip(spark, rate, spm):
    rows = [(i, t) for i, t in enumerate(["", None, " ", "one", "a < b <S", "<P> marked", " lead and trail \n", "<<<S", "S>x P> M>",
                                          "word " * 3000, "\U0001d11e \xe9", "a\nb\n" * 100])] + [(None, "no id"), (3, "one")]
    out = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), rate, spm)
    got = out.select("*", fim.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(r["text"] for r in got) == sorted(t or "" for _, t in rows)
    for r in got:
        assert r["n"] == len(UNIT.findall(r["text"]))
        assert (r["form"] == "plain") == (r["prefix_chars"] is None) == (r["middle_chars"] is None)
        if rate == 100:
            assert (r["form"] == "plain") == (r["text"] == "" or "<P>" in r["text"] or "<S>" in r["text"])
            assert r["form"] in ("plain", "spm" if spm else "psm")


def test_hash_digits_are_exact_for_large_ids(spark):
    rows = [(2**62 + 1, "a b c d e f"), (None, "a b c d e f")]
    got = {r["doc_id"] for r in fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {2**62 + 1, None}


def test_gains_follow_the_formula():
    got = resample.gains(np.array([3, 0]), np.array([0, 5]))
    assert list(got) == [int(np.floor(1000 * np.log(1 * 5 / (4 * 7)))), int(np.floor(1000 * np.log(6 * 5 / (1 * 7))))]

"""Operator 13: fill-in-the-middle transformation by content-defined chunk memoization.

A text is cut into units (a word with the white space before it; white space at the end
is one of its own) and two hashed unit counts give prefix, middle and suffix.

Method: a rolling hash over the last ``SPAN`` code points cuts a text into chunks of about
``CHUNK`` code points. The places depend on the content alone, so passages that documents
share give equal chunks. Each task keeps a cache from a chunk's content to its boundary
summary: how many runs of word characters it has, and whether it begins and ends inside a
word. The content itself is the key, so a hit is verified by comparing it; the cache is
emptied when it holds ``CACHE_CHARS`` code points, which changes no result. Summaries
combine: two runs that meet at a boundary are one word. The running sum of word ends over a
document's chunks gives its unit count, and finds the one chunk that holds a cut; only that
chunk is read unit by unit.

Documents are independent, so nothing is shuffled and a lost task repeats alone.

Defined results: a null text is an empty one (``plain``, no units); a text of white space
alone is one unit; a null doc_id hashes as no digits; repeated rows get equal results;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import id_text
from colloquy.session import read_table

SEED, RATE, SPM_RATE = 42, 50, 80
SPAN, CHUNK, LONGEST_CHUNK, CACHE_CHARS = 32, 256, 4096, 16_000_000
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
RUN = re.compile(r"[^\x20\x09-\x0D]+")


def chunk_ends(text: str) -> np.ndarray:
    """Ends of the content-defined chunks of ``text`` (code points, the last is its length)."""
    x = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32) * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    width = 1
    while width < SPAN:  # each round doubles the window that the hash at a place covers
        x[width:] = x[width:] + (x[:-width] << np.uint32(width))
        width *= 2
    # the high bits depend on every code point of the window
    ends = np.flatnonzero(x >= np.uint32(2**32 - 2**32 // CHUNK)) + 1
    ends = np.append(ends[ends < len(text)], len(text))
    starts = np.append(0, ends[:-1])
    if (ends - starts).max() > LONGEST_CHUNK:  # no boundary for long: even parts from the chunk's start
        ends = np.unique(np.concatenate([np.append(np.arange(s + LONGEST_CHUNK, e, LONGEST_CHUNK), e)
                                         for s, e in zip(starts, ends)]))
    return ends


class ChunkCache:
    """Boundary summaries of chunks: ``runs << 2 | begins in a word << 1 | ends in a word``."""

    def __init__(self, room: int = CACHE_CHARS):
        self.room, self.held, self.known, self.hits, self.misses = room, 0, {}, 0, 0

    def summary(self, chunk: str) -> int:
        got = self.known.get(chunk)
        if got is not None:
            self.hits += 1
            return got
        got = len(RUN.findall(chunk)) << 2 | (chunk[0] not in SPACES) << 1 | (chunk[-1] not in SPACES)
        if self.held + len(chunk) > self.room:
            self.known, self.held = {}, 0
        self.known[chunk] = got
        self.held += len(chunk)
        self.misses += 1
        return got


class Units:
    """The units of one text, counted and located through the chunks' summaries."""

    def __init__(self, text: str, cache: ChunkCache):
        self.text, self.n = text, 0
        if not text:
            return
        ends = chunk_ends(text).tolist()
        self.starts = [0, *ends[:-1]]
        known = np.fromiter((cache.summary(text[s:e]) for s, e in zip(self.starts, ends)), np.int64, len(ends))
        joins = (known[:-1] & 1) & (known[1:] >> 1 & 1)  # a word goes on into the next chunk
        words = known >> 2
        words[:-1] -= joins
        self.upto = np.cumsum(words)  # words that end in a chunk or before it
        self.words = int(self.upto[-1])
        self.n = self.words + (text[-1] in SPACES)

    def end(self, units: int) -> int:
        """Where the first ``units`` units end."""
        if units == 0:
            return 0
        if units > self.words:
            return len(self.text)
        c = int(np.searchsorted(self.upto, units))
        nth = units - (int(self.upto[c - 1]) if c else 0)
        at = self.starts[c]
        for _ in range(nth):
            at = RUN.search(self.text, at).end()
        return at


def cut(text: str, code: str, cache: ChunkCache, rate: int, spm_rate: int) -> tuple:
    """(n, form, output, prefix length, middle length) of one text; ``code`` holds the hash digits."""
    units = Units(text, cache)
    h1, h2, h3, h4 = (int(code[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= rate:
        return units.n, "plain", text, None, None
    lo, hi = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = units.end(lo), units.end(hi)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        return units.n, "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", a, b - a
    return units.n, "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", a, b - a


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, output, prefix_chars, middle_chars for every row."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    slim = id_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), code.alias("code"))

    def run(batches):
        cache = ChunkCache()
        for batch in batches:
            texts, codes = batch.column("text").to_pylist(), batch.column("code").to_pylist()
            n, form, output, before, inside = zip(*(cut(t, c, cache, rate, spm_rate) for t, c in zip(texts, codes))) \
                if texts else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(output, pa.string()), pa.array(before, pa.int64()), pa.array(inside, pa.int64())],
                names=["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"])

    return slim.mapInArrow(
        run, "doc_id long, n long, form string, output string, prefix_chars long, middle_chars long")


def restored(output: Column, form: Column) -> Column:
    """The exact text again: a text that is not plain holds no marker, so the three
    markers of its output are the only ones and part it unmistakably."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


def op13(spark, sf_dir: str) -> DataFrame:
    out = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS code
  FROM documents),
h AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || code[1:8] AS BIGINT) AS h1, CAST('0x' || code[9:16] AS BIGINT) AS h2,
         CAST('0x' || code[17:24] AS BIGINT) AS h3, CAST('0x' || code[25:32] AS BIGINT) AS h4 FROM u),
f AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi, units,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:lo], '') AS pre, array_to_string(units[lo + 1:hi], '') AS mid,
         array_to_string(units[hi + 1:n], '') AS suf FROM f)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

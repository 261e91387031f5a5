"""Operator 12: quality rules with suffix-array repetition.

Method: the suffix array of a text's words is built by prefix doubling (only suffixes
that still have equals are sorted again), the longest common prefixes of neighbours by
Kasai's walk, and the intervals of the LCP array give the maximal repeated substrings:
word sequences that occur twice or more and cannot grow to the left or right without
losing an occurrence. The union of their spans, for repeats of ``LEAST_REPEAT`` words and
more, may cover at most ``COVERED_PERCENT`` of a text's words, and the longest repeat may have
at most ``LONGEST_REPEAT`` words; other texts are not kept. The same intervals, from five
words on, give the words in repeated 5-word windows (base rule).

Texts are taken together until they hold ``BLOCK_WORDS`` words, so that the array work is
vectorised over many short texts; a suffix never reaches into the next text. A text is
never cut, and longer ones are blocks of their own. Memory follows the words of a block.
Documents are independent, so nothing is shuffled and a lost task repeats alone.

Defined results: a null or blank text has no words and fails the base rule; a null doc_id
is kept as null; repeated rows get equal results; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from colloquy.llm.common import id_text
from colloquy.session import read_table

BASE_WINDOW, LEAST_WORDS, REPEAT_PERCENT = 5, 10, 20
LEAST_REPEAT, COVERED_PERCENT, LONGEST_REPEAT = 20, 10, 50
BLOCK_WORDS = 200_000
SPACES, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"


def suffix_array(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes in order, rank of each, longest common prefix of each with the one before it
    in order) for words given as integers ``first``; the text of word i ends before word
    ``last[i]`` and words of different texts are different integers."""
    n = len(first)
    order = np.argsort(first, kind="stable")
    sorted_first = first[order]
    new = np.append(True, sorted_first[1:] != sorted_first[:-1])
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    width, tied = 1, slots
    near = np.zeros(n, dtype=bool)  # shares four words or more with the one before
    while len(tied):
        # slots of groups with more than one member
        head = rank[order[tied]]
        alone = np.append(True, head[1:] != head[:-1]) & np.append(head[1:] != head[:-1], True)
        tied, head = tied[~alone], head[~alone]
        if width == 4:
            near[tied] = head != tied
        if not len(tied):
            break
        at = order[tied]
        beyond = at + width
        follow = np.where(beyond < last[at], rank[np.minimum(beyond, n - 1)] + 1, 0)
        by = np.lexsort((follow, head))
        at, follow = at[by], follow[by]
        order[tied] = at
        new = np.append(True, (head[1:] != head[:-1]) | (follow[1:] != follow[:-1]))
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0))
        width *= 2
    return order, rank, shared_prefixes(first, last, order, rank, near)


def shared_prefixes(first, last, order, rank, near) -> np.ndarray:
    """Kasai's walk over the suffixes that share four words or more with the one before
    them; shorter prefixes are left 0."""
    lcp = np.zeros(len(first), dtype=np.int64)
    places = np.sort(order[near])
    before = order[rank[places] - 1]
    words = first.tolist() if len(places) > len(first) // 8 else first
    have, done, out = 0, -2, []
    for i, j, end_i, end_j in zip(places.tolist(), before.tolist(), last[places].tolist(), last[before].tolist()):
        have = have - 1 if i == done + 1 and have > 4 else 4
        most = min(end_i - i, end_j - j)
        while have < most and words[i + have] == words[j + have]:
            have += 1
        done = i
        out.append(have)
    lcp[rank[places]] = out
    return lcp


def maximal_repeats(first: np.ndarray, starts: np.ndarray, order: np.ndarray, lcp: np.ndarray, least: int) -> list:
    """(words, first slot, end slot) of every maximal repeated substring of ``least`` words
    and more, which occurs at ``order[first:end]``: the LCP intervals (equal prefixes that no
    further word shares) whose occurrences do not all have the same word before them.
    ``starts`` marks the first words of texts. There are fewer intervals than words."""
    before = np.where(starts[order], -1 - order, first[order - 1])
    changes = np.cumsum(np.append(0, before[1:] != before[:-1]))  # within slots l..r: changes[r] - changes[l]
    out, stack = [], []  # (prefix length, first slot)
    slots = np.flatnonzero(lcp >= least)
    runs = np.split(slots, np.flatnonzero(np.diff(slots) > 1) + 1) if len(slots) else []
    for run in runs:
        for slot, have in [*zip(run.tolist(), lcp[run].tolist()), (int(run[-1]) + 1, 0)]:
            left = slot - 1
            while stack and stack[-1][0] > have:
                words, left = stack.pop()
                if changes[slot - 1] > changes[left]:
                    out.append((words, left, slot))
            if have and (not stack or stack[-1][0] < have):
                stack.append((have, left))
    return out


def covered(order: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """For every word, whether a repeat of ``least`` words or more covers it: the union of
    the spans of all LCP intervals, of which a suffix's longest contains its others."""
    edge = np.zeros(len(order) + 1, dtype=np.int64)
    longest = np.maximum(lcp, np.append(lcp[1:], 0))
    slots = np.flatnonzero(longest >= least)
    places = order[slots]
    edge[places] += 1  # suffixes are distinct places
    np.subtract.at(edge, places + longest[slots], 1)
    return np.cumsum(edge[:-1]) > 0


class Block:
    """Suffix array of the words of several texts."""

    def __init__(self, texts: list[list[bytes]]):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        words = np.array([w for t in texts for w in t], dtype=object)
        text = np.repeat(np.arange(len(texts)), sizes)
        code = pd.factorize(words)[0] if len(words) else np.empty(0, dtype=np.int64)
        self.first = code.astype(np.int64) + text * (int(code.max(initial=0)) + 1)
        self.order, _, self.lcp = suffix_array(self.first, self.ends[text])
        self.text = text

    def covered_words(self, least: int) -> np.ndarray:
        """Words of each text that repeats of ``least`` words and more cover."""
        return np.bincount(self.text[covered(self.order, self.lcp, least)], minlength=len(self.ends))

    def longest(self) -> np.ndarray:
        """Words of the longest repeat of each text (0 if none has five)."""
        out = np.zeros(len(self.ends), dtype=np.int64)
        some = np.flatnonzero(self.lcp >= BASE_WINDOW)
        np.maximum.at(out, self.text[self.order[some]], self.lcp[some])
        return out

    def repeats(self, least: int) -> list:
        """(text, words, first slot, end slot) of the maximal repeats of all texts; ``places`` reads them."""
        starts = np.zeros(len(self.first), dtype=bool)
        starts[self.begins[self.begins < len(starts)]] = True
        return [(int(self.text[self.order[lo]]), words, lo, hi) for words, lo, hi in
                maximal_repeats(self.first, starts, self.order, self.lcp, least)]

    def places(self, lo: int, hi: int) -> np.ndarray:
        """Where in its text the repeat of the slots lo to hi occurs."""
        at = np.sort(self.order[lo:hi])
        return at - self.begins[self.text[at[0]]]


def blocks(raw: list[bytes]):
    """The texts' words in blocks of about BLOCK_WORDS words."""
    held, n = [], 0
    for text in raw:
        words = text.split()  # bytes are parted at the six ASCII white-space characters
        if held and n + len(words) > BLOCK_WORDS:
            yield held
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield held


def line_copies(raw: bytes) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


NUMBERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat", "n_repeats"]


def measure(texts: list[str], least: int = LEAST_REPEAT) -> list[np.ndarray]:
    """The columns NUMBERS of the texts."""
    raw = [t.encode() for t in texts]
    per_block = []
    for words in blocks(raw):
        b = Block(words)
        per_block.append((b.ends - b.begins, b.covered_words(BASE_WINDOW), b.covered_words(least), b.longest(),
                          np.bincount(np.array([r[0] for r in b.repeats(least)], dtype=np.int64), minlength=len(words))))
    empty = [np.empty(0, dtype=np.int64)] * 5
    n_words, again, cover, longest, repeats = (np.concatenate(x) for x in zip(*per_block)) if per_block else empty
    chars = np.array([len(t) - sum(map(t.count, SPACES)) for t in texts], dtype=np.int64)
    symbols = np.array([sum(map(t.count, SYMBOLS)) for t in texts], dtype=np.int64)
    lines = np.array([line_copies(r) for r in raw], dtype=np.int64)
    return [n_words, chars, symbols, lines, again, cover, longest, repeats]


def judge(docs: DataFrame, least: int = LEAST_REPEAT, covered_percent: int = COVERED_PERCENT,
          longest: int = LONGEST_REPEAT) -> DataFrame:
    """doc_id, NUMBERS, base_failed, kept for every row."""
    def run(batches):
        for batch in batches:
            numbers = measure([t or "" for t in batch.column("text").to_pylist()], least)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in numbers)],
                                             names=["doc_id", *NUMBERS])

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in NUMBERS)])
    out = id_text(docs).mapInArrow(run, schema)
    failed = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words"
    passed = f"100 * n_covered <= {int(covered_percent)} * n_words and longest_repeat <= {int(longest)}"
    return out.selectExpr("*", f"{failed} as base_failed", f"not ({failed}) and {passed} as kept")


def op12(spark, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered",
        "base_failed", "kept")


# A text's repeats of 20 words and more cover the words of its repeated 20-word windows; its
# longest repeat has over 50 words if a 51-word window is repeated.
OP12_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT r, unnest(w) AS w1, generate_subscripts(w, 1) AS i, len(w) AS n FROM d),
-- windows of a power of two of words, then those of 5, 20 and 51
u2 AS (SELECT *, w1 || ' ' || lead(w1) OVER v AS w2 FROM u WINDOW v AS (PARTITION BY r ORDER BY i)),
u4 AS (SELECT *, w2 || ' ' || lead(w2, 2) OVER v AS w4 FROM u2 WINDOW v AS (PARTITION BY r ORDER BY i)),
u16 AS (SELECT *, w4 || ' ' || lead(w4, 4) OVER v || ' ' || lead(w4, 8) OVER v || ' ' || lead(w4, 12) OVER v AS w16
        FROM u4 WINDOW v AS (PARTITION BY r ORDER BY i)),
g AS (
  SELECT r, i, w4 || ' ' || lead(w1, 4) OVER v AS g5, w16 || ' ' || lead(w4, 16) OVER v AS g20,
         w16 || ' ' || lead(w16, 16) OVER v || ' ' || lead(w16, 32) OVER v || ' ' || lead(w2, 48) OVER v
             || ' ' || lead(w1, 50) OVER v AS g51
  FROM u16 WINDOW v AS (PARTITION BY r ORDER BY i)),
s AS (
  SELECT r, 5 AS k, i, count(*) OVER (PARTITION BY r, g5) AS n FROM g WHERE g5 IS NOT NULL
  UNION ALL SELECT r, 20, i, count(*) OVER (PARTITION BY r, g20) FROM g WHERE g20 IS NOT NULL
  UNION ALL SELECT r, 51, i, count(*) OVER (PARTITION BY r, g51) FROM g WHERE g51 IS NOT NULL),
o AS (
  SELECT r, k, i, lag(i) OVER (PARTITION BY r, k ORDER BY i) AS p FROM s WHERE n > 1),
c AS (
  SELECT r, k, sum(CASE WHEN p IS NULL THEN k ELSE least(k, i - p) END) AS n FROM o GROUP BY r, k),
l AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
x AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM l
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(x.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(a.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_covered,
         e.n IS NOT NULL AS over
  FROM d LEFT JOIN x ON x.r = d.r LEFT JOIN c a ON a.r = d.r AND a.k = 5
       LEFT JOIN c b ON b.r = d.r AND b.k = 20 LEFT JOIN c e ON e.r = d.r AND e.k = 51)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * n_covered <= 10 * n_words AND NOT over AS kept
FROM m
"""

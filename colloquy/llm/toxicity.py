"""Operator 3: toxicity by the nearest labelled examples.

Method: documents are TF-IDF vectors over all words of the labelled examples. No
word is dropped; a word's weight is its idf times the G statistic of its presence
against the label (a tenth of it where it speaks for the clean label, and ``FLOOR``
at least), so words without a say still decide between examples that are else
alike. The cosine of a query with all examples is added up in single precision, queries
block by block: the words that stand in one of ``OFTEN`` examples and more (the ``COMMON``
commonest of them) by a matrix product, all others by an inverted index. No term is
negative, so the rounding is bounded by ``MARGIN`` of a sum, and only examples that reach
the k-th best within that margin are scored in double precision (:class:`BlockMaxIndex`):
the neighbours are those of the full scan. The neighbours vote with weight = cosine; isotonic regression on
examples outside the index turns votes into calibrated scores.

The index, word weights and calibration are fitted on a bounded sample: about
``FIT_ROWS`` labelled rows that are not held out, by a hash of their id; nothing
sent to the executors grows beyond its words. The driver holds the sample's words and
counts as plain columns; the tasks look words up, make the index and search it, also for
the votes that the calibration learns from. Document frequencies are counted over
all documents, and every whole text is scored.

Defined results: null and empty texts, and texts without a word of the examples, get
the share of toxic examples among such texts, drawn to the share among all; of
several labels of a doc_id the highest counts; without labels every score is 0; ties
between neighbours go to the smaller doc_id; repeated rows score alike; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import batched, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import held_out, id_text, in_share
from colloquy.session import materialize, read_table

FIT_ROWS, K, FLOOR, CLEAN_SHARE = 20_000, 15, 1e-3, 0.1
BLOCK, COMMON, OFTEN = 128, 1_024, 20  # queries at a time; words searched by matrix product, at most, and from 1 in OFTEN examples
MARGIN = 2e-4  # above twice the relative error of a sum of COMMON products in single precision (2 * 1,030 * 2**-24)
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")
SPACED = bytes(c if WORD.match(chr(c)) else 0x20 for c in range(256))  # Latin-1: letters stay, others are spaces


def words_of(text: str | None) -> list[str]:
    """Lower-cased letter runs, as ``WORD`` finds them."""
    low = (text or "").lower()
    try:
        return low.encode("latin-1").translate(SPACED).decode("latin-1").split()
    except UnicodeEncodeError:
        return WORD.findall(low)


@dataclass
class BlockMaxIndex:
    """Examples as unit vectors (term ids and weights), searched exactly by cosine."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: list[tuple[np.ndarray, np.ndarray]]
    size: int  # of the vocabulary
    begin: np.ndarray = field(init=False)
    term: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)
    start: np.ndarray = field(init=False)
    owner: np.ndarray = field(init=False)
    share: np.ndarray = field(init=False)
    column: np.ndarray = field(init=False)  # of each word in the matrix of common words, else -1

    def __post_init__(self):
        lengths = [len(t) for t, _ in self.vectors]
        self.begin = np.r_[0, np.cumsum(lengths)].astype(np.int64)
        self.term = np.concatenate([np.empty(0, np.int32), *(t for t, _ in self.vectors)]).astype(np.int32, copy=False)
        self.weight = np.concatenate([np.empty(0), *(w for _, w in self.vectors)])
        self.vectors = []  # held by the arrays
        df = np.bincount(self.term, minlength=self.size)
        often = np.argsort(-df, kind="stable")[:COMMON]
        often = often[df[often] * OFTEN >= max(1, len(lengths))]
        self.column = np.full(self.size, -1, dtype=np.int32)
        self.column[often] = np.arange(len(often))
        rare = np.flatnonzero(self.column[self.term] < 0)
        rare = rare[np.argsort(self.term[rare], kind="stable")]
        self.owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[rare]
        self.share = self.weight[rare].astype(np.float32)
        self.start = np.searchsorted(self.term[rare], np.arange(self.size + 1))

    @cached_property
    def matrix(self) -> np.ndarray:
        """Weights of the common words (rows) in all examples."""
        out = np.zeros((int(self.column.max(initial=-1)) + 1, len(self.ids)), dtype=np.float32)
        for lo in range(0, len(self.ids), 1_000):
            a, b = self.begin[lo], self.begin[min(lo + 1_000, len(self.ids))]
            at = self.column[self.term[a:b]]
            hit = np.flatnonzero(at >= 0)
            out[at[hit], np.searchsorted(self.begin, a + hit, "right") - 1] = self.weight[a:b][hit]
        return out

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = K) -> list[tuple[float, int]]:
        """The k best (cosine, position), cosine over 0, ties by id."""
        return next(self.nearest_of([(terms, weights)], k))

    def nearest_of(self, queries: Iterable[tuple[np.ndarray, np.ndarray]], k: int = K) -> Iterator[list[tuple[float, int]]]:
        """The same for each of many queries."""
        query = np.zeros(self.size)
        for block in batched(queries, BLOCK):
            columns = [self.column[terms] for terms, _ in block]
            grid = np.zeros((len(block), len(self.matrix)), dtype=np.float32)
            for row, c, (_, weights) in zip(grid, columns, block):
                row[c[c >= 0]] = weights[c >= 0]
            for part, c, (terms, weights) in zip(grid @ self.matrix, columns, block):
                query[terms] = weights
                yield self._best(part, terms[c < 0], query, k)
                query[terms] = 0

    def _best(self, part: np.ndarray, rare: np.ndarray, query: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k best, given the parts of the common words and the query at full length."""
        n = len(self.ids)
        hit, m = cells(self.start[rare], self.start[rare + 1])
        part = part + np.bincount(self.owner[hit], np.repeat(query[rare], m) * self.share[hit], minlength=n)
        kth = np.partition(part, n - k)[n - k] if n >= k else 0.0
        near = np.flatnonzero((part > 0) & (part >= kth * (1 - MARGIN) - 1e-11))  # scores are rounded to 12 digits
        hit, m = cells(self.begin[near], self.begin[near + 1])
        score = np.bincount(np.repeat(np.arange(len(near)), m), query[self.term[hit]] * self.weight[hit],
                            minlength=len(near))
        found = [(-round(float(s), 12), int(self.ids[i]), int(i)) for s, i in zip(score, near) if s > 0]
        return [(-s, i) for s, _, i in sorted(found)[:k]]


def cells(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges lo to hi, one range after the other, and the ranges' lengths."""
    m = hi - lo
    return np.repeat(lo - np.cumsum(m) + m, m) + np.arange(m.sum()), m


def unit(tf: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF vector of length one as (terms, weights)."""
    terms = np.array(sorted(tf), dtype=np.int64)
    return unit_of(terms, np.array([tf[t] for t in terms]), idf)


def unit_of(terms: np.ndarray, tf: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from rising term ids and their counts."""
    w = (1 + np.log(tf)) * weight[terms] if len(terms) else np.empty(0)
    return terms, w / np.linalg.norm(w) if len(w) else w


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (x, non-decreasing mean of y)."""
    if not len(x):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum, count, sum of x
    for a, b in zip(x[order], y[order]):
        pools.append([float(b), 1.0, float(a)])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            s, n, a2 = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += n
            pools[-1][2] += a2
    return (np.array([p[2] / p[1] for p in pools]),
            np.array([(p[0] + 0.5) / (p[1] + 1) if p[1] < 20 else p[0] / p[1] for p in pools]))


@dataclass
class Words:
    """The known words as a rising column; a task looks them up in a dictionary of its own."""

    column: pa.Array

    @cached_property
    def at(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.column.to_pylist())}


@dataclass
class Model:
    """The examples as columns; a task searches them in an index of its own."""

    ids: np.ndarray
    labels: np.ndarray
    begin: np.ndarray  # of the terms of each example, and the end
    term: np.ndarray
    tf: np.ndarray
    weight: np.ndarray  # of each word
    prior: float  # share of toxic among the sample
    blank: float  # the same among texts without a known word

    @cached_property
    def index(self) -> BlockMaxIndex:
        return BlockMaxIndex(self.ids, self.labels, [unit_of(self.term[a:b], self.tf[a:b], self.weight)
                                                     for a, b in pairwise(self.begin)], len(self.weight))

    def votes(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, list[tuple[float, int]]]]:
        """Distance-weighted vote for each (terms, tf), drawn to the prior where the evidence is thin."""
        for near in self.index.nearest_of(unit_of(terms, tf, self.weight) for terms, tf in texts):
            mass = sum(s for s, _ in near)
            yes = sum(s for s, at in near if self.labels[at])
            yield (yes + 0.5 * self.prior) / (mass + 0.5), near

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray]], knots: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, str]]:
        """Score and evidence for each (terms, tf)."""
        for vote, near in self.votes(texts):
            if not near:
                yield self.blank, ""
            else:
                yield (float(np.clip(np.interp(vote, *knots), 0, 1)),
                       ",".join(f"{self.ids[at]}:{s:.3f}:{int(self.labels[at])}" for s, at in near[:3]))


def sample_labels(labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, toxic): about ``fit_rows`` labelled ids that are not held out."""
    clean = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    clean = clean.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    return clean.where(in_share(F.xxhash64("doc_id", F.lit(3)), fit_rows, clean.count()))


def label_counts(sample: DataFrame) -> tuple[pa.Table, int, int]:
    """(word, a, b) for every word of the sample, in rising order: the toxic and the clean texts
    that hold it, equal texts once; and how many toxic and clean texts there are."""
    def count(batches):
        for pdf in batches:
            by = Counter()
            for text, y in zip(pdf["text"], pdf["toxic"]):
                by.update((w, y) for w in set(words_of(text)))
            yield pd.DataFrame([(w, int(y), n) for (w, y), n in by.items()], columns=["word", "toxic", "n"])

    once = sample.select("toxic", "text").dropDuplicates()
    total = {r["toxic"]: r["count"] for r in once.groupBy("toxic").count().collect()}
    words = once.mapInPandas(count, "word string, toxic int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
    found = words.toArrow().sort_by("word")  # the bounded sample
    return found, total.get(1, 0), total.get(0, 0)


def dependence(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """G statistic of a word's presence against the label, less where it speaks for clean."""
    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-300)), 0.0)

    df, n = a + b, max(1, n1 + n0)
    g = 2 * (part(a, df * n1 / n) + part(b, df * n0 / n)
             + part(n1 - a, (n - df) * n1 / n) + part(n0 - b, (n - df) * n0 / n))
    return np.maximum(g, 0) * np.where(a * n0 > b * n1, 1.0, CLEAN_SHARE) + FLOOR


def counted(text: str | None, at: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the known words of a text in rising order, and how often each stands there."""
    ids = [i for i in map(at.get, words_of(text)) if i is not None]
    return np.unique(np.array(ids, dtype=np.int32), return_counts=True)


def frequencies(docs: DataFrame, words: Broadcast, size: int) -> tuple[np.ndarray, int]:
    """Document frequency of each known word over all documents, and their number."""
    def run(batches):
        df, at = np.zeros(size + 1, dtype=np.int64), words.value.at  # the last counts documents
        for pdf in batches:
            for texts in batched(pdf["text"], 1_000):
                by = Counter()
                for text in texts:
                    by.update(set(words_of(text)))
                for w, n in by.items():
                    if (t := at.get(w)) is not None:
                        df[t] += n
            df[size] += len(pdf)
        t = np.flatnonzero(df)
        yield pd.DataFrame({"t": t, "n": df[t]})

    out = np.zeros(size + 1, dtype=np.int64)
    rows = id_text(docs).select("text").mapInPandas(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    out[rows["t"].to_numpy()] = rows["n"].to_numpy()
    return out[:size], int(out[size])


def sample_vectors(sample: DataFrame, words: Broadcast) -> DataFrame:
    """(doc_id, toxic, tune, terms, tf) of the sample."""
    def run(batches):
        for pdf in batches:
            found = [counted(t, words.value.at) for t in pdf["text"]]
            yield pdf[["doc_id", "toxic", "tune"]].assign(
                terms=[t.astype(np.int32).tobytes() for t, _ in found], tf=[n.astype(np.int32).tobytes() for _, n in found])

    return sample.mapInPandas(run, "doc_id long, toxic int, tune boolean, terms binary, tf binary")


def in_order(vectors: DataFrame, *columns: str) -> pa.Table:
    """These columns of the bounded sample's vectors, in a fixed order of the rows."""
    return vectors.orderBy("doc_id", "terms", "tf", "toxic").select(*columns).toArrow()


def calibrate(tune: DataFrame, sent: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """Knots from votes (a sum over the nearest examples) to shares of toxic, by vectors outside the index."""
    def run(batches):
        for pdf in batches:
            texts = [(np.frombuffer(t, np.int32), np.frombuffer(n, np.int32)) for t, n in zip(pdf["terms"], pdf["tf"])]
            yield pdf.assign(vote=[v for v, _ in sent.value.votes(texts)])

    voted = in_order(tune.select("doc_id", "toxic", "terms", "tf").mapInPandas(
        run, "doc_id long, toxic int, terms binary, tf binary, vote double"), "vote", "toxic")
    return isotonic(voted["vote"].to_numpy(), voted["toxic"].to_numpy().astype(float))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Broadcast, Broadcast, tuple[np.ndarray, np.ndarray]]:
    """The words and the model, both sent to the tasks, and the knots of the calibration."""
    sc = docs.sparkSession.sparkContext
    chosen = materialize(sample_labels(labels), "tox_labels")
    # the sample has about FIT_ROWS rows, whatever the tables' size
    sample = materialize(id_text(docs).join(F.broadcast(chosen), "doc_id").withColumn(
        "tune", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 3), "tox_sample")
    counts, n1, n0 = label_counts(sample.where("not tune"))
    words = sc.broadcast(Words(counts["word"].combine_chunks()))
    df, n = frequencies(docs, words, counts.num_rows)
    weight = (np.log((n + 1) / (df + 1)) + 1) * dependence(
        counts["a"].to_numpy().astype(float), counts["b"].to_numpy().astype(float), n1, n0)
    vectors = materialize(sample_vectors(sample, words), "tox_vectors")
    known = F.length("terms") > 0
    rows, yes, blank, blank_yes = (x or 0 for x in vectors.agg(
        F.count(F.lit(1)), F.sum("toxic"), F.count(F.when(~known, 1)), F.sum(F.when(~known, F.col("toxic")))).first())
    prior = yes / max(1, rows)
    kept = in_order(vectors.where(known & ~F.col("tune")), "doc_id", "toxic", "terms", "tf")
    term, tf = (np.frombuffer(b"".join(kept[c].to_pylist()), np.int32) for c in ("terms", "tf"))
    lengths = pc.binary_length(kept["terms"]).to_numpy().astype(np.int64) // 4
    sent = sc.broadcast(Model(
        kept["doc_id"].to_numpy(), kept["toxic"].to_numpy().astype(int), np.r_[0, np.cumsum(lengths)], term, tf, weight,
        prior, (blank_yes + 10 * prior) / (blank + 10)))
    return words, sent, calibrate(vectors.where(known & F.col("tune")), sent)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (doc_id:cosine:label of the nearest three)."""
    words, sent, knots = fit(docs, labels)

    def run(batches):
        m, at, seen = sent.value, words.value.at, {}
        for pdf in batches:
            out = []
            for texts in batched(pdf["text"], BLOCK):
                found = [counted(text, at) for text in texts]
                keys = [xxhash.xxh3_128_digest(t.tobytes() + f.tobytes()) for t, f in found]
                if len(seen) > 50_000:
                    seen.clear()
                new = {k: x for k, x in zip(keys, found) if k not in seen}
                seen.update(zip(new, m.scores(list(new.values()), knots)))
                out += [seen[k] for k in keys]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": [s for s, _ in out],
                                "evidence": [e for _, e in out]})

    scored = id_text(docs).mapInPandas(run, "doc_id long, score double, evidence string")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")


def op3(spark, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))

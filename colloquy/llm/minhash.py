"""Operator 4: near-duplicate documents by fast similarity sketching.

Method: a document's sketch has ``T`` coordinates, filled in rounds: in round i
every shingle is hashed into one of the T bins and the bin keeps its least
(round, hash); bins filled in an earlier round are settled, so rounds stop once all
are full. In rounds T to 2T-1 every shingle goes to bin i-T, so each coordinate
fills for certain. Two sketches agree in a coordinate with probability equal to the
Jaccard similarity, with concentration bounds like independent samples
(:func:`sketch`). ``BANDS`` bands of ``ROWS`` coordinates make candidates: at the
threshold 0.85 a pair shares no band with probability 0.7275^48 = 2e-7.

Candidates are verified exactly on the full shingle sets. Copies with equal sets are
one class from the start (only the class is sketched and banded). Documents that
share a band are tied to the band's smallest class, which gives families; inside a
family an inverted index over shingles counts the exact intersections of a member with
those that no search has reached, so no pair is emitted as a row and copies that are all
alike cost one comparison each. A family larger than ``BLOCK_SHINGLES``
is dealt in blocks, one task per pair of blocks. Families pass their links on as
spanning forests, and the forests of a family in blocks are merged by connected
components.

Shingles are 64-bit hashes of five words; 100*|A&B| >= 85*|A|B| is evaluated on
integers. Classes are named by a 128-bit hash of the set.

Defined results: null and empty texts, and texts of white space, have no shingles,
are linked with nothing and are their own component; fewer than five words are one
shingle; rows are judged by their text, so different texts of one doc_id are documents
of their own; rows with a null doc_id link like others, the smallest id of a component
names it, and without any id in it the component is null and its rows are kept (the
pipeline keeps one of them); repeated rows repeat their result; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import MULT, connected_components, gram_hashes, id_text, mix, signed, word_hashes
from colloquy.session import materialize, read_table

WORDS, BANDS, ROWS, BLOCK_SHINGLES = 5, 48, 8, 1 << 20
T = BANDS * ROWS
SEEDS = mix(np.arange(1, 2 * T + 1, dtype=np.uint64) * MULT)
UNFILLED = np.uint64(2**64 - 1)
LOW = np.uint64(2**32 - 1)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct shingle hashes. ``bytes`` lower-cases A-Z only and splits at
    exactly the six ASCII blanks."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(WORDS, len(words))))


def sketch(x: np.ndarray, t: int = T, seeds: np.ndarray = SEEDS) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes: (round << 32 | hash) per bin."""
    out = np.full(t, UNFILLED, dtype=np.uint64)
    n, i, share = len(x), 0, int(t * (np.log(t) + 3))
    while i < t:
        rounds = min(t - i, max(1, share // n), max(1, (1 << 20) // n))
        h = mix((x[None, :] ^ seeds[i:i + rounds, None]).ravel())
        value = np.repeat(np.arange(i, i + rounds, dtype=np.uint64) << np.uint64(32), n) | (h & LOW)
        np.minimum.at(out, ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64), value)
        i += rounds
        if out.max() != UNFILLED:
            return out
    for b in np.flatnonzero(out == UNFILLED):
        out[b] = (np.uint64(t + b) << np.uint64(32)) | (mix(x ^ seeds[t + b]) & LOW).min()
    return out


def band_keys(s: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in s.reshape(BANDS, ROWS).T:
        key = mix(key * MULT + column)
    return key


def set_name(x: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(x.tobytes())


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def links_within(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links (similarity 0.85 or more) between members of
    ``left`` and of ``right``, by exact intersection counts from an inverted index. A search
    goes from member to member and compares each with those not reached so far: a family of
    copies that are all alike is done after the first one."""
    sizes = np.array([len(s) for s in sets])
    forest, out = Forest(len(sets)), []
    if len(sets) <= 6:
        pairs = ((i, j, len(np.intersect1d(sets[i], sets[j], assume_unique=True)))
                 for i in left for j in right if i < j or j not in left)
        for i, j, k in pairs:
            if 100 * k >= 85 * (sizes[i] + sizes[j] - k) and forest.join(int(i), int(j)):
                out.append((int(i), int(j)))
        return out
    both = len(left) == len(right) and bool((left == right).all())  # one block with itself
    sides = [_Side(sets, right)] if both else [_Side(sets, right), _Side(sets, left)]
    for first in left:
        if not sides[-1].waits(first):
            continue
        sides[-1].take(np.array([first]))
        queue = [(int(first), 0)]  # a member, and the side that it is compared with
        for i, side in queue:
            near = sides[side].near(sets[i])
            sides[side].take(near)
            out += [(i, int(j)) for j in near]
            queue += [(int(j), 0 if both else 1 - side) for j in near]
    return out


class _Side:
    """The members of a block that no search has reached yet, with an inverted index.
    Its arrays are cut down whenever half of the members have been reached."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray):
        self.sizes = np.array([len(s) for s in sets])
        self.waiting = np.zeros(len(sets), bool)
        self.waiting[members] = True
        self.left = self.indexed = len(members)
        value = np.concatenate([np.empty(0, dtype=np.uint64), *(sets[i] for i in members)])
        by = np.argsort(value, kind="stable")
        self.value, self.owner = value[by], np.repeat(members, self.sizes[members])[by]

    def waits(self, i: int) -> bool:
        return bool(self.waiting[i])

    def take(self, found: np.ndarray) -> None:
        self.waiting[found] = False
        self.left -= len(found)
        if self.left * 2 <= self.indexed:
            keep = self.waiting[self.owner]
            self.value, self.owner, self.indexed = self.value[keep], self.owner[keep], self.left

    def near(self, x: np.ndarray) -> np.ndarray:
        """The waiting members linked with the set ``x``, by exact intersection counts."""
        if not self.left:
            return np.empty(0, dtype=np.int64)
        lo, hi = np.searchsorted(self.value, x, "left"), np.searchsorted(self.value, x, "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        who, k = np.unique(self.owner[at], return_counts=True)
        return who[(100 * k >= 85 * (len(x) + self.sizes[who] - k)) & self.waiting[who]]


def _mark(text):
    """Column: a hash of the text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, mark of the text, n_shingles, name of the set, band keys; written once."""
    slim = id_text(docs).select("doc_id", _mark(F.col("text")).alias("mark"), F.col("text").cast("binary").alias("text"))

    def run(batches):
        for pdf in batches:
            n, names, bands = [], [], []
            for text in pdf["text"]:
                x = shingles(text)
                n.append(len(x))
                names.append(set_name(x) if len(x) else None)
                bands.append(signed(band_keys(sketch(x))) if len(x) else None)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "mark": pdf["mark"], "n": n, "name": names, "bands": bands})

    return materialize(slim.mapInPandas(run, "doc_id long, mark string, n long, name binary, bands array<long>"),
                       "minhash_sets")


def near_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): links between classes that connect what is linked at all."""
    slots = classes.select("id", F.explode("bands").alias("band"))
    low = slots.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    low = materialize(low.select("band", "low"), "minhash_bands")  # written, so that the join can split a crowded band
    # by shuffle at any size: neither the shared bands nor the members below stay small as documents grow
    edges = slots.join(low.hint("merge"), "band").where("id > low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    family = connected_components(edges, "minhash_family").withColumnRenamed("node", "id")
    member = materialize(family.join(classes.select("id", "name", "n", "doc_id", "mark"), "id"), "minhash_members")
    blocks = member.groupBy("root").agg(
        F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    dealt = (member.join(blocks, "root")
             .withColumn("block", F.pmod(F.xxhash64("id", "name"), F.col("blocks")).cast("int")))
    slim = id_text(docs).select(F.col("doc_id").alias("d"), F.col("text").cast("binary").alias("text"), _mark(F.col("text")).alias("m"))
    columns = ["root", "blocks", "block", "id", "name", "text"]
    owned, free = dealt.where("doc_id is not null"), dealt.where("doc_id is null")
    texts = slim.where("d is not null").join(owned.hint("merge"), F.expr("d = doc_id and m = mark")).select(columns)
    # many rows without an id may hold the text of one class
    texts = texts.unionByName(slim.where("d is null").join(free.hint("merge"), F.expr("m = mark")).select(columns)
                              .dropDuplicates(["id"]))

    def sets(batches):
        for pdf in batches:
            out = []
            for root, blocks, block, i, name, text in pdf.itertuples(index=False):
                x = shingles(text)
                if set_name(x) == name:  # another row may have the same id
                    out += [(root, min(block, o), max(block, o), block, i, x.tobytes()) for o in range(blocks)]
            yield pd.DataFrame(out, columns=["root", "x", "y", "block", "id", "set"])

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "set"], kind="stable")
        found = [np.frombuffer(s, dtype=np.uint64) for s in pdf["set"]]
        block, ids = pdf["block"].to_numpy(), pdf["id"].to_numpy()
        links = links_within(found, np.flatnonzero(block == pdf["x"].iloc[0]), np.flatnonzero(block == pdf["y"].iloc[0]))
        return pd.DataFrame([(ids[i], ids[j]) for i, j in links], columns=["a", "b"])

    dealt_sets = texts.mapInPandas(sets, "root long, x int, y int, block int, id long, set binary")
    return dealt_sets.groupBy("root", "x", "y").applyInPandas(verify, "a long, b long")


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The signatures, and (name, component) for the name of every set."""
    sig = signatures(docs)
    classes = materialize(sig.where("n > 0").groupBy("name").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "mark", "n", "bands")).alias("x"))
        .select(F.monotonically_increasing_id().alias("id"), "name", "x.doc_id", "x.mark", "x.n", "x.bands"), "minhash_classes")
    roots = connected_components(near_links(docs, classes), "minhash_links").withColumnRenamed("node", "id")
    reached = classes.select("id", "name", "doc_id").join(roots, "id", "left").select(
        "name", "doc_id", F.coalesce("root", "id").alias("root"))
    return sig, materialize(reached, "minhash_roots")


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    sig, reached = grouped(docs)
    least = reached.groupBy("root").agg(F.min("doc_id").alias("component"))
    own = sig.select("doc_id", "n", "name").join(reached.join(least, "root").select("name", "component"), "name", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return own.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component: the first by id (null last), then by the hash of the
    text. Of rows without a shingle, one of each (doc_id, text) stays."""
    sig, reached = grouped(docs)
    order = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "mark")
    first = (sig.where("n > 0").select("name", "doc_id", "mark").join(reached.select("name", "root"), "name")
             .groupBy("root").agg(F.min(order).alias("x")).select("x.doc_id", "x.mark"))
    chosen = materialize(first.unionByName(sig.where("n = 0").select("doc_id", "mark").distinct())
                         .toDF("_kept", "_kept_mark"), "minhash_kept")
    number, mark = docs["doc_id"].cast("long"), _mark(docs["text"].cast("string"))
    same = number.eqNullSafe(chosen["_kept"]) & (mark == chosen["_kept_mark"])
    if sig.groupBy("doc_id", "mark").count().where("count > 1").isEmpty():  # spares a shuffle of the texts
        return docs.join(chosen, same, "left_semi")
    # of rows with the same id and text, the least by the hash of all columns
    row = F.xxhash64(*[docs[c] for c in docs.columns])
    least = docs.select(number.alias("_kept"), mark.alias("_kept_mark"), row.alias("_row")).groupBy(
        "_kept", "_kept_mark").agg(F.min("_row").alias("_row"))
    least = materialize(least.join(chosen.toDF("_i", "_m"), F.expr("_kept <=> _i and _kept_mark = _m"), "left_semi"),
                        "minhash_rows")
    out = docs.join(least, number.eqNullSafe(least["_kept"]) & (mark == least["_kept_mark"]) & (row == least["_row"]),
                    "left_semi")
    return out.dropDuplicates()  # what is left of a row is equal in every column


def op4(spark, sf_dir: str) -> DataFrame:
    return components(read_table(spark, sf_dir, "documents"))

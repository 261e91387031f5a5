"""Operator 9: near-duplicate embeddings by product quantisation.

Method: vectors of length one are assigned to coarse inverted lists; their residuals
are split into ``SUB`` subspaces and coded by the nearest of 256 centroids each. A query
probes inverted lists; its distance to a member comes from table look-ups (asymmetric:
the query is not quantised): |q-c|^2 from the coarse centroid, a number stored with the
member, and one table per query of its products with the subspace centroids. Members
whose distance allows a cosine of 0.93 are reranked by the exact cosine in double precision.

Probes and cut-offs are sufficient, not guessed: two unit vectors of cosine 0.93 are at
most r = sqrt(0.14) apart. If y lies in list c, the query's distance to the plane half
way between its own centroid and c is at most r, which decides the lists to probe.
And with e_y = |y - decoded y|, stored in the index, y is dropped only if its table
distance is over r + e_y. Within rounding, no link is lost, at any fit.

Equal vectors of a label are one class with a count. The coarse centroids (about one
per ``LIST_ROWS`` of the sample's share, at most 1,024) and the subspace centroids are
fitted on a bounded sample of ``FIT_ROWS`` vectors; every row is indexed and is a query.
The lists of a label are dealt to shelves of about ``BLOCK`` members, and a query goes once
to each shelf that holds a list it probes. A shelf and its queries are dealt in blocks, so
a crowded list is many tasks. Tasks emit, per query, a number of links and a spanning
forest, never the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components,
and rows without a label, link with nothing and are their own component; vectors of different
length never link; a vector with a null vec_id links as any other, takes the smallest id of its
component (null if none of it has an id), and is kept only if that is null; repeated rows are links of each other; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import connected_components, in_share
from colloquy.llm.minhash import Forest
from colloquy.session import materialize, read_table

COSINE, SUB, FIT_ROWS, LIST_ROWS, BLOCK = 0.93, 16, 16_384, 512, 4_096
RADIUS = np.sqrt(2 - 2 * COSINE) + 1e-6


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's algorithm from a seeded sample of rows; empty centroids keep their place."""
    rng = np.random.Generator(np.random.PCG64(seed))
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = ((c ** 2).sum(1) - 2 * x @ c.T).argmin(axis=1)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


class Quantiser:
    """Coarse centroids and, per subspace, 256 centroids of the residuals."""

    def __init__(self, sample: np.ndarray, rows: int):
        self.dim = sample.shape[1]
        self.width = -(-self.dim // SUB)
        lists = int(np.clip(rows // LIST_ROWS, 1, 1024))
        self.coarse = kmeans(sample, lists)
        parts = self._parts(sample - self.coarse[self.lists(sample)])
        self.fine = [kmeans(parts[:, s], 256) for s in range(SUB)]
        self.between = np.sqrt(np.maximum(0, ((self.coarse[:, None] - self.coarse[None]) ** 2).sum(-1)))

    def _parts(self, x: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(x), SUB * self.width))
        wide[:, : self.dim] = x
        return wide.reshape(len(x), SUB, self.width)

    def far(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, (x ** 2).sum(1)[:, None] + (self.coarse ** 2).sum(1) - 2 * x @ self.coarse.T))

    def lists(self, x: np.ndarray) -> np.ndarray:
        return self.far(x).argmin(axis=1)

    def encode(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes (row x SUB), the distance of each vector to its decoded form, and the
        member's own part of any squared distance to it: |r|^2 + 2 c.r for the coded residual r."""
        parts = self._parts(x - self.coarse[at])
        centre = self._parts(self.coarse[at])
        codes = np.empty((len(x), SUB), dtype=np.uint8)
        error, own = np.zeros(len(x)), np.zeros(len(x))
        for s, c in enumerate(self.fine):
            d = (parts[:, s] ** 2).sum(1)[:, None] + (c ** 2).sum(1) - 2 * parts[:, s] @ c.T
            codes[:, s] = d.argmin(axis=1)
            r = c[codes[:, s]]
            error += ((parts[:, s] - r) ** 2).sum(1)
            own += (r ** 2).sum(1) + 2 * (centre[:, s] * r).sum(1)
        return codes, np.sqrt(error), own

    def probes(self, x: np.ndarray) -> list[np.ndarray]:
        """For each query the lists that can hold a vector within RADIUS."""
        d = self.far(x)
        own = d.argmin(axis=1)
        gap = self.between[own]
        plane = (d ** 2 - d[np.arange(len(x)), own, None] ** 2) / (2 * np.maximum(gap, 1e-12))
        return [np.flatnonzero(row) for row in (plane <= RADIUS + 1e-9) | (gap == 0)]

    def tables(self, x: np.ndarray) -> np.ndarray:
        """Products of the queries' parts with the subspace centroids (query x SUB x 256)."""
        parts = self._parts(x)
        out = np.zeros((len(x), SUB, 256))
        for s, c in enumerate(self.fine):
            out[:, s, : len(c)] = parts[:, s] @ c.T
        return out


def _clean(vecs: DataFrame) -> DataFrame:
    """vec_id, label, v: doubles, null where the row can link with nothing."""
    v = vecs["embedding"].cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = vecs["label"].isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    # -0.0 and 0.0 are one value
    same = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    return vecs.select(vecs["vec_id"].cast("long").alias("vec_id"), vecs["label"].cast("string").alias("label"),
                       F.when(ok, same).alias("v"))


def _unit(column: pd.Series, dim: int) -> np.ndarray:
    """Rows scaled to length one, zero-padded to ``dim``; scaled by the largest entry first, so nothing overflows."""
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out ** 2).sum(axis=1, keepdims=True))


def fit(classes: DataFrame) -> Quantiser | None:
    n, dim = classes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return None
    picked = classes.where(in_share(F.xxhash64("v"), FIT_ROWS, n))
    sample = picked.select("v").toPandas()["v"]  # about FIT_ROWS vectors
    if not len(sample):
        sample = classes.select("v").limit(1).toPandas()["v"]
    x = _unit(sample, dim)
    return Quantiser(x[np.lexsort(x.T[::-1])], min(n, 1024 * LIST_ROWS))


def near_vectors(vecs: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    spark = vecs.sparkSession
    rows = materialize(_clean(vecs), "pq_rows")
    grouped = rows.where("v is not null").groupBy("label", "v").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("id"))
    # written once: the number of a class stays the same when a task is repeated
    classes = materialize(grouped.withColumn("cls", F.monotonically_increasing_id()), "pq_classes")
    model = fit(classes)
    if model is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    sent = spark.sparkContext.broadcast(model)

    def index(batches):
        m = sent.value
        for pdf in batches:
            x = _unit(pdf["v"], m.dim)
            at = m.lists(x)
            codes, error, own = m.encode(x, at)
            yield pd.DataFrame({
                "label": pdf["label"], "dim": pdf["v"].map(len), "list": at, "cls": pdf["cls"], "copies": pdf["copies"],
                "codes": [c.tobytes() for c in codes], "error": error, "own": own, "x": [r.tobytes() for r in x],
                "probes": m.probes(x)})

    coded = materialize(classes.mapInPandas(
        index, "label string, dim int, list int, cls long, copies long, codes binary, error double, own double, "
               "x binary, probes array<int>"), "pq_index")
    shelves = coded.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("shelves"))
    coded = coded.join(shelves, ["label", "dim"])
    cell = ["label", "dim", "shelf"]
    members = coded.withColumn("shelf", F.col("list") % F.col("shelves")).select(
        *cell, "list", "cls", "copies", "codes", "error", "own", "x")
    queries = coded.withColumn("shelf", F.explode(F.array_distinct(F.transform(
        "probes", lambda p: p % F.col("shelves"))))).select(*cell, "cls", "x", "probes")
    sizes = members.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    asked = queries.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / (4 * BLOCK)).cast("int").alias("cuts"))
    both = sizes.join(asked, cell)
    queries = (queries.join(both, cell).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
               .withColumn("cut", F.pmod(F.xxhash64("cls", F.lit(5)), F.col("cuts")).cast("int"))
               .select(*cell, "block", "cut", "cls", "x", "probes"))
    members = (members.join(both, cell).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
               .withColumn("cut", F.explode(F.expr("sequence(0, cuts - 1)"))).drop("blocks", "cuts"))
    queries = queries.toDF(*queries.columns)  # columns of their own: both sides come from the index

    def search(key, ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        if not len(ask) or not len(have):
            return out
        m = sent.value
        have = have.sort_values(["list", "cls"], kind="stable")
        ask = ask.sort_values("cls", kind="stable")
        codes = np.frombuffer(b"".join(have["codes"]), dtype=np.uint8).reshape(-1, SUB)
        y = np.frombuffer(b"".join(have["x"])).reshape(len(have), -1)
        q = np.frombuffer(b"".join(ask["x"])).reshape(len(ask), -1)
        reach, own = (RADIUS + have["error"].to_numpy()) ** 2, have["own"].to_numpy()
        copies, mine, theirs = have["copies"].to_numpy(), ask["cls"].to_numpy(), have["cls"].to_numpy()
        wanted = np.zeros((len(q), len(m.coarse)), dtype=bool)
        for i, probes in enumerate(ask["probes"]):
            wanted[i, probes] = True
        nodes = np.unique(np.r_[mine, theirs])
        forest, edges, counts = Forest(len(nodes)), [], np.zeros(len(ask), dtype=np.int64)
        place, start = np.searchsorted(nodes, theirs), np.searchsorted(nodes, mine)
        lists, first = np.unique(have["list"].to_numpy(), return_index=True)
        ends = np.r_[first[1:], len(have)]
        for lo in range(0, len(q), 512):  # the tables of 512 queries at a time
            table, centre = m.tables(q[lo:lo + 512]), m.far(q[lo:lo + 512]) ** 2
            for at, s, e in zip(lists, first, ends):
                rows = np.flatnonzero(wanted[lo:lo + 512, at])
                far = centre[rows, at][:, None] + own[None, s:e]
                for sub in range(SUB):
                    far -= 2 * table[rows, sub][:, codes[s:e, sub]]
                for r, j in zip(*np.nonzero(far <= reach[None, s:e] + 1e-9)):
                    i, j = lo + rows[r], s + j
                    if theirs[j] != mine[i] and y[j] @ q[i] >= COSINE:
                        counts[i] += copies[j]
                        if forest.join(int(start[i]), int(place[j])):
                            edges.append((mine[i], theirs[j], 0))
        hit = counts > 0
        found = pd.DataFrame(edges, columns=["a", "b", "n"]).astype("int64")
        return pd.concat([found, pd.DataFrame({"a": mine[hit], "b": mine[hit], "n": counts[hit]})])

    keys = [*cell, "block", "cut"]
    found = materialize(queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(
        search, "a long, b long, n long"), "pq_links")
    # links are between classes, so that one without an id still joins its neighbours
    roots = connected_components(found.where("a <> b").select("a", "b"), "pq_components").toDF("cls", "root")
    members = classes.select("cls", "id").join(roots, "cls")
    least = members.groupBy("root").agg(F.min("id").alias("component"))
    named = members.join(least, "root").select("cls", "component")
    number = found.where("a = b").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    done = classes.join(number, "cls", "left").join(named, "cls", "left").select(
        "label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("component", "id").alias("component"))
    out = rows.join(done, ["label", "v"], "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op9(spark, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))

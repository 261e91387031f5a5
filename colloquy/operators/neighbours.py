"""Exact nearest neighbours in a metric space by pivots (used by I3).

Sites lie in cells: up to ``PIVOTS`` of them, picked by a hash, are pivots, and a site belongs to
its nearest one, at distance ``r``. The triangle inequality then tells which sites a query
needs: the first round compares it with the cells nearest to it, as many as hold k points, which
bounds its k-th distance by some theta; the second round visits the cells that reach into that
ball, and in them only sites with ``|d(query, pivot) - r| <= theta``. Both rounds are
equi-joins on (cell, block): a crowded cell is dealt in blocks of about ``BLOCK`` sites.
Theta comes from each query's k best, cut map-side. The result is exact for any pivots; they
decide only how much is compared. No pair is formed outside the visited cells.

Vectors are compared block by block: a block of sites and the queries that visit it meet in one
group, as a matrix product (numpy), and only the pairs that a round asks for leave the group.
Where no clusters let the bounds exclude anything, the work is queries x sites products.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from colloquy.session import materialize

PIVOTS, BLOCK, ASKED = 64, 20_000, 4_096
CELLS = 2_000_000  # distances that a group holds at a time


def near_sites(queries: DataFrame, sites: DataFrame, k: int, distance: Callable[[Column, Column], Column],
               widen: Callable[[Column], Column],
               table: Callable[[pa.ChunkedArray, pa.ChunkedArray], np.ndarray] | None = None,
               level: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None) -> DataFrame:
    """(q, s, n, dist): for each query all sites up to the distance at which it has met k points,
    widened by ``widen`` (for ties and rounding).

    ``queries(q, qv)`` have unique q, ``sites(s, sv, n)`` unique s and n points each; ``distance``
    is a metric on the values, null where two cannot be compared. ``table`` gives the same
    distances of some queries' values (rows) and some sites' (columns) at once, NaN for null. With
    ``level`` (distances to whole numbers in the order the caller ranks by, and whether each is
    sure) sites that k others of their block surely come before, by (level, s), may be left out."""
    sites = materialize(sites.select("s", "sv", F.col("n").cast("long").alias("n")), "knn_sites")
    wanted = max(1, min(PIVOTS, int(sites.count() ** 0.5)))
    # one row of at most PIVOTS values, given to every row
    picked = sites.select(F.xxhash64("s").alias("h"), "s", "sv").orderBy("h", "s").limit(wanted).agg(
        F.collect_list("sv").alias("pivots")).withColumn("one", F.lit(1))

    def measured(df, value):
        return df.withColumn("one", F.lit(1)).join(F.broadcast(picked), "one").withColumn(
            "ds", F.transform("pivots", lambda p: distance(F.col(value), p))).drop("one", "pivots")

    # a site that no pivot can be compared with lies in cell 0, which every query visits
    placed = measured(sites, "sv").withColumns({"r": F.coalesce(F.array_min("ds"), F.lit(0.0)),
                                                "cell": F.coalesce(F.array_position("ds", F.array_min("ds")), F.lit(0)).cast("int")})
    placed = materialize(placed.drop("ds"), "knn_cells")
    cells = placed.groupBy("cell").agg(F.sum("n").alias("points"), F.count(F.lit(1)).alias("sites"), F.min("r").alias("inner"),
                                       F.max("r").alias("outer")).withColumn("blocks", F.ceil(F.col("sites") / BLOCK).cast("int"))
    cells = F.broadcast(cells)  # at most PIVOTS + 1 rows
    asked = materialize(measured(queries.select("q", "qv"), "qv"), "knn_queries")
    reach = asked.select("q", "qv", F.posexplode(F.concat(F.array(F.lit(0.0)), "ds")).alias("cell", "d")).where("d is not null").join(
        cells, "cell")
    members = placed.join(cells.select("cell", "blocks"), "cell").withColumn(
        "block", F.pmod(F.xxhash64("s"), F.col("blocks")).cast("int")).select("cell", "block", "s", "sv", "n", "r")

    def visit(some, near=F.lit(True)):
        dealt = some.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
        return dealt.join(members, ["cell", "block"]).where(near).withColumn(
            "dist", distance(F.col("qv"), F.col("sv"))).where("dist is not null")

    if table is not None:
        parts = max(1, -(-asked.count() // ASKED))  # one number
        kinds = {"q": queries.schema["q"].dataType, "s": sites.schema["s"].dataType}
        pair = StructType([*[StructField(c, t) for c, t in kinds.items()], StructField("n", LongType()), StructField("dist", DoubleType())])
        parted = members.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).drop("r")
        names = ["cell", "block", "part"]

        def blocks(some, best=0):
            """Pairs of the visited blocks: each query's ``best`` nearest of a block, or all up to its theta."""
            met = _meet(table, best, k, level)
            dealt = some.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn(
                "part", F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int")).select(*names, "q", "qv", *([] if best else ["theta"]))
            return dealt.groupBy(*names).cogroup(parted.groupBy(*names)).applyInArrow(
                lambda left, right: met(left, right), pair)

    before = F.sum("points").over(Window.partitionBy("q").orderBy("d", "cell").rowsBetween(Window.unboundedPreceding, -1))
    nearest = reach.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < k)
    first = visit(nearest) if table is None else blocks(nearest, k)
    best = first.select("q", "s", "n", "dist").withColumn(
        "place", F.row_number().over(Window.partitionBy("q").orderBy("dist", "s"))).where(F.col("place") <= k)
    upto = F.sum("n").over(Window.partitionBy("q").orderBy("place"))
    theta = best.withColumn("upto", upto).where(F.col("upto") >= k).groupBy("q").agg(F.min("dist").alias("theta"))
    theta = materialize(theta.select("q", widen(F.col("theta")).alias("theta")), "knn_theta")
    ball = F.coalesce("theta", F.lit(float("inf")))  # fewer than k points met: all cells
    second = reach.join(theta, "q", "left").withColumn("theta", ball).where(
        (F.col("cell") == 0) | ((F.col("d") - F.col("outer") <= F.col("theta")) & (F.col("inner") - F.col("d") <= F.col("theta"))))
    if table is not None:
        return blocks(second)
    found = visit(second, (F.col("cell") == 0) | (F.abs(F.col("d") - F.col("r")) <= F.col("theta")))
    return found.where(F.col("dist") <= F.col("theta")).select("q", "s", "n", "dist")


def _meet(table: Callable, best: int, k: int, level: Callable | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The pairs (q, s, n, dist) of a block's sites and the queries that visit it."""
    def ahead(dist, place):
        """Of one query's sites (distances and places in the order of s) those that may be among its k first."""
        at, sure = level(dist)
        first = np.flatnonzero(sure)
        first = first[np.lexsort((place[first], at[first]))][:k]
        return np.sort(np.r_[first, np.flatnonzero(~sure)])

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        place = np.empty(right.num_rows, np.int64)
        if level is not None and not best:
            place[pc.sort_indices(right["s"]).to_numpy()] = np.arange(right.num_rows)
        rows, cols, dists = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        step = max(1, CELLS // max(1, right.num_rows))
        for lo in range(0, left.num_rows if right.num_rows else 0, step):
            some = left.slice(lo, step)
            dist = table(some["qv"], right["sv"])
            if best:
                few = np.argpartition(dist, best - 1)[:, :best] if best < dist.shape[1] else np.tile(
                    np.arange(dist.shape[1]), (len(dist), 1))
                r, c = np.repeat(np.arange(len(dist)), few.shape[1]), few.ravel()
                known = ~np.isnan(dist[r, c])
                r, c = r[known], c[known]
            else:
                r, c = np.nonzero(dist <= some["theta"].to_numpy()[:, None])
                if level is not None:
                    cuts = np.searchsorted(r, np.arange(len(dist) + 1))
                    kept = [lo2 + (ahead(dist[i, c[lo2:hi2]], place[c[lo2:hi2]]) if hi2 - lo2 > k else np.arange(hi2 - lo2))
                            for i, (lo2, hi2) in enumerate(zip(cuts[:-1], cuts[1:]))]
                    kept = np.concatenate([np.empty(0, np.int64), *kept])
                    r, c = r[kept], c[kept]
            rows.append(r + lo)
            cols.append(c)
            dists.append(dist[r, c])
        at = np.concatenate(cols)
        return pa.table({"q": left["q"].take(pa.array(np.concatenate(rows))), "s": right["s"].take(pa.array(at)),
                         "n": right["n"].take(pa.array(at)), "dist": np.concatenate(dists)})

    return met


def chords(asked: pa.ChunkedArray, sites: pa.ChunkedArray) -> np.ndarray:
    """Distances between the directions of vectors ``struct<v, size>``; NaN between vectors of
    different length."""
    def by_length(values):
        x = values.combine_chunks()
        v, size = x.field("v"), x.field("size").to_numpy(zero_copy_only=False)
        n = pc.list_value_length(v).to_numpy(zero_copy_only=False)
        return {int(m): (at, v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), m) / size[at, None])
                for m in np.unique(n) for at in [np.flatnonzero(n == m)]}

    out = np.full((len(asked), len(sites)), np.nan)
    there = by_length(sites)
    for m, (at, x) in by_length(asked).items():
        if m in there:
            out[np.ix_(at, there[m][0])] = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ there[m][1].T)))
    return out


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def dense_neighbours(queries: DataFrame, points: DataFrame, k: int, vector: str = "embedding", key: str = "vec_id",
                     label: str = "label", digits: int = 6) -> DataFrame:
    """I3 on vectors: (query, rank, key, cosine, label) of the k labelled points of largest cosine
    to each query, rounded to ``digits``; ties by the smaller key; a query is not its own neighbour.

    Cosines are taken in double precision; the metric is the chord between the directions.
    Points without a key or label, and vectors that are null, empty, zero or hold a null or
    non-finite component, are neither found nor asked for; vectors of different length are not
    compared. Keys must be unique among the points, and among the queries."""
    def clean(df):
        v = F.transform(df[vector], lambda x: x.cast("double"))
        ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
        size = F.sqrt(dot(F.col("v"), F.col("v")))
        return df.where(F.coalesce(ok, F.lit(False)) & df[key].isNotNull()).withColumn("v", v).withColumn("size", size)

    def cosine(a, b):
        return F.when(F.size(a["v"]) == F.size(b["v"]), dot(a["v"], b["v"]) / (a["size"] * b["size"]))

    def chord(a, b):
        return F.when(F.size(a["v"]) == F.size(b["v"]), F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) - F.lit(2.0) * cosine(a, b))))

    def widen(theta):  # by one step of the rounded cosine, and rounding errors
        return F.sqrt(theta * theta + F.lit(4.0 * 10**-digits)) + F.lit(1e-7)

    def level(chords):  # the rounded cosine; unsure where another order of summation might round otherwise
        at = (1.0 - chords * chords / 2.0) * 10.0**digits
        return -np.rint(at), np.abs(at - np.floor(at) - 0.5) > 1e-4

    value = F.struct("v", "size")
    sites = clean(points.where(F.col(label).isNotNull())).select(F.col(key).alias("s"), value.alias("sv"), F.lit(1).alias("n"), label)
    sites = materialize(sites, "knn_points")
    asked = materialize(clean(queries).select(F.col(key).alias("q"), value.alias("qv")), "knn_asked")
    # one more than k: the query itself may be among the points
    near = near_sites(asked, sites, k + 1, chord, widen, chords, level).where("q <> s").select("q", "s")
    pairs = near.join(asked, "q").join(sites, "s").withColumn("cosine", F.round(cosine(F.col("qv"), F.col("sv")), digits))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("cosine").desc(), "s"))
    return pairs.select("q", "s", "cosine", label).withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("q").alias("query"), "rank", F.col("s").alias(key), "cosine", label)


def majority(neighbours: DataFrame, label: str = "label") -> DataFrame:
    """(query, predicted_label, votes): the most frequent label, ties by label."""
    votes = neighbours.groupBy("query", label).agg(F.count(F.lit(1)).alias("votes"))
    best = F.min_by(F.struct(F.col(label).alias("l"), "votes"), F.struct((-F.col("votes")).alias("o"), F.col(label).alias("l")))
    return votes.groupBy("query").agg(best.alias("b")).select("query", F.col("b.l").alias("predicted_label"), "b.votes")

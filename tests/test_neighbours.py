"""Exact nearest neighbours by pivots, against comparing everything."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.operators import neighbours as N
from colloquy.operators import recommend as I

ITEMS = [f"item{i}" for i in range(200)]


def bits(pattern):
    return {w * I.WORD_BITS + b for w, x in enumerate(pattern) for b in range(I.WORD_BITS) if x >> b & 1}


def test_patterns_of_200_items_hold_exactly_the_items(spark):
    rng = random.Random(1)
    held = {k: set(rng.sample(ITEMS, rng.randrange(1, 60))) for k in range(30)}
    rows = [(k, i) for k, items in held.items() for i in items] * 2 + [(99, "unknown"), (0, "unknown"), (5, None)]
    df = I.item_pattern(spark.createDataFrame(rows, "k int, item string"), ["k"], "item", ITEMS)
    got = df.select("k", "pattern", I.pattern_items(F.col("pattern"), ITEMS).alias("items")).collect()
    assert {r["k"]: bits(r["pattern"]) for r in got} == {k: {ITEMS.index(i) for i in items} for k, items in held.items()}
    assert all(r["items"] == sorted(held[r["k"]], key=ITEMS.index) for r in got)


@pytest.mark.parametrize("k", [1, 5, 400])
def test_knn_on_200_items_equals_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(N, "BLOCK", 16)  # crowded cells are dealt in blocks
    rng = random.Random(k)
    kinds = [set(rng.sample(range(200), 12)) for _ in range(8)]

    def some():
        return frozenset(x for x in rng.choice(kinds) | set(rng.sample(range(200), rng.randrange(4))) if rng.random() < 0.9)

    points = [(i, some(), rng.randrange(4)) for i in range(300)]
    points += [(1000 + i, points[0][1], 3) for i in range(30)]  # one pattern many times
    queries = [(q, some()) for q in range(40)] + [(99, frozenset())]

    def words(s):
        return [sum(1 << b for b in range(I.WORD_BITS) if w * I.WORD_BITS + b in s) for w in range(4)]

    pdf = spark.createDataFrame([(i, words(s), la) for i, s, la in points], "point_id long, pattern array<bigint>, label int")
    qdf = spark.createDataFrame([(q, words(s)) for q, s in queries], "q long, pattern array<bigint>")
    got = {r["q"]: (r["predicted_label"], r["votes"]) for r in I.knn_label(qdf, pdf, k, ["q"]).collect()}
    for q, s in queries:
        near = sorted(points, key=lambda p: (len(s ^ p[1]), p[0]))[:k]
        votes = collections.Counter(la for *_, la in near)
        assert got[q] == min(votes.items(), key=lambda kv: (-kv[1], kv[0]))


def test_dense_neighbours_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=8) * 0.3], i % 4) for i in range(300)]
    rows += [(300 + i, rows[0][1], 1) for i in range(8)]                 # ties
    rows += [(400, [2 * x for x in rows[0][1]], 2), (401, None, 0), (402, [0.0] * 8, 0), (403, [], 1), (404, [1.0, 2.0], 1),
             (405, [float("nan")] * 8, 1), (406, [None] + [1.0] * 7, 1), (407, rows[1][1], None), (None, rows[2][1], 1),
             (408, [1.0, 2.5], 3), (409, [-x for x in rows[3][1]], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    queries = df.where("vec_id % 7 = 0 or vec_id >= 400")
    got = collections.defaultdict(list)
    for r in N.dense_neighbours(queries, df, 5).collect():
        got[r["query"]].append((r["rank"], r["vec_id"], r["cosine"], r["label"]))

    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    want = {}
    points = [(i, v, la) for i, v, la in rows if i is not None and la is not None and good(v)]
    for q, v, _ in rows:
        if q is not None and (q % 7 == 0 or q >= 400) and good(v):
            cos = sorted((-round(float(np.dot(v, p) / (np.linalg.norm(v) * np.linalg.norm(p))), 6), i, la)
                         for i, p, la in points if i != q and len(p) == len(v))[:5]
            if cos:
                want[q] = [(n + 1, i, -c, la) for n, (c, i, la) in enumerate(cos)]
    assert set(got) == set(want)
    for q in want:
        assert [(a, b, round(c + 0.0, 6), d) for a, b, c, d in sorted(got[q])] == [
            (a, b, round(c + 0.0, 6), d) for a, b, c, d in want[q]], q


def test_numbers_as_sites(spark):
    rng = np.random.default_rng(2)
    values = [(c * 1000 + i, float(c * 100 + rng.random()), 1) for c in range(20) for i in range(30)]
    sites = spark.createDataFrame(values, "s long, sv double, n int")
    queries = spark.createDataFrame([(1, 305.0)], "q long, qv double")
    near = N.near_sites(queries, sites, 3, lambda a, b: F.abs(a - b), lambda t: t)
    assert sorted(r["s"] for r in near.collect()) == sorted(
        s for _, s in sorted((abs(v - 305.0), s) for s, v, _ in values)[:3])


def test_majority_ties_by_label(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (1, 2), (1, 1), (2, 9)], "query long, label int")
    assert sorted(map(tuple, N.majority(df).collect())) == [(1, 1, 2), (2, 9, 1)]


def test_no_points_and_no_queries(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 2)], "vec_id long, embedding array<double>, label int")
    assert N.dense_neighbours(df, df.where("false"), 3).count() == 0
    assert N.dense_neighbours(df.where("false"), df, 3).count() == 0
    assert sorted((r["query"], r["vec_id"]) for r in N.dense_neighbours(df, df, 3).collect()) == [(1, 2), (2, 1)]

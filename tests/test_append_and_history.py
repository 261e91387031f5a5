"""An append counts once, failed ones never. G3: contexts of any length."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import paths as G
from colloquy.operators.scan import turn_chunk
from colloquy.session import scratch_path
from colloquy.sources import banks as A


def batch(spark, n):
    return spark.createDataFrame([(n, f"d{n % 2}"), (n + 1, f"d{n % 2}")], "x int, day string")


def values(spark, path):
    return sorted(r["x"] for r in A.read_feedback(spark, path, ["x"]).collect())


@pytest.mark.parametrize("day", [None, "day"])
def test_a_key_is_appended_once(spark, day):
    path = scratch_path(spark, "t-a7")
    with pytest.raises(FileNotFoundError):
        A.read_feedback(spark, path)
    assert A.append_feedback(batch(spark, 0), path, day, key="batch/1")
    assert not A.append_feedback(batch(spark, 0), path, day, key="batch/1")
    assert values(spark, path) == [0, 1]
    assert A.append_feedback(batch(spark, 5), path, day, key="batch/2")
    assert A.append_feedback(batch(spark, 5), path, day) and A.append_feedback(batch(spark, 5), path, day)  # no key: every call
    assert values(spark, path) == [0, 1, 5, 5, 5, 6, 6, 6]


def test_an_aborted_append_changes_nothing(spark):
    path = scratch_path(spark, "t-a7")
    A.append_feedback(batch(spark, 0), path, key="a")
    broken = spark.range(1000, numPartitions=8).select(
        F.col("id").cast("int").alias("x"), F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise("d0").alias("day"))
    with pytest.raises(Exception, match="lost"):
        A.append_feedback(broken, path, key="b")
    assert values(spark, path) == [0, 1]
    assert A.append_feedback(batch(spark, 7), path, key="b")  # the key is still free
    assert values(spark, path) == [0, 1, 7, 8]


def test_only_the_first_of_two_writers_counts(spark, monkeypatch):
    path = scratch_path(spark, "t-a7")
    real = A._folder
    done = []

    def other_writer_first(session, at):
        # another writer commits the key while this one has its rows written but not yet its record
        if "/drafts/" in at and not done:
            done.append(1)
            A.append_feedback(batch(spark, 100), path, key="k")
        return real(session, at)

    monkeypatch.setattr(A, "_folder", other_writer_first)
    assert not A.append_feedback(batch(spark, 0), path, key="k")
    assert values(spark, path) == [100, 101]


def test_empty_appends_and_other_formats(spark):
    path = scratch_path(spark, "t-a7")
    assert A.append_feedback(batch(spark, 0).where("false"), path, key="none")
    assert values(spark, path) == []
    other = scratch_path(spark, "t-a7j")
    A.append_feedback(batch(spark, 3), other, fmt="json", key="x")
    assert sorted(r["x"] for r in A.read_feedback(spark, other, fmt="json").collect()) == [3, 4]
    with pytest.raises(ValueError):
        A.append_feedback(batch(spark, 3), fmt="noop", key="x")


def histories(rng):
    out = []
    for key in range(12):
        steps = [rng.choice("abc") for _ in range(rng.randrange(0, 40))]
        for i in range(3, len(steps)):
            if steps[i - 3:i] == ["a", "b", "c"]:
                steps[i] = "a"  # only a history of three steps tells it
        out += [(key, t, s if rng.random() > 0.03 else None) for t, s in enumerate(steps)]
    return out + [(None, t, "abab"[t % 4]) for t in range(9)]


@pytest.mark.parametrize("depth,support", [(1, 1), (5, 3)])
def test_context_tree_equals_plain_counts(spark, depth, support):
    rows = histories(random.Random(depth))
    df = spark.createDataFrame(rows, "k int, t int, step string")
    by_key = collections.defaultdict(list)
    for k, _, s in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        by_key[k].append(s)
    seen = collections.defaultdict(collections.Counter)
    for steps in by_key.values():
        for i, s in enumerate(steps):
            for d in range(1, depth + 1):
                context = tuple(steps[i - j] if i - j >= 0 else None for j in range(1, d + 1))
                if s is not None and None not in context:
                    seen[context][s] += 1
    want = {}
    for context, counts in seen.items():
        if sum(counts.values()) >= support:
            want[context] = (sum(counts.values()), *min(counts.items(), key=lambda kv: (-kv[1], kv[0])))
    chunk = turn_chunk("t", 8)
    tree = G.context_tree(df, "k", ["t"], "step", depth, support, chunk=chunk)
    got = {tuple(r[f"prev{i}"] for i in range(1, r["depth"] + 1)): (r["n"], r["next_step"], r["n_next"]) for r in tree.collect()}
    assert got == want

    out = G.predict_next(df, tree, "k", ["t"], "step", depth, chunk=chunk)
    found = {(r["k"], r["t"]): (r["context"], r["predicted"]) for r in out.collect()}
    assert len(found) == len(rows)
    for k, steps in by_key.items():
        for i in range(len(steps)):
            expect = (0, None)
            for d in range(1, depth + 1):
                context = tuple(steps[i - j] if i - j >= 0 else None for j in range(1, d + 1))
                if context in want:
                    expect = (d, want[context][1])
            assert found[k, i] == expect


def test_longer_histories_foresee_more(spark):
    steps = list("abcabd" * 40)  # after "ab", the step before decides
    df = spark.createDataFrame([(1, t, s) for t, s in enumerate(steps)], "k int, t int, step string")

    def hits(depth):
        tree = G.context_tree(df, "k", ["t"], "step", depth, 5)
        out = G.predict_next(df, tree, "k", ["t"], "step", depth)
        return out.where("predicted = step").count()

    assert hits(3) > hits(2) + 30

"""The bit-parallel automaton against a plain search, for short and very long paths."""

import collections
import random

import pytest

from colloquy.operators import paths as G
from colloquy.operators.scan import turn_chunk


def plain(rows, paths):
    by_key = collections.defaultdict(list)
    for k, _, s in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        by_key[k].append(s)
    places = collections.defaultdict(lambda: collections.defaultdict(set))
    for path, pos, step in paths:
        places[path][pos].add(step)
    out = {}
    for k, steps in by_key.items():
        for path, at in places.items():
            want = [at[p] for p in sorted(at)]
            n = sum(all(steps[i + j] in w for j, w in enumerate(want)) for i in range(len(steps) - len(want) + 1))
            if n:
                out[k, path] = n
    return out


def run(spark, rows, paths, chunk=None):
    df = spark.createDataFrame(rows, "k int, t int, step string")
    out = G.path_conformance(df, "k", ["t"], "step", spark.createDataFrame(paths, "path string, pos int, step string"), chunk=chunk)
    return {(r["k"], r["path"]): r["n_matches"] for r in out.collect()}


@pytest.mark.parametrize("cell", [7, 4096])
def test_equals_a_plain_search(spark, monkeypatch, cell):
    monkeypatch.setattr(G, "CELL_ROWS", cell)
    rng = random.Random(cell)
    rows = [(k, t, rng.choice(["a", "b", "c", None])) for k in range(8) for t in range(rng.randrange(0, 60))]
    rows += [(None, t, "a") for t in range(20)]
    paths = [("one", 1, "a"), ("aa", 3, "a"), ("aa", 9, "a"), ("or", 1, "a"), ("or", 2, "b"), ("or", 2, "c"), ("or", 3, "a"),
             ("none", 1, "z"), ("long", 1, "a"), ("long", 2, "a"), ("long", 3, "a"), ("long", 4, "a"), ("long", 5, "b"), ("long", 5, "a")]
    got = run(spark, rows, paths, turn_chunk("t", 5))
    assert got == plain(rows, paths) and (None, "long") in got


def test_a_path_of_500_steps(spark, monkeypatch):
    monkeypatch.setattr(G, "CELL_ROWS", 64)  # the path is longer: cells as long as the path
    rng = random.Random(4)
    path = [rng.choice("abc") for _ in range(500)]
    near = path[:400] + ["x"] + path[401:]
    steps = ["a"] * 77 + path + ["b"] * 300 + near + path + path
    rows = [(1, t, s) for t, s in enumerate(steps)] + [(2, t, s) for t, s in enumerate(path[:-1])]
    paths = [("p", i, s) for i, s in enumerate(path)] + [("p", 250, "x"), ("q", 1, "x")]
    assert run(spark, rows, paths, turn_chunk("t", 100)) == plain(rows, paths) == {(1, "p"): 3, (1, "q"): 1}


def test_no_paths_and_no_rows(spark):
    assert run(spark, [(1, 1, "a")], []) == {}
    assert run(spark, [], [("p", 1, "a")]) == {}

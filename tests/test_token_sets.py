"""I1 on several words: token-set similarity against its plain definition."""

import itertools
import random

from pyspark.sql import functions as F

from colloquy.operators import token_sets as S


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def plain(a, b):
    a, b = set(a.lower().split()), set(b.lower().split())
    if not a or not b:
        return 0.0
    texts = [" ".join(sorted(a & b) + sorted(x)) for x in ((), a - b, b - a)]
    return max(200 * lcs(x, y) / (len(x) + len(y)) if x and y else 0.0 for x, y in itertools.combinations(texts, 2))


def test_lcs_of_any_length(spark):
    rng = random.Random(8)
    cases = [("", ""), ("a", ""), ("", "a"), ("abc", "abc")] + [
        ("".join(rng.choice("abcd") for _ in range(rng.choice([1, 5, 61, 62, 63, 130]))),
         "".join(rng.choice("abcde") for _ in range(rng.choice([1, 7, 62, 140])))) for _ in range(30)]
    df = spark.createDataFrame([(i, list(a), list(b)) for i, (a, b) in enumerate(cases)], "i int, a array<string>, b array<string>")
    got = {r["i"]: r["n"] for r in df.select("i", S.lcs_length(F.col("a"), F.col("b")).alias("n")).collect()}
    assert got == {i: lcs(a, b) for i, (a, b) in enumerate(cases)}


def test_all_matches_are_found(spark):
    rng = random.Random(11)
    stems = ["ordinateur", "portable", "clavier", "souris", "ecran", "noir", "a", "de", "usb", "cle", "station"]

    def bend(w):
        w = list(w)
        if rng.random() < 0.3:
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], [w[at]] * 2, ["x"]])
        return "".join(w) or "y"

    def phrase():
        return " ".join(bend(rng.choice(stems)) for _ in range(rng.randrange(1, 5)))

    words, items = [phrase() for _ in range(120)], sorted({phrase() for _ in range(60)})
    got = {(r["id"], r["item"]): r["similarity"] for r in S.token_set_match(
        spark.createDataFrame(list(enumerate(words)), "id int, word string"),
        spark.createDataFrame([(i,) for i in items], "item string"), ["id"]).collect()}
    want = {(n, i): round(plain(w, i), 6) for n, w in enumerate(words) for i in items if plain(w, i) > 80}
    assert {k: round(v, 5) for k, v in got.items()} == {k: round(v, 5) for k, v in want.items()} and len(want) > 100


def test_order_case_accents_subsets_and_odd_rows(spark):
    words = [(1, "Clavier Sans-Fil"), (2, "fil sans clavier"), (3, "écran"), (4, "ecran large noir"), (5, None), (6, "?!"), (7, ""), (3, "écran")]
    items = [("clavier sans fil",), ("écran large",), (None,), ("...",)]
    got = sorted((r["id"], r["item"], r["similarity"]) for r in S.token_set_match(
        spark.createDataFrame(words, "id int, word string"), spark.createDataFrame(items, "item string"), ["id"]).collect())
    assert got == [(1, "clavier sans fil", 100.0), (2, "clavier sans fil", 100.0), (3, "écran large", 100.0), (4, "écran large", 100.0)]

"""Known values by a trie walk, against a plain search of every value in every text."""

import random

from colloquy.operators import intents as C


def contains(toks, value):
    return any(toks[i:i + len(value)] == value for i in range(len(toks) - len(value) + 1))


def check(spark, texts, values):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id int, text string")
    gaz = spark.createDataFrame([(" ".join(v), f"e{n % 2}") for n, v in enumerate(values)], "value string, entity string")
    got = {(r["id"], r["value"], r["entity"]) for r in C.entity_match(docs, gaz, ["id"]).collect()}
    assert got == {(i, " ".join(v), f"e{n % 2}") for i, t in enumerate(texts) for n, v in enumerate(values) if contains(t, v)}
    return got


def test_trie_walk_equals_a_plain_search(spark):
    rng = random.Random(9)
    texts = [[rng.choice("abc") for _ in range(rng.randrange(0, 60))] for _ in range(40)]
    values = [[rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 3, 4, 6]))] for _ in range(40)]
    assert check(spark, texts, values)


def test_values_of_1_to_50_tokens(spark):
    rng = random.Random(2)
    texts = [[f"w{rng.randrange(2000)}" for _ in range(300)] for _ in range(20)]
    values = []
    for n in range(1, 51):
        t = rng.choice(texts)
        at = rng.randrange(len(t) - n)
        values += [t[at:at + n], t[at:at + n][:-1] + ["other"]]
    assert len(check(spark, texts, values)) >= 50


def test_trie_of_nested_values_has_an_edge_per_branch_or_end(spark):
    values = ["a b c d", "a b", "a b c e", "x y z", "x y z"]
    df = spark.createDataFrame([(v, v.split()) for v in values], "run string, tokens array<string>").distinct()
    got = sorted((r["parent"], r["first"], r["rest"], r["node"], r["level"]) for r in C.phrase_trie(df).collect())
    assert got == [("", "a", ["b"], "a b", 1), ("", "x", ["y", "z"], "x y z", 1), ("a b", "c", [], "a b c", 2),
                   ("a b c", "d", [], "a b c d", 3), ("a b c", "e", [], "a b c e", 3)]


def test_no_values_no_texts_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, "")], "id int, text string")
    none = spark.createDataFrame([], "value string, entity string")
    assert C.entity_match(docs, none, ["id"]).count() == 0
    gaz = spark.createDataFrame([("A  B", "x"), ("a b", "x"), (None, "x"), (" ", "x")], "value string, entity string")
    got = sorted((r["id"], r["value"]) for r in C.entity_match(docs, gaz, ["id"]).collect())
    assert got == [(1, "a  b"), (1, "a b")]

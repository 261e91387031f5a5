"""The learned entity tagger: decoding against all tag sequences, spans, held-out values."""

import itertools
import random
import re

from pyspark.sql import functions as F

from colloquy.operators import tagger as T

MARKED = re.compile(r"\[([^\]]+)\]\((\w+)\)")


def test_viterbi_equals_all_sequences(spark):
    rng = random.Random(7)
    for k in (1, 2, 3):
        trans = [[rng.randrange(-2, 3) for _ in range(k)] for _ in range(k + 1)]
        cases = [[[rng.randrange(-2, 3) for _ in range(k)] for _ in range(rng.randrange(1, 6))] for _ in range(40)]
        df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x array<array<bigint>>")
        got = {r["i"]: r["p"] for r in df.select("i", T.viterbi(F.col("x"), trans).alias("p")).collect()}
        for i, x in enumerate(cases):
            def score(path):
                return sum(x[n][t] + trans[path[n - 1] if n else k][t] for n, t in enumerate(path))

            every = list(itertools.product(range(k), repeat=len(x)))
            best = max(map(score, every))
            # ties: the earlier last tag, then the earlier tag before it, and so on
            assert tuple(got[i]) == min((p for p in every if score(p) == best), key=lambda p: p[::-1])


def test_tokens_of_annotated_texts(spark):
    text = "see [New York](city) and [a]b, [x](y z) or [c](d)"
    df = spark.createDataFrame([(text,)], "text string").select(T.tagged_tokens(F.col("text"), True).alias("t"))
    got = [(r["token"], r["tag"]) for r in df.first()["t"]]
    assert got[:4] == [("see", "O"), ("New", "B-city"), ("York", "I-city"), ("and", "O")]
    assert got[4:8] == [("[", "O"), ("a", "O"), ("]", "O"), ("b", "O")]
    assert ("x", "B-y z") in got and got[-1] == ("c", "B-d")


def test_sequences_end_at_sentences_and_parts(spark, monkeypatch):
    monkeypatch.setattr(T, "PART", 4)
    rows = [(1, "a b. c! d e f g h i"), (2, None), (3, ""), (4, "x"), (4, "x")]
    out = T.sequences(spark.createDataFrame(rows, "id int, text string"), ["id"])
    got = sorted((r["id"], r["at"], [t["token"] for t in r["toks"]]) for r in out.collect())
    assert got == [(1, 0, ["a", "b", "."]), (1, 3, ["c", "!"]), (1, 5, ["d", "e", "f", "g"]), (1, 9, ["h", "i"]),
                   (4, 0, ["x"]), (4, 0, ["x"])]


def test_spans(spark):
    tags = ["O", "B-a", "I-a", "B-b", "I-b"]
    words = {"o": "O", "p": "B-a", "q": "I-a", "r": "B-b", "s": "I-b"}
    weights = spark.createDataFrame([(f"w={w}", t, 9) for w, t in words.items()], "feature string, tag string, w long")
    tagger = T.with_transitions(weights, tags)
    rows = [(1, "o p q q o r"), (2, "q q s s p p"), (3, "o o"), (4, "p . q"), (5, "r q s")]
    got = sorted((r["id"], r["start"], r["value"], r["entity"]) for r in T.find_entities(
        spark.createDataFrame(rows, "id int, text string"), tagger, ["id"]).collect())
    assert got == [(1, 1, "p q q", "a"), (1, 5, "r", "b"), (2, 0, "q q", "a"), (2, 2, "s s", "b"), (2, 4, "p", "a"),
                   (2, 5, "p", "a"), (4, 0, "p", "a"), (4, 2, "q", "a"), (5, 0, "r", "b"), (5, 1, "q", "a"), (5, 2, "s", "b")]


def _sentence(rng):
    def name():
        return rng.choice("BCDFGLMNPRST") + "".join(rng.choice("aeiou") + rng.choice("lnrst") for _ in range(rng.randrange(2, 4)))

    return rng.choice([
        f"my name is [{name()}](name) and i like it", f"please call [{name()} {name()}](name) at noon",
        f"i want to go to [{name()}](city) tomorrow", f"trains from [{name()}](city) to [{name()} {name()}](city) . thanks",
        "what is the weather like today ? fine"])


def test_values_never_seen_are_found(spark):
    rng = random.Random(1)
    train = [_sentence(rng) for _ in range(160)]
    held = [_sentence(rng) for _ in range(80)]
    seen = {v for s in train for v, _ in MARKED.findall(s)}
    gold = {(i, v, e) for i, s in enumerate(held) for v, e in MARKED.findall(s)}
    assert sum(v not in seen for _, v, _ in gold) > 0.9 * len(gold)
    model = T.fit_tagger(spark.createDataFrame([(t,) for t in train], "text string"), epochs=2, batches=4)
    plain = spark.createDataFrame([(i, MARKED.sub(r"\1", s)) for i, s in enumerate(held)], "id int, text string")
    got = {(r["id"], r["value"], r["entity"]) for r in T.find_entities(plain, model, ["id"]).collect()}
    assert 2 * len(got & gold) / (len(got) + len(gold)) > 0.9  # span F1


def test_no_annotations_give_no_entities(spark):
    model = T.fit_tagger(spark.createDataFrame([("plain words", ), (None,)], "text string"), epochs=1, batches=2)
    assert model.tags == ["O"]
    assert T.find_entities(spark.createDataFrame([(1, "a b")], "id int, text string"), model, ["id"]).count() == 0

"""C4, trained: held-out questions find their response without sharing words with it."""

import random

from colloquy.operators import intents as C
from colloquy.operators import selector as S


def bank(rng, ids=12, questions=24):
    """Questions of an id draw from its topic's question words, responses from other words; a few
    words (greetings, articles) are in all texts of both sides."""
    common = ["the", "please", "is", "a"]
    q, r = [], []
    for i in range(ids):
        asks, says = [f"ask{chr(97 + i)}{chr(97 + j)}" for j in range(8)], [f"say{chr(97 + i)}{chr(97 + j)}" for j in range(8)]
        q += [(i, " ".join(rng.sample(asks, 3) + rng.sample(common, 2))) for _ in range(questions)]
        r += [(i, " ".join(rng.sample(says, 4) + rng.sample(common, 2))) for _ in range(3)]
    return q, r


def test_held_out_questions_find_their_id_more_often_than_by_tfidf(spark):
    rng = random.Random(3)
    q, r = bank(rng)
    rng.shuffle(q)
    train, held = q[:200], q[200:]
    model = S.fit_selector(spark.createDataFrame(train, "id long, text string"), spark.createDataFrame(r, "id long, text string"), rank=16)
    items = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(r)], "item_id long, text string")
    asked = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(held)], "query long, text string")
    id_of = {n: i for n, (i, _) in enumerate(r)}

    def right(rows):
        return sum(id_of[x["item_id"]] == held[x["query"]][0] for x in rows if x["rank"] == 1)

    learned = right(S.select_responses(asked, items, model, 1).collect())
    plain = right(C.rank_responses(asked, items, ["query"], k=1).collect())
    assert learned > 0.8 * len(held) and plain < 0.4 * len(held), (learned, plain, len(held))


def test_numbers_are_gapless_and_distinct(spark):
    df = spark.createDataFrame([(f"w{i % 500}",) for i in range(1500)], "w string")
    got = [(r["w"], r["n"]) for r in S.numbered(df, "w").collect()]
    assert len(got) == 500 and sorted(n for _, n in got) == list(range(500))


def test_odd_rows(spark):
    q = spark.createDataFrame([(1, "hello there"), (None, "x y"), (2, None), (2, "other words")], "id long, text string")
    r = spark.createDataFrame([(1, "good day"), (2, "more text"), (2, "")], "id long, text string")
    model = S.fit_selector(q, r, rank=4, rounds=3)
    assert {(w["side"], w["word"]) for w in model.words.collect()} >= {("q", "hello"), ("r", "day")}
    asked = spark.createDataFrame([(1, "hello"), (2, "unknown"), (3, None)], "query long, text string")
    items = spark.createDataFrame([(1, "good day"), (7, "more text"), (8, None)], "item_id long, text string")
    got = [(x["query"], x["rank"], x["item_id"]) for x in S.select_responses(asked, items, model, 1).collect()]
    assert got == [(1, 1, 1)]

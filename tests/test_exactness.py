"""The custom exact algorithms against plain-Python brute force on random
data (fixed seeds): chunked running state, substring containment through the
gram index, pattern kNN and length-blocked fuzzy matching."""

import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from colloquy.operators import keywords as D
from colloquy.operators import recommend as I
from colloquy.operators import state as S
from colloquy.operators.scan import carry_last


def test_carry_last_random(spark):
    rnd = random.Random(7)
    rows = []
    for key in range(12):
        n = rnd.randint(1, 300)
        for turn in rnd.sample(range(5000), n):
            v = rnd.choice([None, None, None, f"v{turn}"])
            rows.append((key, turn, v))
    df = spark.createDataFrame(rows, "k int, turn int, v string")
    for inclusive in (True, False):
        for width in (1, 7, 100, 10_000):
            got = {(r["k"], r["turn"]): r["o"] for r in carry_last(
                df, "k", "turn", F.col("v"), "o", inclusive=inclusive,
                chunk=F.floor(F.col("turn") / width)).collect()}
            for key in range(12):
                seq = sorted((t, v) for k, t, v in rows if k == key)
                last = None
                for t, v in seq:
                    if inclusive and v is not None:
                        last = v
                    assert got[(key, t)] == last, (inclusive, width, key, t)
                    if not inclusive and v is not None:
                        last = v


def test_containment_random(spark):
    rnd = random.Random(11)
    alphabet = "abé"
    rows, tokens_of = [], {}
    for pair in range(3):
        for side in (0, 1):
            for tid in range(rnd.randint(1, 6)):
                toks = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 9)))
                        for _ in range(rnd.randint(1, 5))]
                text_id = pair * 100 + side * 10 + tid
                tokens_of[(pair, side, text_id)] = toks
                rows += [(pair, side, text_id, t) for t in toks]
    tt = spark.createDataFrame(rows, "pair_id int, side int, text_id int, token string")
    words = tt.select("pair_id", F.col("token").alias("word")).distinct()
    got = {(r["pair_id"], r["word"], r["side"]): r["n_containing"] for r in D.containment(words, tt).collect()}
    expected = {}
    for (pair, side, text_id), toks in tokens_of.items():
        vocab = {t for (p, _, _), ts in tokens_of.items() if p == pair for t in ts}
        for w in vocab:
            if any(w in t for t in toks):
                expected[(pair, w, side)] = expected.get((pair, w, side), 0) + 1
    assert got == expected


def _brute_knn(queries, points, k):
    out = {}
    for q, qp in queries:
        near = sorted(points, key=lambda p: (bin(qp ^ p[1]).count("1"), p[0]))[:k]
        votes = {}
        for _, _, lab in near:
            votes[lab] = votes.get(lab, 0) + 1
        best = min(votes.items(), key=lambda kv: (-kv[1], kv[0]))
        out[q] = best
    return out


def test_knn_random(spark):
    rnd = random.Random(3)
    bits = 4
    points = [(i, rnd.randrange(1 << bits), rnd.randrange(3)) for i in range(60)]
    queries = [(q, rnd.randrange(1 << bits)) for q in range(40)]
    pdf = spark.createDataFrame([(i, [p], la) for i, p, la in points], "point_id long, pattern array<bigint>, label int")
    qdf = spark.createDataFrame([(q, [p]) for q, p in queries], "q long, pattern array<bigint>")
    for k in (1, 7, 60, 80):
        got = {r["q"]: (r["predicted_label"], r["votes"]) for r in I.knn_label(qdf, pdf, k, ["q"]).collect()}
        assert got == _brute_knn(queries, points, k), k


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_fuzzy_random(spark):
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 12))) for _ in range(15)]
    words = []
    for i in range(200):
        w = list(rnd.choice(vocab))
        for _ in range(rnd.randint(0, 3)):
            op = rnd.randrange(3)
            pos = rnd.randrange(len(w) + 1)
            if op == 0 and w:
                w.pop(min(pos, len(w) - 1))
            elif op == 1:
                w.insert(pos, rnd.choice("abcd"))
            elif w:
                w[min(pos, len(w) - 1)] = rnd.choice("abcd")
        words.append((i, "".join(w) or "a"))
    wdf = spark.createDataFrame(words, "id int, word string")
    vdf = spark.createDataFrame([(v,) for v in set(vocab)], "item string")
    got = {(r["id"], r["item"]) for r in I.fuzzy_match(wdf, vdf, ["id"]).collect()}
    expected = {(i, v) for i, w in words for v in set(vocab)
                if 100.0 * (1 - _lev(w, v) / max(len(w), len(v))) > 80}
    assert got == expected


def test_carry_over_random(spark):
    rnd = random.Random(5)
    rows = []
    for user in (1, 2, None):
        for n in range(60):
            session = f"2024-0{rnd.randint(1, 3)}-{rnd.randint(10, 28)} {rnd.randint(10, 23)}:00:00"
            rows.append((user, session, n, rnd.choice(["a", "b", None]), rnd.choice([None, "x", "y", "z"])))
    df = spark.createDataFrame(rows, "user int, session string, n int, slot string, value string").withColumn(
        "session_start", F.to_timestamp_ntz("session"))
    got = sorted(map(str, S.carry_over(df, "user", ["n"]).select(
        "user", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session"), "slot", "value").collect()))
    want = []
    for user in (1, 2, None):
        mine = [r for r in rows if r[0] == user]
        for session in {r[1] for r in mine}:
            for slot in ("a", "b", None):
                before = [r for r in mine if r[3] == slot and r[1] <= session]
                if before:
                    want.append(str(Row(user=user, session=session, slot=slot, value=max(before, key=lambda r: (r[1], r[2]))[4])))
    assert got == sorted(want) and len(want) > 100
    assert S.carry_over(df.where("false"), "user", ["n"]).count() == 0

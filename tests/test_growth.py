"""Steps that must not grow faster than their input: what they compare, hold or carry."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from colloquy.operators import intents as C
from colloquy.operators import neighbours as N
from colloquy.operators import tagger as T
from colloquy.plans.registry import load_all
from colloquy.session import scratch_path


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_a_token_meets_its_word_once(spark):
    """The tagger joins one row per token, not one per feature (F1)."""
    weights = spark.createDataFrame([("w=b", "B-x", 3), ("p=a", "B-x", 2), ("n=", "O", 1), ("p=", "O", 1)],
                                    "feature string, tag string, w long")
    model = T.with_transitions(weights, ["O", "B-x", "I-x"])
    assert model.ends == [[1, 0, 0], [1, 0, 0]]
    seqs = T.sequences(spark.createDataFrame([(1, "a b c"), (2, "b"), (3, "c a b")], "id int, text string"), ["id"])
    words = {r["token"]: r["w"] for r in T.word_scores(seqs.select(F.explode("toks.token").alias("token")).distinct(), model).collect()}
    assert words == {"a": [0] * 3 + [0, 2, 0] + [0] * 3, "b": [0, 3, 0] + [0] * 6, "c": [0] * 9}
    paths = {r["id"]: r["path"] for r in seqs.join(T.decode(seqs, model), "_s").collect()}
    assert paths == {1: [0, 1, 0], 2: [1], 3: [0, 0, 1]}


def test_long_texts_of_many_sentences(spark):
    """A sentence carries its own tokens only (F1): 4,000 sentences in one text."""
    df = spark.createDataFrame([(1, "one two . " * 4_000)], "id int, text string")
    got = T.sequences(df, ["id"]).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("toks")).alias("t"), F.max("at").alias("m")).first()
    assert (got["n"], got["t"], got["m"]) == (4_000, 12_000, 11_997)


def test_vectors_meet_in_blocks(spark, monkeypatch):
    """Pairs are compared inside groups of bounded size, and copies beyond the k first stay there."""
    monkeypatch.setattr(N, "BLOCK", 32)
    monkeypatch.setattr(N, "ASKED", 8)
    monkeypatch.setattr(N, "CELLS", 100)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)], i % 3) for i in range(200)]
    rows += [(1000 + i, rows[i % 2][1], 1) for i in range(600)]  # two large groups of copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    asked = df.where("vec_id < 40")
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # else all groups of so few rows are in one partition
    spark.conf.set(small, "false")
    try:
        got = {(r["query"], r["rank"]): (r["vec_id"], r["cosine"]) for r in N.dense_neighbours(asked, df, 4).collect()}
    finally:
        spark.conf.set(small, "true")
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    for q in range(40):
        best = sorted((-round(float(c), 6), i) for (i, _, _), c in zip(rows, x @ x[q]) if i != q)[:4]
        assert [got[q, n + 1] for n in range(4)] == [(i, -c) for c, i in best]


def test_a_block_lets_only_few_copies_go(spark):
    """600 copies of one vector: of a block no more than k pairs leave for a query."""
    vectors = pa.chunked_array([pa.StructArray.from_arrays(
        [pa.array([[1.0, 0.0]] * 600, pa.list_(pa.float64())), pa.array([1.0] * 600)], ["v", "size"])])
    right = pa.table({"s": pa.array(range(600, 0, -1)), "sv": vectors, "n": pa.array([1] * 600)})
    left = pa.table({"q": pa.array([5, 6]), "qv": vectors.slice(0, 2), "theta": pa.array([0.1, 0.1])})
    met = N._meet(N.chords, 0, 4, lambda d: (d * 0, d == d))(left, right).to_pydict()
    assert met["q"] == [5] * 4 + [6] * 4 and sorted(met["s"]) == [1, 1, 2, 2, 3, 3, 4, 4]


def test_common_words_are_not_shuffled(spark, monkeypatch):
    """C3 meets the commonest tokens by a broadcast; however few those are, the scores stay."""
    docs = spark.createDataFrame([(i % 7, f"the the a w{chr(97 + i % 20)} x{chr(97 + i % 3)}", i % 2) for i in range(60)]
                                 + [(100, None, 1), (101, "", 0), (None, "the never seen", None)], "id int, text string, label int")
    model = C.fit_intents(docs)
    result = []
    for frequent in (10_000, 3, 1):
        monkeypatch.setattr(C, "FREQUENT", frequent)
        result.append(sorted(map(str, C.predict_intents(model, docs, ["id"]).collect())))
    assert result[0] == result[1] == result[2] and len(result[0]) == 10
    plan = _plan(C.predict_intents(model, docs, ["id"]))
    assert "LeftAnti" in plan and "LeftOuter" in plan


def test_fact_stream_reads_many_files(spark, monkeypatch, tmp_path):
    """Each third of j4_stream_facts is one batch of as many files as the scan has parts."""
    source = str(tmp_path / "events")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6).write.parquet(f"{source}/events.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    written = []
    from colloquy.plans import stream_queries as Q
    monkeypatch.setattr(Q, "scratch_path", lambda s, n: written.append(scratch_path(s, n)) or written[-1])
    try:
        got = Q.j4_facts(spark, source)
        rows = sorted(map(str, got.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    import glob
    assert all(len(glob.glob(f"{written[0]}/events{i}/part-*")) > 1 for i in range(3))
    want = load_all()["j4_stream_facts"].fn(spark, "/root/testdata/sf0.001")
    assert rows == sorted(map(str, want.collect())) and rows

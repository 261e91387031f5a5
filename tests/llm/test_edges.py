"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows,
empty tables and clashing column names."""

import pytest

import corpus_pipeline
from colloquy.llm import (decontaminate, fim, langid, minhash, mixing, pii, quality, resample, secrets, sharding, substrings,
                          toxicity, vectors)

LONG = " ".join(f"word{i % 977}x{i // 977}" for i in range(60_000)) + " " + "z" * 50_000
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, name string, id long, n long, shard int, "
          "slot string, key string, band long, row int, component string, _doc string, _p int, x int, block int")


def table(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), "c", 1, 2, 3, "s", "k", 4, 5, "q", "d", 6, 7, 8) for r in rows], SCHEMA)


ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (1, "another text for the same id that shares nothing with it", "en", "b"),
    (2, None, "en", "a"), (3, "", "fr", None), (4, " \t\n ", None, "b"), (5, "12 ?!", "de", "b"),
    (6, LONG, "en", "a"), (7, LONG, None, "a"), (None, "a text without an id but with words enough", "en", "a"),
    (None, None, None, None), (8, "the quick brown fox jumps over the lazy dog again and again", "fr", "c"),
    (9, "  word glued \U0001d11e\U0001d11e", "es", "c"), (10, "one", "en", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, ROWS).where("false")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "jumps over the lazy dog"), (2, None), (3, ""), (None, "no id for this item here")],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 0), (None, 1, 1), (9, None, None)],
                                 "doc_id long, quality int, toxic int")


OPS = {
    "pii": lambda d, b, la: pii.find(d),
    "toxicity": lambda d, b, la: toxicity.score(d, la),
    "minhash": lambda d, b, la: minhash.components(d),
    "langid": lambda d, b, la: langid.identify(d, langid.fit(d)),
    "secrets": lambda d, b, la: secrets.scan(d),
    "mixing": lambda d, b, la: mixing.schedule(d),
    "sharding": lambda d, b, la: sharding.shard(d),
    "substrings": lambda d, b, la: substrings.remove_repeats(d),
    "resample": lambda d, b, la: resample.resample(d, b),
    "quality": lambda d, b, la: quality.judge(d),
    "fim": lambda d, b, la: fim.fill_in_middle(d),
}


@pytest.mark.parametrize("name", sorted(OPS))
def test_one_row_per_row(odd, empty, bench, labels, name):
    assert OPS[name](odd, bench, labels).count() == len(ROWS)
    assert OPS[name](empty, bench, labels).count() == 0
    assert OPS[name](empty, bench.where("false"), labels.where("false")).count() == 0


def test_leaks(odd, empty, bench):
    got = decontaminate.find_leaks(odd, bench)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(1, 1), (1, 1), (8, 1)]
    assert decontaminate.find_leaks(empty, bench).count() == 0
    assert decontaminate.find_leaks(odd, bench.where("false")).count() == 0


def test_defined_results(odd, labels):
    parts = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in minhash.components(odd).collect())
    assert ("2", 0, "2", True) in parts and ("8", 8, "1", False) in parts and ("7", 60_000 + 1 - 4, "6", False) in parts
    assert ("None", 0, "None", True) in parts
    lang = {r["doc_id"]: r for r in langid.identify(odd, langid.fit(odd)).collect()}
    assert [lang[i]["lang_pred"] for i in (2, 3, 4, 5)] == ["und"] * 4 and lang[None]["held_out"]
    cut = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in substrings.remove_repeats(odd).collect())
    assert ("6", 60_001, 60_001) in cut and ("8", 12, 0) in cut and ("2", 0, 0) in cut
    size = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in sharding.shard(odd).where("doc_id in (2, 3)").collect()}
    assert size == {2: (16, 0), 3: (16, 0)}


def test_vectors(spark):
    rows = [(1, [1.0, 0.0], 1, 7), (2, None, 1, 7), (None, [1.0, 0.0], 1, 7), (3, [0.0, 0.0], None, 7), (1, [1.0, 0.0], 1, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cls int")
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in vectors.near_vectors(df).collect())
    assert got == [("1", 2, "1", True), ("1", 2, "1", True), ("2", 0, "2", True), ("3", 0, "3", True), ("None", 2, "1", False)]
    assert vectors.near_vectors(df.where("false")).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, odd, empty, name, stage):
    sf = "/root/testdata/sf0.001"
    last = (name, stage) == corpus_pipeline.STAGES[-1]
    for docs in (odd, empty):
        out = stage(spark, docs, sf)
        assert last or out.columns == docs.columns
        assert {"doc_id", "text"} <= set(out.columns)
        out.count()


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 100 < len(ids) < 200
    assert {"text", "lang", "source", "n_chars", "shard", "slot"} <= set(out.columns)

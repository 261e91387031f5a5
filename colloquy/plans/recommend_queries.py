"""Recommendation queries.

I1 folds a misspelled form of each event's type (k % 3: as is, one letter dropped,
upper case with accents) and matches it to the event types. I2 is one-hot over the
event types. For I3-I5 an item is an event type in the lower or upper half of k
(``view-0``, ``view-1``, ...: ten items). The points are a user's weeks (of seven days
of the year), read from the item matrix of A8; a user's role is user_id % 7. A request
(user_id, day) asks for the items of that day. A role's items are those of its first
point (smallest number), as the reference takes the first matrix row of a role.
The dense form asks for the vectors whose id is divisible by 100, among all ``embeddings``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.operators import neighbours as N
from colloquy.operators import recommend as I
from colloquy.operators import token_sets as S
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query, sql_lit as L
from colloquy.session import materialize, read_table, scratch_path
from colloquy.sources import banks as A

ITEMS = ["click", "error", "purchase", "signup", "view"]
K = 5
_WORD_SQL = """CASE json_extract_string(props, '$.k')::INTEGER % 3
    WHEN 0 THEN event_type
    WHEN 1 THEN substr(event_type, 1, json_extract_string(props, '$.k')::INTEGER % length(event_type))
             || substr(event_type, json_extract_string(props, '$.k')::INTEGER % length(event_type) + 2)
    ELSE upper(replace(replace(event_type, 'i', 'î'), 'e', 'é')) END"""


def _said():
    et, k = F.col("event_type"), F.col("k")
    p = k % F.char_length(et)
    return (F.when(k % 3 == 0, et)
            .when(k % 3 == 1, F.concat(F.substr(et, F.lit(1), p), F.substr(et, p + 2, F.char_length(et))))
            .otherwise(F.upper(F.replace(F.replace(et, F.lit("i"), F.lit("î")), F.lit("e"), F.lit("é")))))


@query("i1_fuzzy_match", "I1", f"""
WITH w AS (SELECT event_id, {_WORD_SQL} AS word FROM events),
f AS (SELECT event_id, word, strip_accents(lower(trim(word))) AS fw FROM w),
v(item) AS (VALUES {", ".join(f"({L(i)})" for i in ITEMS)})
SELECT DISTINCT event_id, word, item,
  round(100.0 * (1.0 - levenshtein(fw, item)::DOUBLE / greatest(length(fw), length(item))), 6) AS similarity
FROM f, v
WHERE 100.0 * (1.0 - levenshtein(fw, item)::DOUBLE / greatest(length(fw), length(item))) > 80""")
def i1(spark, sf_dir):
    ev = X.events(spark, sf_dir, "event_id", "event_type", "k")
    words = ev.select("event_id", _said().alias("word"))
    vocab = spark.createDataFrame([(i,) for i in ITEMS], "item string")
    return I.fuzzy_match(words, vocab, ["event_id"])


# Items of two words; what a user says is the misspelled type and another word, in either order.
PHRASES = [f"{a} {b}" for a in ITEMS for b in ("page", "panier")]
_SAID_SQL = f"""CASE WHEN json_extract_string(props, '$.k')::INTEGER % 2 = 0 THEN {_WORD_SQL} || ' page'
    ELSE 'Panniers ' || {_WORD_SQL} END"""
_LCS_SQL = """list_reduce(list_prepend(list_transform(range(0, length({y}) + 1), lambda z: 0::BIGINT), list_transform(
    string_split({x}, ''), lambda c: list_transform(string_split({y}, ''), lambda d: (c = d)::BIGINT))),
    lambda row, hit: list_reduce(list_prepend([0::BIGINT], list_transform(range(1, len(hit) + 1), lambda j: [
        CASE WHEN hit[j] = 1 THEN row[j] + 1 ELSE row[j + 1] END])), lambda acc, v: list_append(acc, greatest(acc[len(acc)], v[1]))))[-1]"""


@query("i1_token_sets", "I1", f"""
WITH w AS (SELECT event_id, {_SAID_SQL} AS word FROM events),
u AS (SELECT DISTINCT word, list_sort(list_distinct(regexp_extract_all(strip_accents(lower(trim(word))), '[a-z0-9]+'))) AS a FROM w),
v AS (SELECT item, list_sort(list_distinct(string_split(item, ' '))) AS b FROM (VALUES {", ".join(f"({L(i)})" for i in PHRASES)}) AS t(item)),
p AS (SELECT word, item, list_sort(list_intersect(a, b)) AS s, list_sort(list_filter(a, lambda x: NOT list_contains(b, x))) AS o1,
        list_sort(list_filter(b, lambda x: NOT list_contains(a, x))) AS o2 FROM u, v WHERE len(a) > 0),
t AS (SELECT word, item, array_to_string(s, ' ') AS t0, array_to_string(list_concat(s, o1), ' ') AS t1,
        array_to_string(list_concat(s, o2), ' ') AS t2 FROM p),
r AS (SELECT word, item, round(greatest(
        CASE WHEN t0 = '' THEN 0 ELSE 200.0::DOUBLE * length(t0) / (length(t0) + length(t1)) END,
        CASE WHEN t0 = '' THEN 0 ELSE 200.0::DOUBLE * length(t0) / (length(t0) + length(t2)) END,
        200.0::DOUBLE * {_LCS_SQL.format(x="t1", y="t2")} / (length(t1) + length(t2))), 6) AS similarity FROM t)
SELECT event_id, word, item, similarity FROM w JOIN r USING (word) WHERE similarity > 80""")
def i1_sets(spark, sf_dir):
    ev = X.events(spark, sf_dir, "event_id", "event_type", "k")
    word = F.when(F.col("k") % 2 == 0, F.concat(_said(), F.lit(" page"))).otherwise(F.concat(F.lit("Panniers "), _said()))
    return S.token_set_match(ev.select("event_id", word.alias("word")),
                             spark.createDataFrame([(p,) for p in PHRASES], "item string"), ["event_id"])


@query("i2_one_hot", "I2", f"""
SELECT user_id, {", ".join(f"max((event_type = {L(i)})::INTEGER) AS {i}" for i in ITEMS)} FROM events GROUP BY user_id""")
def i2(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "event_type")
    return I.one_hot(ev, ["user_id"], "event_type", ITEMS)


HALVES = [f"{i}-{h}" for i in ITEMS for h in (0, 1)]
_HALF_SQL = "event_type || '-' || (json_extract_string(props, '$.k')::INTEGER // 50)::VARCHAR"
_ITEM_BITS_SQL = "(VALUES " + ", ".join(f"({L(it)}, {1 << i})" for i, it in enumerate(HALVES)) + ") AS ib(item, bit)"
_KNN_SQL = f"""
ev AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, user_id * 100 + dayofyear(ts) // 7 AS point_id,
         {_HALF_SQL} AS item FROM events),
p AS (SELECT point_id, point_id // 100 % 7 AS label, sum(DISTINCT ib.bit)::INTEGER AS pattern
      FROM ev JOIN {_ITEM_BITS_SQL} USING (item) GROUP BY ALL),
q AS (SELECT user_id, day, sum(DISTINCT ib.bit)::INTEGER AS pattern FROM ev JOIN {_ITEM_BITS_SQL} USING (item) GROUP BY ALL),
qp AS (SELECT DISTINCT pattern FROM q),
d AS (SELECT qp.pattern, p.point_id, p.label, bit_count(xor(qp.pattern, p.pattern)) AS dist FROM qp, p),
r AS (SELECT *, row_number() OVER (PARTITION BY pattern ORDER BY dist, point_id) AS rn FROM d),
v AS (SELECT pattern, label, count(*) AS votes FROM r WHERE rn <= {K} GROUP BY ALL),
best AS (SELECT pattern, label AS predicted_label, votes FROM
         (SELECT *, row_number() OVER (PARTITION BY pattern ORDER BY votes DESC, label) AS rn FROM v) WHERE rn = 1),
knn AS (SELECT user_id, day, predicted_label, votes FROM q JOIN best USING (pattern))"""


def _asked(spark, sf_dir):
    ev = X.events(spark, sf_dir, "user_id", "day", "ts", "event_type", "k")
    half = F.concat_ws("-", "event_type", F.expr("cast(k div 50 as string)"))
    point = F.col("user_id") * 100 + F.expr("dayofyear(ts) div 7")
    return ev.select("user_id", "day", point.alias("point_id"), half.alias("item"))


def _points(spark, sf_dir):
    """Item matrix (A8) written and read back, one pattern per user and week."""
    wide = I.one_hot(_asked(spark, sf_dir), ["point_id"], "item", HALVES).withColumnRenamed("point_id", "role")
    path = scratch_path(spark, "item-matrix")
    A.write_item_matrix(wide, path)
    rows = A.read_item_matrix(spark, path, "role", HALVES)
    point = F.col("role").cast("bigint")
    return I.item_pattern(rows, ["role"], "item", HALVES).select(
        point.alias("point_id"), F.expr("cast(role as bigint) div 100 % 7").alias("label"), "pattern")


REQ = ["user_id", "day"]


def _predicted(spark, sf_dir, points):
    q = I.item_pattern(_asked(spark, sf_dir), REQ, "item", HALVES)
    return I.knn_label(q, points, K, REQ)


@query("i3_knn_label", "I3", f"WITH {_KNN_SQL} SELECT * FROM knn")
def i3(spark, sf_dir):
    return _predicted(spark, sf_dir, _points(spark, sf_dir))


@query("i3_dense_knn", "I3", f"""
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
n AS (SELECT *, sqrt(list_dot_product(v, v)) AS size FROM e WHERE list_dot_product(v, v) > 0 AND isfinite(list_dot_product(v, v))),
d AS (SELECT q.vec_id AS query, p.vec_id, p.label, round(list_dot_product(q.v, p.v) / (q.size * p.size), 6) AS cosine
      FROM n q JOIN n p ON p.vec_id <> q.vec_id AND p.label IS NOT NULL AND len(p.v) = len(q.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY cosine DESC, vec_id) AS rank FROM d),
v AS (SELECT query, label, count(*) AS votes FROM r WHERE rank <= {K} GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY votes DESC, label) AS rn FROM v)
SELECT r.query, r.rank::INTEGER AS rank, r.vec_id, r.cosine, r.label, b.label AS predicted_label, b.votes
FROM r JOIN b ON b.query = r.query AND b.rn = 1 WHERE r.rank <= {K}""")
def i3_dense(spark, sf_dir):
    points = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    near = materialize(N.dense_neighbours(points.where("vec_id % 100 = 0"), points, K), "dense-knn")
    return near.join(N.majority(near), "query")


def _role_items(points):
    first = points.groupBy("label").agg(F.min_by("pattern", "point_id").alias("pattern"))
    return first.select(F.col("label").alias("predicted_label"), F.explode(I.pattern_items(F.col("pattern"), HALVES)).alias("item"))


_MISSING_SQL = f"""
ri AS (SELECT label, arg_min(pattern, point_id) AS pattern FROM p GROUP BY label),
miss AS (SELECT k.user_id, k.day, ib.item, ib.bit FROM knn k JOIN ri ON ri.label = k.predicted_label
         JOIN {_ITEM_BITS_SQL} ON (ri.pattern & ib.bit) <> 0
         WHERE NOT EXISTS (SELECT 1 FROM ev e WHERE e.user_id = k.user_id AND e.day = k.day AND e.item = ib.item))"""


def _missing(spark, sf_dir):
    asked = _asked(spark, sf_dir).select(*REQ, "item").distinct()
    points = materialize(_points(spark, sf_dir), "item-points")  # for the neighbours and the roles
    return I.missing_items(_predicted(spark, sf_dir, points), _role_items(points), asked, REQ)


@query("i4_missing_items", "I4", f"WITH {_KNN_SQL}, {_MISSING_SQL} SELECT user_id, day, item FROM miss")
def i4(spark, sf_dir):
    return _missing(spark, sf_dir)


@query("i5_list_phrase", "I5", f"""WITH {_KNN_SQL}, {_MISSING_SQL},
a AS (SELECT user_id, day, list(item ORDER BY bit) AS arr FROM miss GROUP BY user_id, day)
SELECT user_id, day, array_to_string(list_concat(arr[1:len(arr) - 1], ['et ' || arr[len(arr)]]), ', ') AS phrase FROM a""")
def i5(spark, sf_dir):
    order = F.coalesce(*[F.when(F.col("item") == it, F.lit(i)) for i, it in enumerate(HALVES)])
    return I.list_phrase(_missing(spark, sf_dir), REQ, "item", order)

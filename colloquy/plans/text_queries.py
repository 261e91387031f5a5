"""Scalar text-function queries (B1-B10) over whole ``documents``,
``events`` and ``conversations`` texts.

``documents`` holds no C1 characters, spans or addresses, so each query
injects them with an expression both engines evaluate the same way.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colloquy.functions import text as B
from colloquy.plans import fixtures as X
from colloquy.plans.registry import query, sql_lit as L

# Injection used by B1: a -> U+0092, e -> U+009C, i -> U+0080, o -> U+00A0
INJECT_FROM = "aeio"
INJECT_TO = B.C1_QUOTE + B.C1_OE + B.C1_EURO + B.NBSP
_INJECT_SQL = f"translate(text, 'aeio', chr(146) || chr(156) || chr(128) || chr(160))"


def _injected(spark, sf_dir):
    d = X.documents(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", F.translate("text", INJECT_FROM, INJECT_TO).alias("text"))


@query("b1_repair_text", "B1", f"""
WITH d AS (SELECT doc_id, {_INJECT_SQL} AS text FROM documents)
SELECT doc_id,
  replace(translate(text, chr(146) || chr(128) || chr(160), '''€ '), chr(156), 'oe') AS repaired_full,
  replace(translate(text, chr(146) || chr(128), '''€'), chr(156), 'oe') AS repaired_no_nbsp,
  replace(text, chr(160), ' ') AS repaired_nbsp_only
FROM d""")
def b1(spark, sf_dir):
    d = _injected(spark, sf_dir).select(
        "doc_id", B.repair_text("text", "no_nbsp").alias("repaired_no_nbsp"),
        B.repair_text("text", "nbsp_only").alias("repaired_nbsp_only"))
    # the full repair is the three C1 repairs, then the non-breaking space
    return d.withColumn("repaired_full", B.repair_text("repaired_no_nbsp", "nbsp_only"))


_KEY_SQL = """CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 'faq'
    ELSE 'faq/' || event_id::VARCHAR END"""


@query("b2_intent_id", "B2", f"""
SELECT event_id, {_KEY_SQL} AS key, nullif(split_part({_KEY_SQL}, '/', 2), '') AS intent_id FROM events""")
def b2(spark, sf_dir):
    ev = X.events(spark, sf_dir, "event_id", "event_type")
    key = (F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
           .when(F.col("event_type") == "view", F.lit("faq"))
           .otherwise(F.concat(F.lit("faq/"), F.col("event_id").cast("string"))))
    return ev.select("event_id", key.alias("key")).withColumn("intent_id", B.intent_id("key"))


# Addresses built from each whole document (local part: md5 of the text);
# the language picks the form: en valid, fr wrong domain, de trailing
# newline and a repeated last domain letter, es text before the address.
def _local_part():
    return F.md5(F.col("text"))


_LOCAL_SQL = "md5(text)"


@query("b3_valid_email", "B3", f"""
WITH a AS (SELECT doc_id, CASE lang
    WHEN 'en' THEN {_LOCAL_SQL} || '@example.com'
    WHEN 'fr' THEN {_LOCAL_SQL} || '@exemple.com'
    WHEN 'de' THEN {_LOCAL_SQL} || '@examplee.com' || chr(10)
    ELSE 'contact ' || {_LOCAL_SQL} || '@example.com' END AS address FROM documents)
SELECT doc_id, address,
  CASE WHEN regexp_full_match(address, {L(B.email_pattern())}) THEN address END AS email,
  CASE WHEN NOT regexp_full_match(address, {L(B.email_pattern())}) THEN 'utter_email_invalid' END AS error
FROM a""")
def b3(spark, sf_dir):
    d = X.documents(spark, sf_dir, "doc_id", "lang", "text")
    lang = F.col("lang")
    local = _local_part()
    addr = (F.when(lang == "en", F.concat(local, F.lit("@example.com")))
            .when(lang == "fr", F.concat(local, F.lit("@exemple.com")))
            .when(lang == "de", F.concat(local, F.lit("@examplee.com\n")))
            .otherwise(F.concat(F.lit("contact "), local, F.lit("@example.com"))))
    a = d.select("doc_id", addr.alias("address"))
    return a.select("doc_id", "address", B.valid_email("address").alias("email"),
                    B.email_error("address").alias("error"))


_NOTE_SQL = "CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 'abc' " \
            "ELSE (json_extract_string(props, '$.k')::INTEGER % 10)::VARCHAR END"


@query("b4_valid_rating", "B4", f"""
SELECT event_id, {_NOTE_SQL} AS note_text,
  CASE WHEN {_NOTE_SQL} IN ('1', '2', '3', '4', '5') THEN {_NOTE_SQL} END AS note,
  CASE WHEN {_NOTE_SQL} IN ('1', '2', '3', '4', '5') THEN NULL ELSE {L(B.RATING_MESSAGE)} END AS message
FROM events""")
def b4(spark, sf_dir):
    ev = X.events(spark, sf_dir, "event_id", "event_type", "k")
    et = F.col("event_type")
    text = (F.when(et == "error", F.lit(None).cast("string")).when(et == "view", F.lit("abc"))
            .otherwise((F.col("k") % 10).cast("string")))
    n = ev.select("event_id", text.alias("note_text"))
    return n.select("event_id", "note_text", B.valid_rating("note_text").alias("note"),
                    B.rating_message("note_text").alias("message"))


# Texts written like str(datetime): purchase rows lose their fraction,
# error rows are malformed.
_TS_TEXT_SQL = """CASE event_type WHEN 'error' THEN 'le ' || strftime(ts, '%d/%m/%Y')
    WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END"""


@query("b5_parse_event_time", "B5", f"""
SELECT event_id, {_TS_TEXT_SQL} AS ts_text,
  strftime(try_strptime({_TS_TEXT_SQL}, ['%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S']), '%Y-%m-%d %H:%M:%S.%f') AS parsed
FROM events""")
def b5(spark, sf_dir):
    ev = X.events(spark, sf_dir, "event_id", "event_type", "ts")
    et = F.col("event_type")
    text = (F.when(et == "error", F.concat(F.lit("le "), F.date_format("ts", "dd/MM/yyyy")))
            .when(et == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    t = ev.select("event_id", text.alias("ts_text"))
    parsed = B.parse_event_time("ts_text")
    return t.select("event_id", "ts_text", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))


@query("b6_format_confidence", "B6", """
SELECT event_id, round(100.0::DOUBLE * (json_extract_string(props, '$.k')::INTEGER / 100.0::DOUBLE), 2)::VARCHAR || ' %'
  AS confidence_text FROM events""")
def b6(spark, sf_dir):
    ev = X.events(spark, sf_dir, "event_id", "k")
    return ev.select("event_id", B.format_confidence(F.col("k").cast("double") / F.lit(100.0)).alias("confidence_text"))


# --- fixed values: templates with holes (the reference's sentences), joined
# on the template name chosen per turn role --------------------------------
TEMPLATES = [
    ("utter_dont_understand", "Pardon, je n'ai compris que {name} de votre question"),
    ("utter_ask_user_password", "Merci de confirmer votre identité en renseignant le mot de passe qui "
                                "vient d'être envoyé à l'adresse {email}"),
]


@query("b7_render_template", "B7", f"""
WITH t(name, template) AS (VALUES {", ".join(f"({L(n)}, {L(t)})" for n, t in TEMPLATES)}),
c AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'utter_dont_understand' ELSE 'utter_ask_user_password' END AS name,
        (turn * 10)::VARCHAR || ' %' AS name_value, 'user' || conv_id::VARCHAR || '@example.com' AS email_value
      FROM conversations)
SELECT c.conv_id, c.turn, replace(replace(t.template, '{{name}}', c.name_value), '{{email}}', c.email_value) AS rendered
FROM c JOIN t USING (name)""")
def b7(spark, sf_dir):
    conv = X.conversations(spark, sf_dir)
    templates = F.broadcast(spark.createDataFrame(TEMPLATES, "name string, template string"))
    c = conv.select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", F.lit("utter_dont_understand"))
        .otherwise(F.lit("utter_ask_user_password")).alias("name"),
        F.concat((F.col("turn") * 10).cast("string"), F.lit(" %")).alias("name_value"),
        F.concat(F.lit("user"), F.col("conv_id").cast("string"), F.lit("@example.com")).alias("email_value"),
    )
    return c.join(templates, "name").select(
        "conv_id", "turn",
        B.render_template("template", name=F.col("name_value"), email=F.col("email_value")).alias("rendered"))


@query("b8_fold_text", "B8", """
SELECT doc_id, strip_accents(lower(trim(text))) AS folded FROM documents""")
def b8(spark, sf_dir):
    d = X.documents(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", B.fold_text("text").alias("folded"))


# Annotate the keyword "des" as entity "mot" in every text.
ANNOTATE_KW, ANNOTATE_ENTITY = "des", "mot"
_ANNOTATED_SQL = f"""SELECT doc_id, CASE WHEN contains(text, '{ANNOTATE_KW}')
    THEN replace(text, '{ANNOTATE_KW}', '[{ANNOTATE_KW}]({ANNOTATE_ENTITY})') ELSE text END AS text
  FROM documents"""


def annotated(spark, sf_dir):
    d = X.documents(spark, sf_dir, "doc_id", "text")
    return d.select("doc_id", B.annotate_entity("text", ANNOTATE_KW, ANNOTATE_ENTITY).alias("text"))


@query("b9_annotate_entity", "B9", _ANNOTATED_SQL)
def b9(spark, sf_dir):
    return annotated(spark, sf_dir)


# B10 input: the annotated text plus malformed forms in every text.
_MALFORMED_SUFFIX = " [a]b [a][b] [x](y)"
_B10_SQL = f"SELECT doc_id, text || {L(_MALFORMED_SUFFIX)} AS text FROM ({_ANNOTATED_SQL})"


def _b10_input(spark, sf_dir):
    return annotated(spark, sf_dir).select("doc_id", F.concat("text", F.lit(_MALFORMED_SUFFIX)).alias("text"))


@query("b10_extract_spans", "B10", f"""
WITH a AS ({_B10_SQL}),
s AS (SELECT doc_id, regexp_extract_all(text, {L(B.SPAN_PATTERN)}, 1) AS v,
        regexp_extract_all(text, {L(B.SPAN_PATTERN)}, 2) AS e FROM a)
SELECT doc_id, i::INTEGER AS pos, v[i] AS value, e[i] AS entity
FROM s, range(1, len(v) + 1) r(i)""")
def b10(spark, sf_dir):
    return B.extract_annotations(_b10_input(spark, sf_dir), "text", ["doc_id"])


@query("b10_plain_text", "B10", f"""
SELECT doc_id, regexp_replace(text, {L(B.SPAN_PATTERN)}, '\\1', 'g') AS plain FROM ({_B10_SQL})""")
def b10_plain(spark, sf_dir):
    return _b10_input(spark, sf_dir).select("doc_id", B.plain_text("text").alias("plain"))

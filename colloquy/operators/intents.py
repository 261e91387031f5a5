"""Intent ranking and the confidence gate.

Rankings are rows ``(request keys..., key, confidence, rank)``. The gate
needs only the two best candidates, so ranking is cut with
``row_number() <= k``: Spark plans that as a partial ``WindowGroupLimit``
on the map side, so a request with millions of candidates ships at most k
rows per map task into the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.text import intent_id
from colloquy.session import materialize

# --- fixed values (thresholds and texts the reference uses) ---------------
LOW_CONFIDENCE = 0.4      # top confidence strictly below: not understood
CONFUSION_MARGIN = 0.2    # top minus second strictly below: confused
OUTCOME_NO_RANKING = "no_ranking"
OUTCOME_NOT_UNDERSTOOD = "not_understood"
OUTCOME_CONFUSED = "confused"
OUTCOME_ANSWER = "answer"
CLARIFY_TITLE = "Pardon, je ne suis pas sur d'avoir bien compris 🤔 me parlez-vous de..."
OTHER_TITLE = "autre"
PAYLOAD_FIRST = "/confusion_1"
PAYLOAD_SECOND = "/confusion_2"
PAYLOAD_OTHER = "/non_sense"
# Choice intents and the side slots that decide a clarification
CHOICE_FIRST, CHOICE_SECOND, CHOICE_NONE = "confusion_1", "confusion_2", "non_sense"
# Fixed button menus (title, payload) in display order
FIXED_MENUS = {
    "misspelled_password": [
        ("Saisir à nouveau le mot de passe", "/retry_password"),
        ("Recevoir un nouveau code", "/send_new_pwd"),
        ("Renseigner un nouveau e-mail", "/change_email"),
    ],
    "note": [("1", "1"), ("2", "2"), ("3", "3"), ("4", "4"), ("5", "5")],
}
# ---------------------------------------------------------------------------


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def rank_candidates(cands: DataFrame, keys: Sequence[str], order: Sequence[Column],
                    top: int | None = None, out: str = "rank") -> DataFrame:
    """Number candidates per request by ``order`` (1 = best); keep ``top``."""
    w = Window.partitionBy(*_list(keys)).orderBy(*order)
    ranked = cands.withColumn(out, F.row_number().over(w))
    return ranked.filter(F.col(out) <= top) if top else ranked


def top_two(ranking: DataFrame, keys: Sequence[str], key: str = "key", conf: str = "confidence",
            rank: str = "rank") -> DataFrame:
    """One row per request with the two best candidates (rank 1 and 2) and
    ``n_ranked`` = min(number of candidates, 2)."""
    keys = _list(keys)
    best = ranking.filter(F.col(rank) <= 2)
    return best.groupBy(*keys).agg(
        F.count("*").alias("n_ranked"),
        F.max(F.when(F.col(rank) == 1, F.col(key))).alias("key1"),
        F.max(F.when(F.col(rank) == 1, F.col(conf))).alias("conf1"),
        F.max(F.when(F.col(rank) == 2, F.col(key))).alias("key2"),
        F.max(F.when(F.col(rank) == 2, F.col(conf))).alias("conf2"),
    )


def top_confidence(top: DataFrame) -> Column:
    """Confidence of the first rank (null without ranking)."""
    return F.col("conf1")


def confidence_margin(top: DataFrame) -> Column:
    """First minus second confidence (null with fewer than two)."""
    return F.col("conf1") - F.col("conf2")


def gate_outcome(n_ranked: Column, conf1: Column, conf2: Column,
                 low: float = LOW_CONFIDENCE, margin: float = CONFUSION_MARGIN) -> Column:
    """One ranking or fewer -> no_ranking; top < low -> not_understood;
    margin < margin -> confused; else answer. Both tests strict."""
    return (
        F.when(F.coalesce(n_ranked, F.lit(0)) <= 1, F.lit(OUTCOME_NO_RANKING))
        .when(conf1 < F.lit(low), F.lit(OUTCOME_NOT_UNDERSTOOD))
        .when(conf1 - conf2 < F.lit(margin), F.lit(OUTCOME_CONFUSED))
        .otherwise(F.lit(OUTCOME_ANSWER))
    )


def confidence_gate(top: DataFrame, low: float = LOW_CONFIDENCE, margin: float = CONFUSION_MARGIN) -> DataFrame:
    """C8 on the output of ``top_two``."""
    return top.withColumn("outcome", gate_outcome(F.col("n_ranked"), F.col("conf1"), F.col("conf2"), low, margin))


def gate_flags(gated: DataFrame) -> DataFrame:
    """0/1 incomprehension and confusion flags from the outcome."""
    return gated.withColumn(
        "bot_question_incomprehension", (F.col("outcome") == OUTCOME_NOT_UNDERSTOOD).cast("int")
    ).withColumn("bot_question_confusion", (F.col("outcome") == OUTCOME_CONFUSED).cast("int"))


def gate_rates(flags: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rates of the two flags per group (partial aggregation)."""
    return flags.groupBy(*_list(by)).agg(
        F.count("*").alias("n_requests"),
        F.sum("bot_question_incomprehension").cast("bigint").alias("n_incomprehension"),
        F.sum("bot_question_confusion").cast("bigint").alias("n_confusion"),
        F.round(F.avg("bot_question_incomprehension"), 6).alias("incomprehension_rate"),
        F.round(F.avg("bot_question_confusion"), 6).alias("confusion_rate"),
    )


def confused_pairs(gated: DataFrame) -> DataFrame:
    """Ids of the two best candidates for confused requests."""
    return gated.filter(F.col("outcome") == OUTCOME_CONFUSED).withColumn(
        "id1", intent_id("key1")).withColumn("id2", intent_id("key2"))


def resolve_choice(intent: Column, first_id: Column, second_id: Column,
                   left: Column | None = None, middle: Column | None = None) -> Column:
    """C11: clarification answer to an id. The intent *or* a filled side slot
    decides: first, then second; anything else gives null."""
    left = F.coalesce(left, F.lit(False)) if left is not None else F.lit(False)
    middle = F.coalesce(middle, F.lit(False)) if middle is not None else F.lit(False)
    return (
        F.when((intent == CHOICE_FIRST) | left, first_id)
        .when((intent == CHOICE_SECOND) | middle, second_id)
    )


def choice_rows(df: DataFrame, keys: Sequence[str], title1: str, title2: str) -> DataFrame:
    """Three button rows per confused request: the two keywords and 'autre'."""
    buttons = F.array(
        F.struct(F.lit(1).alias("pos"), F.col(title1).alias("title"), F.lit(PAYLOAD_FIRST).alias("payload")),
        F.struct(F.lit(2).alias("pos"), F.col(title2).alias("title"), F.lit(PAYLOAD_SECOND).alias("payload")),
        F.struct(F.lit(3).alias("pos"), F.lit(OTHER_TITLE).alias("title"), F.lit(PAYLOAD_OTHER).alias("payload")),
    )
    return df.select(*_list(keys), F.inline(buttons))


def menu_rows(spark, name: str) -> DataFrame:
    """A fixed menu as (pos, title, payload) rows."""
    rows = [(i + 1, t, p) for i, (t, p) in enumerate(FIXED_MENUS[name])]
    return spark.createDataFrame(rows, "pos int, title string, payload string")


# ------------------------------------------------------------------ C1-C5
WORD_RE = r"\p{L}+"


def tokenize(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Whitespace tokens with their 1-based position."""
    trimmed = F.regexp_replace(F.col(text), r"^\s+|\s+$", "")
    toks = F.split(trimmed, r"\s+")
    out = df.select(*_list(keys), F.posexplode(toks).alias("pos", "token"))
    return out.filter(F.col("token") != "").withColumn("pos", F.col("pos") + 1)


def token_counts(tokens: DataFrame, keys: Sequence[str], token: str = "token") -> DataFrame:
    """Bag-of-words counts per text (partial aggregation)."""
    return tokens.groupBy(*_list(keys), token).agg(F.count("*").alias("n"))


MICRO = 1_000_000  # log likelihoods are whole millionths, so sums are exact in any order
FREQUENT = 10_000  # tokens of the model that meet a text's tokens without a shuffle


@dataclass(frozen=True)
class IntentModel:
    """``labels``: (label, log prior, log likelihood of an unseen token) per label;
    ``weights``: per token and label what a seen token adds to that, in millionths, and how often
    the token stands in the training texts."""

    labels: list[tuple]
    weights: DataFrame


def fit_intents(train: DataFrame, text: str = "text", label: str = "label", alpha: float = 1.0) -> IntentModel:
    """Multi-class intent model from token counts (multinomial, smoothed by
    ``alpha``), fitted on all rows with a label: grouped counts; only the labels'
    totals come to the driver."""
    rows = train.where(F.col(label).isNotNull())
    counts = materialize(_words(rows, [label], text).groupBy("token", label).agg(F.count("*").alias("n")), "intent-counts")
    size = counts.select("token").distinct().count()
    tokens = {r[label]: r["n"] for r in counts.groupBy(label).agg(F.sum("n").alias("n")).collect()}
    texts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}  # one row per label

    def micro(x):
        return round(MICRO * math.log(x))

    spread = {x: tokens.get(x, 0) + alpha * size for x in texts}
    labels = sorted((x, micro(n / sum(texts.values())), micro(alpha / spread[x]) if spread[x] else 0)
                    for x, n in texts.items())
    total = F.coalesce(*[F.when(F.col(label) == x, F.lit(float(spread[x]))) for x in texts]) if texts else F.lit(1.0)
    unseen = F.coalesce(*[F.when(F.col(label) == x, F.lit(u)) for x, _, u in labels]) if texts else F.lit(0)
    added = F.round(F.log((F.col("n") + alpha) / total) * MICRO).cast("bigint") - unseen
    weights = counts.groupBy("token").agg(F.collect_list(F.struct(F.col(label).alias("label"), added.alias("w"))).alias("w"),
                                          F.sum("n").alias("seen"))
    return IntentModel(labels, weights)


def predict_intents(model: IntentModel, df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Per text the likeliest label (ties go to the smaller one), its log score
    and its share among the labels. Texts without tokens are scored by the priors.

    The ``FREQUENT`` commonest tokens of the model, most of any text, meet the texts by a
    broadcast of that many rows and are summed where the text lies; only the others are
    shuffled, so no common word is one task's and little is sorted."""
    keys = _list(keys)
    labels = F.array(*[F.lit(x) for x, _, _ in model.labels])
    by_label = F.map_from_entries("w")
    weights = materialize(model.weights.select("token", "seen", F.array(*[
        F.coalesce(F.try_element_at(by_label, F.lit(x)), F.lit(0)).cast("bigint") for x, _, _ in model.labels]).alias("w")),
        "intent-weights")
    common = materialize(weights.orderBy(F.col("seen").desc(), "token").limit(FREQUENT).select("token", "w"), "intent-common")
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_RE), 0)
    each = df.select(*keys, F.explode(words).alias("token"))

    def added(met, n):
        return met.groupBy(*keys).agg(F.sum(n).alias("n"), *[F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(len(model.labels))])

    near = df.select(*keys, F.explode_outer(words).alias("token")).join(F.broadcast(common), "token", "left")
    far = each.join(weights.join(F.broadcast(common.select("token")), "token", "left_anti").select("token", "w"), "token")
    parts = added(near, F.col("token").isNotNull().cast("bigint")).unionByName(added(far, F.lit(0).cast("bigint")))
    # one row per text: its number of tokens and, per label, the sum of what the seen ones add
    sums = parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.array(*[
        F.coalesce(F.sum(f"s{i}"), F.lit(0)) for i in range(len(model.labels))]).alias("seen"))
    fixed = [F.lit(p).cast("bigint") + F.col("n") * F.lit(u).cast("bigint") + F.col("seen")[i] for i, (_, p, u) in enumerate(model.labels)]
    scored = sums.select(*keys, F.array(*fixed).cast("array<bigint>").alias("s")).withColumn("best", F.array_max("s"))
    odds = F.aggregate("s", F.lit(0.0), lambda acc, x: acc + F.exp((x - F.col("best")) / MICRO))
    return scored.where("best is not null").select(
        *keys, F.get(labels, (F.array_position("s", F.col("best")) - 1).cast("int")).alias("prediction"),  # labels are in order
        (F.col("best") / MICRO).alias("score"), F.round(1 / odds, 6).alias("confidence"))


def fit_logistic(train: DataFrame, text: str = "text", label: str = "label", max_iter: int = 20,
                 num_features: int = 1 << 16):
    """C3, discriminative form: tokenizer, hashed term counts, logistic regression
    (``pyspark.ml``); returns the fitted pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    tok = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=WORD_RE, gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_features", numFeatures=num_features)
    lr = LogisticRegression(featuresCol="_features", labelCol=label, maxIter=max_iter, regParam=0.01,
                            predictionCol="prediction", probabilityCol="probability")
    return Pipeline(stages=[tok, tf, lr]).fit(train.withColumn(label, F.col(label).cast("double")))


def _words(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    return df.select(*_list(keys), F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_RE), 0))
                     .alias("token"))


def rank_responses(queries: DataFrame, bank: DataFrame, q_keys: Sequence[str], item: str = "item_id",
                   text: str = "text", k: int = 3) -> DataFrame:
    """C4: rank bank entries for each query text by TF-IDF cosine, best first.

    idf = ln(N/df) over the bank; cosines are rounded to 6 places before ranking, ties
    go to the smaller item id, and the confidence is the cosine normalised over the
    top k. Equal query texts are ranked once.

    Exact top k without every pair that shares a token: a token's largest bank weight
    bounds what it can add to a cosine. The strongest tokens of a text (those that
    make up most of its bound) give lower bounds for its k-th best cosine; tokens that
    together cannot reach it need not bring in new items. Items that share one of the
    other tokens are the candidates, and only they are scored in full."""
    q_keys = _list(q_keys)
    q_texts = queries.select(*q_keys, F.md5(F.col(text).cast("binary")).alias("_t"), F.col(text).alias("_text"))
    once = q_texts.groupBy("_t").agg(F.first("_text").alias("_text"))  # equal texts: any of them

    n_bank = bank.select(item).distinct().count()  # one number
    btf = _words(bank, [item], text).groupBy(item, "token").agg(F.count("*").alias("tf"))
    df = btf.groupBy("token").agg(F.count("*").alias("df"))
    idf = df.select("token", F.log(F.lit(float(n_bank)) / F.col("df")).alias("idf")).filter(F.col("idf") > 0)
    bw = btf.join(idf, "token").select(item, "token", "idf", (F.col("tf") * F.col("idf")).alias("wb"))
    bnorm = bw.groupBy(item).agg(F.sqrt(F.sum(F.col("wb") * F.col("wb"))).alias("nb"))
    # the bank model feeds every branch below: written once; joins with it are left to
    # the planner, which knows its size
    model = materialize(bw.join(bnorm, item).select(
        item, "token", "idf", "wb", "nb", (F.col("wb") / F.col("nb")).alias("share")), "bank-model")
    tokens = model.groupBy("token").agg(F.first("idf").alias("idf"), F.max("share").alias("top"))

    qtf = _words(once, ["_t"], "_text").groupBy("_t", "token").agg(F.count("*").alias("tf"))
    qw = qtf.join(tokens, "token").select("_t", "token", "top", (F.col("tf") * F.col("idf")).alias("wq"))
    qnorm = qw.groupBy("_t").agg(F.sqrt(F.sum(F.col("wq") * F.col("wq"))).alias("nq"))
    qw = materialize(qw.join(qnorm, "_t").select(
        "_t", "token", "wq", "nq", (F.col("wq") / F.col("nq") * F.col("top")).alias("bound")), "query-weights")
    rising = Window.partitionBy("_t").orderBy("bound", "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_of = Window.partitionBy("_t")
    ranked = qw.withColumns({"_upto": F.sum("bound").over(rising), "_sum": F.sum("bound").over(all_of)})
    # lower bounds: partial cosines over the tokens that hold the upper half of the bound
    strong = ranked.filter(F.col("_upto") > F.col("_sum") / 2).select("_t", "token", "wq", "nq")
    partial = strong.join(model.select(item, "token", "share"), "token").groupBy("_t", item).agg(
        F.sum(F.col("wq") / F.col("nq") * F.col("share")).alias("low"))
    kth = rank_candidates(partial, ["_t"], [F.col("low").desc(), F.col(item)], top=k, out="_r") \
        .filter(F.col("_r") == k).select("_t", F.col("low").alias("_kth"))
    needed = ranked.join(kth, "_t", "left").filter(
        F.col("_kth").isNull() | (F.col("_upto") >= F.col("_kth") - 2e-6)).select("_t", "token")
    cands = needed.join(model.select(item, "token"), "token").select("_t", item).distinct()
    dot = (cands.join(qw.select("_t", "token", "wq", "nq"), "_t")
           .join(model.select(item, "token", "wb", "nb"), [item, "token"])
           .groupBy("_t", item).agg(F.sum(F.col("wq") * F.col("wb")).alias("dot"), F.first("nq").alias("nq"),
                                    F.first("nb").alias("nb")))
    cos = dot.select("_t", item, F.round(F.col("dot") / (F.col("nq") * F.col("nb")), 6).alias("cosine"))
    top = rank_candidates(cos, ["_t"], [F.col("cosine").desc(), F.col(item)], top=k)
    top = top.withColumn("confidence", F.round(F.col("cosine") / F.sum("cosine").over(all_of), 6))
    return q_texts.select(*q_keys, "_t").join(top, "_t").drop("_t")


ENTITY_TOKEN_RE = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


def phrase_trie(values: DataFrame) -> DataFrame:
    """(parent, first, rest, n, node, level): the edges of the trie of all token sequences
    ``values(run, tokens)``, chains without a branch or an end taken together. A node is
    named by its tokens joined by a space (the root is empty) and lies ``level`` edges deep;
    an edge adds ``n`` tokens, of which ``first`` tells it from its parent's other edges."""
    steps = values.select("run", "tokens", F.explode(F.sequence(F.lit(1), F.size("tokens"))).alias("k")).select(
        "run", "tokens", "k", F.expr("array_join(slice(tokens, 1, k), ' ')").alias("node"), F.get("tokens", F.col("k")).alias("next"))
    inner = steps.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b"), F.bool_or(F.col("next").isNull()).alias("end"))
    stops = steps.join(inner.where("end or a <> b").select("node"), "node")
    path = Window.partitionBy("run").orderBy("k")
    edges = stops.withColumns({"from": F.coalesce(F.lag("k").over(path), F.lit(0)), "parent": F.coalesce(F.lag("node").over(path), F.lit("")),
                               "level": F.row_number().over(path)})
    return edges.select("parent", F.get("tokens", F.col("from")).alias("first"),
                        F.expr("slice(tokens, `from` + 2, k - `from` - 1)").alias("rest"),
                        (F.col("k") - F.col("from")).alias("n"), "node", "level").distinct()


def entity_match(df: DataFrame, gazetteer: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Known entity values found in each text, as (keys, value, entity).

    Text and value are lower-cased token sequences (runs of letters and digits; any
    other visible character is a token), and a value is found where its whole
    sequence stands. The values' trie is walked from every token that begins a value, all
    places together, one level of edges at a time: a place is at most one row per level,
    however many values begin alike. Such a place carries as many tokens as the longest
    value has; the others are dropped before anything is carried."""
    keys = _list(keys)

    def tokens(c):
        return F.regexp_extract_all(F.lower(c), F.lit(ENTITY_TOKEN_RE), 0)

    named = materialize(gazetteer.select(F.lower("value").alias("value"), "entity", tokens(F.col("value")).alias("tokens")).where(
        F.size("tokens") > 0).select("value", "entity", F.array_join("tokens", " ").alias("run"), "tokens").distinct(), "entity_values")
    edges = materialize(phrase_trie(named.select("run", "tokens").distinct()), "entity_trie")
    deepest, longest = edges.agg(F.max("level")).first()[0] or 0, named.agg(F.max(F.size("tokens"))).first()[0] or 0
    toks = materialize(df.select(*keys, tokens(F.col(text)).alias("toks")).withColumn("row", F.monotonically_increasing_id()),
                       "entity_tokens")  # the row numbers stay
    firsts = edges.where("level = 1").select(F.col("first").alias("tok")).distinct()
    places = toks.select("row", F.posexplode("toks").alias("at", "tok")).join(firsts, "tok", "left_semi")
    at = places.groupBy("row").agg(F.collect_list("at").alias("ats"))  # at most one text's places
    walk = toks.select("row", "toks").join(at, "row").select("row", F.explode(F.transform(
        "ats", lambda a: F.slice("toks", a + 1, F.lit(longest)))).alias("ahead"))
    walk = walk.select("row", "ahead", F.lit("").alias("node"), F.lit(0).alias("depth"))
    reached = toks.sparkSession.createDataFrame([], "row long, node string")
    for level in range(1, deepest + 1):
        step = edges.where(F.col("level") == level).select(
            F.col("parent").alias("node"), F.col("first").alias("tok"), "rest", "n", F.col("node").alias("to"))
        walk = walk.withColumn("tok", F.get("ahead", F.col("depth"))).join(step, ["node", "tok"]).where(
            F.slice("ahead", F.col("depth") + 2, F.col("n") - 1) == F.col("rest")).select(
            "row", "ahead", F.col("to").alias("node"), (F.col("depth") + F.col("n")).alias("depth"))
        if level < deepest:  # read by this level's result and by the next level
            walk = materialize(walk, "entity_walk")
        reached = reached.unionByName(walk.select("row", "node"))
    found = reached.distinct().join(named.select(F.col("run").alias("node"), "value", "entity"), "node")
    return toks.select("row", *keys).join(found, "row").select(*keys, "value", "entity").distinct()

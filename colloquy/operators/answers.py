"""Response choice (E1-E8): length quartiles, profile filter, exclusion of
what was already said, seeded pick, fallback and guard texts.

All operators are DataFrame -> DataFrame. Grouped statistics use partial
aggregation (no group is gathered into one task); the pick is a
``row_number() == 1`` filter, which Spark plans as a partial
``WindowGroupLimit`` before the shuffle, so a hot key ships one row per
map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values (texts the reference sends) ------------------------------
PROFILE_SHORT = "short_utters"
PROFILE_LONG = "long_utters"
PROFILE_ANY = "dont_care"
CHOICE_SHORT = "réponses courtes"
CHOICE_LONG = "réponses longues"
FALLBACK_WITH_CHOICE = (
    "😕 Désolé, par rapport à vos goûts ({choice}) je n'ai plus d'autres reformulations pour cette question."
    "\nVoulez vous quand même  que je vous propose une réponse que je vous ai déjà proposée ?"
)
FALLBACK_PLAIN = (
    "😕 Désolé, je n'ai plus d'autres reformulations pour cette question."
    "\nVoulez vous quand même  que je vous propose une réponse que je vous ai déjà proposée ?"
)
GUARD_NO_QUESTION_REFORMULATE = "Mais vous n'avez encore posé aucune question ^^' !"
GUARD_NOT_UNDERSTOOD_REFORMULATE = "Difficile de reformuler une réponse, à partir d'une question non comprise ^^'"
GUARD_NO_QUESTION_ADAPTIVE = "Je vous écoute pour votre question"
GUARD_NOT_UNDERSTOOD_ADAPTIVE = "utter_give_more_details"
# ---------------------------------------------------------------------------


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def length_quartiles(bank: DataFrame, keys="id", text: str = "text") -> DataFrame:
    """Per key, the 25% and 75% quantiles of the length in code points,
    linear interpolation, truncated to int. ``percentile`` keeps a
    value->count map per group, merged map-side (partial aggregation)."""
    keys = _cols(keys)
    q = F.percentile(F.char_length(F.col(text)), F.array(F.lit(0.25), F.lit(0.75)))
    return (
        bank.groupBy(*keys)
        .agg(q.alias("_q"))
        .select(*keys, F.col("_q")[0].cast("int").alias("q1"), F.col("_q")[1].cast("int").alias("q3"))
    )


def profile_condition(length: Column, profile: Column, q1: Column, q3: Column) -> Column:
    """E2 predicate: short keeps ``len <= q1``, long keeps ``len >= q3``, else all."""
    return (
        F.when(profile == PROFILE_SHORT, length <= q1)
        .when(profile == PROFILE_LONG, length >= q3)
        .otherwise(F.lit(True))
    )


def profile_filter(cands: DataFrame, quartiles: DataFrame, keys="id", text: str = "text",
                   profile: Column | str = "profile") -> DataFrame:
    """Keep the candidates that fit the profile (quartiles joined on key).

    The quartile table has one row per key; a hot key on the candidate side
    is split by AQE's skew-join handling."""
    keys = _cols(keys)
    prof = F.col(profile) if isinstance(profile, str) else profile
    joined = cands.join(quartiles, keys, "inner")
    return joined.filter(
        profile_condition(F.char_length(F.col(text)), prof, F.col("q1"), F.col("q3"))
    ).drop("q1", "q3")


def exclude_uttered(cands: DataFrame, history: DataFrame, keys="conv_id", text: str = "text",
                    before: str | None = None) -> DataFrame:
    """Remove texts already said in the same conversation (left anti join).

    With ``before`` (a column present on both sides), only history rows with
    ``history.before < cands.before`` count as said. Null history is empty.
    """
    keys = _cols(keys)
    if before is None:
        return cands.join(history.select(*keys, text).dropDuplicates(keys + [text]), keys + [text], "left_anti")
    h = history.select(*[F.col(k).alias(f"_h_{k}") for k in keys + [text]], F.col(before).alias("_h_before"))
    cond = [cands[k] == h[f"_h_{k}"] for k in keys + [text]] + [h["_h_before"] < cands[before]]
    return cands.join(h, cond, "left_anti")


def seeded_order(seed: str, keys: Sequence[str], text: str) -> Column:
    """Reproducible stand-in for a uniform random draw: md5 of seed, key, text."""
    parts = [F.lit(seed)] + [F.col(k).cast("string") for k in keys] + [F.col(text)]
    return F.md5(F.concat_ws("|", *parts))


def pick_one(cands: DataFrame, keys="conv_id", text: str = "text", seed: str = "seed") -> DataFrame:
    """One candidate per key, uniform by a seeded hash (ties by text)."""
    keys = _cols(keys)
    w = Window.partitionBy(*keys).orderBy(seeded_order(seed, keys, text), F.col(text))
    return cands.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def fallback_text(profile: Column) -> Column:
    """E5: the text sent when no candidate is left; names the preference."""
    return (
        F.when(profile == PROFILE_SHORT, F.lit(FALLBACK_WITH_CHOICE.format(choice=CHOICE_SHORT)))
        .when(profile == PROFILE_LONG, F.lit(FALLBACK_WITH_CHOICE.format(choice=CHOICE_LONG)))
        .otherwise(F.lit(FALLBACK_PLAIN))
    )


def answer_or_fallback(requests: DataFrame, picks: DataFrame, keys="conv_id", text: str = "text",
                       profile: str = "profile", out: str = "answer") -> DataFrame:
    """E5: the picked text, or the fallback naming the preference."""
    keys = _cols(keys)
    p = picks.select(*keys, F.col(text).alias("_pick"))
    return (
        requests.join(p, keys, "left")
        .withColumn("is_fallback", F.col("_pick").isNull())
        .withColumn(out, F.coalesce(F.col("_pick"), fallback_text(F.col(profile))))
        .drop("_pick")
    )


def answer_guard(has_question: Column, has_id: Column, form: str = "reformulate",
                 has_user_message: Column | None = None) -> Column:
    """Text of the earlier outcome, or null when the answer may be chosen.

    ``reformulate``: no FAQ answer yet, then no understood id.
    ``adaptive``: no FAQ answer *and* no user message, then no id (template).
    """
    if form == "reformulate":
        return (F.when(~has_question, F.lit(GUARD_NO_QUESTION_REFORMULATE))
                .when(~has_id, F.lit(GUARD_NOT_UNDERSTOOD_REFORMULATE)))
    if form == "adaptive":
        msg = has_user_message if has_user_message is not None else F.lit(False)
        return (F.when(~has_question & ~msg, F.lit(GUARD_NO_QUESTION_ADAPTIVE))
                .when(~has_id, F.lit(GUARD_NOT_UNDERSTOOD_ADAPTIVE)))
    raise ValueError(f"unknown form {form!r}")


def lookup_variants(requests: DataFrame, bank: DataFrame, id_col: str = "id") -> DataFrame:
    """All variants of the requested id (inner equi-join). The planner broadcasts
    the bank when its size in bytes is small; a larger one is a shuffle join, where
    AQE splits a hot id."""
    return requests.join(bank, id_col, "inner")


def repeat_last(df: DataFrame, keys="conv_id", order: str = "turn", value: str = "reformulation",
                intent: str = "intent", accept: str = "affirm", chunk: Column | None = None) -> DataFrame:
    """On an accepting turn, repeat the latest earlier reformulation."""
    from colloquy.operators.scan import carry_last

    keys = _cols(keys)
    carried = carry_last(df, keys, order, F.col(value), "_last_ref", inclusive=False, chunk=chunk)
    return carried.filter(F.col(intent) == accept).withColumn("repeated", F.col("_last_ref")).drop("_last_ref")

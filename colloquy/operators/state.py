"""Conversation state.

Per-row running state is computed in one pass over chunks (see ``scan``), so a
hot key does not become one task and rows are shuffled once. Final state per
key uses grouped aggregates (``max_by``), which combine map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.text import intent_id, repair_text, valid_rating
from colloquy.operators.scan import before_chunk, carry_last, chunked, running

# --- fixed values (texts and names the reference uses) ---------------------
PROFILE_ACK = {
    "short_utters": "J'enregistre que vous aimez les réponses courtes",
    "dont_care": "J'enregistre que ça vous est égal",
    "long_utters": "J'enregistre que vous aimez les réponses détaillées",
}
PROFILE_UNKNOWN_ACK = "Je n'ai pas encore cerné votre profil"
RATING_NOTICE = "Vous avez donné la note de {note} à la question."
SESSION_GAP_MINUTES = 60
AUTH_SUCCESS, AUTH_RETRY, AUTH_NO_CODE = "success", "retry", "no_code"
AUTH_NEXT_STEP = {
    AUTH_SUCCESS: "utter_good_password",
    AUTH_RETRY: "action_propose_opts_if_misspell_psw",
    AUTH_NO_CODE: "action_askingEmail_form",
}
FORM_INTENT = "number"
FORM_EXCLUDED_INTENTS = ["faq", "deny", "ask_reformulate"]
# ---------------------------------------------------------------------------


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def last_message(df: DataFrame, keys, order: str, role_col: str, role: str, text: str = "text") -> DataFrame:
    """F1 (final form): latest text of ``role`` per key and its position.
    ``max_by`` is a partial aggregate: a hot key is combined map-side."""
    keys = _list(keys)
    return (
        df.filter(F.col(role_col) == role)
        .groupBy(*keys)
        .agg(F.max_by(F.col(text), F.col(order)).alias("last_text"), F.max(order).alias("last_" + order))
    )


def last_value_by_row(df: DataFrame, keys, order, when: Column, value: Column, out: str,
                      chunk: Column | None = None, inclusive: bool = True) -> DataFrame:
    """F1/F2 (per-row form): latest ``value`` among rows where ``when`` holds."""
    return carry_last(df, keys, order, F.when(when, value), out, inclusive=inclusive, chunk=chunk)


def last_faq_answer(df: DataFrame, keys, order, role_col: str, intent_col: str, text: str = "text",
                    chunk: Column | None = None) -> DataFrame:
    """as F2, but updated only when the latest user intent is ``faq``.

    One pass: inside a chunk an answer after a user turn is judged at once; answers
    before the chunk's first user turn wait for the intent carried into the chunk."""
    order = _list(order)
    rows = chunked(df, keys, chunk)
    at = F.struct(*[F.col(c) for c in order])
    upto = Window.partitionBy("_k").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    said = F.col(role_col) == "assistant"
    rows = rows.withColumn("_intent", F.last(F.col(intent_col), ignorenulls=True).over(upto))
    rows = rows.withColumns({"_sure": F.when(said & (F.col("_intent") == "faq"), F.struct(F.col(text).alias("v"))),
                             "_open": F.when(said & F.col("_intent").isNull(), F.struct(F.col(text).alias("v")))})
    local = rows.withColumns({f"_l{c}": F.last(c, ignorenulls=True).over(upto) for c in ("_sure", "_open")})
    chunks = local.groupBy("_k").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)
                                       for c in ("_intent", "_sure", "_open")])
    w = before_chunk()
    chunks = chunks.withColumn("_in", F.last("_intent", ignorenulls=True).over(w))
    kept = F.coalesce("_sure", F.when(F.col("_in") == "faq", F.col("_open")))
    carry = chunks.select("_k", "_in", F.last(kept, ignorenulls=True).over(w).alias("_before"))
    out = local.join(carry, "_k", "left")
    answer = F.coalesce("_l_sure", F.when(F.col("_in") == "faq", F.col("_l_open")), "_before")
    return out.withColumn("last_faq_answer", answer["v"]).drop(
        "_k", "_intent", "_sure", "_open", "_l_sure", "_l_open", "_in", "_before")


def uttered_history(df: DataFrame, keys, order: str, text: str = "text") -> DataFrame:
    """duplicate-free bot texts (after the non-breaking-space repair) with
    the position where each was first said. A text is in the history at
    position t when ``first_<order> <= t``; rows instead of a growing array
    keep a long conversation linear."""
    keys = _list(keys)
    rep = df.select(*keys, F.col(order), repair_text(F.col(text), "nbsp_only").alias("text"))
    return rep.groupBy(*keys, "text").agg(F.min(order).alias("first_" + order))


def fold_slots(writes: DataFrame, keys, order: Sequence[str], slot: str = "slot", value: str = "value",
               slots: Sequence[str] | None = None) -> DataFrame:
    """latest value per slot; a null write is a reset (kept, not skipped).
    With ``slots`` the result is pivoted wide (one column per slot)."""
    keys = _list(keys)
    latest = F.max_by(F.col(value), F.struct(*[F.col(c) for c in order]))
    if slots is None:
        return writes.groupBy(*keys, slot).agg(latest.alias(value))
    return writes.groupBy(*keys).pivot(slot, list(slots)).agg(latest)


def set_profile(intent: Column) -> tuple[Column, Column, Column]:
    """(profile, acknowledgement, details flag) for a profile intent."""
    profile = F.when(intent.isin(list(PROFILE_ACK)), intent)
    ack = F.coalesce(
        *[F.when(intent == k, F.lit(v)) for k, v in PROFILE_ACK.items()], F.lit(PROFILE_UNKNOWN_ACK)
    )
    details = F.when(intent == "long_utters", F.lit(1))
    return profile, ack, details


def sessions(df: DataFrame, keys, ts: str = "ts", tiebreak: str = "event_id",
             gap_minutes: int = SESSION_GAP_MINUTES, chunk: Column | None = None) -> DataFrame:
    """split each key's events into sessions; a gap strictly longer than
    ``gap_minutes`` starts a new one. Adds ``session_start`` (the first event
    time of the session), which identifies the session within the key.

    One pass: gaps inside a chunk are judged at once, the gap before a chunk's
    first event on the chunk table."""
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(gap_minutes))
    here = Window.partitionBy("_k").orderBy(ts, tiebreak)
    rows = chunked(df, keys, chunk)
    rows = rows.withColumn("_prev", F.lag(ts).over(here))
    rows = rows.withColumn("_new", F.when(F.col(ts) > F.col("_prev") + gap, F.col(ts)))
    local = rows.withColumn("_mark", F.last("_new", ignorenulls=True).over(
        here.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    chunks = local.groupBy("_k").agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.max("_new").alias("_inner"))
    w = before_chunk()
    chunks = chunks.withColumn("_gone", F.max("_last").over(w))
    opens = F.when(F.col("_gone").isNull() | (F.col("_first") > F.col("_gone") + gap), F.col("_first"))
    chunks = chunks.withColumn("_opens", opens)
    carry = chunks.select("_k", F.coalesce("_opens", F.max(F.coalesce("_inner", "_opens")).over(w)).alias("_start"))
    return local.join(carry, "_k", "left").withColumn("session_start", F.coalesce("_mark", "_start")).drop(
        "_k", "_prev", "_new", "_mark", "_start")


def session_slots(writes_with_session: DataFrame, keys, order: Sequence[str], slot: str = "slot",
                  value: str = "value", session: str = "session_start") -> DataFrame:
    """The last write of each slot in each session (a struct ``_last``, so a reset is kept)."""
    return writes_with_session.groupBy(*_list(keys), session, slot).agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*[F.col(c) for c in order])).alias("_last"))


def slot_intervals(writes_with_session: DataFrame, keys, order: Sequence[str], slot: str = "slot",
                   value: str = "value", session: str = "session_start") -> DataFrame:
    """F8 with slots surviving, as state changes: (keys, slot, session_from,
    session_to, value) holds from one session until the session of the next write
    (null: still). As many rows as writing sessions; nothing is filled in between."""
    keys = _list(keys)
    per = session_slots(writes_with_session, keys, order, slot, value, session)
    # the next session is the previous one in falling order
    per = per.withColumn("_back", -F.unix_micros(F.col(session).cast("timestamp")))
    out = running(per, [*keys, slot], "_back", previous={"_next": (F.col(session), 1)},
                  chunk=F.floor(F.col("_back") / F.lit(30 * 86_400_000_000)))
    return out.select(*keys, slot, F.col(session).alias("session_from"), F.col("_next1").alias("session_to"),
                      F.col("_last.v").alias(value))


def carry_over(writes_with_session: DataFrame, keys, order: Sequence[str], keep: bool = True,
               slot: str = "slot", value: str = "value", session: str = "session_start") -> DataFrame:
    """F8: slot state at the end of each session. ``keep`` carries slots into later
    sessions (the reference's setting); otherwise each session starts empty. Rows:
    (keys, session, slot, value); a null value is a reset. With ``keep`` this is
    every session times every slot written so far; :func:`slot_intervals` says the
    same in one row per change."""
    keys = _list(keys)
    per_session = session_slots(writes_with_session, keys, order, slot, value, session)
    if not keep:
        return per_session.select(*keys, session, slot, F.col("_last.v").alias(value))
    # every (key, session) x (slot written by then): the slots go to a key's days first and
    # meet its sessions day by day, so the sessions of a busy key are many small joins
    day, key = F.to_date(F.col(session)), F.struct(*keys).alias("_key")
    sess = writes_with_session.select(*keys, session).distinct()
    slots = per_session.groupBy(*keys, slot).agg(F.min(day).alias("_since")).select(key, slot, "_since")
    days = sess.select(key, day.alias("_day")).distinct().join(slots, "_key").where(F.col("_day") >= F.col("_since"))
    grid = sess.select(F.struct(key, day.alias("_day")).alias("_at"), *keys, session).join(
        days.select(F.struct("_key", "_day").alias("_at"), slot), "_at")
    unwritten = F.lit(None).cast(per_session.schema["_last"].dataType).alias("_last")
    # a slot has at most one last write in a session
    filled = grid.select(*keys, session, slot, unwritten).unionByName(per_session).groupBy(*keys, session, slot).agg(
        F.first("_last", ignorenulls=True).alias("_last"))
    carried = carry_last(filled, keys + [slot], [session], F.col("_last"), "_state", chunk=day)
    return carried.filter(F.col("_state").isNotNull()).select(*keys, session, slot, F.col("_state.v").alias(value))


def form_fill(events: DataFrame, keys, order: Sequence[str], opens: Column, intent: str, text: str,
              form_id: Column, chunk: Column | None = None) -> DataFrame:
    """per opened form, the first valid rating after it opens (and before
    the next opening) from the ``number`` intent and no excluded intent.
    Forms never filled keep a row with null note."""
    keys = _list(keys)
    tagged = carry_last(events, keys, order, F.when(opens, form_id), "form_id", chunk=chunk)
    forms = tagged.filter(opens).select(*keys, "form_id")
    return forms.join(_first_ratings(tagged, keys, order, intent, text), keys + ["form_id"], "left").select(
        *keys, "form_id", F.col("_f.note").alias("note"), *[F.col("_f." + c).alias("filled_" + c) for c in order])


def _first_ratings(tagged: DataFrame, keys: list[str], order: Sequence[str], intent: str, text: str) -> DataFrame:
    """The first valid rating of each ``form_id`` as a struct ``_f``."""
    ok = rating_given(intent, text) & F.col("form_id").isNotNull()
    at = [F.col(c) for c in order]
    return tagged.filter(ok).groupBy(*keys, "form_id").agg(
        F.min_by(F.struct(F.col(text).alias("note"), *at), F.struct(*at)).alias("_f"))


def auth_outcomes(events: DataFrame, keys, order: Sequence[str], issues: Column, attempts: Column,
                  code: Column, chunk: Column | None = None) -> DataFrame:
    """compare each attempt with the latest code issued to that user
    before it; outcome and next step per attempt."""
    latest = carry_last(events, keys, order, F.when(issues, code), "_code", chunk=chunk)
    att = latest.filter(attempts)
    outcome = (F.when(F.col("_code").isNull(), F.lit(AUTH_NO_CODE))
               .when(code == F.col("_code"), F.lit(AUTH_SUCCESS)).otherwise(F.lit(AUTH_RETRY)))
    nxt = F.coalesce(*[F.when(outcome == k, F.lit(v)) for k, v in AUTH_NEXT_STEP.items()])
    return att.withColumn("outcome", outcome).withColumn("next_step", nxt).drop("_code")


def auth_funnel(outcomes: DataFrame, issued: DataFrame, keys) -> DataFrame:
    """per user: codes issued, attempts, successes; authentication
    sticks once any attempt succeeded."""
    keys = _list(keys)
    a = outcomes.groupBy(*keys).agg(
        F.count("*").alias("n_attempts"),
        F.sum((F.col("outcome") == AUTH_SUCCESS).cast("bigint")).alias("n_success"),
    )
    i = issued.groupBy(*keys).agg(F.count("*").alias("n_codes"))
    return i.join(a, keys, "full").select(
        *keys,
        F.coalesce("n_codes", F.lit(0)).alias("n_codes"),
        F.coalesce("n_attempts", F.lit(0)).alias("n_attempts"),
        F.coalesce("n_success", F.lit(0)).alias("n_success"),
        (F.coalesce("n_success", F.lit(0)) > 0).alias("authenticated"),
    )


def interaction_facts(events: DataFrame, gate: DataFrame, keys, order: Sequence[str], user: Column, bot: Column,
                      opens: Column, details: Column, intent: str, note: str, form_id: Column, time: str,
                      request: Sequence[str], chunk: Column | None = None) -> DataFrame:
    """one row per rated interaction, the eleven columns typed.

    When a rating form opens, the question is the latest user text (F1), the answer
    the latest bot text (F2), each with its own time, and ``details`` (0/1, F6) the
    latest flag, all strictly before it; the rating is the form's first valid one
    (F9). Confidence, id and the two flags come from ``gate`` (C8, C9) by ``request``.
    ``user``, ``bot``, ``opens`` say which events are user texts, bot texts (null
    elsewhere) and openings. Everything about the past comes from one running pass."""
    keys, order, request = _list(keys), _list(order), list(request)

    rows = running(events.withColumn("_form", F.when(opens, form_id)), keys, order,
                   {"_q": stamped(user, time), "_a": stamped(bot, time), "_d": details, "_last": F.col("_form")},
                   inclusive=False, chunk=chunk)
    rows = rows.withColumn("form_id", F.coalesce("_form", "_last"))
    opened = rows.filter(opens).select(*keys, *[r for r in request if r not in keys], "form_id", "_q", "_a", "_d")
    rated = _first_ratings(rows, keys, order, intent, note).select(*keys, "form_id", F.col("_f.note").alias("note"))
    joined = opened.join(rated, keys + ["form_id"]).join(gate, request)
    return fact_columns(joined, keys)


def stamped(text: Column, time: str) -> Column:
    """A text with its time, null where there is no text."""
    return F.when(text.isNotNull(), F.struct(text.alias("text"), F.col(time).alias("time")))


def rating_given(intent: str, text: str) -> Column:
    """Whether an event fills a rating form: intent ``number`` and a valid rating."""
    return (F.col(intent) == FORM_INTENT) & ~F.col(intent).isin(FORM_EXCLUDED_INTENTS) & valid_rating(F.col(text)).isNotNull()


def fact_columns(joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The eleven columns of a rated interaction: question ``_q`` and answer ``_a`` (text, time),
    details flag ``_d``, ``note`` and the columns of the gate."""
    return joined.select(
        F.concat(F.lit("user"), *[F.col(k).cast("string") for k in keys]).alias("pseudo"),
        intent_id("key1").try_cast("int").alias("question_id"),
        F.col("_q.text").alias("user_question"), F.col("_a.text").alias("bot_answer"),
        F.col("conf1").alias("bot_confid_to_user_question"), F.col("note").cast("int").alias("user_note"),
        F.col("_q.time").cast("timestamp").alias("time_user_question"),
        F.col("_a.time").cast("timestamp").alias("time_bot_answer"),
        "bot_question_confusion", "bot_question_incomprehension",
        F.coalesce("_d", F.lit(0)).alias("user_wants_details"))


def rating_notice(note: Column) -> Column:
    """confirmation text holding the rating."""
    head, tail = RATING_NOTICE.split("{note}")
    return F.concat(F.lit(head), note.cast("string"), F.lit(tail))

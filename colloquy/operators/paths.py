"""Rule lookup and path analytics.

Rules and paths are tables of step rows. Steps before the current one come
from ``running`` (one chunked pass for any number of steps), so no key is one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.operators.scan import before_chunk, chunked, running
from colloquy.session import materialize

FORM = "note_and_pseudo_asking_form"
WORD_BITS, CELL_ROWS = 62, 4096
# --- fixed values: the reference's rules, step by step ---------------------
# (rule, pos, step_kind, step_value). Kinds: condition (loop active when the
# turn starts), intent, action, slot (``name=value``; no value: must be empty),
# loop (loop active at that step; no value: none).
RULE_STEPS = [
    ("faq_no_confusion", 1, "intent", "faq"),
    ("faq_no_confusion", 2, "action", "action_set_confusion_slot_to_none"),
    ("faq_no_confusion", 3, "slot", "confusion="),
    ("faq_no_confusion", 4, "action", "action_get_user_curent_intent"),
    ("faq_no_confusion", 5, "action", "user_note_to_none"),
    ("faq_no_confusion", 6, "action", "action_user_last_message"),
    ("faq_no_confusion", 7, "action", "action_ask_for_clarification"),
    ("faq_no_confusion", 8, "slot", "confusion="),
    ("faq_no_confusion", 9, "action", "action_increment_confusion_incomprehension"),
    ("faq_no_confusion", 10, "action", "action_bot_last_message"),
    ("faq_no_confusion", 11, "action", "action_bot_utterances_list"),
    ("faq_no_confusion", 12, "action", "note_and_pseudo_asking_form"),
    ("faq_no_confusion", 13, "loop", "note_and_pseudo_asking_form"),
    ("faq_in_form_no_confusion", 0, "condition", "note_and_pseudo_asking_form"),
    ("faq_in_form_no_confusion", 1, "intent", "faq"),
    ("faq_in_form_no_confusion", 2, "action", "action_set_confusion_slot_to_none"),
    ("faq_in_form_no_confusion", 3, "slot", "confusion="),
    ("faq_in_form_no_confusion", 4, "action", "action_get_user_curent_intent"),
    ("faq_in_form_no_confusion", 5, "action", "user_note_to_none"),
    ("faq_in_form_no_confusion", 6, "action", "action_user_last_message"),
    ("faq_in_form_no_confusion", 7, "action", "action_ask_for_clarification"),
    ("faq_in_form_no_confusion", 8, "slot", "confusion="),
    ("faq_in_form_no_confusion", 9, "action", "action_increment_confusion_incomprehension"),
    ("faq_in_form_no_confusion", 10, "action", "action_bot_last_message"),
    ("faq_in_form_no_confusion", 11, "action", "action_bot_utterances_list"),
    ("faq_in_form_no_confusion", 12, "action", "note_and_pseudo_asking_form"),
    ("faq_in_form_no_confusion", 13, "loop", "note_and_pseudo_asking_form"),
    ("faq_confusion", 1, "intent", "faq"),
    ("faq_confusion", 2, "action", "action_set_confusion_slot_to_none"),
    ("faq_confusion", 3, "slot", "confusion="),
    ("faq_confusion", 4, "action", "action_get_user_curent_intent"),
    ("faq_confusion", 5, "action", "user_note_to_none"),
    ("faq_confusion", 6, "action", "action_user_last_message"),
    ("faq_confusion", 7, "action", "action_ask_for_clarification"),
    ("faq_confusion", 8, "slot", "confusion=true"),
    ("faq_confusion", 9, "action", "action_increment_confusion_incomprehension"),
    ("faq_confusion", 10, "action", "action_bot_last_message"),
    ("faq_confusion", 11, "action", "action_bot_utterances_list"),
    ("faq_in_form_confusion", 0, "condition", "note_and_pseudo_asking_form"),
    ("faq_in_form_confusion", 1, "intent", "faq"),
    ("faq_in_form_confusion", 2, "action", "action_set_confusion_slot_to_none"),
    ("faq_in_form_confusion", 3, "slot", "confusion="),
    ("faq_in_form_confusion", 4, "action", "action_get_user_curent_intent"),
    ("faq_in_form_confusion", 5, "action", "user_note_to_none"),
    ("faq_in_form_confusion", 6, "action", "action_user_last_message"),
    ("faq_in_form_confusion", 7, "action", "action_ask_for_clarification"),
    ("faq_in_form_confusion", 8, "slot", "confusion=true"),
    ("faq_in_form_confusion", 9, "action", "action_increment_confusion_incomprehension"),
    ("faq_in_form_confusion", 10, "action", "action_bot_last_message"),
    ("faq_in_form_confusion", 11, "action", "action_bot_utterances_list"),
    ("submit_note", 0, "condition", "note_and_pseudo_asking_form"),
    ("submit_note", 1, "action", "note_and_pseudo_asking_form"),
    ("submit_note", 2, "loop", None),
    ("submit_note", 3, "action", "action_record_the_user_note"),
    ("deny_in_form", 0, "condition", "note_and_pseudo_asking_form"),
    ("deny_in_form", 1, "action", "note_and_pseudo_asking_form"),
    ("deny_in_form", 2, "loop", "note_and_pseudo_asking_form"),
    ("deny_in_form", 3, "intent", "deny"),
    ("deny_in_form", 4, "action", "utter_reformulate"),
    ("confusion_1", 1, "intent", "confusion_1"),
    ("confusion_1", 2, "action", "action_set_faq_confusion_id"),
    ("confusion_1", 3, "action", "action_bot_adaptive_answer"),
    ("confusion_1", 4, "action", "action_bot_last_message"),
    ("confusion_1", 5, "action", "action_bot_utterances_list"),
    ("confusion_1", 6, "action", "note_and_pseudo_asking_form"),
    ("confusion_1", 7, "loop", "note_and_pseudo_asking_form"),
    ("confusion_2", 1, "intent", "confusion_2"),
    ("confusion_2", 2, "action", "action_set_faq_confusion_id"),
    ("confusion_2", 3, "action", "action_bot_adaptive_answer"),
    ("confusion_2", 4, "action", "action_bot_last_message"),
    ("confusion_2", 5, "action", "action_bot_utterances_list"),
    ("confusion_2", 6, "action", "note_and_pseudo_asking_form"),
    ("confusion_2", 7, "loop", "note_and_pseudo_asking_form"),
    ("non_sense", 1, "intent", "non_sense"),
    ("non_sense", 2, "action", "action_set_faq_confusion_id"),
    ("non_sense", 3, "action", "action_bot_adaptive_answer"),
    ("non_sense", 4, "action", "action_bot_last_message"),
    ("non_sense", 5, "action", "action_bot_utterances_list"),
    ("non_sense", 6, "action", "note_and_pseudo_asking_form"),
    ("non_sense", 7, "loop", "note_and_pseudo_asking_form"),
    ("ask_profile", 1, "intent", "want_inform_profile"),
    ("ask_profile", 2, "action", "utter_ask_profil"),
    ("ask_profile_in_form", 0, "condition", "note_and_pseudo_asking_form"),
    ("ask_profile_in_form", 1, "intent", "want_inform_profile"),
    ("ask_profile_in_form", 2, "action", "action_deactivate_loop"),
    ("ask_profile_in_form", 3, "loop", None),
    ("ask_profile_in_form", 4, "action", "utter_ask_profil"),
    ("profile_short", 1, "intent", "short_utters"),
    ("profile_short", 2, "action", "action_set_and_acknowledge_profile"),
    ("profile_short", 3, "action", "user_note_to_none"),
    ("profile_short", 4, "action", "action_bot_adaptive_answer"),
    ("profile_short", 5, "action", "note_and_pseudo_asking_form"),
    ("profile_short", 6, "loop", "note_and_pseudo_asking_form"),
    ("profile_dont_care", 1, "intent", "dont_care"),
    ("profile_dont_care", 2, "action", "action_set_and_acknowledge_profile"),
    ("profile_dont_care", 3, "action", "user_note_to_none"),
    ("profile_dont_care", 4, "action", "action_bot_adaptive_answer"),
    ("profile_dont_care", 5, "action", "note_and_pseudo_asking_form"),
    ("profile_dont_care", 6, "loop", "note_and_pseudo_asking_form"),
    ("profile_long", 1, "intent", "long_utters"),
    ("profile_long", 2, "action", "action_set_and_acknowledge_profile"),
    ("profile_long", 3, "action", "user_note_to_none"),
    ("profile_long", 4, "action", "action_bot_adaptive_answer"),
    ("profile_long", 5, "action", "note_and_pseudo_asking_form"),
    ("profile_long", 6, "loop", "note_and_pseudo_asking_form"),
    ("profile_denied", 1, "action", "action_set_and_acknowledge_profile"),
    ("profile_denied", 2, "action", "user_note_to_none"),
    ("profile_denied", 3, "action", "action_bot_adaptive_answer"),
    ("profile_denied", 4, "action", "note_and_pseudo_asking_form"),
    ("profile_denied", 5, "loop", "note_and_pseudo_asking_form"),
    ("profile_denied", 6, "intent", "deny"),
    ("profile_denied", 7, "action", "utter_ask_profil"),
    ("reformulated_affirm", 1, "action", "action_utter_reformulate"),
    ("reformulated_affirm", 2, "action", "action_bot_utterances_list"),
    ("reformulated_affirm", 3, "intent", "affirm"),
    ("reformulated_affirm", 4, "action", "action_no_further_reformulation"),
    ("reformulated_deny", 1, "action", "action_utter_reformulate"),
    ("reformulated_deny", 2, "action", "action_bot_utterances_list"),
    ("reformulated_deny", 3, "intent", "deny"),
    ("reformulated_deny", 4, "action", "action_ask_another_question"),
    ("ask_reformulate", 1, "intent", "ask_reformulate"),
    ("ask_reformulate", 2, "action", "action_utter_reformulate"),
    ("ask_reformulate", 3, "action", "action_bot_utterances_list"),
    ("greet", 1, "intent", "greet"),
    ("greet", 2, "action", "utter_greet"),
    ("bot_challenge", 1, "intent", "bot_challenge"),
    ("bot_challenge", 2, "action", "utter_iamabot"),
    ("ask_email", 1, "intent", "intent_trigger_conversation"),
    ("ask_email", 2, "action", "askingEmail_form"),
    ("ask_email", 3, "loop", "askingEmail_form"),
    ("submit_email", 0, "condition", "askingEmail_form"),
    ("submit_email", 1, "action", "askingEmail_form"),
    ("submit_email", 2, "loop", None),
    ("submit_email", 3, "action", "action_send_email"),
    ("submit_email", 4, "action", "check_password_form"),
    ("submit_email", 5, "loop", "check_password_form"),
    ("password_wrong", 0, "condition", "check_password_form"),
    ("password_wrong", 1, "action", "check_password_form"),
    ("password_wrong", 2, "loop", None),
    ("password_wrong", 3, "action", "action_set_misspell_pwd"),
    ("password_wrong", 4, "slot", "misspelled_password=true"),
    ("password_wrong", 5, "action", "action_propose_opts_if_misspell_psw"),
    ("password_right", 0, "condition", "check_password_form"),
    ("password_right", 1, "action", "check_password_form"),
    ("password_right", 2, "loop", None),
    ("password_right", 3, "action", "action_set_misspell_pwd"),
    ("password_right", 4, "slot", "misspelled_password="),
    ("password_right", 5, "action", "utter_good_password"),
    ("password_right", 6, "action", "utter_invite_user_to_ask"),
    ("retry_password", 1, "intent", "retry_password"),
    ("retry_password", 2, "action", "action_set_retry_password_to_none"),
    ("retry_password", 3, "action", "retry_password_form"),
    ("retry_password", 4, "loop", "retry_password_form"),
    ("retry_wrong", 0, "condition", "retry_password_form"),
    ("retry_wrong", 1, "action", "retry_password_form"),
    ("retry_wrong", 2, "loop", None),
    ("retry_wrong", 3, "action", "action_set_misspell_pwd"),
    ("retry_wrong", 4, "slot", "misspelled_password=true"),
    ("retry_wrong", 5, "action", "action_propose_opts_if_misspell_psw"),
    ("retry_right", 0, "condition", "retry_password_form"),
    ("retry_right", 1, "action", "retry_password_form"),
    ("retry_right", 2, "loop", None),
    ("retry_right", 3, "action", "action_set_misspell_pwd"),
    ("retry_right", 4, "slot", "misspelled_password="),
    ("retry_right", 5, "action", "utter_good_password"),
    ("retry_right", 6, "action", "utter_invite_user_to_ask"),
    ("send_new_pwd", 1, "intent", "send_new_pwd"),
    ("send_new_pwd", 2, "action", "action_send_email"),
    ("send_new_pwd", 3, "action", "action_set_user_password_to_none"),
    ("send_new_pwd", 4, "action", "check_password_form"),
    ("send_new_pwd", 5, "loop", "check_password_form"),
    ("change_email", 1, "intent", "change_email"),
    ("change_email", 2, "action", "action_set_email_slot_to_none"),
    ("change_email", 3, "action", "action_set_user_password_to_none"),
    ("change_email", 4, "action", "askingEmail_form"),
    ("change_email", 5, "loop", "askingEmail_form"),
]
# the reference's stories as paths; several rows of one position are an *or* step
STORY_STEPS = [
    ("gives_profile", 1, "short_utters"),
    ("gives_profile", 1, "dont_care"),
    ("gives_profile", 1, "long_utters"),
    ("gives_profile", 2, "action_set_and_acknowledge_profile"),
    ("gives_profile", 3, "user_note_to_none"),
    ("gives_profile", 4, "action_bot_adaptive_answer"),
    ("gives_profile", 5, "note_and_pseudo_asking_form"),
    ("asked_profile", 1, "utter_ask_profil"),
    ("asked_profile", 2, "short_utters"),
    ("asked_profile", 2, "dont_care"),
    ("asked_profile", 2, "long_utters"),
    ("asked_profile", 3, "action_set_and_acknowledge_profile"),
    ("asked_profile", 4, "user_note_to_none"),
    ("asked_profile", 5, "action_bot_adaptive_answer"),
    ("asked_profile", 6, "note_and_pseudo_asking_form"),
    ("reformulated_affirm", 1, "ask_reformulate"),
    ("reformulated_affirm", 2, "action_utter_reformulate"),
    ("reformulated_affirm", 3, "action_bot_utterances_list"),
    ("reformulated_affirm", 4, "affirm"),
    ("reformulated_affirm", 5, "action_no_further_reformulation"),
    ("reformulated_deny", 1, "ask_reformulate"),
    ("reformulated_deny", 2, "action_utter_reformulate"),
    ("reformulated_deny", 3, "action_bot_utterances_list"),
    ("reformulated_deny", 4, "deny"),
    ("reformulated_deny", 5, "action_ask_another_question"),
]
RULE_SCHEMA = "rule string, pos int, step_kind string, step_value string"
# ---------------------------------------------------------------------------


def literal_table(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """Rows as an inline table: the planner knows its size, so small tables are broadcast."""
    def lit(v):
        if v is None:
            return "CAST(NULL AS STRING)"
        return str(v) if isinstance(v, int) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    values = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def rules_frame(spark: SparkSession) -> DataFrame:
    return literal_table(spark, RULE_STEPS, "rule, pos, step_kind, step_value")


def stories_frame(spark: SparkSession) -> DataFrame:
    return literal_table(spark, STORY_STEPS, "path, pos, step")


def compile_rules(steps: DataFrame) -> DataFrame:
    """One row per rule: what must hold before it answers, and its answer.

    The rule waits for its last intent (or, without one, for its first action);
    ``actions`` are those that follow. ``last_action`` is the action just before
    the wait ends, ``loop_now`` the last loop step before the first answer (empty
    text: no loop may be active), ``slots`` the last value asked of each slot
    (null: must be empty). A null column asks for nothing."""
    r = steps.groupBy("rule").agg(F.array_sort(F.collect_list(F.struct("pos", "step_kind", "step_value"))).alias("s"))

    def of(kind, extra=lambda x: F.lit(True)):
        return F.filter("s", lambda x: (x["step_kind"] == kind) & extra(x))

    def last(column):
        return F.try_element_at(column, F.lit(-1))

    r = r.withColumn("_wait", F.coalesce(last(of("intent"))["pos"], F.try_element_at(of("action"), F.lit(1))["pos"]))
    answer = of("action", lambda x: x["pos"] > F.col("_wait"))
    r = r.withColumns({"_answer": answer, "_first": F.coalesce(F.try_element_at(answer, F.lit(1))["pos"], F.lit(1 << 30))})
    slots = of("slot")

    def name(x):
        return F.split_part(x["step_value"], F.lit("="), F.lit(1))

    final = F.filter(slots, lambda x: ~F.exists(slots, lambda y: (y["pos"] > x["pos"]) & (name(y) == name(x))))
    loop = last(of("loop", lambda x: x["pos"] < F.col("_first")))
    r = r.select(
        "rule", last(of("intent"))["step_value"].alias("intent"), last(of("condition"))["step_value"].alias("condition"),
        last(of("action", lambda x: x["pos"] <= F.col("_wait")))["step_value"].alias("last_action"),
        F.when(loop.isNotNull(), F.coalesce(loop["step_value"], F.lit(""))).alias("loop_now"),
        F.transform(final, lambda x: F.struct(
            name(x).alias("slot"),
            F.nullif(F.split_part(x["step_value"], F.lit("="), F.lit(2)), F.lit("")).alias("value"))).alias("slots"),
        F.array_join(F.transform("_answer", lambda x: x["step_value"]), ",").alias("actions"))
    set_ = [F.col(c).isNotNull().cast("int") for c in ("condition", "last_action", "loop_now")]
    return r.withColumn("specificity", set_[0] + set_[1] + set_[2] + F.size("slots"))


def rule_lookup(events: DataFrame, steps: DataFrame, event_key: str) -> DataFrame:
    """G1: the actions of the most specific rule that applies to each event (ties by
    rule name); null where none does. One row per event, whatever its key.

    ``events`` has intent, active_loop (when the turn starts), loop_now, last_action
    and slots (map). The rules of an intent are one array, joined to the events on
    the intent; the choice is made per row, so events are not grouped again."""
    by_intent = compile_rules(steps).groupBy(F.col("intent").alias("_intent")).agg(F.collect_list(F.struct(
        (-F.col("specificity")).alias("s"), "rule", "actions", "condition", "last_action", "loop_now", "slots")).alias("_rules"))
    joined = events.join(by_intent, events["intent"].eqNullSafe(by_intent["_intent"]), "left")

    def applies(r):
        asked = F.forall(r["slots"], lambda x: F.try_element_at(F.col("slots"), x["slot"]).eqNullSafe(x["value"]))
        return ((r["condition"].isNull() | F.col("active_loop").eqNullSafe(r["condition"]))
                & (r["last_action"].isNull() | F.col("last_action").eqNullSafe(r["last_action"]))
                & (r["loop_now"].isNull() | F.coalesce(F.col("loop_now"), F.lit("")).eqNullSafe(r["loop_now"])) & asked)

    best = F.array_min(F.filter("_rules", applies))
    return joined.select(event_key, best["rule"].alias("rule"), best["actions"].alias("actions"))


def previous_steps(df: DataFrame, keys, order: Sequence[str], step: str, n: int = 2,
                   chunk: Column | None = None) -> DataFrame:
    """Add ``prev1`` .. ``prev<n>``: the steps 1..n positions back (a null step counts)."""
    return running(df, keys, order, previous={"prev": (F.col(step), n)}, chunk=chunk)


def path_masks(paths: DataFrame) -> DataFrame:
    """(path, length, masks, ends) of ``paths(path, pos, step)``: for every step the places
    of the path that take it, one bit each, ``WORD_BITS`` to a whole number; ``ends`` are the
    steps of the last place. Places follow ``pos``, whatever its numbers."""
    place = F.dense_rank().over(Window.partitionBy("path").orderBy("pos")) - 1
    at = paths.where("step is not null").select("path", "step", place.alias("at")).distinct()
    size = at.groupBy("path").agg((F.max("at") + 1).alias("length"))
    words = at.groupBy("path", "step", F.expr(f"at div {WORD_BITS}").alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(at % {WORD_BITS} as int))")).alias("m"))
    whole = words.groupBy("path", "step").agg(F.map_from_entries(F.collect_list(F.struct("w", "m"))).alias("m")).join(size, "path")
    whole = whole.withColumn("m", F.expr(f"transform(sequence(0L, (length - 1) div {WORD_BITS}), w -> coalesce(m[w], 0L))"))
    last = at.join(size, "path").where(F.col("at") + 1 == F.col("length")).groupBy("path").agg(F.collect_set("step").alias("ends"))
    return whole.groupBy("path", "length").agg(F.map_from_entries(F.collect_list(F.struct("step", "m"))).alias("masks")).join(last, "path")


def path_conformance(df: DataFrame, keys, order: Sequence[str], step: str, paths: DataFrame,
                     chunk: Column | None = None) -> DataFrame:
    """Per key and path, at how many places the contiguous steps of the path
    occur. ``paths`` has (path, pos, step); several rows of a position are an *or*
    step. Keys that never follow a path have no row for it.

    Rows are numbered per key (in chunks) and dealt to cells of ``CELL_ROWS`` steps, or of
    as many as the longest path has; a cell also gets the steps before it that a path
    reaching into it needs, so a row is in two cells at most, whatever the length of the
    paths. A path meets the cells that hold one of its last steps (an equi-join) and runs
    over a cell's steps as a bit-parallel automaton: one bit per place of the path, moved on
    by a shift and kept by the step's mask."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    masks = materialize(path_masks(paths), "path-masks")
    longest = masks.agg(F.max("length")).first()[0] or 1  # one number of the path table
    width = max(CELL_ROWS, longest)
    rows = chunked(df.select(*keys, *[c for c in order if c not in keys], F.col(step).alias("_step")), keys, chunk)
    rows = rows.select("_k", "_step", F.row_number().over(Window.partitionBy("_k").orderBy(*order)).alias("_in"))
    before = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).select(
        "_k", F.coalesce(F.sum("_n").over(before_chunk()), F.lit(0)).alias("_before"))
    at = F.col("_before") + F.col("_in") - 1
    rows = rows.join(before, "_k").select("_k._key", "_step", at.alias("_at"), F.floor(at / width).alias("_cell"))
    ahead = rows.where(F.col("_at") % width >= width - (longest - 1)).withColumn("_cell", F.col("_cell") + 1)
    cells = rows.unionByName(ahead).groupBy("_key", "_cell").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_step"))).alias("_steps"))
    met = cells.select("*", F.explode(F.array_distinct("_steps._step")).alias("_end")).join(
        masks.select("path", F.explode("ends").alias("_end")), "_end").select("_key", "_cell", "_steps", "path").distinct()
    run = met.join(masks.drop("ends"), "path")
    none = F.expr(f"transform(sequence(0L, (length - 1) div {WORD_BITS}), w -> 0L)")
    top, bit = F.expr(f"cast((length - 1) div {WORD_BITS} as int)"), F.expr(f"shiftleft(1L, cast((length - 1) % {WORD_BITS} as int))")

    def move(acc, x):
        mask = F.coalesce(F.try_element_at(F.col("masks"), F.coalesce(x["_step"], F.lit(""))), none)
        state = F.transform(acc["s"], lambda w, i: F.shiftleft(w, 1).bitwiseOR(F.when(i == 0, F.lit(1).cast("long")).otherwise(
            F.shiftright(F.get(acc["s"], i - 1), WORD_BITS - 1).bitwiseAND(F.lit(1).cast("long")))).bitwiseAND(F.get(mask, i)))
        return F.struct(state.alias("s"), (acc["n"] + F.when(
            (F.get(state, top).bitwiseAND(bit) != 0) & (F.floor(x["_at"] / width) == F.col("_cell")), F.lit(1).cast("long")).otherwise(
            F.lit(0).cast("long"))).alias("n"))

    found = F.aggregate("_steps", F.struct(none.alias("s"), F.lit(0).cast("long").alias("n")), move, lambda acc: acc["n"])
    out = run.select("_key", "path", found.alias("n")).groupBy("_key", "path").agg(F.sum("n").alias("n_matches"))
    return out.where("n_matches > 0").select(*[F.col(f"_key.{k}").alias(k) for k in keys], "path", "n_matches")


def next_action(df: DataFrame, keys, order: Sequence[str], step: str, chunk: Column | None = None) -> DataFrame:
    """Most frequent next step after each pair of steps (ties by step)."""
    prev = previous_steps(df, keys, order, step, 2, chunk=chunk).filter(F.col("prev2").isNotNull())
    counts = prev.groupBy("prev2", "prev1", F.col(step).alias("next_step")).agg(F.count("*").alias("n"))
    best = counts.groupBy("prev2", "prev1").agg(
        F.min_by(F.struct("next_step", "n"), F.struct((-F.col("n")).alias("m"), F.col("next_step"))).alias("_b"))
    return best.select("prev2", "prev1", "_b.next_step", "_b.n")


def _context(n: int) -> list[str]:
    return [f"prev{i}" for i in range(1, n + 1)]


def context_tree(df: DataFrame, keys, order: Sequence[str], step: str, depth: int, support: int,
                 chunk: Column | None = None) -> DataFrame:
    """G3 with histories of up to ``depth`` steps: the suffix tree of contexts, as
    (depth, prev1 .. prev<depth>, n, next_step, n_next).

    A context is the last steps before a place, nearest first. The tree grows a level at a
    time: a context of d steps is counted only where its last d - 1 steps were kept, since it
    cannot be met more often than they; it is kept if it is met ``support`` times. Each node
    holds its most frequent next step (ties by step). Columns past a node's depth are null; a
    null step is not part of any context and is never a next step. The levels are grouped
    counts, combined map-side, over rows whose previous steps come from one running pass."""
    rows = previous_steps(df, keys, order, step, depth, chunk=chunk).where(F.col(step).isNotNull())
    rows = materialize(rows.select(F.col(step).alias("next_step"), *_context(depth)), "context-rows")
    tree, open_rows = None, rows
    for d in range(1, depth + 1):
        at = _context(d)
        counts = open_rows.where(F.col(f"prev{d}").isNotNull()).groupBy(*at, "next_step").agg(F.count(F.lit(1)).alias("c"))
        nodes = counts.groupBy(*at).agg(
            F.sum("c").alias("n"), F.min_by(F.struct("next_step", "c"), F.struct(-F.col("c"), "next_step")).alias("best"))
        nodes = materialize(nodes.where(F.col("n") >= support), "context-level")
        level = nodes.select(F.lit(d).alias("depth"), *at, *[F.lit(None).cast("string").alias(c) for c in _context(depth)[d:]],
                             "n", "best.next_step", F.col("best.c").alias("n_next"))
        tree = level if tree is None else tree.unionByName(level)
        if d < depth:
            open_rows = open_rows.join(nodes.select(*at), at, "left_semi")
    return tree


def predict_next(df: DataFrame, tree: DataFrame, keys, order: Sequence[str], step: str, depth: int,
                 chunk: Column | None = None) -> DataFrame:
    """Every row of ``df`` with ``context`` (steps of the longest context of ``tree`` that
    ends just before it, 0 if none) and ``predicted``, the next step that context foresees."""
    rows = previous_steps(df, keys, order, step, depth, chunk=chunk)
    for d in range(1, depth + 1):
        level = tree.where(F.col("depth") == d).select(*_context(d), F.col("next_step").alias(f"_n{d}"))
        rows = rows.join(level, _context(d), "left")
    found = [F.col(f"_n{d}") for d in range(depth, 0, -1)]
    steps = F.coalesce(*[F.when(F.col(f"_n{d}").isNotNull(), F.lit(d)) for d in range(depth, 0, -1)], F.lit(0))
    return rows.withColumns({"context": steps, "predicted": F.coalesce(*found)}).drop(
        *_context(depth), *[f"_n{d}" for d in range(1, depth + 1)])

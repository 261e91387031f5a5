"""Literal-row edge cases (FIXTURES section 3) for the operators."""

import datetime as dt

from pyspark.sql import functions as F

from colloquy.functions import text as B
from colloquy.operators import answers as E
from colloquy.operators import corpus as H
from colloquy.operators import intents as C
from colloquy.operators import keywords as D
from colloquy.operators import paths as G
from colloquy.operators import recommend as I
from colloquy.operators import state as S
from colloquy.operators.scan import carry_last, running, turn_chunk


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


rows_of = rows


def test_b1_repair_modes(spark):
    df = spark.createDataFrame([("l\u0092un c\u009cur 5\u0080 net",)], "text string")
    out = df.select(B.repair_text("text", "full").alias("f"), B.repair_text("text", "no_nbsp").alias("n"),
                    B.repair_text("text", "nbsp_only").alias("o")).first()
    assert out["f"] == "l'un coeur 5€ net"
    assert out["n"] == "l'un coeur 5€ net"
    assert out["o"] == "l\u0092un c\u009cur 5\u0080 net"


def test_b2_intent_id(spark):
    df = spark.createDataFrame([("faq/12",), ("faq",), (None,)], "key string")
    assert [r[0] for r in df.select(B.intent_id("key")).collect()] == ["12", None, None]


def test_b3_valid_email(spark):
    addrs = ["ana.b@example.com", "ana@exemple.com", "ana@example.com\n", "dear ana@example.com",
             "ana@examplee.com", ".ana@example.com"]
    df = spark.createDataFrame([(a,) for a in addrs], "a string")
    got = [r[0] for r in df.select(B.valid_email("a")).collect()]
    assert got == ["ana.b@example.com", None, None, None, "ana@examplee.com", None]


def test_b4_valid_rating(spark):
    df = spark.createDataFrame([("0",), ("1",), ("5",), ("6",), ("abc",), (None,)], "n string")
    got = df.select(B.valid_rating("n").alias("v"), B.rating_message("n").alias("m")).collect()
    assert [r["v"] for r in got] == [None, "1", "5", None, None, None]
    assert got[1]["m"] is None and got[0]["m"] == B.RATING_MESSAGE


def test_b5_parse_event_time(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05.123456",), ("2024-01-02 03:04:05",), ("02/01/2024",)],
                               "t string")
    got = [r[0] for r in df.select(B.parse_event_time("t")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5, 123456), dt.datetime(2024, 1, 2, 3, 4, 5), None]


def test_b5_knows_no_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:  # an hour that the zone skips
        df = spark.createDataFrame([("2021-03-28 02:30:00.000000",), ("2021-03-28 02:30:00\n",), ("2021-02-30 00:00:00",)],
                                   "t string")
        got = [r[0] for r in df.select(B.parse_event_time("t").cast("string")).collect()]
        assert got == ["2021-03-28 02:30:00", None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_b8_folds_every_latin_letter(spark):
    df = spark.createDataFrame([("  Œuvre ŠŽ \ufb01n e\u0301te\u0301 Ấ ",)], "t string")
    assert df.select(B.fold_text("t")).first()[0] == "oeuvre sz fin ete a"


def test_b10_spans(spark):
    df = spark.createDataFrame([(1, "[a](b)"), (2, "[a]b"), (3, "[a][b]"), (4, "un [x](y) et [z](w)")],
                               "doc_id int, text string")
    spans = B.extract_annotations(df)
    assert sorted(rows(spans, "doc_id", "pos", "value", "entity")) == [
        (1, 1, "a", "b"), (4, 1, "x", "y"), (4, 2, "z", "w")]
    plain = df.select("doc_id", B.plain_text("text").alias("p"))
    assert dict(rows(plain, "doc_id", "p")) == {1: "a", 2: "[a]b", 3: "[a][b]", 4: "un x et z"}


def test_c8_gate_thresholds(spark):
    cands = spark.createDataFrame(
        [(1, "faq/1", 0.9),                              # one rank
         (2, "faq/1", 0.4), (2, "faq/2", 0.1),           # top exactly 0.4 -> margin test
         (3, "faq/1", 0.6), (3, "faq/2", 0.41),          # margin 0.19 -> confused
         (4, "faq/1", 0.61), (4, "faq/2", 0.4),          # margin 0.21 -> answer
         (5, "faq/1", 0.39), (5, "faq/2", 0.1)],         # low -> not understood
        "req int, key string, confidence double")
    ranked = C.rank_candidates(cands, ["req"], [F.col("confidence").desc(), F.col("key")], top=2)
    g = C.confidence_gate(C.top_two(ranked, ["req"]))
    assert dict(rows(g, "req", "outcome")) == {
        1: "no_ranking", 2: "answer", 3: "confused", 4: "answer", 5: "not_understood"}


def test_c11_resolve_choice(spark):
    df = spark.createDataFrame([("confusion_1", False), ("confusion_2", False), ("other", True), ("other", False)],
                               "intent string, left boolean")
    got = df.select(C.resolve_choice(F.col("intent"), F.lit("7"), F.lit("9"), left=F.col("left"))).collect()
    assert [r[0] for r in got] == ["7", "9", "7", None]


def test_d4_containment_and_scores(spark):
    corpus = spark.createDataFrame(
        [(0, 0, 1, "chateau fort", 2), (0, 0, 2, "chat", 2), (0, 1, 3, "chat noir", 1)],
        "pair_id long, side long, doc_id long, text string, n_texts long")
    t = D.keyword_table(corpus)
    got = {(r["side"], r["word"]): (r["df_own"], r["df_other"]) for r in t.collect()}
    # "chat" occurs inside "chateau": both side-0 texts contain it
    assert got[(0, "chat")] == (2, 1)
    assert got[(0, "chateau")] == (1, 0)
    assert got[(1, "noir")] == (1, 0)
    best = dict(((r["side"], r["keyword"])) for r in D.top_keyword(t, ["pair_id", "side"]).collect())
    # side 0: chateau and fort tie at 0.5*ln(1/1)=0 vs chat 1*ln(1/2)<0 -> ties by word
    assert best[0] == "chateau"
    assert best[1] == "noir"


def test_e1_quartiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, "ab"), (1, "abc"), (1, "abcdefghi"),
                                (2, "x"), (3, "aa"), (3, "bb"), (3, "cc"), (3, "dd"), (4, "é😕")],
                               "id int, text string")
    q = {r["id"]: (r["q1"], r["q3"]) for r in E.length_quartiles(df, "id").collect()}
    assert q[1] == (1, 4) and q[2] == (1, 1) and q[3] == (2, 2) and q[4] == (2, 2)


def test_e3_e5_fallback_and_history(spark):
    cands = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "conv_id int, text string")
    hist = spark.createDataFrame([(1, "a"), (1, "b")], "conv_id int, text string")
    left = E.exclude_uttered(cands, hist, "conv_id")
    assert rows(left, "conv_id", "text") == [(2, "c")]
    picks = E.pick_one(left, "conv_id")
    req = spark.createDataFrame([(1, "short_utters"), (2, None), (3, "long_utters")], "conv_id int, profile string")
    out = dict(rows(E.answer_or_fallback(req, picks, "conv_id"), "conv_id", "answer"))
    assert out[2] == "c"
    assert "réponses courtes" in out[1] and "réponses longues" in out[3]


def test_e6_guard(spark):
    df = spark.createDataFrame([(False, False, False), (True, False, True), (True, True, True)],
                               "q boolean, i boolean, m boolean")
    r = df.select(E.answer_guard(F.col("q"), F.col("i"), "reformulate").alias("r"),
                  E.answer_guard(F.col("q"), F.col("i"), "adaptive", F.col("m")).alias("a")).collect()
    assert r[0]["r"] == E.GUARD_NO_QUESTION_REFORMULATE and r[0]["a"] == E.GUARD_NO_QUESTION_ADAPTIVE
    assert r[1]["r"] == E.GUARD_NOT_UNDERSTOOD_REFORMULATE and r[1]["a"] == E.GUARD_NOT_UNDERSTOOD_ADAPTIVE
    assert r[2]["r"] is None and r[2]["a"] is None


def test_f5_null_is_reset(spark):
    w = spark.createDataFrame([(1, 1, "s", "v"), (1, 2, "s", None), (2, 1, "s", "x")],
                              "conv_id int, seq int, slot string, value string")
    got = dict(rows(S.fold_slots(w, "conv_id", ["seq"]), "conv_id", "value"))
    assert got == {1: None, 2: "x"}


def test_f7_gap_boundary(spark):
    base = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(1, 1, base), (1, 2, base + dt.timedelta(minutes=59)),
                                (1, 3, base + dt.timedelta(minutes=119)), (1, 4, base + dt.timedelta(minutes=180))],
                               "user_id int, event_id int, ts timestamp_ntz")
    s = S.sessions(ev, "user_id", gap_minutes=60)
    starts = {r["event_id"]: r["session_start"] for r in s.collect()}
    assert starts[1] == starts[2] == starts[3]      # gaps of 59 and 60 minutes stay
    assert starts[4] != starts[3]                   # 61 minutes starts a new session


def test_f9_form_fill_skips_excluded(spark):
    ev = spark.createDataFrame([(1, 1, "view", "x"), (1, 2, "faq", "4"), (1, 3, "number", "7"),
                                (1, 4, "number", "3"), (1, 5, "number", "2")],
                               "user_id int, seq int, intent string, note string")
    f = S.form_fill(ev, "user_id", ["seq"], F.col("intent") == "view", "intent", "note", F.col("seq"))
    assert rows(f, "form_id", "note", "filled_seq") == [(1, "3", 4)]


def test_f10_auth(spark):
    ev = spark.createDataFrame([(1, 1, "try", 3), (1, 2, "code", 3), (1, 3, "try", 4), (1, 4, "code", 4),
                                (1, 5, "try", 4)], "user_id int, seq int, kind string, code int")
    o = S.auth_outcomes(ev, "user_id", ["seq"], F.col("kind") == "code", F.col("kind") == "try", F.col("code"))
    assert rows(o.orderBy("seq"), "seq", "outcome") == [(1, "no_code"), (3, "retry"), (5, "success")]


G_SCHEMA = ("event_id int, intent string, active_loop string, loop_now string, last_action string, "
            "slots map<string, string>")


def test_g1_specific_rule_wins(spark):
    ev = spark.createDataFrame([
        (1, "faq", None, None, None, {}), (2, "faq", G.FORM, G.FORM, None, {}),
        (3, "faq", G.FORM, G.FORM, None, {"confusion": "true"}), (4, "deny", None, None, None, {}),
        (5, "deny", G.FORM, G.FORM, G.FORM, {}), (6, "deny", None, None, "action_bot_utterances_list", None),
        (7, None, G.FORM, None, G.FORM, {}),                                  # the form was submitted: no loop left
        (8, None, G.FORM, G.FORM, G.FORM, {}),                                # still active: the rule asks for none
        (9, None, "check_password_form", None, "check_password_form", {"misspelled_password": "true"}),
        (10, None, "check_password_form", None, "check_password_form", {"misspelled_password": None}),
        (1, "greet", None, None, None, {})], G_SCHEMA)
    got = sorted((r["event_id"], r["rule"]) for r in G.rule_lookup(ev, G.rules_frame(spark), "event_id").collect())
    assert got == [(1, "faq_no_confusion"), (1, "greet"), (2, "faq_in_form_no_confusion"), (3, "faq_in_form_confusion"),
                   (4, None), (5, "deny_in_form"), (6, "reformulated_deny"), (7, "submit_note"), (8, None),
                   (9, "password_wrong"), (10, "password_right")]
    assert len({r for r, *_ in G.RULE_STEPS}) == 29


def test_g1_any_number_of_rules(spark):
    steps = [(f"r{i:04d}", p, k, v) for i in range(400) for p, k, v in
             ((1, "intent", f"i{i % 7}"), (2, "slot", f"s{i}=x"), (3, "action", f"do{i}"))]
    ev = spark.createDataFrame([(1, "i3", None, None, None, {"s10": "x", "s24": "x"}), (1, "i3", None, None, None, {})], G_SCHEMA)
    got = G.rule_lookup(ev, spark.createDataFrame(steps, G.RULE_SCHEMA), "event_id")
    assert sorted((r["rule"] or "") for r in got.collect()) == ["", "r0010"]


def test_g2_g3_null_steps_and_stories(spark):
    told = ["ask_reformulate", "action_utter_reformulate", "action_bot_utterances_list", "affirm",
            "action_no_further_reformulation"]
    rows = [(1, i, x) for i, x in enumerate(told)] + [(2, 0, "a"), (2, 1, None), (2, 2, "c"), (2, 3, "a"), (2, 4, "c")]
    df = spark.createDataFrame(rows, "k int, seq int, step string")
    for chunk in (None, F.floor(F.col("seq") / 2)):
        prev = {r["seq"]: (r["prev1"], r["prev2"]) for r in
                G.previous_steps(df, "k", ["seq"], "step", chunk=chunk).where("k = 2").collect()}
        assert prev == {0: (None, None), 1: ("a", None), 2: (None, "a"), 3: ("c", None), 4: ("a", "c")}
        met = G.path_conformance(df, "k", ["seq"], "step", G.stories_frame(spark), chunk=chunk)
        assert rows_of(met, "k", "path", "n_matches") == [(1, "reformulated_affirm", 1)]


def test_h2_priority(spark):
    a = spark.createDataFrame([("k1", "a1"), ("k2", "a2"), ("k3", "a3")], "key string, v string")
    b = spark.createDataFrame([("k2", "b2"), ("k3", "b3"), ("k3", "b3bis")], "key string, v string")
    c = spark.createDataFrame([("k3", "c3")], "key string, v string")
    out = sorted(rows(H.merge_by_priority([a, b, c], "key"), "key", "v"))
    assert out == [("k1", "a1"), ("k2", "b2"), ("k3", "c3")]


def test_i1_fuzzy(spark):
    words = spark.createDataFrame([(1, "Sourîs"), (2, "clavie"), (3, "zzz")], "id int, word string")
    vocab = spark.createDataFrame([("souris",), ("clavier",)], "item string")
    out = sorted(rows(I.fuzzy_match(words, vocab, ["id"]), "id", "item"))
    assert out == [(1, "souris"), (2, "clavier")]


def test_i3_knn_ties_and_votes(spark):
    pts = spark.createDataFrame([(1, [0b01], 0), (2, [0b01], 1), (3, [0b01], 1), (4, [0b11], 0), (5, [0b10], 2)],
                                "point_id long, pattern array<bigint>, label int")
    q = spark.createDataFrame([(100, [0b01])], "q long, pattern array<bigint>")
    got = I.knn_label(q, pts, 3, ["q"]).first()
    # nearest three: the pattern-01 points 1, 2, 3 (distance 0): labels 0, 1, 1
    assert (got["predicted_label"], got["votes"]) == (1, 2)
    got4 = I.knn_label(q, pts, 4, ["q"]).first()
    # add point 4 (distance 1, smaller id than 5): labels 0,1,1,0 -> tie -> smallest label
    assert (got4["predicted_label"], got4["votes"]) == (0, 2)


def test_i5_phrase(spark):
    items = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (2, "b", 2), (2, "c", 3)], "k int, item string, o int")
    out = dict(rows(I.list_phrase(items, ["k"], "item", F.col("o")), "k", "phrase"))
    assert out == {1: "et a", 2: "a, b, et c"}
    again = items.unionByName(spark.createDataFrame([(2, "a", 9), (1, "a", 1), (1, "a", 0)], "k int, item string, o int"))
    assert dict(rows(I.list_phrase(again, ["k"], "item", F.col("o")), "k", "phrase")) == out


def test_carry_last_chunked_equals_window(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 7).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 5 == 0, F.col("id").cast("string")).alias("v"))
    plain = carry_last(df, "conv_id", "turn", F.col("v"), "out")
    chunked = carry_last(df, "conv_id", "turn", F.col("v"), "out", chunk=turn_chunk(width=64))
    a = sorted(rows(plain, "conv_id", "turn", "out"))
    b = sorted(rows(chunked, "conv_id", "turn", "out"))
    assert a == b
    excl_p = sorted(rows(carry_last(df, "conv_id", "turn", F.col("v"), "o", inclusive=False), "turn", "o"))
    excl_c = sorted(rows(carry_last(df, "conv_id", "turn", F.col("v"), "o", inclusive=False,
                                    chunk=turn_chunk(width=64)), "turn", "o"))
    assert excl_p == excl_c


def test_carry_last_null_keys_and_many_values(spark):
    df = spark.range(0, 200).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.col("id").alias("turn"),
        F.when(F.col("id") % 11 == 0, F.col("id")).alias("v"))
    plain, cut = (running(df, "k", "turn", {"a": F.col("v"), "b": F.col("turn")}, {"p": (F.col("v"), 3)},
                          inclusive=False, chunk=c) for c in (None, turn_chunk(width=7)))
    cols = ("turn", "a", "b", "p1", "p2", "p3")
    assert sorted(rows(plain, *cols), key=str) == sorted(rows(cut, *cols), key=str)
    assert any(r["a"] is not None for r in cut.where("k is null").collect())


def test_c5_whole_token_sequences(spark):
    docs = spark.createDataFrame([(1, "la grippe covid ici"), (2, "un test COVID-19."), (3, "c est bon"), (4, "en c++ !"),
                                  (5, "un new yorker"), (6, "a New York"), (7, "la 4G et g")], "doc_id int, text string")
    gaz = spark.createDataFrame([("covid-19", "m"), ("c++", "l"), ("new york", "v"), ("4G", "r")], "value string, entity string")
    assert sorted(rows(C.entity_match(docs, gaz, ["doc_id"]), "doc_id", "value")) == [
        (2, "covid-19"), (4, "c++"), (6, "new york"), (7, "4g")]


def test_i1_empty_words(spark):
    words = spark.createDataFrame([(1, ""), (2, None), (3, "ab")], "id int, word string")
    vocab = spark.createDataFrame([("",), ("ab",)], "item string")
    assert sorted(rows(I.fuzzy_match(words, vocab, ["id"]), "id", "item", "similarity")) == [(1, "", 100.0), (3, "ab", 100.0)]


def test_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert D.FRENCH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("french")


def test_a2_reads_reference_document_form(spark, tmp_path):
    from colloquy.sources import banks as A

    p = tmp_path / "bank.txt"
    p.write_text('[{"1": ["Un visa ?", "Visa obligatoire ?"]}, {"2": ["Passeport ?"]}]', encoding="utf-8")
    got = sorted(rows(A.read_grouped_json(spark, str(p), document=True), "id", "pos", "text"))
    assert got == [("1", 1, "Un visa ?"), ("1", 2, "Visa obligatoire ?"), ("2", 1, "Passeport ?")]


def test_a4_a6_round_trip(spark, tmp_path):
    from colloquy.sources import banks as A

    bank = spark.createDataFrame([(1, 0, "Faut-il un visa ?"), (1, 1, "Un visa\nest obligatoire ?"),
                                  (2, 0, "Passeport l\u0092avion")], "id int, pos long, text string")
    path = str(tmp_path / "nlu")
    A.emit_training_blocks(bank, path)
    (file,) = (tmp_path / "nlu").glob("first=0/part=*/part-*.txt")
    text = file.read_text(encoding="utf-8")
    assert text.startswith('version: "2.0"')
    assert "- intent: faq/1\n  examples: |\n    - Faut-il un visa ?\n    - Un visa est obligatoire ?\n" in text
    back = sorted(rows(A.read_training_blocks(spark, path), "intent", "pos", "text"))
    assert back == [("faq/1", 1, "Faut-il un visa ?"), ("faq/1", 2, "Un visa est obligatoire ?"),
                    ("faq/2", 1, "Passeport l'avion")]


def test_blocks_do_not_show(spark, tmp_path):
    """Whatever the block size, every document has its header, names an id once, and the rows read back are the same."""
    from colloquy.sources import banks as A

    texts = ["avant\u0085apres", " blanc \u2028 ", "x", '- intent: faq/9', 'a "quoted" one', "", "last"]
    bank = spark.createDataFrame([(i, 10 * n, t) for i in (1, 2) for n, t in enumerate(texts)], "id int, pos long, text string")
    want = sorted((i, n + 1, t) for i in (1, 2) for n, t in enumerate(texts))
    for size in (2, 1000):
        for bytes_ in (4, 1 << 20):
            kw = {"block_rows": size, "block_bytes": bytes_}
            at = str(tmp_path / f"{size}-{bytes_}")
            A.write_grouped_json(bank, at + "j", **kw)
            A.emit_training_blocks(bank, at + "t", **kw)
            A.emit_response_blocks(bank, at + "r", **kw)
            assert sorted((int(a), b, c) for a, b, c in rows(A.read_grouped_json(spark, at + "j"), "id", "pos", "text")) == want
            got = rows(A.read_training_blocks(spark, at + "t"), "intent", "pos", "text")
            assert sorted((int(a[4:]), b, c) for a, b, c in got) == want
            got = rows(A.read_response_blocks(spark, at + "r"), "response", "pos", "text")
            assert sorted((int(a[10:]), b, c) for a, b, c in got) == want
            import pathlib
            for f in pathlib.Path(at + "r").glob("**/part-*.txt"):
                body = f.read_text(encoding="utf-8")
                assert body.startswith("version:") and all(body.count(f"utter_faq/{i}:") <= 1 for i in (1, 2))


def test_a1_keeps_blanks_and_reports_bad_rows(spark, tmp_path):
    from colloquy.sources import banks as A

    bank = spark.createDataFrame([(1, "  lead trail  "), (1, ""), (2, None), (2, "z")], "id int, text string")
    A.write_bank(bank, str(tmp_path / "w"))
    assert sorted(rows(A.read_bank(spark, str(tmp_path / "w")), "id", "text")) == [(1, ""), (1, "  lead trail  "), (2, "z")]
    p = tmp_path / "bad.csv"
    p.write_text("id;t\n1;bon\nx7;perdu\n2;a;b\n1;encore\n", encoding="utf-8")
    assert sorted(rows(A.read_bank(spark, str(p)), "id", "pos", "text")) == [(1, 0, "bon"), (1, 1, "encore")]
    assert sorted(r["record"] for r in A.bank_rejects(spark, str(p)).collect()) == ["2;a;b", "x7;perdu"]


def test_a8_item_matrix(spark, tmp_path):
    from colloquy.sources import banks as A

    p = tmp_path / "reco.csv"
    p.write_text("role;ordinateur;souris;clavier\ndeveloppeur;1;1;0\nmanager;0;1;1\n", encoding="utf-8")
    got = sorted(rows(A.read_item_matrix(spark, str(p)), "role", "item"))
    assert got == [("developpeur", "ordinateur"), ("developpeur", "souris"), ("manager", "clavier"),
                   ("manager", "souris")]


def test_c12_menus_and_buttons(spark):
    menu = C.menu_rows(spark, "misspelled_password")
    assert [r["payload"] for r in menu.orderBy("pos").collect()] == ["/retry_password", "/send_new_pwd",
                                                                      "/change_email"]
    df = spark.createDataFrame([(1, "visa", "passeport")], "req int, k1 string, k2 string")
    b = C.choice_rows(df, ["req"], "k1", "k2").orderBy("pos").collect()
    assert [(r["title"], r["payload"]) for r in b] == [("visa", "/confusion_1"), ("passeport", "/confusion_2"),
                                                       ("autre", "/non_sense")]


def test_d2_lexicon_lemmas_and_pos(spark):
    texts = spark.createDataFrame([(1, "Les voyageurs partent, 3 valises et les passeports.")], "id int, text string")
    lexicon = spark.createDataFrame([("voyageurs", "voyageur", "NOUN"), ("partent", "partir", "VERB"),
                                     ("passeports", "passeport", "NOUN")], "form string, lemma string, pos string")
    plain = [r["word"] for r in D.content_words(texts, ["id"]).orderBy("pos").collect()]
    assert plain == ["voyageurs", "partent", "valises", "passeports"]     # stop words and numbers gone
    lem = [r["word"] for r in D.content_words(texts, ["id"], lexicon=lexicon, keep_pos=["NOUN"])
           .orderBy("pos").collect()]
    assert lem == ["voyageur", "valises", "passeport"]                    # verb dropped, unknown word kept


def test_a1_reads_reference_csv_shape(spark, tmp_path):
    from colloquy.sources import banks as A

    p = tmp_path / "questions.csv"
    p.write_text('id_question_pivot;reponse_prop\n1;Un visa ?\n1;"Le visa est-il obligatoire ? "\n\n'
                 '2;"Deux lignes\net un ; dedans"\n', encoding="utf-8")
    got = sorted(rows(A.read_bank(spark, str(p)), "id", "text"))
    assert got == [(1, "Le visa est-il obligatoire ? "), (1, "Un visa ?"), (2, "Deux lignes\net un ; dedans")]


def test_f2_f3_opening_user_and_non_faq_turn(spark):
    conv = spark.createDataFrame([(1, 0, "user", "q1", "faq"), (1, 1, "assistant", "a1", None),
                                  (1, 2, "user", "salut", "chitchat"), (1, 3, "assistant", "a2", None)],
                                 "conv_id int, turn int, role string, text string, intent string")
    f2 = S.last_value_by_row(conv, "conv_id", ["turn"], F.col("role") == "assistant", F.col("text"), "last_bot",
                             chunk=turn_chunk(width=2))
    assert [r["last_bot"] for r in f2.orderBy("turn").collect()] == [None, "a1", "a1", "a2"]
    f3 = S.last_faq_answer(conv, "conv_id", ["turn"], "role", "intent", chunk=turn_chunk(width=2))
    # the answer after the chit-chat turn does not replace the last FAQ answer
    assert [r["last_faq_answer"] for r in f3.orderBy("turn").collect()] == [None, "a1", "a1", "a1"]


def test_f3_answers_wait_for_the_carried_intent(spark):
    turns = [("user", "faq"), ("assistant", None), ("assistant", None), ("user", "chitchat"), ("assistant", None),
             ("assistant", None), ("user", "faq"), ("assistant", None)] * 3
    conv = spark.createDataFrame([(1, i, r, f"t{i}", x) for i, (r, x) in enumerate(turns)],
                                 "conv_id int, turn int, role string, text string, intent string")
    want, intent, last = [], None, None
    for i, (role, x) in enumerate(turns):
        intent = x or intent
        last = f"t{i}" if role == "assistant" and intent == "faq" else last
        want.append(last)
    for width in (1, 2, 3, 5, 100):
        got = S.last_faq_answer(conv, "conv_id", "turn", "role", "intent", chunk=turn_chunk(width=width))
        assert [r["last_faq_answer"] for r in got.orderBy("turn").collect()] == want


def test_f7_chunks_do_not_show(spark):
    base = dt.datetime(2024, 1, 1)
    import random
    rnd = random.Random(4)
    at, rows_ = 0, []
    for i in range(300):
        at += rnd.choice([1, 20, 59, 60, 61, 200])
        rows_.append((None if i % 2 else 1, i, base + dt.timedelta(minutes=at)))
    ev = spark.createDataFrame(rows_, "user_id int, event_id int, ts timestamp_ntz")
    plain = sorted(rows(S.sessions(ev, "user_id"), "event_id", "session_start"))
    for unit in ("hour", "day", "minute"):
        assert sorted(rows(S.sessions(ev, "user_id", chunk=F.date_trunc(unit, "ts")), "event_id", "session_start")) == plain


def test_f11_types(spark):
    import colloquy.plans.state_queries as Q

    ev = spark.createDataFrame([], "user_id long, event_id long, ts timestamp_ntz, day string, event_type string, "
                                   "props string, intent string, note_text string")
    gate = spark.createDataFrame([], "user_id long, day string, key1 string, conf1 double, "
                                     "bot_question_confusion int, bot_question_incomprehension int")
    out = S.interaction_facts(ev, gate, ["user_id"], ["ts", "event_id"], F.col("props"), F.col("props"), F.lit(True),
                              F.lit(1), "intent", "note_text", F.col("event_id"), "ts", ["user_id", "day"])
    assert out.columns == Q.FACT_COLUMNS
    kinds = dict(out.dtypes)
    assert kinds["question_id"] == "int" and kinds["time_user_question"] == kinds["time_bot_answer"] == "timestamp"

"""Lemmas and parts of speech of words that the lexicon does not hold."""

import collections
import itertools
import math
import random

from colloquy.operators import lemmas as M

LEXICON = [("voyageurs", "voyageur", "NOUN"), ("bagages", "bagage", "NOUN"), ("valise", "valise", "NOUN"),
           ("partent", "partir", "VERB"), ("finissent", "finir", "VERB"), ("parlent", "parler", "VERB"), ("chantent", "chanter", "VERB"),
           ("grandes", "grand", "ADJ"), ("petites", "petit", "ADJ"), ("les", "le", "DET")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "form string, lemma string, pos string")


def texts(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "id int, text string")


def test_unseen_inflected_forms(spark):
    docs = texts(spark, "Les grandes valise parlent", "les petites bagages chantent, les voyageurs partent",
                 "les docteurs dansent", "les lourdes tables", None, "", "123 !")
    model = M.fit_lemmas(frame(spark, LEXICON), docs)
    got = {(r["id"], r["pos"]): (r["word"], r["lemma"], r["tag"]) for r in M.tag_words(docs, model, ["id"]).collect()}
    assert got[2, 0] == ("les", "le", "DET")
    assert got[2, 1] == ("docteurs", "docteur", "NOUN")    # as voyageurs
    assert got[2, 2] == ("dansent", "danser", "VERB")      # as parlent, chantent
    assert got[3, 1] == ("lourdes", "lourd", "ADJ")        # as grandes
    assert {k for k, _ in got} == {0, 1, 2, 3}
    nouns = sorted((r["id"], r["word"]) for r in M.content_lemmas(docs, model, ["id"], keep_pos=["NOUN"]).collect())
    assert (2, "docteur") in nouns and not [w for _, w in nouns if w in ("danser", "le", "chanter")]


def test_context_decides_between_readings(spark):
    lexicon = LEXICON + [("porte", "porte", "NOUN"), ("porte", "porter", "VERB"), ("il", "il", "PRON"), ("la", "le", "DET"),
                         ("table", "table", "NOUN"), ("mange", "manger", "VERB")]
    docs = texts(spark, *["la table"] * 5, *["il mange"] * 5, "la porte", "il porte")
    got = {(r["id"], r["word"]): (r["lemma"], r["tag"]) for r in M.tag_words(docs, M.fit_lemmas(frame(spark, lexicon), docs), ["id"]).collect()}
    assert got[10, "porte"] == ("porte", "NOUN") and got[11, "porte"] == ("porter", "VERB")


def plain_rules(forms):
    count = collections.Counter()
    for form, lemma, pos in forms:
        shared = max(i for i in range(min(len(form), len(lemma)) + 1) if form[:i] == lemma[:i])
        strip, add = len(form) - shared, lemma[shared:]
        for e in range(max(strip, 1), min(len(form), M.ENDING) + 1):
            count[form[-e:], pos, strip, add] += 1
    best = {}
    for (ending, pos, strip, add), n in sorted(count.items(), key=lambda x: (-x[1], x[0][2], x[0][3])):
        best.setdefault((ending, pos), (strip, add, n))
    return best


def plain_candidates(word, forms, rules):
    known = {pos: (lemma, 0) for form, lemma, pos in forms if form == word}
    if known:
        return known
    for e in range(min(M.ENDING, len(word)), 0, -1):
        met = {pos: r for (ending, pos), r in rules.items() if ending == word[-e:]}
        if met:
            total = sum(n for *_, n in met.values())
            return {pos: (word[:len(word) - s] + a, round(M.MICRO * math.log(n / total))) for pos, (s, a, n) in met.items()}
    return {}


def test_equals_a_plain_version(spark):
    rng = random.Random(6)

    def word():
        return "".join(rng.choice(["ma", "to", "li", "re"]) for _ in range(rng.randrange(1, 3))) + rng.choice(["s", "nt", "e", "", "es"])

    seen = {(w := word(), rng.choice("AB")): w.rstrip("s") + rng.choice(["", "r"]) for _ in range(40)}
    lexicon = [(f, la, p) for (f, p), la in seen.items()]
    docs = [" ".join(word() for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    df = texts(spark, *docs)
    model = M.fit_lemmas(frame(spark, lexicon), df)
    rules = plain_rules(lexicon)
    assert {(r["ending"], r["pos"]): (r["strip"], r["add"], r["n"]) for r in model.endings.collect()} == rules

    single = {f: p for f, _, p in lexicon if sum(g == f for g, *_ in lexicon) == 1}
    pairs = collections.Counter()
    for d in docs:
        for a, b in zip(["", *d.split()], d.split()):
            p = "^" if a == "" else single.get(a)
            if p and b in single:
                pairs[p, single[b]] += 1
    tags = model.tags
    for row, p in zip(model.trans, [*tags, "^"]):
        whole = sum(pairs[p, t] for t in tags) + len(tags)
        assert row == [round(M.MICRO * math.log((pairs[p, t] + 1) / whole)) for t in tags]

    got = collections.defaultdict(list)
    for r in M.tag_words(df, model, ["id"]).orderBy("id", "pos").collect():
        got[r["id"]].append((r["lemma"], r["tag"]))
    for i, d in enumerate(docs):
        words = d.split()
        may = [plain_candidates(w, lexicon, rules) for w in words]

        def score(path):
            return sum((may[n][tags[t]][1] if tags[t] in may[n] else M.NEVER if may[n] else 0)
                       + model.trans[path[n - 1] if n else -1][t] for n, t in enumerate(path))

        every = list(itertools.product(range(len(tags)), repeat=len(words)))
        top = max(map(score, every))
        best = min((p for p in every if score(p) == top), key=lambda p: p[::-1])
        assert got[i] == [(may[n][tags[t]][0] if tags[t] in may[n] else words[n], tags[t]) for n, t in enumerate(best)]


def test_long_texts_are_read_in_parts_and_an_empty_lexicon_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(M, "PART", 4)
    docs = texts(spark, "un deux trois quatre cinq six sept huit neuf")
    out = M.tag_words(docs, M.fit_lemmas(frame(spark, []), docs), ["id"]).orderBy("pos").collect()
    assert [(r["pos"], r["lemma"], r["tag"]) for r in out] == [(i, w, None) for i, w in enumerate(docs.first()["text"].split())]

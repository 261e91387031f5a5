"""Operator 2: personal data by weak-supervision aggregation.

Method: candidate spans are found by loose patterns; three labelers vote on each
(+1, 0, -1): a regex labeler (strict shape), a gazetteer labeler (given names,
domain endings, country codes, number plans) and a context labeler (cue words to
the left). Expectation-maximisation over the vote patterns of the whole corpus
estimates each labeler's reliability and gives every pattern a probability. With
these as soft labels a span classifier (logistic regression over kind, votes,
length and neighbouring characters) is trained, and spans of 0.5 and more are added.

The four base kinds (email, ip, card, phone) follow fixed patterns and always
stay; they vote like the others, so they also teach the labelers' reliabilities.

Texts are read once, whole. What is gathered for EM and the classifier is counts
by (kind, votes, features), a set whose size is fixed by the code (at most
kinds x 27 x 36), whatever the corpus. No text is shuffled.

Defined results: a null text is empty; a null doc_id stays null; repeated rows
repeat their result; equal starts are ordered by kind; an empty table gives an
empty result; other columns are not read. All patterns run in time linear in the
text, also on very long runs of one character class.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import id_text
from colloquy.session import materialize, read_table

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("ssn", "iban", "local_phone", "spelled_email", "person")

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}(?![0-9])")
SPELLED = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{2,63}"
                     r"\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z]{2,12}(?![A-Za-z])")
PERSON = re.compile(r"(?<!\w)(?:(?:Mr|Mrs|Ms|Dr|Prof|Mme|Mlle|Herr|Frau|Sr|Sra)\.?\x20)?"
                    r"[A-ZÀ-Þ][a-zà-ÿ]{1,20}\x20[A-ZÀ-Þ][a-zà-ÿ]{1,20}(?!\w)")

# fixed values: small gazetteers of the labelers
NAMES = frozenset("""James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan
Joseph Jessica Thomas Sarah Charles Karen Daniel Nancy Matthew Lisa Anthony Margaret Mark Sandra Paul Ashley Steven
Kimberly Andrew Emily Kevin Donna Brian Michelle George Carol Edward Amanda Jean Marie Pierre Jacques Michel Philippe
Nathalie Isabelle Sophie Camille Julien Nicolas Hans Peter Klaus Wolfgang Juergen Ursula Monika Petra Sabine Anna Stefan
Markus Katrin Jose Antonio Manuel Francisco Juan Maria Carmen Ana Isabel Pilar Dolores Cristina Luis Javier Carlos""".split())
ENDINGS = frozenset("com org net edu gov info io de fr es uk eu ch at it nl us ca".split())
IBAN_COUNTRIES = frozenset("AT BE CH CY CZ DE DK EE ES FI FR GB GR HU IE IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK".split())
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Mme", "Mlle", "Herr", "Frau", "Sr", "Sra")
CUES = {
    "email": ("mail", "contact", "write", "address", "courriel", "correo"),
    "spelled_email": ("mail", "contact", "write", "address", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "carte", "karte", "tarjeta"),
    "phone": ("call", "phone", "tel", "mobile", "fax", "anruf", "llame"),
    "local_phone": ("call", "phone", "tel", "mobile", "fax", "anruf", "llame"),
    "ssn": ("ssn", "social", "security"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "person": ("name", "dear", "regards", "signed", "author", "nom", "nombre"),
}
DENIALS = ("version", "isbn", "section", "order", "invoice", "figure", "table")


def _luhn(digits: str) -> bool:
    d = [int(x) for x in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def _digits(s: str) -> str:
    return "".join(x for x in s if x in "0123456789")


def _emails(text: str):
    """Leftmost, non-overlapping matches of the base pattern, found from each '@' outwards."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _ok_ip(s: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in s.split("."))


def _ok_card(s: str) -> bool:
    d = _digits(s)
    return 14 <= len(d) <= 19 and _luhn(d)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", s, e) for s, e in _emails(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if _ok_ip(m[0])]
    found += [("card", *m.span()) for m in CARD.finditer(text) if _ok_card(m[0])]
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return found


def loose_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    for kind, rule in (("ssn", SSN), ("iban", IBAN), ("local_phone", LOCAL_PHONE)):
        found += [(kind, *m.span()) for m in rule.finditer(text)]
    if "at" in text and "dot" in text:
        found += [("spelled_email", *m.span()) for m in SPELLED.finditer(text)]
    found += [("person", *m.span()) for m in PERSON.finditer(text)]
    return found


def votes(kind: str, text: str, s: int, e: int) -> tuple[int, int, int]:
    """Regex, gazetteer and context labeler on one span: +1, 0 or -1."""
    v, left = text[s:e], text[max(0, s - 40):s].lower()
    d = _digits(v)
    if kind in ("email", "spelled_email"):
        shape = 1 if len(v) <= 254 and ".." not in v else -1
        lexicon = 1 if v.rsplit(".", 1)[-1].rsplit(" ", 1)[-1].strip(")]").lower() in ENDINGS else 0
    elif kind == "ip":
        shape, lexicon = (1 if _ok_ip(v) else -1), (-1 if v.startswith(("0.", "255.")) else 0)
    elif kind == "card":
        shape, lexicon = (1 if _ok_card(v) else -1), (1 if d[0] in "3456" else 0)
    elif kind in ("phone", "local_phone"):
        shape = 1 if 10 <= len(d) <= 15 else -1
        lexicon = 1 if kind == "phone" and d[0] != "0" else -1 if len(set(d)) < 3 else 0
    elif kind == "ssn":
        ok = d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        shape, lexicon = (1 if ok else -1), 0
    elif kind == "iban":
        w = v.replace(" ", "")
        moved = "".join(str(int(x, 36)) for x in w[4:] + w[:4])
        shape, lexicon = (1 if int(moved) % 97 == 1 else -1), (1 if w[:2] in IBAN_COUNTRIES else -1)
    else:
        words = v.split(" ")
        titled = words[0].rstrip(".") in TITLES
        shape, lexicon = (1 if titled else 0), (1 if any(w in NAMES for w in words) else -1)
    context = 1 if any(x in left for x in CUES[kind]) else -1 if any(x in left for x in DENIALS) else 0
    return shape, lexicon, context


def features(text: str, s: int, e: int) -> int:
    """Length class (4) x class of the character before (3) and after (3)."""
    def side(i):
        return 0 if not 0 <= i < len(text) or text[i].isspace() else 1 if text[i].isalnum() else 2
    n = e - s
    return ((0 if n < 10 else 1 if n < 16 else 2 if n < 24 else 3) * 3 + side(s - 1)) * 3 + side(e)


def pattern_code(v: tuple[int, int, int]) -> int:
    return (v[0] + 1) * 9 + (v[1] + 1) * 3 + v[2] + 1


CANDIDATE = "struct<kind:int,s:int,e:int,votes:int,feat:int>"


def label(docs: DataFrame) -> DataFrame:
    """doc_id and all candidate spans with votes and features, base kinds included;
    written once to the shared folder."""
    def run(batches):
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                text = text or ""
                spans = base_spans(text) + loose_spans(text)
                rows.append([(KINDS.index(k), s, e, pattern_code(votes(k, text, s, e)), features(text, s, e))
                             for k, s, e in spans])
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "spans": rows})

    return materialize(id_text(docs).mapInPandas(run, f"doc_id long, spans array<{CANDIDATE}>"), "pii_votes")


def estimate(counts: list[tuple[int, int, int, int]], rounds: int = 100) -> dict[tuple[int, int], float]:
    """EM over (kind, votes, feat, n): P(real | kind, votes). Reliability of each
    labeler (its vote law given real or not) is shared by all kinds; each kind has its own prior."""
    n = Counter()
    for kind, code, _, c in counts:
        n[kind, code] += c
    if not n:
        return {}
    keys = sorted(n)
    weight = np.array([n[k] for k in keys], float)
    kind = np.array([k for k, _ in keys])
    vote = np.array([[c // 9, c // 3 % 3, c % 3] for _, c in keys])
    prior = np.full(len(KINDS), 0.5)
    law = np.array([[[0.6, 0.3, 0.1], [0.1, 0.3, 0.6]]] * 3)  # labeler, class, vote
    p = np.zeros(len(keys))
    for _ in range(rounds):
        like = np.stack([np.prod([law[x, z, vote[:, x]] for x in range(3)], axis=0) for z in (0, 1)])
        like *= np.stack([1 - prior[kind], prior[kind]])
        p = like[1] / like.sum(axis=0)
        for x in range(3):
            for z, w in ((0, weight * (1 - p)), (1, weight * p)):
                c = np.bincount(vote[:, x], w, 3) + 1.0
                law[x, z] = c / c.sum()
        real, all_ = np.bincount(kind, weight * p, len(KINDS)), np.bincount(kind, weight, len(KINDS))
        prior = (real + 1) / (all_ + 2)
    return {k: float(x) for k, x in zip(keys, p)}


def _design(kind: int, code: int, feat: int) -> np.ndarray:
    x = np.zeros(1 + len(KINDS) + 9 + 4 + 3 + 3)
    x[0] = 1
    x[1 + kind] = 1
    at = 1 + len(KINDS)
    for i, v in enumerate((code // 9, code // 3 % 3, code % 3)):
        x[at + 3 * i + v] = 1
    at += 9
    x[at + feat // 9] = x[at + 4 + feat // 3 % 3] = x[at + 7 + feat % 3] = 1
    return x


def train(counts: list[tuple[int, int, int, int]], ridge: float = 1.0, steps: int = 30) -> dict[tuple[int, int, int], float]:
    """Logistic regression on EM's soft labels, by Newton steps over the grouped
    counts; returns the probability of every feature combination that occurs."""
    if not counts:
        return {}
    soft = estimate(counts)
    x = np.array([_design(k, c, f) for k, c, f, _ in counts])
    y = np.array([soft[k, c] for k, c, _, _ in counts])
    w = np.array([n for *_, n in counts], float)
    w /= max(1.0, w.max() / 1e4)  # a very common combination must not drown the ridge's scale
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) - ridge * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        beta += np.linalg.solve(hess, grad)
    p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
    return {(k, c, f): float(v) for (k, c, f, _), v in zip(counts, p)}


def classifier(labelled: DataFrame) -> dict[tuple[int, int, int], float]:
    """Counts by (kind, votes, features) over all documents, and the model fitted to them."""
    grouped = labelled.select(F.explode("spans").alias("x")).groupBy("x.kind", "x.votes", "x.feat").count()
    return train(sorted((r["kind"], r["votes"], r["feat"], r["count"]) for r in grouped.collect()))


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: base counts and digest, and all accepted spans."""
    labelled = label(docs)
    model = classifier(labelled)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most kinds x 27 x 36 numbers

    def run(batches):
        p = sent.value
        for pdf in batches:
            rows = []
            for spans in pdf["spans"]:
                base = [(x["s"], x["kind"], x["e"]) for x in spans if x["kind"] < len(BASE)]
                more = [(x["s"], x["kind"], x["e"]) for x in spans if x["kind"] >= len(BASE)
                        and p.get((x["kind"], x["votes"], x["feat"]), 0.0) >= 0.5]
                n = Counter(k for _, k, _ in base)
                rows.append((*[n[k] for k in range(len(BASE))],
                             hashlib.sha256(_written(base).encode()).hexdigest(), _written(base + more)))
            out = pd.DataFrame(rows, columns=[*[f"n_{k}" for k in BASE], "base_sha256", "spans"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").values)
            yield out

    return labelled.mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                     "base_sha256 string, spans string")


def op2(spark, sf_dir: str) -> DataFrame:
    return find(read_table(spark, sf_dir, "documents"))

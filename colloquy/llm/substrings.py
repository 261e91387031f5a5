"""Operator 10: substring dedup by seed and extend.

A window is ``WINDOW`` = 35 consecutive words; every word covered by a window whose
words also start anywhere else (same document included) is removed.

Method: of the ``GRAM``-word hashes inside a window the least (leftmost of equals) is its
anchor, so equal windows have equal anchors at equal places, and a text has an anchor
every ten words or so (winnowing). Texts are joined on anchors: anchors that occur once
are dropped. Each seed left, an anchor at a place in a text, is extended both ways to its
span: all windows that it anchors, at most 28, from the first word of the first to the
last of the last. Equal spans are counted together (combined map-side, so a passage that
a third of all documents share is one row per task); then the windows inside different
spans of one anchor are counted, which finds the repeats that end inside a span. A window
counted twice or more is a match; the union of a text's matches are its maximal repeats
of at least 35 words, and they are cut out.

Documents with equal word sequences are one class: only its smallest doc_id is read
again, and if the class has two members every window of it is repeated.

Windows are told apart by a 64-bit window hash together with a 64-bit anchor hash of
another family and the place in it. No pair of occurrences is emitted, and nothing is
gathered but the repeats of one document.

Defined results: a null or blank text has no words (kept_sha256 of the empty string);
texts shorter than a window keep all words; a null doc_id is kept as null; repeated
rows are copies of each other, so their windows are repeated; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import gram_hashes, id_text, mix, signed, word_hashes
from colloquy.session import materialize, read_table

WINDOW, GRAM = 35, 8
PER_WINDOW = WINDOW - GRAM + 1
SALT = np.uint64(0x5851F42D4C957F2D)


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor hash per GRAM start, anchor position of every window)."""
    g = gram_hashes(h ^ SALT, GRAM)
    n = len(h) - WINDOW + 1
    return g, np.arange(n) + sliding_window_view(g, PER_WINDOW).argmin(axis=1)


def name_of(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, name, n_words, all_sha256) and classes (name, id and text hash ``h`` of one of
    their rows, copies, n_words, anchors)."""
    slim = id_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("h"))

    def run(batches):
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                words = text.split() if text else []
                a = np.empty(0, dtype=np.uint64)
                if len(words) >= WINDOW:
                    g, at = anchors(word_hashes(words))
                    a = g[np.unique(at)]
                out.append((name_of(words), len(words), hashlib.sha256(b" ".join(words)).hexdigest(), signed(a)))
            out = pd.DataFrame(out, columns=["name", "n_words", "all_sha256", "anchors"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").values)
            out["h"] = pdf["h"].values
            yield out

    rows = materialize(slim.mapInPandas(
        run, "doc_id long, name binary, n_words int, all_sha256 string, anchors array<long>, h long"), "substr_rows")
    # the class's first row; anchors travel with it
    grouped = rows.where(f"n_words >= {WINDOW}").groupBy("name").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "h", "n_words", "anchors")).alias("x"))
    return rows, materialize(grouped.select("name", F.col("x.doc_id").alias("id"), F.col("x.h").alias("h"), "copies", "x.n_words", "x.anchors"),
                             "substr_classes")


def seeded_texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(name, copies, text, seeds): one text per class that has an anchor which occurs elsewhere too."""
    each = known.select("name", F.explode("anchors").alias("anchor"))
    # written, so that the join below can split a frequent anchor
    again = materialize(each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"),
                        "substr_again")
    seeds = each.join(again, "anchor").groupBy("name").agg(F.collect_set("anchor").alias("seeds"))
    seeds = seeds.join(known.select("name", "id", "h", "copies"), "name")
    slim = id_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    # by the text as well, so that rows without an id do not all meet
    both = slim.join(seeds, slim["doc_id"].eqNullSafe(seeds["id"]) & (F.xxhash64(slim["text"].cast("string")) == seeds["h"])).select("name", "copies", "text", "seeds", "id")

    def same(batches):
        for pdf in batches:  # other rows may have the same id
            ok = [name_of(t.split()) == n if t else False for t, n in zip(pdf["text"], pdf["name"])]
            yield pdf[ok].drop(columns="id")

    checked = both.mapInPandas(same, "name binary, copies long, text binary, seeds array<long>")
    return materialize(checked, "substr_texts")


def extend(texts: DataFrame) -> DataFrame:
    """(name, copies, at, anchor, span, windows): every seed with the windows it anchors, from
    word ``at`` on; ``span`` names the whole stretch."""
    def run(batches):
        for pdf in batches:
            out = []
            for name, copies, text, seeds in pdf[["name", "copies", "text", "seeds"]].itertuples(index=False):
                h = word_hashes(text.split())
                g, at = anchors(h)
                w = gram_hashes(h, WINDOW)
                own = signed(g)[at]
                cut = np.flatnonzero(np.diff(at)) + 1  # windows of one anchor are neighbours
                lo, hi = np.r_[0, cut], np.r_[cut, len(at)]
                for s, e in zip(lo[np.isin(own[lo], seeds)], hi[np.isin(own[lo], seeds)]):
                    # the place of each window relative to the anchor is part of its hash
                    places = mix(w[s:e] + np.arange(at[s] - s, at[s] - e, -1).astype(np.uint64) * SALT)
                    out.append((name, copies, int(s), int(own[s]),
                                xxhash.xxh3_64_intdigest(places.tobytes()) - 2**63, signed(places)))
            yield pd.DataFrame(out, columns=["name", "copies", "at", "anchor", "span", "windows"])

    return materialize(texts.mapInPandas(
        run, "name binary, copies long, at int, anchor long, span long, windows array<long>"), "substr_seeds")


def repeats(spans: DataFrame) -> DataFrame:
    """(name, at, mask): bit i of mask is set if the window at word at+i is repeated."""
    # max, not first: equal spans have equal windows, and a maximum is combined map-side
    distinct = materialize(spans.groupBy("anchor", "span").agg(
        F.sum("copies").alias("n"), F.max("windows").alias("windows")), "substr_spans")
    windows = distinct.select("anchor", "span", "n", F.posexplode("windows").alias("i", "w"))
    again = windows.groupBy("anchor", "w").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "w")
    alone = windows.where("n = 1").join(again, ["anchor", "w"]).groupBy("anchor", "span").agg(
        F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask"))
    whole = distinct.where("n > 1").select(
        "anchor", "span", F.expr("shiftleft(1L, size(windows)) - 1L").alias("mask"))
    return spans.select("name", "at", "anchor", "span").join(
        alone.unionByName(whole), ["anchor", "span"]).select("name", "at", "mask")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    rows, known = classes(docs)
    texts = seeded_texts(docs, known)
    masks = repeats(extend(texts)).groupBy("name").agg(F.collect_list(F.struct("at", "mask")).alias("cuts"))
    single = texts.where("copies = 1").select("name", "text").join(masks, "name")

    def cut(batches):
        for pdf in batches:
            out = []
            for name, text, cuts in pdf[["name", "text", "cuts"]].itertuples(index=False):
                words = text.split()
                edge = np.zeros(len(words) + 1, dtype=np.int32)
                for c in cuts:
                    starts = c["at"] + np.flatnonzero(c["mask"] >> np.arange(PER_WINDOW) & 1)
                    edge[starts] += 1
                    np.subtract.at(edge, starts + WINDOW, 1)
                kept = [w for w, n in zip(words, np.cumsum(edge[:-1])) if not n]
                out.append((name, len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pd.DataFrame(out, columns=["name", "n_removed", "kept_sha256"])

    done = single.mapInPandas(cut, "name binary, n_removed int, kept_sha256 string")
    copied = known.where("copies > 1").select(
        "name", F.col("n_words").alias("n_removed"), F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"))
    return rows.select("doc_id", "name", "n_words", "all_sha256").join(
        done.unionByName(copied), "name", "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"))


def op10(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))

"""C5 (learned): an entity tagger that finds values no gazetteer holds.

A text becomes token sequences, cut after ``.``, ``!`` and ``?`` and every ``PART`` tokens.
A token has features (itself, its neighbours, its ending, its shape and length); a weight
table says what a feature speaks for each tag (``O``, ``B-x``, ``I-x`` per entity x), and
transitions between neighbouring tags are features too. The best tag sequence is found by
Viterbi's recursion, written as Column expressions over a sequence's scores.

A feature reads one word: the token itself, the one before or the one after. So what the weights
say is added up once per distinct word, in each of these three places, and a token is one row
that meets one row of its word, however many features there are.

``fit_tagger`` is the structured perceptron in batches: training sequences are dealt to
``batches`` by a hash of their words. A batch is decoded with the weights so far, and every
feature of a wrong sequence votes +1 for the right tag and -1 for the decoded one; a weight
moves by one in the direction of the batch's vote (whole sums overshoot when a batch has many
sequences of one kind). The model is the sum of the weights after every batch of every epoch
(the averaged perceptron without the division). Weights are whole numbers, so sums do not
depend on the order of rows.

Feature weights stay a distributed table. The driver holds the tags (one pair per entity) and
the transitions between them (tags squared).

Ties go to the tag that comes first: at every step the earlier previous tag, at the end the
earlier last tag; tags are ``O`` and then ``B-x``, ``I-x`` by entity name. Null and empty texts
have no sequences. Malformed annotations are text. Repeated rows count as often as they stand.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.text import SPAN_PATTERN
from colloquy.operators.intents import ENTITY_TOKEN_RE
from colloquy.session import materialize

EPOCHS, BATCHES, PART, ENDING, LONGEST = 3, 6, 512, 3, 12
OUTSIDE, BEGIN, INSIDE = "O", "B-", "I-"
# a well-formed annotation, or the text up to the next bracket
_PIECE = rf"{SPAN_PATTERN}|(?s:.)[^\[]*"


@dataclass(frozen=True)
class Tagger:
    """``weights(feature, tag, w)``; ``tags`` in their order; ``trans[p][t]`` of tag t after
    tag p, the last row for the first token of a sequence; ``ends`` what the tags get at the
    first token for having none before, and at the last for having none after."""

    tags: list[str]
    weights: DataFrame
    trans: list[list[int]]
    ends: list[list[int]]


def tagged_tokens(text: Column, annotated: bool) -> Column:
    """array<struct<token, tag>> of a text; without ``annotated`` all tags are O."""
    def tokens(c, entity):
        words = F.regexp_extract_all(c, F.lit(ENTITY_TOKEN_RE), 0)
        tag = (lambda i: F.lit(OUTSIDE)) if entity is None else (
            lambda i: F.when(entity == "", F.lit(OUTSIDE)).otherwise(
                F.concat(F.when(i == 0, F.lit(BEGIN)).otherwise(F.lit(INSIDE)), entity)))
        return F.transform(words, lambda w, i: F.struct(w.alias("token"), tag(i).alias("tag")))

    if not annotated:
        return tokens(text, None)

    def piece(p):
        entity = F.regexp_extract(p, f"^{SPAN_PATTERN}$", 2)
        return tokens(F.when(entity == "", p).otherwise(F.regexp_extract(p, f"^{SPAN_PATTERN}$", 1)), entity)

    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), 0), piece))


def sequences(df: DataFrame, keys: Sequence[str], text: str = "text", annotated: bool = False) -> DataFrame:
    """(keys, _s, at, toks): the sequences of every text with a number each; ``at`` is the
    position of the first token in its text."""
    toks = df.select(*keys, tagged_tokens(F.col(text), annotated).alias("toks"))
    n = F.size("toks")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: F.get("toks", i - 1)["token"].isin(".", "!", "?") | (i == n))
    # only the parts themselves go on, not the whole text with each of them
    parts = toks.where(n > 0).withColumn("ends", ends).select(*keys, F.explode(F.flatten(F.expr(f"""
        transform(ends, (hi, e) -> transform(sequence(if(e = 0, 0, ends[e - 1]), hi - 1, {PART}), at -> struct(
          at, slice(toks, at + 1, least({PART}, hi - at)) AS toks)))"""))).alias("part"))
    out = parts.select(*keys, "part.at", "part.toks")
    # written, so that the numbers stay the same when a task is repeated
    return materialize(out.withColumn("_s", F.monotonically_increasing_id()), "tagger_sequences")


def word_features(token: Column) -> list[Column]:
    """The features that a token has of itself: the word, its ending, its shape and length."""
    low, shape = F.lower(token), token
    for pattern, sign in ((r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), (r"\p{N}+", "0")):
        shape = F.regexp_replace(shape, pattern, sign)
    return [F.concat(F.lit("w="), low), F.concat(F.lit("e="), F.right(low, F.lit(ENDING))), F.concat(F.lit("h="), shape),
            F.concat(F.lit("l="), F.least(F.char_length(token), F.lit(LONGEST)).cast("string"))]


def beside(sign: str, token: Column) -> Column:
    """The feature of the token before (``p``) or after (``n``), null for none."""
    return F.concat(F.lit(f"{sign}="), F.coalesce(F.lower(token), F.lit("")))


def token_features(seqs: DataFrame) -> DataFrame:
    """(_s, i, features): every token with its features."""
    def around(t, i):
        return F.struct(t["token"].alias("token"), F.when(i > 0, F.get("toks", i - 1)["token"]).alias("before"),
                        F.get("toks", i + 1)["token"].alias("after"))

    each = seqs.select("_s", F.posexplode(F.transform("toks", around)).alias("i", "t"))
    return each.select("_s", "i", F.array(*word_features(F.col("t.token")), beside("p", F.col("t.before")),
                                          beside("n", F.col("t.after"))).alias("features"))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.transform(F.array(value), use)[0]


def viterbi(scores: Column, trans: list[list[int]]) -> Column:
    """The best sequence of tag numbers for ``scores`` (array per token of a long per tag)."""
    k = len(trans[0])
    # a total and the tag it came from are one number, k * total + (k - 1 - tag before): of equal
    # totals the earlier tag gives the larger number
    first = F.transform(scores[0], lambda s, t: (s + F.array(*map(F.lit, trans[-1]))[t]) * k).cast("array<bigint>")

    def largest(codes):
        return F.greatest(*codes) if k > 1 else codes[0]

    def whole(code):
        return code - F.pmod(code, F.lit(k))

    def step(codes, here):
        came = F.transform(F.element_at(codes, -1), lambda c, p: whole(c) + (k - 1 - p))
        return F.concat(codes, F.array(_bound(came, lambda b: F.array(*[
            largest([b[p] + F.lit(trans[p][t] * k) for p in range(k)]) + here[t] * k for t in range(k)]))))

    def trace(codes):
        totals = F.transform(F.element_at(codes, -1), whole)
        end = _bound(totals, lambda x: (F.array_position(x, F.array_max(x)) - 1).cast("int"))
        return F.reverse(F.aggregate(F.reverse(F.slice(codes, 2, F.size(codes) - 1)), F.array(end), lambda path, c: F.concat(
            path, F.array((F.lit(k - 1) - F.pmod(F.get(c, F.element_at(path, -1)), F.lit(k))).cast("int")))))

    return F.aggregate(F.slice(scores, 2, F.greatest(F.size(scores) - 1, F.lit(0))), F.array(first), step, trace)


def word_scores(words: DataFrame, tagger: Tagger) -> DataFrame:
    """(token, w): what the weights say for each of ``words(token)``, a long per tag: for a token
    that is the word, then for the token after it, then for the token before it."""
    by_tag = tagger.weights.groupBy("feature").agg(F.array(*[
        F.sum(F.when(F.col("tag") == t, F.col("w")).otherwise(0)) for t in tagger.tags]).alias("w"))
    token = F.col("token")
    places = [*[(0, f) for f in word_features(token)], (1, beside("p", token)), (2, beside("n", token))]
    said = words.select("token", F.explode(F.array(*[
        F.struct(F.lit(n).alias("place"), f.alias("feature")) for n, f in places])).alias("f")).select("token", "f.*")
    return said.join(by_tag, "feature", "left").groupBy("token").agg(F.array(*[
        F.coalesce(F.sum(F.when(F.col("place") == n, F.col("w")[t])), F.lit(0))
        for n in range(3) for t in range(len(tagger.tags))]).alias("w"))


def decode(seqs: DataFrame, tagger: Tagger) -> DataFrame:
    """(_s, path): the best tags (numbers) of every sequence of ``seqs(_s, toks)``."""
    each = seqs.select("_s", F.posexplode("toks.token").alias("i", "token"))
    met = each.join(word_scores(each.select("token").distinct(), tagger), "token")
    whole = met.groupBy("_s").agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("x")).select(
        "_s", F.col("x.w").alias("x"))  # at most PART tokens
    k, (none_before, none_after) = len(tagger.tags), tagger.ends
    scores = F.transform("x", lambda w, i: F.array(*[
        w[t] + F.coalesce(F.get(F.get("x", i - 1), F.lit(k + t)), F.lit(none_before[t]))
        + F.coalesce(F.get(F.get("x", i + 1), F.lit(2 * k + t)), F.lit(none_after[t])) for t in range(k)]))
    return whole.select("_s", scores.alias("scores")).select("_s", viterbi(F.col("scores"), tagger.trans).alias("path"))


def _moves(seqs: DataFrame, tokens: DataFrame, paths: DataFrame, tags: list[str]) -> DataFrame:
    """(feature, tag, w): what the vote of the wrong sequences adds to the weights."""
    names = F.array(*map(F.lit, tags))
    both = seqs.join(paths, "_s").select("_s", F.col("toks.tag").alias("gold"),
                                         F.transform("path", lambda p: F.get(names, p)).alias("guess"))
    wrong = materialize(both.where("gold <> guess"), "tagger_wrong")  # read three times
    tag_of = wrong.select("_s", F.posexplode(F.arrays_zip("gold", "guess")).alias("i", "t")).where("t.gold <> t.guess")
    sides = F.explode(F.array(F.struct(F.col("t.gold").alias("tag"), F.lit(1).alias("w")),
                              F.struct(F.col("t.guess").alias("tag"), F.lit(-1).alias("w"))))
    emitted = tokens.join(tag_of, ["_s", "i"]).select(
        F.explode("features").alias("feature"), "t").select("feature", sides.alias("m"))

    def steps(c, sign):
        return wrong.select(F.explode(F.transform(c, lambda t, i: F.struct(
            F.concat(F.lit("t="), F.when(i > 0, F.get(c, i - 1)).otherwise(F.lit("^"))).alias("feature"),
            F.struct(t.alias("tag"), F.lit(sign).alias("w")).alias("m")))).alias("x")).select("x.*")

    moves = emitted.unionByName(steps("gold", 1)).unionByName(steps("guess", -1))
    return moves.groupBy("feature", F.col("m.tag").alias("tag")).agg(F.signum(F.sum("m.w")).cast("long").alias("w")).where("w <> 0")


def with_transitions(weights: DataFrame, tags: list[str]) -> Tagger:
    """A tagger from ``weights(feature, tag, w)``; transitions are the features ``t=<tag before>``."""
    names = [*[f"t={t}" for t in [*tags, "^"]], "p=", "n="]
    found = {(r["feature"], r["tag"]): r["w"] for r in weights.where(F.col("feature").isin(names)).groupBy(
        "feature", "tag").agg(F.sum("w").alias("w")).collect()}  # at most (tags + 3) x tags rows
    rows = [[int(found.get((f, t), 0)) for t in tags] for f in names]
    return Tagger(tags, weights, rows[:-2], rows[-2:])


def fit_tagger(examples: DataFrame, text: str = "text", epochs: int = EPOCHS, batches: int = BATCHES) -> Tagger:
    """The tagger learned from annotated texts (``[value](entity)``, B10)."""
    words = F.md5(F.array_join("toks.token", " ").cast("binary"))
    batch = F.conv(F.substring(words, 1, 8), 16, 10).cast("long") % batches
    seqs = sequences(examples, [], text, annotated=True)
    tokens = materialize(token_features(seqs), "tagger_tokens")
    spark = examples.sparkSession
    entities = [r["e"] for r in seqs.select(F.explode("toks.tag").alias("tag")).where(F.col("tag") != OUTSIDE).select(
        F.substring("tag", 3, 1 << 30).alias("e")).distinct().orderBy("e").collect()]  # the kinds of entity
    tags = [OUTSIDE] + [f"{side}{e}" for e in entities for side in (BEGIN, INSIDE)]
    now = total = spark.createDataFrame([], "feature string, tag string, w long")
    for n in range(epochs * batches):
        some = seqs.where(batch == n % batches)
        moves = _moves(some, tokens, decode(some, with_transitions(now, tags)), tags)

        def added(a, b):
            return a.unionByName(b).groupBy("feature", "tag").agg(F.sum("w").alias("w")).where("w <> 0")

        now = materialize(added(now, moves), "tagger_now")
        total = materialize(added(total, now), "tagger_total")
    return with_transitions(total, tags)


def find_entities(df: DataFrame, tagger: Tagger, keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, start, n_tokens, value, entity): the spans that the tagger marks; ``start`` is the
    position of the first token in its text (from 0), ``value`` its tokens joined by a space.
    A span begins at ``B-x``, or at ``I-x`` after a tag of something else."""
    seqs = sequences(df, keys, text)
    names = F.array(*map(F.lit, tagger.tags))
    tagged = seqs.join(decode(seqs, tagger), "_s").select(*keys, "at", F.col("toks.token").alias("toks"),
                                           F.transform("path", lambda p: F.get(names, p)).alias("tags"))

    def entity_at(i):
        return F.substring(F.get("tags", i), 3, 1 << 30)

    def goes_on(i):
        here, before = F.get("tags", i), F.get("tags", i - 1)
        return (i > 0) & here.startswith(INSIDE) & (before != OUTSIDE) & (entity_at(i - 1) == entity_at(i))

    n = F.size("tags")
    # a span ends where the next token does not go on with it; one pass over a sequence's tokens
    tagged = tagged.withColumn("cuts", F.concat(F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~goes_on(i)), F.array(n)))
    spans = F.filter(F.transform("cuts", lambda lo, c: F.struct(lo.alias("lo"), F.get("cuts", c + 1).alias("hi"))),
                     lambda x: F.get("tags", x["lo"]) != OUTSIDE)
    found = F.transform(spans, lambda x: F.struct(
        (F.col("at") + x["lo"]).alias("start"), (x["hi"] - x["lo"]).alias("n_tokens"),
        F.array_join(F.slice("toks", x["lo"] + 1, x["hi"] - x["lo"]), " ").alias("value"), entity_at(x["lo"]).alias("entity")))
    return tagged.select(*keys, F.explode(found).alias("found")).select(*keys, "found.*")

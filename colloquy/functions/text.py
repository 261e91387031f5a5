"""Scalar text functions (Column -> Column), all JVM-side expressions.

Every function here builds a Catalyst expression, so it stays inside
whole-stage codegen and can be pushed through projections and filters.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
# Mis-decoded Windows-1252 characters and their repairs:
#   U+0092 -> "'"   U+009C -> "oe"   U+0080 -> "€"   U+00A0 -> " "
C1_QUOTE = "\u0092"
C1_OE = "\u009c"
C1_EURO = "\u0080"
NBSP = "\u00a0"
# Ligatures and what they fold to.
LIGATURES = {"œ": "oe", "æ": "ae", "ĳ": "ij", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬆ": "st"}
# Accepted ratings.
RATINGS = ["1", "2", "3", "4", "5"]
# Rating prompt shown for an invalid rating.
RATING_MESSAGE = "veuillez renseigner une valeur entre 1 et 5"
# E-mail pattern: local part, "@", a domain whose last letter may repeat, ".com".
EMAIL_LOCAL = r"[A-Za-z0-9._%+-]+"
EMAIL_INVALID_TEMPLATE = "utter_email_invalid"
# Span annotation "[value](entity)".
SPAN_PATTERN = r"\[([^\]\[]+)\]\(([^()]+)\)"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair_text(c, mode: str = "full") -> Column:
    """B1: undo mis-decoded C1 characters.

    ``full`` repairs all four, ``no_nbsp`` the three C1 characters,
    ``nbsp_only`` only the non-breaking space. Each repair is a byte-level
    ``replace`` (faster than ``translate``, which looks up every character).
    """
    pairs = {
        "full": [(C1_QUOTE, "'"), (C1_OE, "oe"), (C1_EURO, "€"), (NBSP, " ")],
        "no_nbsp": [(C1_QUOTE, "'"), (C1_OE, "oe"), (C1_EURO, "€")],
        "nbsp_only": [(NBSP, " ")],
    }
    if mode not in pairs:
        raise ValueError(f"unknown repair mode {mode!r}")
    c = _col(c)
    for bad, good in pairs[mode]:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


def intent_id(key) -> Column:
    """B2: part after '/' of a response key ``faq/12``; null when absent."""
    return F.nullif(F.split_part(_col(key), F.lit("/"), F.lit(2)), F.lit(""))


def email_pattern(domain: str = "example") -> str:
    """Whole-address pattern; the domain's last letter may repeat."""
    return rf"\b{EMAIL_LOCAL}@{domain}+\.com\b"


def valid_email(c, pattern: str | None = None) -> Column:
    """The address when it matches the whole pattern, else null.

    ``\\A...\\z`` anchors the match: ``$`` would accept a final newline.
    """
    pattern = pattern or email_pattern()
    c = _col(c)
    return F.when(c.rlike(rf"\A(?:{pattern})\z"), c)


def email_error(c, pattern: str | None = None) -> Column:
    """Template to send for an invalid address (null when valid)."""
    return F.when(valid_email(c, pattern).isNull(), F.lit(EMAIL_INVALID_TEMPLATE))


def valid_rating(c) -> Column:
    """Rating text in 1..5, else null."""
    c = _col(c).cast("string")
    return F.when(c.isin(RATINGS), c)


def rating_message(c) -> Column:
    """Prompt for an invalid rating, null when valid."""
    return F.when(valid_rating(c).isNull(), F.lit(RATING_MESSAGE))


def parse_event_time(c) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss[.ffffff]`` to TIMESTAMP_NTZ; null if malformed.
    No time zone is involved: the form is checked, then cast."""
    c = _col(c)
    form = r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d{1,6})?\z"
    return F.when(c.rlike(form), c.try_cast("timestamp_ntz"))


def format_confidence(c) -> Column:
    """``round(100*x, 2)`` followed by `` %``."""
    return F.concat(F.round(F.lit(100.0) * _col(c), 2).cast("string"), F.lit(" %"))


def render_template(text, **values) -> Column:
    """Fill ``{name}``-style holes with column values (null keeps the hole)."""
    out = _col(text)
    for hole, value in values.items():
        mark = "{" + hole + "}"
        out = F.replace(out, F.lit(mark), F.coalesce(_col(value).cast("string"), F.lit(mark)))
    return out


def _accents() -> tuple[str, str]:
    """Every precomposed lower-case Latin letter and its base letter; the combining
    marks at the end have no counterpart, so ``translate`` deletes them."""
    pairs = []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = "".join(x for x in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(x))
        if chr(code).lower() == chr(code) != plain and len(plain) == 1:
            pairs.append((chr(code), plain))
    marks = "".join(map(chr, range(0x300, 0x370)))
    return "".join(a for a, _ in pairs) + marks, "".join(b for _, b in pairs)


def fold_text(c) -> Column:
    """Lower, trim, strip accents (all Latin letters, composed or with
    combining marks) and open ligatures."""
    out = F.translate(F.lower(F.trim(_col(c))), *_accents())
    for ligature, letters in LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(letters))
    return out


def annotate_entity(text, keyword: str, entity: str) -> Column:
    """When the keyword occurs, wrap every occurrence as ``[kw](entity)``."""
    t = _col(text)
    tagged = F.replace(t, F.lit(keyword), F.lit(f"[{keyword}]({entity})"))
    return F.when(t.contains(keyword), tagged).otherwise(t)


def plain_text(text) -> Column:
    """Text with every well-formed span replaced by its value."""
    return F.regexp_replace(_col(text), SPAN_PATTERN, "$1")


def extract_annotations(df: DataFrame, text: str = "text", keys=("doc_id",)) -> DataFrame:
    """One row per well-formed ``[value](entity)`` span.

    Malformed forms (``[a]b``, ``[a][b]``) produce no span and stay as text.
    """
    spans = F.arrays_zip(
        F.regexp_extract_all(F.col(text), F.lit(SPAN_PATTERN), 1).alias("value"),
        F.regexp_extract_all(F.col(text), F.lit(SPAN_PATTERN), 2).alias("entity"),
    )
    return (
        df.select(*keys, F.posexplode(spans).alias("pos", "span"))
        .select(*keys, (F.col("pos") + 1).alias("pos"),
                F.col("span.value").alias("value"), F.col("span.entity").alias("entity"))
    )

"""Scalar text functions: normalization, slugs, locators, labels."""

from __future__ import annotations

import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that become several; fixed values.
GREEK_PAIRS = {"θ": "th", "φ": "ph", "χ": "ch", "ψ": "ps"}
#: Letters that become one; fixed values.
GREEK_FROM = "αβγδεζηικλμνξοπρσςτυω"
GREEK_TO = "abgdezeiklmnxoprsstyo"
UNDATED = 9999


#: Letters that composition leaves alone whatever of them stand side by side: Latin, Greek, Cyrillic, quotes and dashes, kana,
#: Han, Hangul syllables. The test in front is quick: long classes are slow, and nearly all characters are ASCII.
COMPOSED = r"\x{c0}-\x{131}\x{388}-\x{3ce}\x{400}-\x{482}\x{48a}-\x{52f}\x{2012}-\x{2016}\x{2018}-\x{2023}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fff}\x{ac00}-\x{d7a3}"
NOT_COMPOSED = rf"[[^\x{{0}}-\x{{9f}}]&&[^{COMPOSED}]]"
ROWS = 64  # texts that Python holds as objects at a time


@F.arrow_udf(T.StringType())
def composed(text: pa.Array) -> pa.Array:
    """Unicode compatibility composition; no built-in does it."""
    done = [pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in text.slice(i, ROWS).to_pylist()], pa.string()) for i in range(0, len(text), ROWS)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def nfkc(text: Column) -> Column:
    """Unicode compatibility composition; only texts that it may change go to Python."""
    doubtful = (F.octet_length(text) != F.length(text)) & F.rlike(text, F.lit(NOT_COMPOSED))
    return F.coalesce(composed(F.when(doubtful, text)), text)


@F.pandas_udf(T.StringType())
def nfkd_plain(text: pd.Series) -> pd.Series:
    """plain() of a column."""
    return text.map(plain)


def plain(text: str | None) -> str | None:
    """Compatibility decomposition without combining marks."""
    if text is None or text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def folded(text: Column) -> Column:
    """normalize_quote after NFKC: straight quotes, plain dashes, no emphasis, single spaces, lower case."""
    plain = F.translate(text, "‘’“”–—−*_`", "''\"\"---")
    return F.lower(F.trim(F.regexp_replace(F.replace(plain, F.lit("…"), F.lit("...")), r"(?U)\s+", " ")))


def normalize_quote(text: Column) -> Column:
    """What must not matter when a quotation is compared: width forms, quotes, dashes, emphasis, wrapping, case."""
    return folded(nfkc(text))


def section_id(title: Column, level: Column) -> Column:
    """``h<level>-<slug>``; Greek is transliterated, at most 80 characters of slug."""
    return id_of_plain(nfkd_plain(F.replace(F.replace(title, F.lit("§"), F.lit("s")), F.lit("&"), F.lit(" and "))), level)


def id_of_plain(text: Column, level: Column) -> Column:
    """section_id() of a title that is decomposed already."""
    t = F.lower(text)
    for letter, pair in GREEK_PAIRS.items():
        t = F.replace(t, F.lit(letter), F.lit(pair))
    t = F.translate(t, GREEK_FROM, GREEK_TO)
    t = F.regexp_replace(F.regexp_replace(t, "[^a-z0-9]+", "-"), "^-|-$", "")
    t = F.regexp_replace(t, r"\A\z", "section")
    return F.concat(F.lit("h"), level.cast("string"), F.lit("-"), F.regexp_replace(F.substring(t, 1, 80), "-+$", ""))


def anchor_id(title: Column) -> Column:
    """The anchor a static site makes of a heading: leading non-letters go, only plain spaces become ``-``."""
    return anchor_of_plain(nfkd_plain(title))


def anchor_of_plain(text: Column) -> Column:
    """anchor_id() of a title that is decomposed already."""
    t = F.lower(text)
    t = F.regexp_replace(F.regexp_replace(t, "^[^a-z]+", ""), r"(?U)[^a-z0-9\s-]", "")
    t = F.replace(F.regexp_replace(t, r"(?U)^\s+|\s+$", ""), F.lit(" "), F.lit("-"))
    return F.regexp_replace(t, r"\A\z", "section")


def word_count(text: Column) -> Column:
    """Whitespace-separated words."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\S+")), F.lit(0)).cast("long")


def locator_slug(locator: Column) -> Column:
    """Part before the first ``#``; null where either part is missing."""
    return F.when(locator_ok(locator), F.substring_index(locator, "#", 1))


def locator_section(locator: Column) -> Column:
    """Part after the first ``#``; null where either part is missing."""
    return F.when(locator_ok(locator), F.substr(locator, F.locate("#", locator) + 1))


def locator_ok(locator: Column) -> Column:
    at = F.locate("#", locator)
    return F.coalesce((at > 1) & (at < F.length(locator)), F.lit(False))


def section_url(url: Column, anchor: Column) -> Column:
    return F.concat_ws("#", url, anchor)


def first_year(strata: Column) -> Column:
    """Smallest year_start of an entry's strata; null where none is dated."""
    return F.array_min(F.transform(strata, lambda s: s["year_start"]))


def year_or_sentinel(year: Column) -> Column:
    return F.coalesce(year, F.lit(UNDATED))


def year_label(strata: Column) -> Column:
    """``a``, ``a-b`` or ``first to last`` over the dated strata in file order; else undated."""

    def label(s: Column) -> Column:
        start, end = s["year_start"], s["year_end"]
        one = end.isNull() | (end == 0) | (start == end)
        return F.when(one, start.cast("string")).otherwise(F.concat_ws("-", start.cast("string"), end.cast("string")))

    years = F.transform(F.filter(strata, lambda s: s["year_start"].isNotNull()), label)
    first, last = F.try_element_at(years, F.lit(1)), F.try_element_at(years, F.lit(-1))
    return F.when(F.size(years) < 1, "undated").when(first == last, first).otherwise(F.concat_ws(" to ", first, last))


def capitalized(text: Column) -> Column:
    """First character upper, the rest lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def author_tag(folder: Column) -> Column:
    return F.array_join(F.transform(F.split(folder, "-"), capitalized), "-")


def html_escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text

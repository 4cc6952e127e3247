"""Term lists as one regular expression, counted JVM-side."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

BOUNDARY = r"(?<![\p{L}\p{N}_])"


def normalized_term(term: str) -> str:
    """normalize_quote of one term, on the driver."""
    t = unicodedata.normalize("NFKC", term)
    t = t.translate(str.maketrans({"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "−": "-", "*": None, "_": None, "`": None}))
    return re.sub(r"\s+", " ", t).strip().lower()


def quoted(term: str) -> str:
    """A term as a literal of Java's dialect."""
    return re.sub(r"([\\.\[\]{}()*+\-?^$|&#~])", r"\\\1", term)


def term_pattern(terms: list[str]) -> str:
    """One alternation, in the order given, bounded on the left only.

    A term that normalizes to nothing would match everywhere and is refused (a
    deliberate deviation); so is an empty list."""
    plain = [normalized_term(t) for t in terms]
    if not plain or not all(plain):
        raise ValueError(f"empty term in {terms!r}")
    return f"{BOUNDARY}(?:{'|'.join(map(quoted, plain))})"


def count_terms(normalized: Column, terms: list[str]) -> Column:
    """Non-overlapping hits in normalized text; overlapping terms count once."""
    return F.coalesce(F.regexp_count(normalized, F.lit(term_pattern(terms))), F.lit(0)).cast("long")


def term_present(normalized: Column, term: Column) -> Column:
    """Is one normalized term, given as a column, in the text?"""
    literal = F.concat(F.lit(BOUNDARY), F.regexp_replace(term, r"([\\.\[\]{}()*+\-?^$|&#~])", r"\\$1"))
    return F.regexp_count(normalized, literal) > 0

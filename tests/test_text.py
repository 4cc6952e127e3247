"""Scalar functions against values worked out by hand."""

from __future__ import annotations

import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from folioscope.functions import terms
from folioscope.functions import text as X
from folioscope.operators.schema_check import compiled, problems_of
from folioscope.operators.toc import parents, toc_html, toc_parents


def value(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("v")).first()["v"]


@pytest.mark.parametrize(("text", "want"), [
    ("“Care” – is *old*…", "\"care\" - is old..."),
    ("  a\n b\t c ", "a b c"),
    ("ﬁne", "fine"),
    (None, None),
    ("", ""),
])
def test_normalize_quote(spark, text, want):
    assert value(spark, text, X.normalize_quote) == want


def test_composition_of_every_character(spark):
    """What stays out of Python is composed already, alone and in pairs."""
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(c,) for c in chars], "t string").select("t", X.nfkc(F.col("t")).alias("c"), F.rlike("t", F.lit(X.NOT_COMPOSED)).alias("odd")).collect()
    assert [r["t"] for r in rows if r["c"] != unicodedata.normalize("NFKC", r["t"])] == []
    fine = [r["t"] for r in rows if not r["odd"]]
    assert len(fine) > 30_000 and all(unicodedata.is_normalized("NFKC", a + b) for b in fine for a in "aeου가하かハЕи")
    assert all(value(spark, t, X.nfkc) == unicodedata.normalize("NFKC", t) for t in ("e\u0301", "\u1112\u1161\u11ab", "가\u11a8", "か\u3099", "ü ﬁ"))


def test_normalize_is_idempotent(spark):
    once = value(spark, "‘A’ — B_c*d  e", X.normalize_quote)
    assert value(spark, once, X.normalize_quote) == once


@pytest.mark.parametrize(("title", "want"), [
    ("§ 27. In Being & Care", "h3-s-27-in-being-and-care"),
    ("Φρόνησις und θεός", "h3-phronesis-und-theos"),
    ("???", "h3-section"),
    ("a" * 79 + " bcd", "h3-" + "a" * 79),
])
def test_section_id(spark, title, want):
    assert value(spark, title, lambda c: X.section_id(c, F.lit(3))) == want


@pytest.mark.parametrize(("title", "want"), [("§ 1. In Being", "in-being"), ("B) ἀλή as — and", "b--as--and"), ("123", "section"), ("Deep φρ ", "deep")])
def test_anchor_id(spark, title, want):
    assert value(spark, title, X.anchor_id) == want


@pytest.mark.parametrize(("text", "wanted", "n"), [
    ("care, careful, scare", ["care"], 2),
    ("taking care of care", ["taking care", "care"], 2),
    ("übercare care", ["care"], 1),
    ("a.b axb", ["a.b"], 1),
    ("", ["care"], 0),
])
def test_count_terms(spark, text, wanted, n):
    assert value(spark, text, lambda c: terms.count_terms(c, wanted)) == n
    if len(wanted) == 1:
        assert value(spark, text, lambda c: terms.term_present(c, F.lit(wanted[0]))) == (n > 0)


@pytest.mark.parametrize("bad", [[], [""], ["**"]])
def test_empty_terms_are_refused(bad):
    with pytest.raises(ValueError):
        terms.term_pattern(bad)


@pytest.mark.parametrize(("locator", "slug", "sec"), [("a#b", "a", "b"), ("a#b#c", "a", "b#c"), ("a#", None, None), ("#b", None, None), ("ab", None, None), (None, None, None)])
def test_locators(spark, locator, slug, sec):
    assert value(spark, locator, X.locator_slug) == slug
    assert value(spark, locator, X.locator_section) == sec


def test_years(spark):
    schema = "strata array<struct<year_start:int,year_end:int>>"
    rows = [([(1911, 1913), (None, None), (1907, None)],), ([(None, None)],), ([(1950, 1950)],), ([],)]
    df = spark.createDataFrame(rows, schema).select(X.year_label(F.col("strata")).alias("l"), X.first_year(F.col("strata")).alias("y"))
    assert [tuple(r) for r in df.collect()] == [("1911-1913 to 1907", 1907), ("undated", None), ("1950", 1950), ("undated", None)]


def test_author_tag_and_html(spark):
    assert value(spark, "van-der-BERG", X.author_tag) == "Van-Der-Berg"
    assert value(spark, "<a & 'b'>", X.html_escaped) == "&lt;a &amp; &#x27;b&#x27;&gt;"


def test_schema_keywords(spark):
    unit = {"type": "object", "required": ["id"], "additionalProperties": False, "properties": {"id": {"type": "string", "pattern": "^a$", "maxLength": 2}, "n": {"type": ["integer", "null"]}}}
    schema = {"$defs": {"u": unit}, "type": "object", "format": "ignored", "properties": {"v": {"const": 1}, "k": {"enum": ["x", None, 2]}, "us": {"type": "array", "minItems": 2, "items": {"$ref": "#/$defs/u", "type": "string"}}, "o'k": {"type": "number", "minLength": 9}}}
    records = [{"v": 1.0, "k": "x", "us": [{"id": "a"}, {"id": "a\n", "n": None, "_c": 1}], "o'k": 3}, {"v": 2, "k": "y", "us": [{"id": 1, "n": True, "x": 0}]}, [], {"v": True, "us": {}}, {"k": None, "us": [{"id": "abc"}, {}, 3]}, {"k": 2.0, "o'k": "1"}]
    got = problems_of(spark, [*map(json.dumps, records), "{", None, '{"a": 1, "a": 2}'], schema)
    assert got == [
        [],
        ["$.v: must be 1", '$.k: must be one of ["x", null, 2]', "$.us: needs 2 items or more", "$.us[0]: does not know x", "$.us[0].id: is integer, must be string", "$.us[0].n: is boolean, must be integer or null"],
        ["$: is array, must be object"],
        ["$.v: must be 1", "$.us: is object, must be array"],
        ["$.us[0].id: does not fit ^a$", "$.us[0].id: may have 2 characters at most", "$.us[1]: lacks id", "$.us[2]: is integer, must be object"],
        ["$.o'k: is string, must be number"],
        *[["$: cannot be read as JSON"]] * 3,
    ]
    with pytest.raises(ValueError, match="cannot compile"):
        compiled({"$ref": "#/$defs/r"}, {"$defs": {"r": {"items": {"$ref": "#/$defs/r"}}}})


def test_toc_nesting():
    assert parents([1, 2, 2, 3, 1]) == [-1, 0, 0, 2, -1]
    assert parents([3, 2, 2, 3, 1]) == [-1, 0, 0, 2, 0]
    assert toc_html([(0, None, "a", "A & B"), (1, 0, "b", "B")]) == '<ul><li><a href="#a">A &amp; B</a><ul><li><a href="#b">B</a></li></ul></li></ul>'


def test_toc_parents_of_many_documents(spark):
    """Rows in any order; Python gets many documents at a time, not a group for each."""
    rows = [("a", 2, 3, "x", "x"), ("a", 1, 2, "y", "y"), ("b", 5, 1, None, "z"), (None, 7, 3, "u", "u"), (None, 9, 3, "v", "v"), ("a", 4, 3, "w", "w"), (None, 10, 6, "t", "t")]
    found = toc_parents(spark.createDataFrame(rows, "slug string, n long, level int, title string, anchor string"))
    assert {(r["slug"], r["n"], r["title"], r["parent"]) for r in found.collect()} == {("a", 1, "y", None), ("a", 2, "x", 1), ("a", 4, "w", 1), ("b", 5, None, None), (None, 7, "u", None), (None, 9, "v", None), (None, 10, "t", 9)}
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().executedPlan().toString()

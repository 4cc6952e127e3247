"""Documents to lines to sections, each document inside its own row.

A document is named by its path: two authors may each have a file of one name.
Its slug, which records use, stands for the last such file in the order of
author and file (see by_slug).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from folioscope.functions import text as X

FENCE = r"(?U)^\s*(```|~~~)"
HEADING = r"(?U)^(#{1,6})\s+(.*?)\s*#*\s*$"
STRIP = r"(?U)^\s+|\s+$"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, STRIP, "")


def with_front_matter(docs: DataFrame) -> DataFrame:
    """Add lines, offset (lines of front matter) and meta (its flat pairs) to ``docs(text)``.

    Front matter opens with ``---`` at the start and closes at the first later
    line that is ``---``; without a close there is none.  Quotes around a value
    go, doubled single quotes become one, later duplicates win."""
    docs = docs.withColumn("lines", F.split("text", "\n", -1))
    # position of the first closing line, counted from 1; 0: none
    close = F.when(F.startswith("text", F.lit("---")), F.array_position(F.transform(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(1))), lambda x: stripped(x) == "---"), True)).otherwise(F.lit(0))
    docs = docs.withColumn("offset", F.when(close > 0, close + 1).otherwise(F.lit(0)).cast("int"))
    head = F.when(F.col("offset") > 0, F.slice("lines", 2, F.greatest(F.col("offset") - 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    pairs = F.filter(head, lambda x: (stripped(x) != "") & ~F.startswith(F.regexp_replace(x, r"(?U)^\s+", ""), F.lit("#")) & (F.locate(":", x) > 0))

    def value(x: Column) -> Column:
        v = stripped(F.substr(x, F.locate(":", x) + 1))
        q = F.substring(v, 1, 1)
        wrapped = (F.length(v) >= 2) & q.isin('"', "'") & (F.substring(v, -1, 1) == q)
        return F.when(wrapped, F.replace(F.substr(v, F.lit(2), F.greatest(F.length(v) - 2, F.lit(0))), F.lit("''"), F.lit("'"))).otherwise(v)

    entries = F.transform(pairs, lambda x: F.struct(stripped(F.substring_index(x, ":", 1)).alias("key"), value(x).alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return docs.withColumn("meta", F.map_from_entries(last))


HEADS = T.ArrayType(T.StructType().add("line_start", "integer").add("level", "integer").add("title", "string").add("titles", T.ArrayType(T.StringType())).add("for_id", "string").add("for_anchor", "string"))


def outline(marks: list[dict]) -> list[dict]:
    """The headings outside fences of one document's fences and headings, with the titles of the open ancestors and the own one."""
    found, fenced, last = [], False, [None] * 7
    for m in marks:
        if m["fence"]:
            fenced = not fenced
        elif not fenced:
            level, title = m["level"], m["title"]
            last[level:] = [title, *[None] * (6 - level)]
            plain = title.replace("§", "s").replace("&", " and ")
            found.append({"line_start": m["at"] + 1, "level": level, "title": title, "titles": [t for t in last if t is not None], "for_id": X.plain(plain), "for_anchor": X.plain(title)})
    return found


@F.arrow_udf(HEADS)
def outlines(marks: pa.Array) -> pa.Array:
    """outline() of each document; only fences and headings come to Python."""
    return pa.array([outline(m or []) for m in marks.to_pylist()], to_arrow_type(HEADS))


def numbered(first: int) -> Callable[..., Column]:
    """A function of a list of strings: those that are repeated get ``-first``, ``-first+1`` and so on."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def apart(names: pa.Array) -> pa.Array:
        out = []
        for one in names.to_pylist():
            seen: Counter = Counter()
            out.append([])
            for name in one or []:
                out[-1].append(f"{name}-{seen[name] - 1 + first}" if seen[name] else name)
                seen[name] += 1
        return pa.array(out, pa.list_(pa.string()))

    return apart


def with_heads(docs: DataFrame) -> DataFrame:
    """Add heads, the headings outside fences in order, to ``docs(text)``; every document is dealt with inside its own row."""
    docs = docs if "meta" in docs.columns else with_front_matter(docs)
    # the front matter is cut off first: named inside the function, offset would be worked out anew for each line
    body = F.slice(F.transform("lines", lambda x, i: F.struct(i.alias("at"), x.alias("line"))), F.col("offset") + 1, F.greatest(F.size("lines"), F.lit(0)))
    marked = F.filter(body, lambda m: m["line"].rlike(FENCE) | m["line"].rlike(HEADING))

    def mark(m: Column) -> Column:
        title = stripped(F.regexp_replace(F.regexp_extract(m["line"], HEADING, 2), "[*_`]", ""))
        return F.struct(m["at"].alias("at"), m["line"].rlike(FENCE).alias("fence"), F.length(F.regexp_extract(m["line"], HEADING, 1)).alias("level"), title.alias("title"))

    marked = docs.withColumn("marks", F.transform(marked, mark)).drop("lines")
    # the lines are split again: next to the text they would wait in the queue for Python's answers
    return marked.withColumn("heads", outlines("marks")).drop("marks").withColumn("lines", F.split("text", "\n", -1))


def ancestor_path(order: str = "line_start", key: str = "path") -> Column:
    """Titles of the open ancestors and the own one: per level the last heading, unless a higher one came after."""
    upto = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    parts = []
    for k in range(1, 7):
        last = F.last(F.when(F.col("level") == k, F.struct(F.col(order).alias("n"), "title")), True).over(upto)
        above = F.last(F.when(F.col("level") < k, F.col(order)), True).over(upto) if k > 1 else F.lit(None).cast("int")
        live = last.isNotNull() & (F.lit(k) <= F.col("level")) & (above.isNull() | (last["n"] > above))
        parts.append(F.when(live, last["title"]))
    return F.array_compact(F.array(*parts))


def sections_of(docs: DataFrame) -> DataFrame:
    """Sections of ``docs(path, slug, text)``, flat: a section ends where the next heading of any level begins.

    Returns file, slug, ordinal, id, level, title, path (of titles), anchor,
    line_start, line_end, words (heading left out), text (heading kept).  A
    document's sections are found and cut inside its own row: no text is
    exchanged."""
    docs = docs if "heads" in docs.columns else with_heads(docs)
    # the names go to Python and come back numbered: kept beside it, Spark would work them out twice
    ids, anchors = F.transform("heads", lambda h: X.id_of_plain(h["for_id"], h["level"])), F.transform("heads", lambda h: X.anchor_of_plain(h["for_anchor"]))
    named = docs.withColumn("ids", numbered(2)(ids)).withColumn("anchors", numbered(1)(anchors))
    ends = F.transform(F.slice("heads", 2, F.greatest(F.size("heads"), F.lit(0))), lambda h: h["line_start"] - 1)  # of all but the last
    lined = named.select("path", "slug", F.arrays_zip("heads", "ids", "anchors", ends.alias("end")).alias("all"), F.split("text", "\n", -1).alias("lines"))

    def cut(s: Column, i: Column) -> Column:
        h = s["heads"]
        end = F.coalesce(s["end"], F.size("lines"))
        own = F.slice("lines", h["line_start"], end - h["line_start"] + 1)
        body = F.slice("lines", h["line_start"] + 1, F.greatest(end - h["line_start"], F.lit(0)))
        return F.struct((i + 1).alias("ordinal"), s["ids"].alias("id"), h["level"].alias("level"), h["title"].alias("title"), h["titles"].alias("path"), s["anchors"].alias("anchor"), h["line_start"].alias("line_start"), end.alias("line_end"), X.word_count(F.array_join(body, "\n")).alias("words"), F.array_join(own, "\n").alias("text"))

    return lined.select(F.col("path").alias("file"), "slug", F.explode(F.transform("all", cut)).alias("c")).select("file", "slug", "c.*")


def by_slug(documents: DataFrame) -> DataFrame:
    """One document for each slug: the last in the order of author and file."""
    last = F.row_number().over(Window.partitionBy("slug").orderBy(F.desc("author"), F.desc("path")))
    return documents.withColumn("_nth", last).where("_nth = 1").drop("_nth")


def documents_of(docs: DataFrame, site: str = "") -> DataFrame:
    """The documents of ``docs(author, slug, path, sha256, text)``.

    A document's title is that of its front matter, else its first heading of
    level 1, else its slug; an empty title falls through."""
    docs = docs if "heads" in docs.columns else with_heads(docs)
    h1 = F.try_element_at(F.filter("heads", lambda h: h["level"] == 1), F.lit(1))["title"]
    title = F.coalesce(F.nullif(F.try_element_at("meta", F.lit("title")), F.lit("")), F.nullif(h1, F.lit("")), "slug")
    url = F.concat(F.lit(site), F.regexp_replace("path", r"\.md$", ".html"))
    return docs.select("slug", "path", "author", title.alias("title"), F.try_element_at("meta", F.lit("wordpress_id")).alias("wordpress_id"), "sha256", F.size("lines").alias("lines"), X.word_count(F.col("text")).alias("words"), url.alias("url"), X.normalize_quote(F.col("text")).alias("norm_text"))


def index_documents(docs: DataFrame, site: str = "") -> tuple[DataFrame, DataFrame]:
    """(documents, sections) of ``docs(author, slug, path, sha256, text)``.

    Both tables carry norm_text, so that no query normalizes again."""
    docs = with_heads(docs)
    return documents_of(docs, site), sections_of(docs).withColumn("norm_text", X.normalize_quote(F.col("text")))


def totals(documents: DataFrame, sections: DataFrame) -> DataFrame:
    """documents, words, sections: one row."""
    return documents.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).crossJoin(sections.agg(F.count(F.lit(1)).alias("sections")))

"""Tables of contents: nesting as parent pointers, and their HTML."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parents(levels: list[int]) -> list[int]:
    """For each heading the position of the one it nests under, -1 at the top.

    Open lists are closed only by a smaller level than theirs. A heading whose
    level is not that of the open list goes below the list's last item; at the
    top, where the sentinel never closes, a shallower heading thus nests under
    the last top item."""
    items: dict[int, list[int]] = {-1: []}  # headings listed under each heading
    open_lists = [(0, -1)]  # (level, heading that owns the list)
    out = []
    for i, level in enumerate(levels):
        while len(open_lists) > 1 and open_lists[-1][0] > level:
            open_lists.pop()
        at, owner = open_lists[-1]
        if at != level:
            owner = items[owner][-1] if items[owner] else owner
            open_lists.append((level, owner))
        items[owner].append(i)
        items[i] = []
        out.append(owner)
    return out


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def positions(levels: pa.Array) -> pa.Array:
    """parents() of each document's levels."""
    return pa.array([parents(x) for x in levels.to_pylist()], pa.list_(pa.int32()))


HEADING = r"(?is)<h([1-6])(?:\s[^>]*)?>.*?</h[1-6]>"
ID = r"(?is)^<h[1-6](?:\s[^>]*?)?\sid\s*=\s*[\"']([^\"']*)[\"']"


def rendered_headings(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """(slug, n, level, title, anchor) of the headings of ``pages(slug, html)`` that carry an id, in order; tags inside a title go."""
    found = pages.select("slug", F.posexplode(F.regexp_extract_all(html_column, F.lit(HEADING), 0)).alias("n", "h"))
    title = F.trim(F.regexp_replace(F.regexp_replace("h", "(?s)<[^>]*>", ""), r"\s+", " "))
    rows = found.select("slug", F.col("n").cast("long").alias("n"), F.regexp_extract("h", HEADING, 1).cast("int").alias("level"), title.alias("title"), F.regexp_extract("h", ID, 1).alias("anchor"))
    return rows.where("anchor <> ''")


def toc_parents(headings: DataFrame) -> DataFrame:
    """(slug, n, level, title, anchor, parent) of ``headings(slug, n, level, title, anchor)``; a document is a group.

    The headings of a document are one row; Python gets the levels of many documents at a time."""
    one = headings.select("slug", F.struct(F.col("n").cast("long").alias("n"), F.col("level").cast("int").alias("level"), "title", "anchor").alias("h"))
    rows = one.groupBy("slug").agg(F.array_sort(F.collect_list("h")).alias("h")).withColumn("up", positions("h.level"))
    # a position, from 0, becomes the number of the heading there
    each = rows.select("slug", F.explode(F.arrays_zip("h", F.transform("up", lambda p: F.when(p >= 0, F.get("h", p)["n"])).alias("parent"))).alias("x"))
    return each.select("slug", "x.h.*", "x.parent")


def toc_html(rows: list[tuple[int, int | None, str, str]]) -> str:
    """Nested lists of (n, parent, anchor, title) rows of one document."""
    below: dict[int | None, list] = {}
    for n, parent, anchor, title in rows:
        below.setdefault(parent, []).append((n, anchor, title))

    def render(parent: int | None) -> str:
        items = below.get(parent, [])
        inner = "".join(f'<li><a href="#{html.escape(a)}">{html.escape(t)}</a>{render(n)}</li>' for n, a, t in items)
        return f"<ul>{inner}</ul>" if items else ""

    return render(None)

"""The HTML listing of documents by author, and payloads for publishing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as X

REGION = re.compile(r'<div class="commentary-groups">.*?</div>', re.DOTALL)


def author_groups(documents: DataFrame) -> DataFrame:
    """(author, at, items): list items of each author's documents by path; authors without regard to case."""
    href = F.concat(F.replace(F.regexp_replace("path", r"\.md$", ""), F.lit(" "), F.lit("%20")), F.lit(".html"))
    item = F.concat(F.lit('      <li><a href="'), X.html_escaped(href), F.lit('">'), X.html_escaped(F.col("title")), F.lit("</a></li>"))
    each = documents.select("author", "path", item.alias("item"))
    grouped = each.groupBy("author").agg(F.array_sort(F.collect_list(F.struct("path", "item"))).alias("i"))
    order = Window.partitionBy().orderBy(F.lower("author"), "author")
    return grouped.select("author", F.row_number().over(order).alias("at"), F.array_join("i.item", "\n").alias("items"))


def listing_html(documents: DataFrame) -> str:
    summary = X.html_escaped(X.capitalized(F.col("author")))
    block = F.concat(F.lit("  <details open>\n    <summary>"), summary, F.lit("</summary>\n    <ul>\n"), "items", F.lit("\n    </ul>\n  </details>"))
    blocks = author_groups(documents).select("at", block.alias("b")).orderBy("at").collect()  # one for each author
    return '<div class="commentary-groups">\n' + "\n".join(r["b"] for r in blocks) + "\n</div>"


def replace_region(page: str, listing: str) -> str:
    """The first listing region of a page replaced; nothing in ``listing`` is special."""
    return REGION.sub(lambda _: listing, page, count=1)


def publishing_payloads(documents: DataFrame) -> DataFrame:
    """What a publisher would send: path, slug, title, tag, create or update. Nothing is sent from here."""
    return documents.select("path", "slug", "title", X.author_tag(F.col("author")).alias("tag"), F.when(F.coalesce("wordpress_id", F.lit("")) == "", "create").otherwise("update").alias("action"), "wordpress_id")


def with_new_ids(files: DataFrame, answers: DataFrame) -> DataFrame:
    """``files(path, text)`` with the ids of ``answers(path, wordpress_id)`` in their front matter, as a publisher's answer is kept.

    An id goes into the first line of front matter that is there, else into new
    front matter; a file that has an id keeps it."""
    named = answers.select("path", F.col("wordpress_id").alias("_new"))
    has = F.col("text").rlike(r"(?s)\A---\n(?:(?!---\n).*?\n)??wordpress_id:")
    own = F.concat(F.lit("wordpress_id: "), F.col("_new"), F.lit("\n"))
    opened = F.concat(F.lit("---\n"), own, F.substr("text", F.lit(5)))
    new = F.concat(F.lit("---\n"), own, F.lit("---\n"), "text")
    text = F.when(F.col("_new").isNull() | has, F.col("text")).when(F.startswith("text", F.lit("---\n")), opened).otherwise(new)
    return files.join(named, "path", "left").withColumn("text", text).drop("_new")

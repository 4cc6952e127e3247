"""Term search and ranking, with marks for what a record already covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.terms import count_terms


def covered_locators(extractions: DataFrame, theme: str) -> DataFrame:
    """Distinct locators that units and absences of a theme's records name."""
    own = extractions.where(F.col("theme") == theme)
    return own.select(F.explode("units.locator").alias("locator")).union(own.select(F.explode("absences.locator").alias("locator"))).distinct()


def search(documents: DataFrame, sections: DataFrame, terms: list[str], by_section: bool = False, commentary: str | None = None, author: str | None = None, top: int = 25, min_hits: int = 1, covered: DataFrame | None = None) -> DataFrame:
    """The ``top`` documents, or sections, by hits; hits of a document are the sum over its sections.

    Returns rank, hits, author, slug and, by section, locator, done, path,
    line_start, line_end, words, url; ``total`` counts all matches, so that the
    overflow is known. Ties go by slug, then section order."""
    docs = documents.select(F.col("path").alias("file"), "slug", "author", "url")
    if commentary:
        docs = docs.where(F.col("slug") == commentary)
    if author:
        docs = docs.where(F.col("author") == author)
    if commentary:
        sections = sections.where(F.col("slug") == commentary)
    # texts stay where they are: only sections with hits, without their texts, meet the documents
    hits = section_hits(sections, terms).drop("slug", "text", "norm_text").where(F.col("hits") >= (min_hits if by_section else 1))
    everything = Window.partitionBy()
    if not by_section:
        per_doc = hits.groupBy("file").agg(F.sum("hits").alias("hits"))
        found = docs.join(per_doc, "file", "left").withColumn("hits", F.coalesce("hits", F.lit(0)).cast("long")).where(F.col("hits") >= min_hits)
        order, keep = [F.desc("hits"), F.asc("slug"), F.asc("file")], ["hits", "author", "slug"]
    else:
        found = hits.join(docs, "file").withColumn("locator", F.concat_ws("#", "slug", "id")).withColumn("url", F.concat_ws("#", "url", "anchor"))
        if covered is None:
            found = found.withColumn("done", F.lit(False))
        else:
            found = found.join(covered.select("locator", F.lit(True).alias("_done")), "locator", "left").withColumn("done", F.coalesce("_done", F.lit(False)))
        order = [F.desc("hits"), F.asc("slug"), F.asc("file"), F.asc("line_start")]
        keep = ["hits", "author", "slug", "locator", "done", F.slice("path", F.greatest(F.size("path") - 1, F.lit(1)), 2).alias("path"), "line_start", "line_end", "words", "url"]
    total = found.agg(F.count(F.lit(1)).alias("total"))
    first = found.orderBy(*order).limit(top).withColumn("rank", F.row_number().over(everything.orderBy(*order)))
    return first.select("rank", *keep).crossJoin(total)


def section_hits(sections: DataFrame, terms: list[str]) -> DataFrame:
    """Sections with ``hits``."""
    return sections.withColumn("hits", count_terms(F.col("norm_text"), terms))


def document_hits(documents: DataFrame, terms: list[str]) -> DataFrame:
    """(path, slug, hits) over the whole normalized text, front matter and text before the first heading included."""
    return documents.select("path", "slug", count_terms(F.col("norm_text"), terms).alias("hits"))

"""The coverage report: what is read, what to read next, what is old, undated or open, as ordered lines.

The terms of all themes are counted in one scan of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as X
from folioscope.functions.terms import count_terms
from folioscope.operators.validation import with_documents
from folioscope.plans.ledger import fragment, last_entry, numbered

CANDIDATES = 6


def s(c: str) -> Column:
    return F.col(c).cast("string")


def cells(*columns: Column) -> Column:
    """A table row."""
    parts = [x for c in columns for x in (F.lit(" | "), c)][1:]
    return F.concat(F.lit("| "), *parts, F.lit(" |"))


def theme_rows(spark, themes: list[dict]) -> DataFrame:
    """(at, theme, english) of the authored registry, by id."""
    ordered = sorted(themes, key=lambda t: t["id"])
    return spark.createDataFrame([(i, t["id"], t["english"]) for i, t in enumerate(ordered)], "at int, theme string, english string")


def open_documents(themes: list[dict], records: DataFrame, chronology: DataFrame, documents: DataFrame) -> DataFrame:
    """(theme, slug, author, path, year, hits): documents with a theme's terms but no record of it, one scan for all themes."""
    entries = last_entry(chronology).select(F.col("commentary").alias("slug"), "role", X.first_year(F.col("strata")).alias("year"))
    counted = F.filter(F.array(*(F.struct(F.lit(t["id"]).alias("theme"), count_terms(F.col("norm_text"), t["search_terms"]).alias("hits")) for t in themes)), lambda x: x["hits"] > 0)
    docs = documents.join(entries, "slug", "left").where("coalesce(role, '') <> 'output'")
    each = docs.select("slug", "author", "path", "year", F.explode(counted).alias("t")).select("slug", "author", "path", "year", "t.theme", "t.hits")
    return each.join(records.select(F.col("commentary").alias("slug"), "theme").distinct(), ["slug", "theme"], "left_anti")


def candidates(hits: DataFrame) -> DataFrame:
    """The first ``CANDIDATES`` of each theme: hits falling, then author and file."""
    order = Window.partitionBy("theme").orderBy(F.desc("hits"), "author", "path")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= CANDIDATES)


def coverage(themes: list[dict], records: DataFrame, hits: DataFrame, documents: DataFrame) -> DataFrame:
    """One row for each theme: records, units, absences, stale, partial, open."""
    own = with_documents(records, documents).groupBy("theme").agg(F.count(F.lit(1)).alias("records"), F.sum(F.size("units")).alias("units"), F.sum(F.size("absences")).alias("absences"), F.count_if("stale").alias("stale"), F.count_if(F.col("coverage") == "partial").alias("partial"))
    left = hits.groupBy("theme").agg(F.count(F.lit(1)).alias("open"))
    return theme_rows(documents.sparkSession, themes).join(own, "theme", "left").join(left, "theme", "left").na.fill(0)


def listed(df: DataFrame, part: int, head: str, none: str, line: Column, order: list[str]) -> list[DataFrame]:
    """A headed list with one line for each row of ``df``; ``none`` where there is none."""
    count = df.agg(F.count(F.lit(1)).alias("n"))
    start = F.concat(F.array(F.lit(f"## {head}"), F.lit("")), F.when(F.col("n") == 0, F.array(F.lit(none))).otherwise(F.expr("cast(array() as array<string>)")))
    return [fragment(count, [part, 0], start), fragment(df, [part, 1], F.array(line), F.concat_ws("\t", *order)), fragment(count, [part, 2], F.array(F.lit("")))]


def status(themes: list[dict], records: DataFrame, inheritance: DataFrame, chronology: DataFrame, gaps: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """(ordinal, line) of the report; ``themes`` are the rows of the theme registry, as dicts."""
    themes = list({t["id"]: t for t in themes}.values())  # the last of two equal ids counts
    hits = open_documents(themes, records, chronology, documents)
    size = documents.agg(F.count(F.lit(1)).alias("d"), F.coalesce(F.sum("words"), F.lit(0)).alias("w")).crossJoin(sections.agg(F.count(F.lit(1)).alias("n")))
    corpus = F.concat(s("d"), F.lit(" documents, "), s("n"), F.lit(" sections, "), s("w"), F.lit(" words"))
    table = cells(F.concat("theme", F.lit(" ("), "english", F.lit(")")), *(s(c) for c in ("records", "units", "absences", "stale", "partial", "open")))
    head = [F.lit(x) for x in ("## Themes", "", "| theme | records | units | absences | stale | partial | open |", "|-|-|-|-|-|-|-|")]
    covered = coverage(themes, records, hits, documents)
    next_line = F.concat(F.lit("- "), "theme", F.lit(" "), s("rank"), F.lit(": `"), "slug", F.lit("`, "), F.coalesce(s("year"), F.lit("no year")), F.lit(", hits: "), s("hits"))
    inh = with_documents(inheritance, documents)
    mark = lambda c, name: F.when(c, name)
    marks = F.concat_ws(", ", F.concat(F.size("engagements").cast("string"), F.lit(" engagements")), mark(F.col("stale"), "stale"), mark(F.col("coverage") == "partial", "partial"))
    stale = with_documents(records, documents).where("stale").join(theme_rows(documents.sparkSession, themes).select("theme"), "theme")
    open_dates = last_entry(chronology).where("status = 'unresolved' and role <> 'output'")
    left = gaps.where("status <> 'closed'")
    gap = F.concat(F.lit("- "), "id", F.lit(" ("), F.concat_ws(", ", "status", F.nullif("theme", F.lit(""))), F.lit("): "), "question", F.lit(" Needs: "), "needs")
    return numbered([
        fragment(size, [0], F.array(F.lit("# Coverage"), F.lit(""), corpus, F.lit(""), *head)),
        fragment(covered, [1, F.col("at")], F.array(table)),
        fragment(documents.sparkSession.range(1), [2], F.array(F.lit(""))),
        *listed(candidates(hits).withColumn("order", F.lpad(s("rank"), 9, "0")), 3, "To be read next", "Every document with these terms has a record.", next_line, ["theme", "order"]),
        *listed(inh, 4, "Inheritance", "No records.", F.concat(F.lit("- `"), "commentary", F.lit("`: "), marks), ["path"]),
        *listed(stale, 5, "Older than their documents", "None.", F.concat(F.lit("- `"), "theme", F.lit("/"), "commentary", F.lit("`")), ["theme", "path"]),
        *listed(open_dates, 6, "No date known", "None.", F.concat(F.lit("- `"), "commentary", F.lit("`"), F.coalesce(F.concat(F.lit(": "), F.nullif("note", F.lit(""))), F.lit(""))), ["commentary"]),
        *listed(left.withColumn("order", F.lpad(s("position"), 9, "0")), 7, "Open questions", "None.", gap, ["id", "order"]),
    ])


def zero_filled(items: DataFrame, key: str, values: list) -> DataFrame:
    """(key, n) for every one of ``values``, 0 where there is none."""
    spark = items.sparkSession
    enum = spark.createDataFrame([(v,) for v in values], f"{key} {dict(items.dtypes)[key]}")
    return enum.join(items.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))

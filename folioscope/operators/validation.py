"""Validation rules; each gives rows (severity, rule, file, item, message).

Deliberate deviations: files are taken in order of their full path; malformed
JSON is a violation; a stratum of another document is an extra warning; a quote
or term that normalizes to nothing is an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text as X
from folioscope.functions.terms import term_present
from folioscope.operators.schema_check import schema_problems
from folioscope.operators.sections import by_slug
from folioscope.sources.scratch import materialize

COLUMNS = ["severity", "rule", "file", "item", "message"]


def rows(df: DataFrame, rule: str, severity: str | Column, file: str | Column, item: str | Column, message: Column) -> DataFrame:
    as_col = lambda c: F.lit(c) if isinstance(c, str) else c
    return df.select(as_col(severity).alias("severity"), F.lit(rule).alias("rule"), as_col(file).alias("file"), as_col(item).alias("item"), message.alias("message"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def or_warning(stale: Column) -> Column:
    return F.when(stale, "warning").otherwise("error")


def said(when: Column, rule: str, severity: str | Column, message: Column) -> Column:
    """One violation of a row, or null."""
    return F.when(when, F.struct((F.lit(severity) if isinstance(severity, str) else severity).alias("severity"), F.lit(rule).alias("rule"), message.alias("message")))


def all_said(items: DataFrame, *rules: Column) -> DataFrame:
    """The violations of items (path, id) under several rules, in one pass over the items."""
    each = items.select(F.col("path").alias("file"), F.col("id").alias("item"), F.explode(F.array_compact(F.array(*rules))).alias("v"))
    return each.select("v.severity", "v.rule", "file", "item", "v.message")


def registry_rules(themes: DataFrame, chronology: DataFrame, gaps: DataFrame, documents: DataFrame, files: DataFrame) -> DataFrame:
    """V2 to V8; ``files(path)`` lists the paths that exist."""
    slugs = documents.select("slug").distinct()
    strata = chronology.select("position", "commentary", F.posexplode("strata").alias("at", "s"))
    dated = F.exists("strata", lambda s: s["year_start"].isNotNull())

    def repeated(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
        return df.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_nth > 1")

    named = lambda what, c, rest="": F.concat(F.lit(f"{what} "), quoted(F.col(c)), F.lit(rest))
    return union([
        rows(repeated(themes, F.col("id"), ["position"]), "V2", "error", "themes.json", F.col("id"), named("theme", "id", " is listed twice")),
        rows(chronology.join(slugs, chronology["commentary"] == slugs["slug"], "left_anti"), "V3", "error", "chronology.json", F.col("commentary"), named("no document is called", "commentary")),
        rows(repeated(strata, F.col("s.id"), ["position", "at"]), "V4", "error", "chronology.json", F.col("s.id"), named("layer", "s.id", " is listed twice")),
        rows(strata.where(~F.col("s.stated_in_commentary") & (F.coalesce("s.evidence", F.lit("")) == "")), "V5", "error", "chronology.json", F.col("s.id"), named("layer", "s.id", " takes its date from elsewhere and names no evidence")),
        rows(chronology.where((F.col("status") == "resolved") & ~dated), "V6", "error", "chronology.json", F.col("commentary"), named("entry", "commentary", " counts as resolved but has no year")),
        rows(chronology.where((F.col("status") == "unresolved") & dated), "V6", "error", "chronology.json", F.col("commentary"), named("entry", "commentary", " counts as unresolved but has a year")),
        rows(slugs.join(chronology, slugs["slug"] == chronology["commentary"], "left_anti"), "V7", "warning", "chronology.json", F.col("slug"), named("document", "slug", " has no entry, so no ledger can place it")),
        rows(gaps.where("coalesce(raised_by, '') <> ''").join(files.select(F.col("path").alias("raised_by")), "raised_by", "left_anti"), "V8", "warning", "gaps.json", F.col("id"), named("raised by", "raised_by", ", which is not a file")),
    ])


def schema_rule(files: DataFrame, rule: str, schema: dict, root: dict | None = None) -> DataFrame:
    """V1 and V9: one error for each message about ``files(path, raw)``."""
    found = files.select("path", F.posexplode(schema_problems("raw", schema, root)).alias("at", "message"))
    return rows(found, rule, "error", F.col("path"), F.lit(None).cast("string"), F.col("message"))


def with_documents(records: DataFrame, documents: DataFrame) -> DataFrame:
    """Records with doc_sha and stale of their document; a missing document leaves both null."""
    docs = by_slug(documents).select(F.col("slug").alias("commentary"), F.col("sha256").alias("doc_sha"), F.col("path").alias("doc_path"))
    return records.join(docs, "commentary", "left").withColumn("stale", F.col("doc_sha") != F.col("source_sha256"))


def record_rules(records: DataFrame, themes: DataFrame | None) -> DataFrame:
    """V10 to V13 of schema-valid records with_documents(), in one pass; ``themes`` is None for inheritance records."""
    stale = F.concat(F.lit("document "), quoted(F.col("commentary")), F.lit(" is newer than the record"))
    no_document = said(F.col("doc_sha").isNull(), "V11", "error", F.concat(F.lit("there is no document "), quoted(F.col("commentary"))))
    misnamed = said(F.col("stem") != F.col("commentary"), "V10", "error", F.lit("the file is not named after its document"))
    if themes is None:
        return all_said(records.withColumn("id", F.col("commentary")), misnamed, no_document, said(F.col("stale"), "V12", "warning", stale))
    known = themes.select(F.col("id").alias("theme"), F.lit(True).alias("known_theme")).distinct()
    stale = F.concat(stale, F.lit(": "), F.substring("source_sha256", 1, 12), F.lit(" then, "), F.substring("doc_sha", 1, 12), F.lit(" now"))
    part = F.col("doc_sha").isNotNull() & (F.col("coverage") == "partial") & (F.coalesce("coverage_note", F.lit("")) == "")
    return all_said(
        records.join(known, "theme", "left").withColumn("id", F.col("commentary")),
        said(F.col("known_theme").isNull(), "V10", "error", F.concat(F.lit("there is no theme "), quoted(F.col("theme")))),
        said(F.col("directory") != F.col("theme"), "V10", "error", F.lit("the folder is not that of the theme")),
        misnamed,
        no_document,
        said(F.col("stale"), "V12", "warning", stale),
        said(part, "V13", "error", F.lit("a partial record needs a note on what was read")),
    )


def duplicate_ids(items: DataFrame, noun: str) -> DataFrame:
    """V14: an id seen before, with the file that held it last."""
    before = F.lag("path").over(Window.partitionBy("id").orderBy("path", "at"))
    found = items.withColumn("previous", before).where("previous is not null")
    return rows(found, "V14", "error", F.col("path"), F.col("id"), F.concat(F.lit(f"{noun} id was used before, last in "), "previous"))


def resolved(items: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """Items (locator, commentary) with their section, or the first reason why there is none."""
    items = items.withColumn("slug", X.locator_slug(F.col("locator"))).withColumn("sec", X.locator_section(F.col("locator")))
    known = by_slug(documents).select(F.col("slug").alias("_slug"), F.col("path").alias("_file"))
    # the last of several sections with one id is the one that counts
    last = Window.partitionBy("file", "id").orderBy(F.desc("ordinal"))
    secs = sections.withColumn("_nth", F.row_number().over(last)).where("_nth = 1").select(F.col("file").alias("s_file"), F.col("id").alias("s_id"), "line_start", "line_end", F.col("norm_text").alias("body"))
    joined = items.join(known, F.col("slug") == F.col("_slug"), "left").join(secs, (F.col("_file") == F.col("s_file")) & (F.col("sec") == F.col("s_id")), "left")
    reason = (
        F.when(F.col("slug").isNull(), F.concat(F.lit("a locator has a document, # and a section, not "), F.coalesce(quoted(F.col("locator")), F.lit("nothing"))))
        .when(F.col("slug") != F.col("commentary"), F.concat(F.lit("the locator names "), quoted(F.col("slug")), F.lit(" in a record on "), quoted(F.col("commentary"))))
        .when(F.col("_slug").isNull(), F.concat(F.lit("there is no document "), quoted(F.col("slug"))))
        .when(F.col("s_id").isNull(), F.concat(F.lit("document "), quoted(F.col("slug")), F.lit(" has no section "), quoted(F.col("sec"))))
    )
    return joined.withColumn("reason", reason)


def quote_rules(found: DataFrame, *more: Column) -> DataFrame:
    """V17 and V18 of resolved() items (path, id, quote, stale), and ``more`` rules on the same rows."""
    checked = found.withColumn("norm_quote", X.normalize_quote(F.col("quote")))
    missing = F.concat(F.lit("the quote is not in section "), quoted(F.col("sec")), F.lit(", lines "), F.col("line_start").cast("string"), F.lit(" to "), F.col("line_end").cast("string"))
    old = F.when(F.col("stale"), "; the record is older than the document").otherwise("")
    fine, text = F.col("reason").isNull(), F.col("norm_quote")
    return all_said(
        checked,
        said(~fine, "V17", "error", F.col("reason")),
        said(fine & (text != "") & ~F.contains("body", text), "V18", or_warning(F.col("stale")), F.concat(missing, old)),
        said(fine & (text == ""), "V18", "error", F.lit("nothing is left of the quote when it is normalized")),
        *more,
    )


def unit_rules(records: DataFrame, chronology: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """V14 to V18 of the units of records with a known document."""
    units = records.where("doc_sha is not null").select("path", "theme", "commentary", "stale", F.posexplode("units").alias("at", "u")).select("path", "theme", "commentary", "stale", "at", "u.*")
    strata = chronology.select("commentary", F.explode("strata").alias("s")).select(F.col("s.id").alias("stratum"), F.col("commentary").alias("owner")).distinct()
    owners = strata.groupBy("stratum").agg(F.collect_set("owner").alias("owners"))  # documents that list one layer
    known = resolved(units.join(owners, "stratum", "left"), documents, sections)
    placed = F.coalesce("stratum", F.lit("")) != ""
    layer = quoted(F.col("stratum"))
    foreign = F.concat(F.lit("layer "), layer, F.lit(" is another document's; the unit counts but is not shown"))
    return union([
        duplicate_ids(units, "unit"),
        quote_rules(
            known,
            said(~F.startswith("id", F.concat("theme", F.lit("/"))), "V15", "error", F.lit("the id does not begin with that of the theme")),
            said(placed & F.col("owners").isNull(), "V16", "error", F.concat(F.lit("there is no layer "), layer)),
            said(placed & ~F.array_contains("owners", F.col("commentary")), "V16x", "warning", foreign),
        ),
    ])


def absence_rules(records: DataFrame, themes: DataFrame, documents: DataFrame, sections: DataFrame) -> DataFrame:
    """V17 and V19: each own term, or each of the theme's, that does occur."""
    items = records.where("doc_sha is not null").select("path", "theme", "commentary", "stale", F.posexplode("absences").alias("at", "a")).select("path", "theme", "commentary", "stale", F.concat(F.lit("absence "), F.col("at").cast("string")).alias("id"), "a.*")
    found = resolved(items, documents, sections)
    terms = themes.groupBy(F.col("id").alias("theme")).agg(F.max_by("search_terms", "position").alias("theme_terms"))
    own = F.when(F.size(F.coalesce("absent_terms", F.array().cast("array<string>"))) > 0, F.col("absent_terms")).otherwise(F.col("theme_terms"))
    each = found.where("reason is null").join(terms, "theme", "left").withColumn("term", F.explode(own)).withColumn("norm_term", X.normalize_quote(F.col("term")))
    message = F.concat(F.lit("term "), quoted(F.col("term")), F.lit(" does occur in section "), quoted(F.col("sec")), F.when(F.col("stale"), "; the record is older than the document").otherwise(""))
    occurs = (F.col("norm_term") != "") & term_present(F.col("body"), F.col("norm_term"))
    return union([
        all_said(found, said(F.col("reason").isNotNull(), "V17", "error", F.col("reason"))),
        all_said(each, said(occurs, "V19", or_warning(F.col("stale")), message), said(F.col("norm_term") == "", "V19", "error", F.lit("nothing is left of the term when it is normalized"))),
    ])


def validate(documents: DataFrame, sections: DataFrame, themes: DataFrame, chronology: DataFrame, gaps: DataFrame, files: DataFrame, extractions: DataFrame, inheritance: DataFrame, schemas: dict[str, dict], stored: DataFrame | None = None) -> DataFrame:
    """All violations. A record with a schema error is checked no further; one about an unknown document loses its items.

    ``schemas`` has extraction, inheritance and, optionally, registry problems
    are checked apart with schema_rule(). ``stored`` is the committed index's
    documents table (V20)."""
    parts = [registry_rules(themes, chronology, gaps, documents, files)]
    for records, name in ((extractions, "extraction"), (inheritance, "inheritance")):
        # written once: four passes read it
        checked = materialize(records.withColumn("_problems", schema_problems("raw", schemas[name])).drop("raw"), "checked-records")
        valid = with_documents(checked.where(F.size("_problems") == 0).drop("_problems"), documents)
        problems = checked.select("path", F.explode("_problems").alias("message"))
        parts += [rows(problems, "V9", "error", F.col("path"), F.lit(None).cast("string"), F.col("message")), record_rules(valid, themes if name == "extraction" else None)]
        if name == "extraction":
            parts += [unit_rules(valid, chronology, documents, sections), absence_rules(valid, themes, documents, sections)]
        else:
            items = valid.where("doc_sha is not null").select("path", "commentary", "stale", F.posexplode("engagements").alias("at", "u")).select("path", "commentary", "stale", "at", "u.*")
            parts += [duplicate_ids(items, "engagement"), quote_rules(resolved(items, documents, sections))]
    if stored is None:
        parts.append(rows(documents.sparkSession.range(1), "V20", "warning", "index", F.lit(None).cast("string"), F.lit("there is no index yet")))
    else:
        same = ["path", "slug", "sha256", "words", "lines", "title"]
        off = documents.select(same).exceptAll(stored.select(same)).union(stored.select(same).exceptAll(documents.select(same))).limit(1)
        parts.append(rows(off, "V20", "warning", "index", F.lit(None).cast("string"), F.lit("the index is older than the documents")))
    return union(parts)


def verdict(violations: DataFrame, strict: bool = False) -> DataFrame:
    """errors, warnings, failed: one row (V21)."""
    n = violations.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return n.withColumn("failed", (F.col("errors") > 0) | (F.lit(strict) & (F.col("warnings") > 0)))

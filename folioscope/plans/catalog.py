"""Queries of the engine over the supplied tables, with the SQL they are checked against.

The tables play the roles of the engine's own: documents are documents, their
lines are sections, labels say that a record exists, benchmark texts are quotes,
events.props are JSON records, conversations are ordered groups, orders are
dated entries.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.functions import text as X
from folioscope.functions.terms import count_terms
from folioscope.operators import secrets, toc, validation
from folioscope.operators import search as S
from folioscope.operators.schema_check import schema_problems
from folioscope.operators.sections import ancestor_path, totals
from folioscope.plans import ledger, listing, status
from folioscope.plans import tables as T
from folioscope.plans import tables_sql as Q
from folioscope.sources.reports import differences

THEMES = {"care": ["thand", "then", "in the"], "being": ["onat", "erth"], "path": ["für", "über", "mit", "pour"]}
QUOTES = 50_000  # quotes that travel in one row; more of them are joined
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

NORM = Q.NORM


def sql_hits(norm: str, terms: list[str]) -> str:
    """DuckDB has no look-behind; the boundary is matched instead."""
    alternatives = "|".join(terms)
    return rf"len(regexp_extract_all({norm}, '(?:^|[^\p{{L}}\p{{N}}_])(?:{alternatives})'))"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def normalized_docs(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *more, X.normalize_quote(F.col("text")).alias("norm_text"))


def lines_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as sections: doc_id, n (from 1), line."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("at", "line")).select("doc_id", (F.col("at") + 1).cast("long").alias("n"), "line")


LINES = "lines as (select doc_id, generate_subscripts(string_split(text, chr(10)), 1)::bigint as n, unnest(string_split(text, chr(10))) as line from documents)"


@query(f"select doc_id, {sql_hits(NORM.format('text'), THEMES['care'])}::bigint as hits from documents")
def term_counts_by_doc(spark, sf_dir):
    """Hits of a fused term list over whole normalized texts."""
    return normalized_docs(spark, sf_dir).select("doc_id", count_terms(F.col("norm_text"), THEMES["care"]).alias("hits"))




@query(f"with {LINES} select doc_id, n, len(regexp_extract_all(line, '\\S+'))::bigint as words from lines")
def section_words(spark, sf_dir):
    return lines_of(spark, sf_dir).select("doc_id", "n", X.word_count(F.col("line")).alias("words"))


@query(r"""select doc_id, sha256(text) as sha256, len(string_split(text, chr(10)))::bigint as lines, len(regexp_extract_all(text, '\S+'))::bigint as words from documents""")
def document_index(spark, sf_dir):
    """Digest, lines and words of every document."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.sha2("text", 256).alias("sha256"), F.size(F.split("text", "\n", -1)).cast("long").alias("lines"), X.word_count(F.col("text")).alias("words"))



@query("select sha256(text) as digest, count(*)::bigint as n, min(doc_id) as first_doc from documents group by 1 having count(*) > 1")
def digest_duplicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return docs.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")



@query("""with p as (select event_id, case when event_id % 7 = 0 then '{"k": true, "z": 1}' when event_id % 7 = 1 then '{"_c": 0}' when event_id % 7 = 2 then '{' else props end as props from events)
select event_id, m.message as message from (select event_id, unnest(case event_id % 7 when 0 then [{'message': '$: does not know z'}, {'message': '$.k: is boolean, must be integer'}] when 1 then [{'message': '$: lacks k'}] when 2 then [{'message': '$: cannot be read as JSON'}] else [] end) as m from p)""")
def props_schema(spark, sf_dir):
    """Schema messages of JSON records; three kinds of defects are put into known rows."""
    props = F.expr("""case event_id % 7 when 0 then '{"k": true, "z": 1}' when 1 then '{"_c": 0}' when 2 then '{' else props end""")
    schema = {"type": "object", "required": ["k"], "additionalProperties": False, "properties": {"k": {"type": "integer"}}}
    rows = table(spark, sf_dir, "events").select("event_id", props.alias("props"))
    return rows.select("event_id", F.explode(schema_problems("props", schema)).alias("message"))



@query("""with e as (select o_orderpriority as id, case when o_orderstatus = 'P' then null else min(year(o_orderdate)) end as y, o_orderstatus as status from orders group by 1, 3),
b as (select *, case when y is null then 'undated' when id like '5%' then 'reception' else 'primary' end as bucket from e)
select bucket, id, status, coalesce(y, 9999)::bigint as year, row_number() over (partition by bucket order by y nulls last, id, status)::bigint as place from b""")
def chrono_buckets(spark, sf_dir):
    """Entries by bucket, year and name; undated entries last, 9999 at the edge only."""
    e = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("id"), F.col("o_orderstatus").alias("state")).agg(F.min(F.year("o_orderdate")).alias("y"))
    e = e.withColumn("y", F.when(F.col("state") != "P", F.col("y"))).withColumn("status", F.when(F.col("y").isNull(), "unresolved").otherwise("resolved")).withColumn("role", F.when(F.col("id").startswith("5"), "reception").otherwise("primary"))
    e = e.withColumn("bucket", ledger.bucket())
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.asc_nulls_last("y"), "id", "state"))
    return e.select("bucket", "id", F.col("state").alias("status"), X.year_or_sentinel(F.col("y")).cast("long").alias("year"), place.cast("long").alias("place"))



@query("select v.quality, count(l.doc_id)::bigint as n from (values (0), (1), (2)) v(quality) left join labels l using (quality) group by 1")
def status_zero_fill(spark, sf_dir):
    """A tally that keeps the values that do not occur."""
    return status.zero_filled(table(spark, sf_dir, "labels"), "quality", [0, 1, 2])


@query(rf"""with {LINES}, k as (select doc_id, n, case when regexp_matches(line, '/home/[A-Za-z0-9._-]+') then 'personal path' when regexp_matches(line, '\bAKIA[0-9A-Z]{{16}}\b') or regexp_matches(line, '\bgh[pousr]_[A-Za-z0-9]{{20,}}\b') or regexp_matches(line, '\bsk-[A-Za-z0-9]{{20,}}\b') or regexp_matches(line, '(?i)\b(api[_-]?key|secret|password|access[_-]?token)\b\s*[:=]\s*[''"][^''"\s]{{8,}}[''"]') then 'possible secret' when regexp_matches(line, 'Nobody Noone') then 'real name' when regexp_matches(line, '@mail[0-9]\.example\.com') then 'real email' end as kind, left(trim(line), 120) as snippet from lines)
select doc_id, n, kind, snippet from k where kind is not null""")
def pii_first_hit(spark, sf_dir):
    """One violation for each line, of the first pattern that matches."""
    lines = lines_of(spark, sf_dir).withColumnRenamed("doc_id", "sha")
    found = secrets.scan_lines(lines, ["Nobody Noone"], [r"@mail[0-9]\.example\.com"], [r"/home/[A-Za-z0-9._-]+"])
    return found.withColumnRenamed("sha", "doc_id")


@query("""with a as (select doc_id, quality from labels), b as (select doc_id, case when doc_id % 50 = 0 then 1 - quality else quality end as quality from labels)
select *, 'missing' as side from (select * from a except all select * from b) union all select *, 'unexpected' from (select * from b except all select * from a)""")
def check_mode_diff(spark, sf_dir):
    """What a rebuild would change: rows of either side that the other lacks."""
    a = table(spark, sf_dir, "labels").select("doc_id", "quality")
    b = a.select("doc_id", F.expr("if(doc_id % 50 = 0, 1 - quality, quality)").alias("quality"))
    return differences(a, b)


@query(f"""with {LINES}, h as (select l.doc_id, sum({sql_hits(NORM.format('line'), THEMES['being'])})::bigint as hits from lines l join documents d on d.doc_id = l.doc_id where source = 'src3' group by 1), f as (select * from h where hits >= 3)
select row_number() over (order by hits desc, doc_id::varchar)::bigint as rank, hits, doc_id, (select count(*) from f)::bigint as total from f order by hits desc, doc_id::varchar limit 10""")
def search_documents(spark, sf_dir):
    """Ranked search of one source: hits summed over sections, at least three, ten shown, all counted."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("doc_id").cast("string").alias("slug"), F.col("source").alias("author"), F.lit("").alias("url"))
    sections = lines_of(spark, sf_dir).select(F.col("doc_id").cast("string").alias("file"), F.col("doc_id").cast("string").alias("slug"), F.col("n").alias("line_start"), X.normalize_quote(F.col("line")).alias("norm_text"))
    found = S.search(docs, sections, THEMES["being"], author="src3", top=10, min_hits=3)
    return found.select(F.col("rank").cast("long").alias("rank"), "hits", F.col("slug").cast("long").alias("doc_id"), "total")


@query("""with t as (select conv_id, turn, (len(text) % 4 + 1)::int as level, 'n' || turn as title from conversations)
select conv_id, turn, level, array_to_string(list_filter([
  (select title from t a where a.conv_id = t.conv_id and a.turn = (select max(turn) from t x where x.conv_id = t.conv_id and x.turn <= t.turn and x.level = 1)),
  (select case when a.turn > coalesce((select max(turn) from t y where y.conv_id = t.conv_id and y.turn <= t.turn and y.level < 2), -1) and t.level >= 2 then title end from t a where a.conv_id = t.conv_id and a.turn = (select max(turn) from t x where x.conv_id = t.conv_id and x.turn <= t.turn and x.level = 2)),
  (select case when a.turn > coalesce((select max(turn) from t y where y.conv_id = t.conv_id and y.turn <= t.turn and y.level < 3), -1) and t.level >= 3 then title end from t a where a.conv_id = t.conv_id and a.turn = (select max(turn) from t x where x.conv_id = t.conv_id and x.turn <= t.turn and x.level = 3)),
  (select case when a.turn > coalesce((select max(turn) from t y where y.conv_id = t.conv_id and y.turn <= t.turn and y.level < 4), -1) and t.level >= 4 then title end from t a where a.conv_id = t.conv_id and a.turn = (select max(turn) from t x where x.conv_id = t.conv_id and x.turn <= t.turn and x.level = 4))], lambda x: x is not null), ' > ') as path from t""")
def heading_paths(spark, sf_dir):
    """Ancestor paths of ordered levels (here from the lengths of turns), as the section parser finds them."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.length("text") % 4 + 1).cast("int").alias("level"), F.concat(F.lit("n"), F.col("turn").cast("string")).alias("title"))
    return rows.withColumn("path", F.array_join(ancestor_path("turn", "conv_id"), " > ")).select("conv_id", "turn", "level", "path")


@query("select doc_id, 'unit id was used before, last in ' || previous as message from (select doc_id, lag(doc_id) over (partition by sha256(text) order by lpad(doc_id::varchar, 12, '0')) as previous from documents) where previous is not null")
def dup_id_previous_holder(spark, sf_dir):
    """A repeated key names the row that held it last."""
    items = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("id"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.lit(0).alias("at"))
    found = validation.duplicate_ids(items, "unit")
    plain = F.regexp_replace("message", "last in 0*(?=[0-9])", "last in ")
    return found.select(F.col("file").cast("long").alias("doc_id"), plain.alias("message"))


@query(f"select d.doc_id, b.item_id from documents d join benchmark b on contains({NORM.format('d.text')}, {NORM.format('b.text')})")
def quote_found(spark, sf_dir):
    """Which quotes occur in which documents, without a locator; one pass over the documents.

    Three words inside a quote are its key. A document meets the keys of all
    quotes inside its row, where they fit (QUOTES), else through a join; only
    quotes whose key it holds are looked for. Quotes too short for a key are
    looked for everywhere: they are the stated query set."""
    docs = normalized_docs(spark, sf_dir, "text").where("text is not null").withColumn("w", F.split("norm_text", " "))
    quotes = table(spark, sf_dir, "benchmark").select("item_id", X.normalize_quote(F.col("text")).alias("quote")).where("quote <> ''").withColumn("w", F.split("quote", " "))
    long_ones = quotes.where(F.size("w") >= 5).select("item_id", "quote", F.xxhash64(F.array_join(F.slice("w", 2, 3), " ")).alias("key"))
    short = quotes.where(F.size("w") < 5).select("item_id", "quote")
    keys = F.when(F.size("w") >= 5, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.xxhash64(F.array_join(F.slice("w", i, 3), " "))))).otherwise(F.expr("cast(array() as array<bigint>)"))
    if quotes.count() > QUOTES:
        met = docs.select("doc_id", "norm_text", F.explode(keys).alias("key")).join(long_ones, "key").where(F.contains("norm_text", "quote"))
        return met.select("doc_id", "item_id").unionByName(docs.join(short, F.contains("norm_text", "quote")).select("doc_id", "item_id"))
    one = long_ones.agg(F.collect_set("key").alias("wanted")).crossJoin(short.agg(F.collect_list(F.struct("item_id", "quote")).alias("short")))  # QUOTES entries at most
    known = F.transform(F.array_intersect(keys, F.col("wanted")), lambda k: F.struct(k.alias("key"), F.lit(None).cast("long").alias("found")))
    whole = F.transform(F.filter("short", lambda q: F.contains(F.col("norm_text"), q["quote"])), lambda q: F.struct(F.lit(None).cast("long").alias("key"), q["item_id"].alias("found")))
    each = docs.crossJoin(F.broadcast(one)).select("doc_id", "norm_text", F.explode(F.concat(known, whole)).alias("c"))
    met = each.join(long_ones, F.col("c.key") == F.col("key"), "left").where(F.col("c.found").isNotNull() | F.contains("norm_text", "quote"))
    return met.select("doc_id", F.coalesce("c.found", "item_id").alias("item_id"))


# Queries over markdown files and records made from the tables; see tables.py.


@query(Q.SECTIONS)
def section_table(spark, sf_dir):
    """Sections of all files: ids, anchors, paths, extents, words, texts; some files share a name."""
    own = ("ordinal", "line_start", "line_end", "words")
    sections = T.fresh_index(spark, sf_dir)[1]  # not the stored one: this query also times the building
    return sections.select("file", *(F.col(c).cast("int").alias(c) for c in own), "id", "level", "title", F.array_join("path", " > ").alias("titles"), "anchor", F.sha2("text", 256).alias("text_sha256"))


@query(Q.DOCUMENTS)
def document_table(spark, sf_dir):
    """Documents: titles, digests, sizes, URLs."""
    return T.indexed(spark, sf_dir)[0].select("path", "slug", "author", "title", "wordpress_id", "sha256", "lines", F.col("words").cast("int").alias("words"), "url")


@query(Q.TOTALS)
def corpus_totals(spark, sf_dir):
    return totals(*T.indexed(spark, sf_dir))


@query(Q.TOC)
def toc_nesting(spark, sf_dir):
    """Parents of all headings in a table of contents."""
    headings = T.indexed(spark, sf_dir)[1].select(F.col("file").alias("slug"), F.col("ordinal").cast("long").alias("n"), "level", "title", "anchor")
    return toc.toc_parents(headings).select(F.col("slug").alias("file"), "n", "parent")


@query(Q.AUTHORS)
def author_groups(spark, sf_dir):
    """List items of each author's documents, authors without regard to case."""
    return listing.author_groups(T.indexed(spark, sf_dir)[0]).select("author", F.col("at").cast("int").alias("place"), "items")


@query(Q.PAYLOADS)
def publishing_payloads(spark, sf_dir):
    """What a publisher would send, and the front matter after the answer."""
    files = T.markdown(spark, sf_dir)
    sent = listing.publishing_payloads(T.indexed(spark, sf_dir)[0])
    answers = sent.select("path", F.when(F.col("action") == "create", F.concat(F.lit("n-"), "slug")).alias("wordpress_id")).where("wordpress_id is not null")
    return sent.join(listing.with_new_ids(files, answers).select("path", F.sha2("text", 256).alias("new_sha256")), "path").select("path", "slug", "title", "tag", "action", "wordpress_id", "new_sha256")


@query(Q.SEARCH)
def search_sections(spark, sf_dir):
    """Sections by hits of a theme, marked where a record of the theme covers them."""
    documents, sections = T.indexed(spark, sf_dir)
    covered = S.covered_locators(T.record_tables(spark, sf_dir, sections)[0], "care")
    found = S.search(documents, sections, T.THEMES[1]["search_terms"], by_section=True, top=40, covered=covered)
    return found.select(F.col("rank").cast("int").alias("rank"), "hits", "author", "locator", "done", F.array_join("path", " > ").alias("titles"), "line_start", F.col("line_end").cast("int").alias("line_end"), F.col("words").cast("int").alias("words"), "url", "total")


@query(Q.TWO_TOTALS)
def two_hit_totals(spark, sf_dir):
    """Hits summed over sections, and over the whole text; front matter and a phrase across a border count only in the second."""
    documents, sections = T.indexed(spark, sf_dir)
    terms = T.THEMES[1]["search_terms"]
    by_section = S.section_hits(sections, terms).groupBy(F.col("file").alias("path")).agg(F.sum("hits").alias("section_hits"))
    return S.document_hits(documents, terms).select("path", F.col("hits").alias("document_hits")).join(by_section, "path", "left").select("path", "document_hits", F.coalesce("section_hits", F.lit(0)).alias("section_hits"))


@query(Q.OPEN)
def theme_scores(spark, sf_dir):
    """Documents by themes without a record of the theme; the terms of all themes are counted in one scan."""
    documents, sections = T.indexed(spark, sf_dir)
    hits = status.open_documents(list({t["id"]: t for t in T.THEMES}.values()), T.record_tables(spark, sf_dir, sections)[0], T.registries(spark, sf_dir)[1], documents)
    return hits.select("path", "theme", "year", "hits")


@query(Q.UNCOVERED)
def top_candidates_uncovered(spark, sf_dir):
    """Next candidates of one theme, by hits; the anti-joins come before the text is looked at."""
    documents, sections = T.indexed(spark, sf_dir)
    own = ledger.records_of(T.record_tables(spark, sf_dir, sections)[0], "care")
    hits = ledger.uncovered(documents, own, T.registries(spark, sf_dir)[1], T.THEMES[1]["search_terms"])
    return hits.orderBy(F.desc("hits"), "slug", "path").limit(25).select("slug", "path", "year", "hits")


@query(Q.VIOLATIONS)
def violations(spark, sf_dir):
    """Every rule, over records and registries with planted defects."""
    documents, sections = T.indexed(spark, sf_dir)
    extractions, inheritance = T.record_tables(spark, sf_dir, sections)
    stored = documents.where("slug <> 'd0'")  # the stored index lacks a document
    return validation.validate(documents, sections, *T.registries(spark, sf_dir), documents.select("path"), extractions, inheritance, T.SCHEMAS, stored)


@query(Q.LEDGER)
def ledger_lines(spark, sf_dir):
    """The ledger of the theme care, line by line."""
    documents, sections = T.indexed(spark, sf_dir)
    return ledger.ledger(T.THEMES[1], T.record_tables(spark, sf_dir, sections)[0], T.registries(spark, sf_dir)[1], documents, sections)


@query(Q.STATUS)
def status_lines(spark, sf_dir):
    """The coverage report, line by line."""
    documents, sections = T.indexed(spark, sf_dir)
    extractions, inheritance = T.record_tables(spark, sf_dir, sections)
    _, chronology, gaps = T.registries(spark, sf_dir)
    return status.status(T.THEMES, extractions, inheritance, chronology, gaps, documents, sections)


@query(r"""with p as (select page_id, replace(replace(html, '<h1>', '<h1 class="t" id="top">'), '<p>', '<h2 id=''p''>a <b>b</b></h2><h3>no id</h3><p>') as html from pages),
h as (select page_id, unnest(regexp_extract_all(html, '(?is)<h([1-6])(?:\s[^>]*)?>.*?</h[1-6]>')) as h, generate_subscripts(regexp_extract_all(html, '(?is)<h([1-6])(?:\s[^>]*)?>.*?</h[1-6]>'), 1) - 1 as n from p),
r as (select page_id, n::bigint as n, lower(h)[3]::int as level, trim(regexp_replace(regexp_replace(h, '(?s)<[^>]*>', '', 'g'), '\s+', ' ', 'g')) as title, regexp_extract(h, '(?is)^<h[1-6](?:\s[^>]*?)?\sid\s*=\s*["'']([^"'']*)["'']', 1) as anchor from h)
select * from r where anchor <> ''""")
def page_headings(spark, sf_dir):
    """Headings of rendered pages that carry an id; ids and further headings are put into the pages."""
    html = F.replace(F.replace("html", F.lit("<h1>"), F.lit('<h1 class="t" id="top">')), F.lit("<p>"), F.lit("<h2 id='p'>a <b>b</b></h2><h3>no id</h3><p>"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("slug"), html.alias("html"))
    return toc.rendered_headings(pages).withColumnRenamed("slug", "page_id")


@query("""select 'error' as severity, 'V1' as rule, 'gaps-' || item_id || '.json' as file, m.message as message from (select item_id, unnest(case when item_id % 12 = 0 then [{'message': '$.gaps[0]: lacks question'}, {'message': '$.gaps[0].status: must be one of ["open", "closed"]'}] when item_id % 3 = 0 then [{'message': '$.gaps[0].status: must be one of ["open", "closed"]'}] when item_id % 4 = 0 then [{'message': '$.gaps[0]: lacks question'}] else [] end) as m from benchmark)""")
def registry_schema(spark, sf_dir):
    """Schema errors of registry files, one made of each benchmark row."""
    gap = {"type": "object", "required": ["id", "question"], "properties": {"id": {"type": "string", "minLength": 2}, "status": {"enum": ["open", "closed"]}}}
    schema = {"$defs": {"gap": gap}, "type": "object", "properties": {"gaps": {"type": "array", "items": {"$ref": "#/$defs/gap"}}}}
    raw = "to_json(named_struct('gaps', array(named_struct('id', concat('g', item_id), 'question', if(item_id % 4 = 0, null, 'Who?'), 'status', if(item_id % 3 = 0, 'shut', 'open')))))"
    files = table(spark, sf_dir, "benchmark").selectExpr("concat('gaps-', item_id, '.json') path", f"{raw} raw")
    return validation.schema_rule(files, "V1", schema).select("severity", "rule", "file", "message")

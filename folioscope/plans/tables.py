"""Markdown files, registries and records made from the supplied tables, in Spark and, for the checks, in SQL.

Every row of ``documents`` becomes a file with front matter, headings of all
levels and fences; every third line is a heading, every eighth may open or close
a fence.  Some files share a name under two authors.  ``labels`` rows become
records of three themes with units and absences, ``benchmark`` rows questions.
Remainders of the ids plant every kind of defect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.sections import index_documents
from folioscope.sources import corpus as C
from folioscope.sources.scratch import materialize

SITE = "https://example.org/"
THEMES = [
    {"id": "path", "english": "way", "glossary_terms": None, "search_terms": ["für", "über", "mit", "pour"], "note": None},
    {"id": "care", "english": "tending", "glossary_terms": None, "search_terms": ["thand", "then", "in the"], "note": "What is tended."},
    {"id": "being", "english": "to be", "glossary_terms": None, "search_terms": ["onat", "erth"], "note": None},
    {"id": "path", "english": "road", "glossary_terms": None, "search_terms": ["für", "pour"], "note": None},
]
ITEM = {"type": "object", "required": ["id", "locator", "quote"], "properties": {"id": {"type": "string", "pattern": "^[a-z/0-9-]+$"}, "quote": {"type": "string"}}}
HEAD = {"schema_version": {"const": 1}, "source_sha256": {"type": "string", "pattern": "^[0-9a-f]{64}$"}, "coverage": {"enum": ["complete", "partial"]}, "commentary": {"type": "string"}, "extracted_at": {"type": "string"}, "coverage_note": {"type": ["string", "null"]}}
SCHEMAS = {
    "extraction": {"type": "object", "additionalProperties": False, "required": ["theme", "units"], "$defs": {"unit": ITEM}, "properties": HEAD | {"theme": {"type": "string"}, "units": {"type": "array", "items": {"$ref": "#/$defs/unit"}}, "absences": {"type": "array"}}},
    "inheritance": {"type": "object", "additionalProperties": False, "required": ["engagements"], "properties": HEAD | {"engagements": {"type": "array", "minItems": 1, "items": ITEM}}},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, author, slug, path, sha256, text) of the files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    line = "case when i % 3 = 0 then concat(repeat('#', 1 + length(x) % 6), ' ', array_join(slice(split(x, ' '), 1, 4), ' '), if(i % 6 = 0, ' ##', '')) when i % 8 = 5 then '```' else x end"
    head = "if(doc_id % 3 = 0, concat('---\\ntitle: ''Doc ', doc_id, '''\\nwordpress_id: ', doc_id, '\\n---\\n'), '')"
    rows = docs.selectExpr("doc_id", "concat(coalesce(source, 'none'), if(doc_id % 10 = 1, '-b', '')) author", "concat('d', if(doc_id % 10 = 1, doc_id - 1, doc_id)) slug", f"concat({head}, array_join(transform(split(coalesce(text, ''), '\\n', -1), (x, i) -> {line}), '\\n')) text")
    return rows.select("doc_id", "author", "slug", F.concat("author", F.lit("/"), "slug", F.lit(".md")).alias("path"), F.sha2("text", 256).alias("sha256"), "text")


FILES_SQL = """
f0 as (select doc_id, coalesce(source, 'none') || case when doc_id % 10 = 1 then '-b' else '' end as author, 'd' || case when doc_id % 10 = 1 then doc_id - 1 else doc_id end as slug,
  case when doc_id % 3 = 0 then '---' || chr(10) || 'title: ''Doc ' || doc_id || '''' || chr(10) || 'wordpress_id: ' || doc_id || chr(10) || '---' || chr(10) else '' end
  || array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: case when (i - 1) % 3 = 0 then repeat('#', (1 + length(x) % 6)::int) || ' ' || array_to_string(string_split(x, ' ')[1:4], ' ') || case when (i - 1) % 6 = 0 then ' ##' else '' end when (i - 1) % 8 = 5 then '```' else x end), chr(10)) as text from documents),
files as materialized (select *, author || '/' || slug || '.md' as path, sha256(text) as sha256, string_split(text, chr(10)) as lines, case when doc_id % 3 = 0 then 4 else 0 end as front from f0),
l as (select path, front, len(lines) as n_lines, generate_subscripts(lines, 1) as n, unnest(lines) as line from files),
k as (select *, regexp_matches(line, '^\\s*(```|~~~)')::int as fence from l where n > front and (regexp_matches(line, '^\\s*(```|~~~)') or regexp_matches(line, '^(#{1,6})\\s+(.*?)\\s*#*\\s*$'))),
o as (select *, coalesce(sum(fence) over (partition by path order by n rows between unbounded preceding and 1 preceding), 0) % 2 as open from k),
h as materialized (select path, n, n_lines, length(regexp_extract(line, '^(#{1,6})\\s+(.*?)\\s*#*\\s*$', 1)) as level, trim(regexp_replace(regexp_extract(line, '^(#{1,6})\\s+(.*?)\\s*#*\\s*$', 2), '[*_`]', '', 'g'), ' ' || chr(9)) as title from o where open = 0 and fence = 0),
till as (select a.path, a.n, a.level, a.title, coalesce(min(x.n), 1000000000) as until from h a left join h x on x.path = a.path and x.n > a.n and x.level <= a.level group by 1, 2, 3, 4),
above as (select h.path, h.n, list(a.title order by a.n) as titles from h join till a on a.path = h.path and a.n <= h.n and h.n < a.until group by 1, 2),
g as (select h.*, row_number() over (partition by h.path order by h.n) as ordinal, coalesce(lead(h.n) over (partition by h.path order by h.n) - 1, n_lines) as line_end,
  trim(regexp_replace(lower(strip_accents(replace(replace(title, '§', 's'), '&', ' and '))), '[^a-z0-9]+', '-', 'g'), '-') as s0,
  replace(trim(regexp_replace(regexp_replace(lower(strip_accents(title)), '^[^a-z]+', ''), '[^a-z0-9\\s-]', '', 'g')), ' ', '-') as a0 from h),
g1 as (select *, 'h' || level || '-' || rtrim(left(case when s0 = '' then 'section' else s0 end, 80), '-') as base, case when a0 = '' then 'section' else a0 end as anchor_base from g),
g2 as (select *, row_number() over (partition by path, base order by n) as nth, row_number() over (partition by path, anchor_base order by n) as nth_anchor from g1),
sections as materialized (select f.author, f.slug, g.path as file, ordinal, base || case when nth = 1 then '' else '-' || nth end as id, level, title, titles, anchor_base || case when nth_anchor = 1 then '' else '-' || (nth_anchor - 1) end as anchor, g.n as line_start, line_end,
  len(regexp_extract_all(array_to_string(f.lines[g.n + 1 : line_end], chr(10)), '\\S+')) as words, array_to_string(f.lines[g.n : line_end], chr(10)) as text from g2 g join files f on f.path = g.path join above a on a.path = g.path and a.n = g.n),
docs as materialized (select f.*, case when doc_id % 3 = 0 then 'Doc ' || doc_id else coalesce(nullif((select arg_min(title, n) from h where h.path = f.path and level = 1), ''), slug) end as title, len(lines) as n_lines, len(regexp_extract_all(text, '\\S+')) as words, 'https://example.org/' || author || '/' || slug || '.html' as url from files f),
named as materialized (select * from docs qualify row_number() over (partition by slug order by author desc, path desc) = 1)"""


def fresh_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(documents, sections), built and stored now."""
    documents, sections = index_documents(markdown(spark, sf_dir), SITE)
    return materialize(documents, "index-documents"), materialize(sections, "index-sections")


_stored: dict[tuple, tuple[DataFrame, ...]] = {}


def kept(spark: SparkSession, sf_dir: str, what: str, build: Callable[[], tuple[DataFrame, ...]]) -> tuple[DataFrame, ...]:
    """What ``build`` stored for these very files in this session; built again where a file has changed."""
    stamps = []
    for name in ("documents", "labels"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
        stamps += [(str(x.getPath()), x.getLen(), x.getModificationTime()) for x in status]
    key = (spark.sparkContext.applicationId, what, *stamps)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The stored index (documents, sections), which all reports read; it is built once for the same files."""
    return kept(spark, sf_dir, "index", lambda: fresh_index(spark, sf_dir))


def registries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(themes, chronology, gaps) as the registry readers give them."""
    themes = spark.createDataFrame([(i, t["id"], t["english"], t["search_terms"], t["note"]) for i, t in enumerate(THEMES)], "position int, id string, english string, search_terms array<string>, note string")
    strata = """concat(array(named_struct('id', if(doc_id % 41 = 0, 'same', concat('s', doc_id, 'a')), 'label', 'Layer A', 'year_start', cast(if(doc_id % 5 in (2, 3), null, 1500 + doc_id % 400) as int), 'year_end', cast(if(doc_id % 4 = 0, 1502 + doc_id % 400, null) as int), 'stated_in_commentary', doc_id % 6 <> 0, 'evidence', if(doc_id % 12 = 0, 'colophon', null))),
        if(doc_id % 4 = 1, array(named_struct('id', concat('s', doc_id, 'b'), 'label', 'Layer B', 'year_start', cast(1493 + doc_id % 400 as int), 'year_end', cast(null as int), 'stated_in_commentary', true, 'evidence', cast(null as string))), array()))"""
    files = markdown(spark, sf_dir).where("doc_id % 7 <> 5")
    chronology = files.selectExpr("cast(doc_id as int) position", "if(doc_id % 29 = 0, concat('lost', doc_id), slug) commentary", "case when doc_id % 9 = 4 then 'output' when doc_id % 3 = 1 then 'reception' else 'primary' end role", "if(doc_id % 5 = 2, 'unresolved', 'resolved') status", f"{strata} strata", "if(doc_id % 2 = 0, 'no year given', null) note")
    gaps = table(spark, sf_dir, "benchmark").selectExpr("cast(item_id as int) position", "concat('g', item_id) id", "if(item_id % 2 = 0, 'care', null) theme", "concat('Who knows ', item_id, '?') question", "concat('d', item_id, '.md') needs", "if(item_id % 4 = 3, null, concat('src', item_id % 4, '/d', item_id, '.md')) raised_by", "if(item_id % 3 = 0, 'closed', 'open') status")
    return themes, chronology, gaps


RECORDS_SQL = """
themes(position, id, english, search_terms) as (values (0, 'path', 'way', ['für', 'über', 'mit', 'pour']), (1, 'care', 'tending', ['thand', 'then', 'in the']), (2, 'being', 'to be', ['onat', 'erth']), (3, 'path', 'road', ['für', 'pour'])),
entry as materialized (select doc_id as position, case when doc_id % 29 = 0 then 'lost' || doc_id else slug end as commentary, case when doc_id % 9 = 4 then 'output' when doc_id % 3 = 1 then 'reception' else 'primary' end as role, case when doc_id % 5 = 2 then 'unresolved' else 'resolved' end as status, case when doc_id % 2 = 0 then 'no year given' end as note, doc_id from files where doc_id % 7 <> 5),
strata as materialized (select position, commentary, 0 as nr, case when doc_id % 41 = 0 then 'same' else 's' || doc_id || 'a' end as id, 'Layer A' as label, case when doc_id % 5 not in (2, 3) then 1500 + doc_id % 400 end as y1, case when doc_id % 4 = 0 then 1502 + doc_id % 400 end as y2, doc_id % 6 <> 0 as stated, case when doc_id % 12 = 0 then 'colophon' end as evidence from entry
  union all select position, commentary, 1, 's' || doc_id || 'b', 'Layer B', 1493 + doc_id % 400, null, true, null from entry where doc_id % 4 = 1),
gaps as (select item_id as position, 'g' || item_id as id, case when item_id % 2 = 0 then 'care' end as theme, 'Who knows ' || item_id || '?' as question, 'd' || item_id || '.md' as needs, case when item_id % 4 <> 3 then 'src' || item_id % 4 || '/d' || item_id || '.md' end as raised_by, case when item_id % 3 = 0 then 'closed' else 'open' end as status from benchmark),
r0 as (select f.doc_id, f.path as file, f.slug, f.sha256 as own, quality, toxic, case when f.doc_id % 31 = 0 then 'ghost' when f.doc_id % 3 = 0 then 'care' when f.doc_id % 3 = 1 then 'being' else 'path' end as theme, case when f.doc_id % 47 = 3 then 'gone' || f.doc_id else f.slug end as commentary from files f join labels using (doc_id)),
rec as materialized (select *, 'extractions/' || case when doc_id % 37 = 5 then 'elsewhere' else theme end || '/' || case when doc_id % 43 = 7 then 'misnamed' || doc_id else slug end || '.json' as path, case when doc_id % 53 = 0 then 'short' when doc_id % 6 = 1 then repeat('0', 64) else own end as source_sha256,
  case when doc_id % 59 = 1 then 'whole' when quality = 0 then 'partial' else 'complete' end as coverage, case when quality = 0 and doc_id % 2 = 0 then 'first part' end as coverage_note from r0),
unit as materialized (select r.doc_id, r.path, r.theme, r.commentary, s.ordinal - 1 as nr, case when r.doc_id % 8 = 0 and s.ordinal = 1 then r.theme || '/dup' when r.doc_id % 14 = 3 and s.ordinal = 2 then 'x/' || r.doc_id else r.theme || '/' || r.doc_id || '-' || s.ordinal end as id,
  case when r.doc_id % 11 = 0 and s.ordinal = 2 then 'nowhere#x' when r.doc_id % 13 = 0 and s.ordinal = 3 then r.slug || '#none' when r.doc_id % 17 = 0 and s.ordinal = 1 then 'nohash' else r.slug || '#' || s.id end as locator, case when s.ordinal = 2 then 'p. ' || r.doc_id end as primary_locator,
  case when r.doc_id % 4 = 1 and s.ordinal = 1 then 's' || r.doc_id || 'b' when r.doc_id % 4 in (1, 2) and s.ordinal < 3 then 's' || r.doc_id || 'a' when r.doc_id % 4 = 3 and s.ordinal = 1 then 'zz' when r.doc_id % 4 = 3 and s.ordinal = 2 then 's2a' end as stratum, 'care' as term, 'It is said ' || s.ordinal || ' times.' as claim, 'introduced' as status,
  case when r.doc_id % 19 = 0 then 'zzz ' else '' end || left(s.text, 40) as quote from rec r join sections s on s.file = r.file and s.ordinal <= 3),
absence as (select r.doc_id, r.path, r.theme, r.commentary, 0 as nr, r.slug || '#' || s.id as locator, 'it opens the text' as expected_because, case when r.doc_id % 2 = 0 then 'but see below' end as note, case when toxic = 1 then ['thand', 'pour'] end as absent_terms from rec r join sections s on s.file = r.file and s.ordinal = 1),
inh as materialized (select r.doc_id, r.slug as commentary, 'inheritance/' || r.slug || '.json' as path, r.own as source_sha256, 'complete' as coverage, 'e' || r.doc_id % 50 as id, r.slug || '#' || s.id as locator, left(s.text, 30) as quote from r0 r join sections s on s.file = r.file and s.ordinal = 1 where toxic = 1 and r.doc_id % 10 <> 1)"""


def record_tables(spark: SparkSession, sf_dir: str, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(extractions, inheritance): the records are written as JSON, once for the same files, and read back as files are."""
    stored = kept(spark, sf_dir, "records", lambda: tuple(materialize(x, "records") for x in raw_records(spark, sf_dir, sections)))
    return tuple(C.typed_records(x, schema) for x, schema in zip(stored, (C.EXTRACTION, C.INHERITANCE), strict=True))


def raw_records(spark: SparkSession, sf_dir: str, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, raw) of the extraction and the inheritance files."""
    files = markdown(spark, sf_dir).select("doc_id", F.col("path").alias("file"), "slug", F.col("sha256").alias("own"))
    base = files.join(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id")
    theme = "case when doc_id % 31 = 0 then 'ghost' when doc_id % 3 = 0 then 'care' when doc_id % 3 = 1 then 'being' else 'path' end"
    base = base.selectExpr("*", f"{theme} theme", "if(doc_id % 47 = 3, concat('gone', doc_id), slug) commentary")
    each = sections.where("ordinal <= 3").select("file", "ordinal", F.col("id").alias("sid"), F.substring("text", 1, 40).alias("text")).join(base, "file")
    unit = """named_struct('ordinal', ordinal, 'u', named_struct('id', case when doc_id % 8 = 0 and ordinal = 1 then concat(theme, '/dup') when doc_id % 14 = 3 and ordinal = 2 then concat('x/', doc_id) else concat(theme, '/', doc_id, '-', ordinal) end,
        'locator', case when doc_id % 11 = 0 and ordinal = 2 then 'nowhere#x' when doc_id % 13 = 0 and ordinal = 3 then concat(slug, '#none') when doc_id % 17 = 0 and ordinal = 1 then 'nohash' else concat(slug, '#', sid) end, 'primary_locator', if(ordinal = 2, concat('p. ', doc_id), null),
        'stratum', case when doc_id % 4 = 1 and ordinal = 1 then concat('s', doc_id, 'b') when doc_id % 4 in (1, 2) and ordinal < 3 then concat('s', doc_id, 'a') when doc_id % 4 = 3 and ordinal = 1 then 'zz' when doc_id % 4 = 3 and ordinal = 2 then 's2a' end,
        'term', 'care', 'claim', concat('It is said ', ordinal, ' times.'), 'status', 'introduced', 'quote', concat(if(doc_id % 19 = 0, 'zzz ', ''), substring(text, 1, 40))))"""
    absence = "named_struct('locator', concat(slug, '#', sid), 'expected_because', 'it opens the text', 'note', if(doc_id % 2 = 0, 'but see below', null), 'absent_terms', if(toxic = 1, array('thand', 'pour'), null))"
    engagement = "named_struct('id', concat('e', doc_id % 50), 'locator', concat(slug, '#', sid), 'mode', 'cites', 'claim', 'It cites.', 'quote', substring(text, 1, 30))"
    keys = ["doc_id", "slug", "own", "quality", "toxic", "theme", "commentary"]
    whole = each.groupBy(*keys).agg(F.array_sort(F.collect_list(F.expr(unit))).alias("us"), F.collect_list(F.when(F.col("ordinal") == 1, F.expr(absence))).alias("absences"), F.collect_list(F.when(F.col("ordinal") == 1, F.expr(engagement))).alias("engagements"))
    head = "1 as schema_version, '2020-02-02' as extracted_at, commentary, case when doc_id % 53 = 0 then 'short' when doc_id % 6 = 1 then repeat('0', 64) else own end as source_sha256, case when doc_id % 59 = 1 then 'whole' when quality = 0 then 'partial' else 'complete' end as coverage, if(quality = 0 and doc_id % 2 = 0, 'first part', null) as coverage_note"
    raw = f"to_json(struct({head}, theme, transform(us, x -> x.u) as units, absences))"
    place = "concat('extractions/', if(doc_id % 37 = 5, 'elsewhere', theme), '/', if(doc_id % 43 = 7, concat('misnamed', doc_id), slug), '.json')"
    extractions = whole.selectExpr(f"{place} path", f"{raw} raw")
    own = "to_json(struct(1 as schema_version, '2020-02-02' as extracted_at, slug as commentary, own as source_sha256, 'complete' as coverage, engagements))"
    inheritance = whole.where("toxic = 1 and doc_id % 10 <> 1").selectExpr("concat('inheritance/', slug, '.json') path", f"{own} raw")
    return extractions, inheritance

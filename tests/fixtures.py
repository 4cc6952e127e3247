"""A small invented corpus with records, and the reports over it."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.sections import index_documents
from folioscope.sources import corpus as C

FILES = {
    "weaver/loom-notes.md": "---\ntitle: 'The Loom''s Notes'\nwordpress_id: 7\n# a remark\n---\npreamble on care\n# Loom\n\nThe warp is under *care*; the weft\nfollows. Taking care of thread.\n\n## § 1. Warp & Weft\n\nA careful hand — “steady” and slow — keeps the tension even.\n\n```\n# not a heading\n```\n\n## Knots\n\nKnots hold.\n\n## Knots\n\nKnots slip, carelessly.\n\n#### Deep φρόνησις ##\n\nNothing here.\n",
    "weaver/spindle.md": "# Spindle\n\nThe spindle turns with care.\n\n### Skipped level\n\nUncared for wool; care again.\n\n## Back\n\nWool.\n",
    "dyer/vat.md": "Plain words on care and colour, no heading.\n",
    "dyer/mordant book.md": "---\ntitle: Mordants\n---\n# Alum\n\nAlum binds.\n",
}
THEMES = [
    {"id": "care", "english": "care", "glossary_terms": ["care"], "search_terms": ["taking care", "care"], "note": "What is tended."},
    {"id": "wool", "english": "wool", "glossary_terms": None, "search_terms": ["wool"], "note": None},
]
CHRONOLOGY = [
    {"commentary": "loom-notes", "role": "primary", "status": "resolved", "note": None, "strata": [{"id": "l2", "label": "Second layer", "year_start": 1911, "year_end": 1913, "stated_in_commentary": True, "evidence": None}, {"id": "l1", "label": "First layer", "year_start": 1907, "year_end": None, "stated_in_commentary": False, "evidence": "the colophon"}]},
    {"commentary": "spindle", "role": "reception", "status": "resolved", "note": None, "strata": [{"id": "s1", "label": "Only layer", "year_start": 1950, "year_end": 1950, "stated_in_commentary": True, "evidence": None}]},
    {"commentary": "vat", "role": "primary", "status": "unresolved", "note": "no date given", "strata": [{"id": "v1", "label": "Vat", "year_start": None, "year_end": None, "stated_in_commentary": True, "evidence": None}]},
    {"commentary": "lost", "role": "primary", "status": "resolved", "note": None, "strata": [{"id": "l1", "label": "Lost", "year_start": None, "year_end": None, "stated_in_commentary": False, "evidence": None}]},
]
GAPS = [
    {"id": "g2", "opened": "2020-01-01", "theme": "care", "question": "Who tends the vat?", "needs": "vat.md", "raised_by": "outputs/none.md", "status": "open", "resolution": None},
    {"id": "g1", "opened": "2020-01-02", "theme": None, "question": "Closed?", "needs": "-", "raised_by": None, "status": "closed", "resolution": "yes"},
]


def sha(path: str) -> str:
    return hashlib.sha256(FILES[path].encode()).hexdigest()


def unit(id_: str, locator: str, quote: str, stratum: str | None = None, status: str = "introduced") -> dict:
    out = {"id": id_, "locator": locator, "term": "care", "claim": "It is said that care is at work.", "status": status, "quote": quote}
    return out | ({"stratum": stratum} if stratum else {})


def records() -> dict[str, str]:
    """Extraction and inheritance files by path; one of them is not JSON."""
    head = {"schema_version": 1, "extracted_at": "2020-02-02"}
    loom = head | {
        "theme": "care", "commentary": "loom-notes", "source_sha256": sha("weaver/loom-notes.md"), "coverage": "partial", "coverage_note": "first part only",
        "units": [
            unit("care/one", "loom-notes#h1-loom", "the warp is under care; the weft follows.", "l2"),
            unit("care/two", "loom-notes#h2-s-1-warp-and-weft", "A careful hand - \"steady\" and slow - keeps", "l1"),
            unit("care/three", "loom-notes#h2-knots-2", "Knots slip, with great care.", None),
            unit("wool/four", "loom-notes#h2-none", "Knots hold and hold and hold.", "zz"),
            unit("care/five", "spindle#h1-spindle", "The spindle turns with care.", "s1"),
        ],
        "absences": [
            {"locator": "loom-notes#h2-knots", "expected_because": "knots are tended", "absent_terms": ["care", "hold"]},
            {"locator": "loom-notes#h1-loom", "expected_because": "it opens the book", "note": "but see below"},
        ],
    }
    spindle = head | {"theme": "care", "commentary": "spindle", "source_sha256": "0" * 64, "coverage": "complete", "units": [unit("care/one", "spindle#h3-skipped-level", "carded wool")], "absences": []}
    odd = head | {"theme": "care", "commentary": "vat", "source_sha256": "x", "coverage": "whole", "units": [], "absences": [], "extra": 1, "_note": "fine"}
    inherited = head | {"commentary": "spindle", "source_sha256": sha("weaver/spindle.md"), "coverage": "partial", "engagements": [{"id": "e1", "locator": "spindle", "predecessor": {"author": "Weaver"}, "mode": "cites", "claim": "It cites the loom.", "quote": "The spindle turns with care."}]}
    return {
        "extractions/care/loom-notes.json": json.dumps(loom), "extractions/care/spindle.json": json.dumps(spindle), "extractions/wool/vat.json": json.dumps(odd),
        "extractions/wool/broken.json": "{", "inheritance/spindle.json": json.dumps(inherited),
    }


ITEM = {"type": "object", "required": ["id", "locator", "quote"], "properties": {"id": {"type": "string", "pattern": "^[a-z/0-9-]+$"}, "quote": {"type": "string", "minLength": 8}}}
HEAD = {"schema_version": {"const": 1}, "source_sha256": {"type": "string", "pattern": "^[0-9a-f]{64}$"}, "coverage": {"enum": ["complete", "partial"]}, "commentary": {"type": "string"}, "extracted_at": {"type": "string"}, "coverage_note": {"type": "string"}}
SCHEMAS = {
    "extraction": {"type": "object", "additionalProperties": False, "required": ["theme", "units"], "$defs": {"unit": ITEM}, "properties": HEAD | {"theme": {"type": "string"}, "units": {"type": "array", "items": {"$ref": "#/$defs/unit"}}, "absences": {"type": "array"}}},
    "inheritance": {"type": "object", "additionalProperties": False, "required": ["engagements"], "properties": HEAD | {"engagements": {"type": "array", "minItems": 1, "items": ITEM}}},
}


def documents(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    rows = [(f"root/{p}", bytearray(t.encode()), t) for p, t in FILES.items()]
    return index_documents(C.document_rows(spark.createDataFrame(rows, "path string, content binary, text string")), "https://example.org/")


def registries(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    def table(items: list[dict], schema: str) -> DataFrame:
        typed = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "position int, raw string")
        return typed.select("position", F.from_json("raw", schema).alias("r")).select("position", "r.*")

    return table(THEMES, C.THEMES), table(CHRONOLOGY, C.CHRONOLOGY), table(GAPS, C.GAPS)


def record_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    def table(prefix: str, schema: str) -> DataFrame:
        rows = [(p, raw) for p, raw in records().items() if p.startswith(prefix)]
        return C.typed_records(spark.createDataFrame(rows, "path string, raw string"), schema)

    return table("extractions", C.EXTRACTION), table("inheritance", C.INHERITANCE)


#: The reports over this corpus, read and checked by hand.
LEDGER = """\
# Care, care: the records in order of time

What is tended.

From 3 documents: units 6, absences 2

## Dated sources

### The Loom's Notes, 1911-1913 to 1907 (`loom-notes`)

#### First layer

- introduced **care** (`care/two`): It is said that care is at work.
  - at `loom-notes#h2-s-1-warp-and-weft`, [§ 1. Warp & Weft](https://example.org/weaver/loom-notes.html#warp--weft)
  - > A careful hand - "steady" and slow - keeps

#### Second layer

- introduced **care** (`care/one`): It is said that care is at work.
  - at `loom-notes#h1-loom`, [Loom](https://example.org/weaver/loom-notes.html#loom)
  - > the warp is under care; the weft follows.

#### No layer named

- introduced **care** (`care/three`): It is said that care is at work.
  - at `loom-notes#h2-knots-2`, [Knots](https://example.org/weaver/loom-notes.html#knots-1)
  - > Knots slip, with great care.

#### Not found

- nothing at `loom-notes#h2-knots`, [Knots](https://example.org/weaver/loom-notes.html#knots)
  - looked for since knots are tended
- nothing at `loom-notes#h1-loom`, [Loom](https://example.org/weaver/loom-notes.html#loom)
  - looked for since it opens the book
  - but see below

Read in part: first part only

## Later readers

Years here are those of the readers.

### Spindle, 1950 (`spindle`)

- introduced **care** (`care/one`): It is said that care is at work.
  - at `spindle#h3-skipped-level`, [Skipped level](https://example.org/weaver/spindle.html#skipped-level)
  - > carded wool

## Without a date

No year is known, so these have no place in the order above.

### vat, undated (`vat`)

## Not read yet

Nothing: all documents with these terms have a record."""

STATUS = """\
# Coverage

4 documents, 9 sections, 101 words

## Themes

| theme | records | units | absences | stale | partial | open |
|-|-|-|-|-|-|-|
| care (care) | 3 | 6 | 2 | 2 | 1 | 0 |
| wool (wool) | 0 | 0 | 0 | 0 | 0 | 1 |

## To be read next

- wool 1: `spindle`, 1950, hits: 2

## Inheritance

- `spindle`: 1 engagements, partial

## Older than their documents

- `care/spindle`
- `care/vat`

## No date known

- `vat`: no date given

## Open questions

- g2 (open, care): Who tends the vat? Needs: vat.md
"""

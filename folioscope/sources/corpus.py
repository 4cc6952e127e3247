"""Sources: a directory of markdown documents, JSON records, registries, stored indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRATUM = "struct<id:string,label:string,year_start:int,year_end:int,stated_in_commentary:boolean,evidence:string>"
THEMES = "id string, english string, glossary_terms array<string>, search_terms array<string>, note string"
CHRONOLOGY = f"commentary string, role string, status string, strata array<{STRATUM}>, note string"
GAPS = "id string, opened string, theme string, question string, needs string, raised_by string, status string, resolution string"
EXTRACTOR = "extractor struct<agent:string,prompt:string,note:string>"
UNIT = "struct<id:string,locator:string,primary_locator:string,stratum:string,term:string,claim:string,status:string,quote:string>"
ABSENCE = "struct<locator:string,expected_because:string,note:string,absent_terms:array<string>>"
ENGAGEMENT = "struct<id:string,locator:string,primary_locator:string,stratum:string,predecessor:struct<author:string,text:string>,mode:string,claim:string,quote:string>"
HEAD = f"schema_version int, commentary string, source_sha256 string, extracted_at string, {EXTRACTOR}, coverage string, coverage_note string"
EXTRACTION = f"{HEAD}, theme string, units array<{UNIT}>, absences array<{ABSENCE}>"
INHERITANCE = f"{HEAD}, engagements array<{ENGAGEMENT}>"


def decoded_path(path: Column) -> Column:
    """File paths of Spark's metadata are percent-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """``root/<author>/*.md`` as (author, slug, path, content, sha256, text).

    The digest is that of the bytes; ``text`` has universal newlines."""
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/*.md")
    path = decoded_path(F.col("path"))
    text = F.regexp_replace(F.decode("content", "UTF-8"), "\r\n?", "\n")
    return document_rows(files.select(path.alias("path"), "content", text.alias("text")))


def document_rows(files: DataFrame) -> DataFrame:
    """(author, slug, path, sha256, text) of ``files(path, content, text)``."""
    parts = F.split("path", "/")
    slug = F.regexp_replace(F.element_at(parts, -1), r"\.md$", "")
    return files.select(F.element_at(parts, -2).alias("author"), slug.alias("slug"), F.concat_ws("/", F.slice(parts, -2, 2)).alias("path"), F.sha2("content", 256).alias("sha256"), "text")


def read_records(spark: SparkSession, root: str, schema: str, missing_ok: bool = True) -> DataFrame:
    """All ``*.json`` below ``root``: (path, directory, stem, raw, and the typed columns).

    Rows are ordered by nothing; sort by path where order matters.  ``raw``
    keeps what typed reading hides.  A malformed file has null typed columns."""
    read = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")
    empty = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "raw")])
    try:
        files = read.text(root, wholetext=True).select(decoded_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("raw"))
        files.schema  # noqa: B018  resolves the path
    except Exception as e:
        if not missing_ok or "PATH_NOT_FOUND" not in str(e):
            raise
        files = spark.createDataFrame([], empty)
    return typed_records(files, schema)


def typed_records(files: DataFrame, schema: str) -> DataFrame:
    parts = F.split("path", "/")
    rows = files.select("path", F.element_at(parts, -2).alias("directory"), F.regexp_replace(F.element_at(parts, -1), r"\.json$", "").alias("stem"), "raw")
    return rows.withColumn("_r", F.from_json("raw", schema)).select("path", "directory", "stem", "raw", "_r.*")


def read_registry(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """The list ``key`` of a registry file, with its position; a missing file is an empty registry."""
    row = T._parse_datatype_string(schema)
    try:
        files = spark.read.text(path, wholetext=True)
        files.schema  # noqa: B018
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], T.StructType([T.StructField("position", T.IntegerType()), *row.fields]))
    items = files.select(F.from_json("value", f"struct<{key}:array<{row.simpleString()}>>")[key].alias("items"))
    return items.select(F.posexplode("items").alias("position", "item")).select("position", "item.*")


def read_index(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(documents, sections) written by write_index; a missing index is an error that says what to do."""
    try:
        return spark.read.parquet(f"{root}/documents"), spark.read.parquet(f"{root}/sections")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no index at {root}; build it with the command 'index'") from e
        raise


def write_index(documents: DataFrame, sections: DataFrame, root: str) -> None:
    """The index as Parquet, by author, so that one author reads one folder."""
    documents.repartition("author").write.mode("overwrite").partitionBy("author").parquet(f"{root}/documents")
    sections.write.mode("overwrite").parquet(f"{root}/sections")

"""Incremental indexing of new files with Structured Streaming (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioscope.operators.sections import index_documents
from folioscope.sources.corpus import decoded_path, document_rows
from pyspark.sql import functions as F

FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, root: str) -> DataFrame:
    """A stream of the markdown files that appear below ``root/<author>/``."""
    return spark.readStream.format("binaryFile").schema(FILE).load(f"{root.rstrip('/')}/*/*.md")


def index_stream(spark: SparkSession, root: str, out: str, checkpoint: str, site: str = ""):
    """Index what is new since the last run and stop; sections need whole files, so each batch is indexed as one."""

    def one_batch(files: DataFrame, batch: int) -> None:
        text = F.regexp_replace(F.decode("content", "UTF-8"), "\r\n?", "\n")
        rows = document_rows(files.select(decoded_path(F.col("path")).alias("path"), "content", text.alias("text")))
        documents, sections = index_documents(rows, site)
        documents.write.mode("overwrite").parquet(f"{out}/documents/batch={batch}")  # a batch that is repeated replaces itself
        sections.write.mode("overwrite").parquet(f"{out}/sections/batch={batch}")

    query = new_files(spark, root).writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query

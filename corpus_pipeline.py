"""The corpus pipeline: documents in, shards of a cleaned and mixed corpus out.

Each stage gets all that its predecessor kept and returns the columns of
documents; the last returns a shard and a slot for every row.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.decontaminate import without_leaks
from folioscope.llm.langid import held_out, keep_identified
from folioscope.llm.mixing import mix_documents
from folioscope.llm.neardup import keep_one_of_each
from folioscope.llm.scratch import materialize
from folioscope.llm.sharding import shard_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without a letter and texts that no learned language explains."""
    return keep_identified(docs, docs.where(~held_out()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each group linked at 0.8 over five-word shingles; rows are told apart by id and text."""
    return keep_one_of_each(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject rows in whose text a benchmark item is found; other rows of the same id stay."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat the documents of smaller sources, at most twice; every document stays."""
    return mix_documents(docs, max_repeat=2.0)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal all rows into 16 shards of nearly equal bytes."""
    return shard_documents(docs, 16)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Language identification, the decontamination search and the component search have no SQL form.
ORACLE_SQL = None


def steps(spark: SparkSession, sf_dir: str) -> Iterator[tuple[str, DataFrame, DataFrame]]:
    """(stage, its input, its output) in order; every output but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            out = materialize(out, f"stage-{name}")
        yield name, docs, out
        docs = out


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    *_, (_, _, out) = steps(spark, sf_dir)
    return out


def counts(spark: SparkSession, sf_dir: str) -> list[dict]:
    """For each stage the rows and distinct (doc_id, text) it was given, kept and rejected."""

    def named(df: DataFrame) -> DataFrame:
        text = F.crc32(F.coalesce("text", F.lit(""))) if "text" in df.columns else F.col("text_crc32")
        return df.select("doc_id", text.alias("text")).distinct()

    out = []
    for name, before, after in steps(spark, sf_dir):
        known, kept = named(before), named(after)
        same = known["doc_id"].eqNullSafe(kept["doc_id"]) & (known["text"] == kept["text"])
        out.append({"stage": name, "rows_in": before.count(), "rows_out": after.count(), "kept": known.join(kept, same, "left_semi").count(), "rejected": known.join(kept, same, "left_anti").count()})
    return out

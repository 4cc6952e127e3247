"""Sinks: ordered lines as a file, JSON export, differences against what is there."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_of(lines: DataFrame) -> str:
    """The report of ``lines(sort keys..., line)``, ordered by its ``ordinal`` column; reports are small."""
    return "\n".join(r["line"] for r in lines.orderBy("ordinal").select("line").collect())


def write_text(lines: DataFrame, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text_of(lines), encoding="utf-8", newline="\n")


def up_to_date(lines: DataFrame, path: str) -> bool:
    """Check mode: is the file what would be written?"""
    return Path(path).exists() and Path(path).read_text(encoding="utf-8") == text_of(lines)


def as_json(df: DataFrame) -> DataFrame:
    """One JSON object in ``value`` for each row; nulls stay."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str, order: list[str], key: str = "rows") -> None:
    """The rows, in ``order``, as one indented JSON file: columns in their order, letters as they are, a line end at the end.

    The rows stream through the driver one partition after the other."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    with target.open("w", encoding="utf-8", newline="\n") as out:
        out.write(f'{{\n  "{key}": [')
        first = True
        for r in as_json(df.orderBy(*order)).toLocalIterator():
            text = json.dumps(json.loads(r["value"]), ensure_ascii=False, indent=2)
            out.write(("" if first else ",") + "\n    " + text.replace("\n", "\n    "))
            first = False
        out.write(("" if first else "\n  ") + "]\n}\n")


def differences(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with ``side``; repeated rows count."""
    found = found.select(*expected.columns)
    return expected.exceptAll(found).withColumn("side", F.lit("missing")).unionByName(found.exceptAll(expected).withColumn("side", F.lit("unexpected")))

"""Small documents with the awkward cases, and brute-force helpers."""

from __future__ import annotations

import random
import re

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"en": "the and tion er ing on at re es nd".split(), "fr": "le ou eau ment que ai re en é ç".split(), "de": "sch ein ung ch ver heit ö ü ß tz".split()}


def prose(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def make_documents() -> list[tuple]:
    rng = random.Random(7)
    rows = []
    for i in range(60):
        lang = ("en", "fr", "de")[i % 3]
        rows.append((i, prose(rng, lang, rng.randint(20, 160)), lang, "src0" if i % 2 else f"src{i % 5}", 0))
    passage = prose(rng, "en", 60)
    for i in (3, 9, 15):  # a passage that documents share
        rows[i] = (i, f"{rows[i][1]} {passage} {rows[i][1][:50]}", *rows[i][2:])
    for i in range(60, 66):  # near copies
        w = rows[6][1].split()
        w[i - 60] = "changed"
        rows.append((i, " ".join(w), "en", "src0", 0))
    rows += [(70 + i, rows[4][1], "fr", "src1", 0) for i in range(5)]  # exact copies
    rows += [
        (80, None, None, None, None), (81, "", "en", "src2", 0), (82, "   \n\t ", "en", None, 0), (83, "12 34 !!", "en", "src3", 0),
        (84, "One two", "en", "src3", 0), (85, "one TWO", "en", "src3", 0), (86, prose(rng, "de", 30_000), "de", "src9", 0),
        (87, "x" * 50_000, "en", "src9", 0), (88, "漢字 " * 40, None, "src9", 0), (None, prose(rng, "en", 40), "en", "src4", 0), (5, rows[5][1], "de", "src0", 0),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def clashing(df):
    """The same rows with extra columns whose names operators might use."""
    from pyspark.sql import functions as F

    for name in ("key", "n", "rep", "component", "bucket", "shard", "slot", "_source", "_id", "pass", "hash", "tokens", "anchor", "block", "th", "low", "_words", "words", "label", "digest", "id", "rank", "weight"):
        df = df.withColumn(name, F.lit("clash"))
    return df

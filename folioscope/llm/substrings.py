"""Substring deduplication by seed and extend (op 4).

Seeds are winnowed: in every window of ``length`` words the ``k``-word anchor of
smallest hash is chosen (the rightmost of equal ones), so equal windows choose
equal anchors.  Consecutive windows with the same anchor form a block: the anchor
extended both ways as far as its windows reach.

Anchors are joined by hash across documents.  Where the whole extended block
occurs twice, all its windows are repeats, and longer repeats are chains of such
blocks.  Where anchors agree but the extensions differ, the extension is followed
window by window, once for each different block.  Maximal repeats of at least
``length`` words are the unions of repeated windows; everything is counted by
aggregation, so a passage with many copies never forms pairs.  Blocks and
windows are counted under their anchor's hash and their own, 128 bits together:
64 would give false repeats among the 10^12 blocks of 100 TB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.scratch import materialize, release
from folioscope.llm.textvec import K3, U64, batches, grams, mix, words_of

BASE = U64(0xD1342543DE82EF95)
BASE_INVERSE = U64(pow(0xD1342543DE82EF95, -1, 1 << 64))


class RunHashes:
    """Hashes of arbitrary runs of words, from prefix sums."""

    def __init__(self, words: np.ndarray):
        power = np.full(len(words) + 1, BASE)
        power[0] = 1
        np.cumprod(power, out=power)
        self.back = np.full(len(words) + 1, BASE_INVERSE)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * power[:-1], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(np.uint64) * K3)


def rightmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the rightmost minimum of values[i : i + width]."""
    best, at, size = values, np.arange(len(values), dtype=np.int64), 1
    while size < width:
        step = min(size, width - size)
        right = best[step:]
        take = right <= best[: len(right)]
        best = np.where(take, right, best[: len(right)])
        at = np.where(take, at[step:], at[: len(take)])
        size += step
    return at


def blocks_of(hashes: np.ndarray, first: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, low, high, anchor hash): runs of window starts that choose the same anchor."""
    size = np.diff(first)
    none = np.zeros(0, np.int64)
    if len(hashes) < length:
        return none, none, none, np.zeros(0, np.uint64)
    seeds = grams(hashes, k)
    at = rightmost_minimum(seeds, length - k + 1)
    counts = np.maximum(size - length + 1, 0)
    text = np.repeat(np.arange(len(size)), counts)
    start = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + first[text]
    if not len(start):
        return none, none, none, np.zeros(0, np.uint64)
    chosen = at[start]
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(start)) - 1
    return text[low], start[low], start[high], seeds[chosen[low]]


KEY = ["doc_id", "th"]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): th tells rows apart that share a doc_id; a null doc_id is kept as null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")


def anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(anchor, block, doc_id, th, low, high) of every block of every text."""

    def find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, "text"):
            words = words_of(batch.column(2), lower=False)
            hashes = words.hashes()
            text, low, high, anchor = blocks_of(hashes, words.first, length, k)
            block = RunHashes(hashes).of(low, high + length)
            base = words.first[text]
            take = pa.array(text)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(block.view(np.int64)), batch.column(0).take(take), batch.column(1).take(take), pa.array((low - base).astype(np.int32)), pa.array((high - base).astype(np.int32))], names=["anchor", "block", "doc_id", "th", "low", "high"])

    return docs.mapInArrow(find, "anchor long, block long, doc_id long, th long, low int, high int")


def lists_of(column: pa.Array, *fields: str) -> tuple[np.ndarray, ...]:
    """(offsets, field values...) of a list<struct> column; null lists are empty."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return np.concatenate([[0], np.cumsum(size)]).astype(np.int64), *(flat.field(f).to_numpy(zero_copy_only=False) for f in fields)


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, value) of all integers in the ranges low..high."""
    size = high - low + 1
    which = np.repeat(np.arange(len(low)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]


def windows(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, window, weight, wanted, doc_id, th, start) of the blocks named in the column ``parts``."""

    def find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, "text"):
            words = words_of(batch.column(2), lower=False)
            runs = RunHashes(words.hashes())
            offsets, anchor, low, high, weight = lists_of(batch.column(3), "anchor", "low", "high", "weight")
            text = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            which, start = expand(low.astype(np.int64), high.astype(np.int64))
            begin = start + words.first[text[which]]
            take = pa.array(text[which])
            w = weight[which]
            yield pa.RecordBatch.from_arrays([pa.array(anchor[which].astype(np.int64)), pa.array(runs.of(begin, begin + length).view(np.int64)), pa.array(w.astype(np.int32)), pa.array(w == 1), batch.column(0).take(take), batch.column(1).take(take), pa.array(start.astype(np.int32))], names=["anchor", "window", "weight", "wanted", "doc_id", "th", "start"])

    return docs.mapInArrow(find, "anchor long, window long, weight int, wanted boolean, doc_id long, th long, start int")


def cut_out(docs: DataFrame, length: int, with_text: bool) -> DataFrame:
    """Remove the words under the windows in the column ``gone`` from each text."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, "text"):
            offsets, low, high = lists_of(batch.column(3), "low", "high")
            n_words, n_removed, shas, kept_texts = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                own = (text.as_py() or "").encode().split()
                n = len(own)
                a, b = offsets[row], offsets[row + 1]
                if b > a:
                    depth = np.zeros(n + 1, np.int64)
                    np.add.at(depth, low[a:b], 1)
                    np.add.at(depth, high[a:b] + length, -1)
                    stay = np.cumsum(depth[:n]) == 0
                    own = list(compress(own, stay.tolist()))
                n_words.append(n)
                n_removed.append(n - len(own))
                kept = b" ".join(own)
                shas.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    kept_texts.append(kept.decode())
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(shas, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array(kept_texts, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)


def repeated_windows(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(doc_id, th, gone): ranges of window starts that stand anywhere else too; ``docs`` from keyed()."""
    found = materialize(anchors(docs, length, k), "sub-anchors")
    shared = materialize(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("lo"), F.max("block").alias("hi")).where("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")), "sub-shared")
    seeds = materialize(found.join(shared, "anchor"), "sub-seeds")
    release(found, shared)
    counted = materialize(seeds.groupBy("anchor", "block").agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce("doc_id", F.lit(0))).alias("one")), "sub-blocks")
    whole = F.col("n") > 1
    follow = F.col("mixed") & (~whole | (F.coalesce("doc_id", F.lit(0)) == F.col("one")))
    extended = materialize(seeds.join(counted, ["anchor", "block"]).select(*KEY, "anchor", "low", "high", whole.alias("whole"), follow.alias("follow")).where("whole or follow"), "sub-extended")
    release(seeds, counted)
    # blocks whose extensions differ: window by window; a block that occurs twice weighs 2 and is settled
    part = F.struct("anchor", "low", "high", F.when(F.col("whole"), 2).otherwise(1).alias("weight"))
    # rows that share an id and a text name the same ranges: those are told once before they are gathered
    each = extended.where("follow").select(*KEY, part.alias("part")).distinct()
    parts = each.groupBy(*KEY).agg(F.collect_list("part").alias("parts"))
    near = materialize(windows(joined(docs, parts, "inner").select(*KEY, "text", "parts"), length), "sub-windows")
    twice = materialize(near.groupBy("anchor", "window").agg(F.sum("weight").alias("n"), F.max("wanted").alias("wanted")).where("n > 1 and wanted").select("anchor", "window"), "sub-twice")
    single = near.where("wanted").join(twice, ["anchor", "window"]).select(*KEY, F.col("start").alias("low"), F.col("start").alias("high"))
    ranges = extended.where("whole").select(*KEY, "low", "high").unionByName(single)
    return materialize(ranges.distinct().groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("gone")), "sub-gone")


def joined(docs: DataFrame, parts: DataFrame, how: str) -> DataFrame:
    """Join by the row key; null doc_ids meet null doc_ids."""
    other = parts.withColumnsRenamed({"doc_id": "_doc_id", "th": "_th"})
    return docs.join(other, (docs["th"] == other["_th"]) & docs["doc_id"].eqNullSafe(other["_doc_id"]), how).drop("_doc_id", "_th")


def remove_repeats(docs: DataFrame, length: int = 35, k: int = 8, with_text: bool = False) -> DataFrame:
    """Remove repeated passages from each row of ``docs(doc_id, text)``.

    A word goes if it lies in a window of ``length`` words whose word sequence
    also starts anywhere else, in the same text or another; all copies go.
    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by
    one space) and, with ``with_text``, kept_text.  A null text has no words.
    Texts shorter than ``length`` words keep all; repeated rows, with or without
    an id, lose all of a text of ``length`` words or more.  Very long texts are
    read whole, one batch each.
    """
    rows = keyed(docs)
    gone = repeated_windows(rows, length, k)
    return cut_out(joined(rows, gone, "left").select(*KEY, "text", "gone"), length, with_text)


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = """
with d as (select doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda x: x <> '') as w,
    row_number() over () as rid from documents),
p as (select rid, unnest(range(1, len(w) - 33)) as s, w from d where len(w) >= 35),
h as (select rid, s, sha256(array_to_string(w[s : s + 34], ' ')) as g from p),
r as (select rid, s from h where g in (select g from h group by g having count(*) > 1)),
c as (select distinct rid, unnest(range(s, s + 35)) as i from r),
n as (select rid, count(*) as n_removed, list(i) as gone from c group by rid)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
  sha256(array_to_string(case when gone is null then w else list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: not list_contains(gone, z[2])), lambda z: z[1]) end, ' ')) as kept_sha256
from d left join n using (rid)
"""

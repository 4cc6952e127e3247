"""Near duplicates by fast similarity sketching, banding and exact checks (op 5).

A document is the set of its distinct word shingles.  Its sketch has ``t``
coordinates.  In round i every element is hashed to one bin and a fraction; a
bin keeps its smallest ``i + fraction``.  Rounds go on until every coordinate is
filled; from round t on all elements go to bin ``i - t``, so 2t rounds always
suffice and large sets need one.  Two coordinates agree with the probability of
the Jaccard similarity, and concentrate like independent ones.

Coordinates are banded so that a pair at the threshold shares no band with a
probability below ``MISS``.  Documents with equal sets are one class; only one
of each class is banded.  Inside a bucket a few centres are compared exactly with
the members of other components; components are contracted after each round, a
bucket whose members are all in one component is finished, and a centre that has
met its whole bucket leaves it.  Members still in different components after
that are compared in blocks of bounded size: a task counts the common shingles
of two blocks at once and returns only links that join components.  So every
link between components is found, and pairs never become rows; but each block
meets every other of its bucket, so n such members make n * n / BLOCK rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.components import components
from folioscope.llm.scratch import materialize, materialize_in_batches
from folioscope.llm.textvec import K1, U64, batches, grams, mix, words_of

ROWS = 5  # coordinates in a band
MISS = 1e-9
CENTRES = (1, 3)  # centres of a bucket in the rounds before what is left is compared in blocks
BLOCK = 256  # members of a bucket in one block
SHINGLES = 1_000_000  # and their shingles, but for a longer text, which is alone
UNPACKED = 4_000_000  # bytes of text turned into sets at once
ROW = ["doc_id", "th", "tk"]


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands of ``rows`` coordinates that miss a pair at the threshold with probability ``miss``."""
    share = (percent / 100) ** rows
    return 1 if share >= 1 else math.ceil(math.log(miss) / math.log(1 - share))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingle hashes of each text, A-Z lower-cased.

    A text with fewer words is one shingle; a text without words has none."""
    words = words_of(texts, lower=True)
    hashes = words.hashes()
    all_grams = grams(hashes, k)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        n = b - a
        own = np.sort(all_grams[a : b - k + 1]) if n >= k else grams(hashes[a:b], n) if n else np.zeros(0, np.uint64)
        if len(own) > 1:
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        out.append(own)
    return out


def fast_similarity_sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """[sets, t] coordinates; a set without elements keeps the largest value everywhere."""
    size = np.array([len(s) for s in sets], np.int64)
    table = np.full((len(sets), t), np.iinfo(np.uint64).max, np.uint64)
    if not size.sum():
        return table
    items, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    flat, empty = table.ravel(), np.iinfo(np.uint64).max
    for i in range(2 * t):
        h = mix(items ^ U64(int(K1) * (i + 1) % (1 << 64)))
        bin_ = (h >> U64(32)) * U64(t) >> U64(32) if i < t else np.full(len(h), i - t, np.uint64)
        np.minimum.at(flat, owner * t + bin_.astype(np.int64), (h & U64(0xFFFFFFFF)) | U64(i << 32))
        open_ = (table == empty).any(axis=1)
        go_on = open_[owner]
        if not go_on.any():
            break
        items, owner = items[go_on], owner[go_on]
    return table


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """[sets, bands] of 64-bit keys."""
    shaped = table.reshape(len(table), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * K1, shaped.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * K1 + shaped[:, :, r])
    return key.view(np.int64)


def rows_of(docs: DataFrame, tie: Column | None = None) -> DataFrame:
    """(doc_id, th, tk, tie, text): the id and 128 bits of the text name a row; ``tie`` tells others apart."""
    text = F.col("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.xxhash64(F.lit(1), text).alias("tk"), (F.lit(0) if tie is None else tie).cast("long").alias("tie"), text.alias("text"))


def sketches(rows: DataFrame, k: int, bands: int, height: int) -> DataFrame:
    """(doc_id, th, tk, tie, n_shingles, set_a, set_b, bands) of rows_of(); set_a and set_b name the set."""

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, "text", 2_000_000):
            sets = shingle_sets(batch.column(4), k)
            keys = band_keys(fast_similarity_sketch(sets, bands * height), bands, height)
            size = np.array([len(s) for s in sets], np.int64)
            with np.errstate(over="ignore"):
                a = np.array([mix(s ^ K1).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                b = np.array([mix(s + K1).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands), pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(4)), pa.array(size), pa.array(a), pa.array(b), lists], names=[*ROW, "tie", "n_shingles", "set_a", "set_b", "bands"])

    return rows.mapInArrow(sketch, "doc_id long, th long, tk long, tie long, n_shingles long, set_a long, set_b long, bands array<long>")


def unpacked_sets(packed: list[bytes], k: int) -> list[np.ndarray]:
    """The shingle sets of packed texts; about ``UNPACKED`` bytes of text are open at once."""
    unpack, out, begin = zstandard.ZstdDecompressor(), [], 0
    size = [zstandard.get_frame_parameters(x).content_size for x in packed]
    while begin < len(packed):
        stop, total = begin, 0
        while stop < len(packed) and (stop == begin or total + size[stop] <= UNPACKED):
            total += size[stop]
            stop += 1
        out += shingle_sets(pa.array([unpack.decompress(x) for x in packed[begin:stop]], pa.binary()), k)
        begin = stop
    return out


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose whole sets reach the threshold; ``texts(rep, packed)``."""

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            size = [sum(zstandard.get_frame_parameters(x).content_size for x in pair) for pair in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            at = 0
            while at < batch.num_rows:  # up to 256 pairs, or fewer where their texts are long
                stop, total = at, 0
                while stop < min(at + 256, batch.num_rows) and (stop == at or total + size[stop] <= 4 * UNPACKED):
                    total += size[stop]
                    stop += 1
                part = batch.slice(at, stop - at)
                packed: dict[bytes, int] = {}
                which = [[packed.setdefault(x, len(packed)) for x in part.column(c).to_pylist()] for c in (2, 3)]
                sets = unpacked_sets(list(packed), k)
                keep = []
                for x, y in zip(*which, strict=True):
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
                at = stop

    one, two = texts.select(F.col("rep").alias("a"), F.col("packed").alias("pa")), texts.select(F.col("rep").alias("b"), F.col("packed").alias("pb"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "pa", "pb").mapInArrow(check, "a long, b long")


def packed_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, packed), one text for each row of ``wanted(rep, doc_id, th, tk)``."""

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches(it, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([press.compress((t or "").encode()) for t in batch.column(1).to_pylist()], pa.binary())], names=["rep", "packed"])

    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["th"] == wanted["th"]) & (rows["tk"] == wanted["tk"])
    return rows.join(wanted, same).select("rep", "text").mapInArrow(pack, "rep long, packed binary").dropDuplicates(["rep"])


def merged(links: DataFrame, known: DataFrame | None) -> DataFrame:
    return links if known is None else links.union(known.select(F.col("node").alias("a"), F.col("component").alias("b")))


def block_links(sets: list[np.ndarray], component: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of rows in different components that are linked, as a forest."""
    names, count = np.unique(component, return_counts=True)
    outer = np.flatnonzero(component != names[count.argmax()])  # two members of the largest need no check
    if not len(outer):
        return []
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = seen[column] > 1
    owner, column = owner[common], (np.cumsum(seen > 1) - 1)[column[common]]
    both = np.zeros((len(outer), len(sets)), np.int64)
    for low in range(0, int(column.max(initial=-1)) + 1, 8192):
        own = (column >= low) & (column < low + 8192)
        x = np.zeros((len(sets), 8192), np.float32)
        x[owner[own], column[own] - low] = 1
        both += np.rint(x[outer] @ x.T).astype(np.int64)
    linked = (100 * both >= percent * (size[outer][:, None] + size[None, :] - both)) & (both > 0)
    linked &= component[outer][:, None] != component[None, :]
    root = {c: c for c in names.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = find(int(component[outer[i]])), find(int(component[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(outer[i]), int(j)))
    return out


def compared_in_blocks(at: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between different components of ``at(key, rep, component)``, bucket by bucket.

    A bucket is dealt into blocks of about ``BLOCK`` members and ``SHINGLES``
    shingles at most, and every two blocks meet in one group."""
    members, shingles = F.count(F.lit(1)) / BLOCK, F.sum("n") / SHINGLES
    blocks = at.groupBy("key").agg(F.ceil(F.greatest(members, shingles)).cast("int").alias("blocks"))
    own = at.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    own = own.join(texts, "rep").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = own.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "rep", "component", "packed")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        sets, rep = unpacked_sets(pdf["packed"].tolist(), k), pdf["rep"].to_numpy()
        found = block_links(sets, pdf["component"].to_numpy(), percent)
        return pd.DataFrame({"a": [rep[i] for i, _ in found], "b": [rep[j] for _, j in found]}, dtype="int64")

    return met.groupBy("key", "lo", "hi").applyInPandas(compare, "a long, b long")


def link_classes(reps: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame | None:
    """(node, component) of the linked classes of ``reps(rep, n, bands, lead)``; None where there are none."""
    banded = reps.select(F.explode("bands").alias("key"), "rep", "n")
    shared = banded.groupBy("key").count().where("count > 1").select("key")
    rest = materialize(banded.join(shared, "key"), "near-buckets")
    wanted = reps.join(rest.select("rep").distinct(), "rep").select("rep", "lead.doc_id", "lead.th", "lead.tk")
    texts = materialize_in_batches(packed_texts(rows, wanted), "near-texts")
    known, tried = None, None
    for take in (*CENTRES, None):
        if known is None:
            at = rest.withColumn("component", F.col("rep"))
        else:
            at = rest.join(known.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("component"))
            at = materialize(at, "near-at")
        mixed = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
        at = materialize(at.join(mixed, "key"), "near-mixed")
        if at.isEmpty():
            return known
        if take is None:
            links = materialize_in_batches(compared_in_blocks(at, texts, k, percent), "near-links")
            return known if links.isEmpty() else components(merged(links, known), "near")
        order = [F.xxhash64("rep"), F.col("rep")]
        centres = at.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("place") <= take)
        centres = materialize(centres.select("key", F.col("rep").alias("centre"), F.col("n").alias("centre_n"), F.col("component").alias("centre_component")), "near-centres")
        fits = 100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n")
        met = centres.join(at, "key").where((F.col("component") != F.col("centre_component")) & fits)
        pairs = met.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "near-pairs")
        links = materialize_in_batches(verified(pairs, texts, k, percent), "near-links")
        if not links.isEmpty():
            known = components(merged(links, known), "near")
        tried = pairs if tried is None else tried.union(pairs)
        left = at.join(centres.select("key", F.col("centre").alias("rep")), ["key", "rep"], "left_anti").select("key", "rep", "n")
        rest = materialize(left, "near-rest")
    return known


def linked_rows(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """rows_of() without their texts, with n_shingles, n_equal and ``lead``: the first row that each is linked with.

    Rows with equal sets are a class; classes are numbered, so that rows that
    share a doc_id, or have none, are told apart.  A row without shingles is its
    own lead.  The first row is that of smallest doc_id; rows without one come last."""
    bands = bands_for(percent)
    sketched = materialize_in_batches(sketches(rows, k, bands, ROWS), "near-sketches")
    real = sketched.where("n_shingles > 0")
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), *ROW, "tie")
    classes = real.groupBy("set_a", "set_b").agg(F.min(name).alias("lead"), F.first("bands").alias("bands"), F.min("n_shingles").alias("n"), F.count(F.lit(1)).alias("n_equal"))
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "near-classes")  # written once: the numbers stay
    known = link_classes(classes.select("rep", "n", "bands", "lead"), rows, k, percent)
    named = classes.select("set_a", "set_b", "rep", "n_equal", "lead")
    if known is not None:
        members = known.select(F.col("node").alias("rep"), "component").union(known.select("component", "component").distinct())
        members = materialize(members.join(classes.select("rep", "lead"), "rep"), "near-members")
        first = members.groupBy("component").agg(F.min("lead").alias("first"))
        named = named.join(members.join(first, "component").select("rep", "first"), "rep", "left").withColumn("lead", F.coalesce("first", "lead"))
    named = materialize(named.select("set_a", "set_b", "n_equal", "lead"), "near-named")
    linked = real.select(*ROW, "tie", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"]).select(*ROW, "tie", "n_shingles", "n_equal", "lead")
    alone = sketched.where("n_shingles = 0").select(*ROW, "tie", "n_shingles", F.lit(1).cast("long").alias("n_equal"), name.alias("lead"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)`` with its class of linked documents.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable),
    kept (doc_id = component_id) and n_equal (rows with the same set).
    Texts without words, and null texts, have an empty set and are linked with
    nothing.  Rows that share a doc_id are documents of their own.  A row
    without a doc_id is linked like any other; its component is null where no
    linked row has an id, and then it is kept if its text is the first one's.
    Very long texts are compared whole.
    """
    found = linked_rows(rows_of(docs), k, percent)
    own = F.col("doc_id").isNull() & F.col("lead.no_id") & (F.col("th") == F.col("lead.th")) & (F.col("tk") == F.col("lead.tk"))
    return found.select("doc_id", "n_shingles", F.col("lead.doc_id").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("lead.doc_id"), own).alias("kept"), "n_equal")


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged: of each group of linked rows the first one.

    The first row is that of smallest doc_id.  Rows with different texts that
    share a doc_id, or have none, go only where they are linked with the kept
    one; of rows that are equal throughout, one stays.  Rows without words all
    stay, as nothing is linked with them."""
    tie = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    found = linked_rows(rows_of(docs, tie), k, percent)
    is_first = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("th") == F.col("lead.th")) & (F.col("tk") == F.col("lead.tk")) & (F.col("tie") == F.col("lead.tie"))
    judged = materialize(found.select(*ROW, "tie", ((F.col("n_shingles") == 0) | is_first).alias("stay"), (F.col("n_shingles") > 0).alias("real")), "near-judged")
    names = {c: f"_near_{c}" for c in (*ROW, "tie")}

    def same(left: DataFrame, right: DataFrame) -> Column:
        i, text = left["doc_id"].cast("long"), left["text"]
        return i.eqNullSafe(right["_near_doc_id"]) & (F.xxhash64(text) == right["_near_th"]) & (F.xxhash64(F.lit(1), text) == right["_near_tk"]) & (F.xxhash64(*(left[f"`{c}`"] for c in left.columns)) == right["_near_tie"])

    gone = judged.where("not stay").select(*ROW, "tie").distinct().withColumnsRenamed(names)
    stay = docs.join(gone, same(docs, gone), "left_anti")
    twice = judged.where("stay and real").groupBy(*ROW, "tie").count().where("count > 1").select(*ROW, "tie").withColumnsRenamed(names)
    twice = materialize(twice, "near-twice")
    if twice.isEmpty():
        return stay
    return stay.join(twice, same(stay, twice), "left_anti").unionByName(stay.join(twice, same(stay, twice), "left_semi").dropDuplicates())


def op5_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 85)


ORACLE_SQL = """
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end) as g from w),
n as (select doc_id, count(*) as n, md5(string_agg(g, '|' order by g)) as k from s group by 1),
e as (select k, count(*) as n_equal from n group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as i from s a join s b using (g) where a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 85 * (x.n + y.n - i)),
edges as (select a, b from l union all select b, a from l),
r(x, y) as (select doc_id, doc_id from documents union select r.x, edges.b from r join edges on edges.a = r.y),
c as (select x as doc_id, min(y) as component_id from r group by 1)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept, coalesce(n_equal, 1)::bigint as n_equal
from documents d join c using (doc_id) left join n using (doc_id) left join e using (k)
"""

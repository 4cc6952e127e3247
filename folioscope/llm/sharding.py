"""Sharding by minimax contiguous partition (op 10, native).

Equal texts form atomic groups, ordered by their first doc_id.  The smallest
shard capacity for which a greedy left-to-right fill needs at most ``shards``
shards is found by binary search, and the cuts are placed by that fill.  A group
larger than the capacity has a shard of its own: the largest shard is no larger
for it (some shard must hold that group), and the rest is dealt evenly over the
other shards instead of being packed up to the size of the largest group.

The driver never sees the groups.  It searches over at most a few thousand
*blocks*: key ranges with their total bytes.  A capacity is checked twice, once
as if blocks could be split anywhere and once as if they could not be split;
the optimum lies between the two answers, so the cuts lie in narrow windows.
One aggregation job splits the blocks in those windows again, until only single
groups are left there.  The search is then exact.  The largest groups, one more
than there are shards, are blocks of their own from the start.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.numbering import buckets_for, numbered
from folioscope.llm.scratch import materialize

BLOCKS = 4096


class Blocks:
    """Consecutive key ranges: (low key, high key, bytes)."""

    def __init__(self, items: list[tuple[int, int, int]]):
        self.items = items
        self.ends = list(accumulate(b for _, _, b in items))
        self.total = self.ends[-1] if items else 0

    def atomic(self, i: int) -> bool:
        return self.items[i][0] == self.items[i][1]

    def cuts(self, cap: int, shards: int, whole: bool) -> list[int]:
        """Greedy shard ends as byte positions; ``whole``: no block is split."""
        pos, out = 0, []
        for _ in range(shards):
            reach = pos + cap
            i = bisect_right(self.ends, reach)
            floor = self.ends[i - 1] if i else 0
            if i < len(self.ends) and not whole and not self.atomic(i):
                pos = max(pos, reach)
            elif floor <= pos and i < len(self.ends) and self.atomic(i):
                pos = self.ends[i]  # a group larger than the capacity stands alone
            else:
                pos = max(pos, floor)
            out.append(pos)
        return out

    def smallest(self, shards: int, least: int, whole: bool) -> int:
        lo, hi = max(least, 1), max(self.total, least)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.cuts(mid, shards, whole)[-1] >= self.total:
                hi = mid
            else:
                lo = mid + 1
        return lo


def _split(groups: DataFrame, windows: list[tuple[int, int]], blocks: int) -> list[tuple[int, int, int]]:
    """Totals of equal-width key ranges inside each of the given key ranges (ascending, apart)."""
    each = max(2, blocks // len(windows))
    longs = lambda items: F.array(*(F.lit(x).cast("decimal(38,0)") for x in items))
    rows = groups.select("key", "bytes", F.size(F.filter(longs(lo for lo, _ in windows), lambda x: x <= F.col("key"))).alias("nth")).where("nth > 0")
    own = lambda items: F.element_at(longs(items), F.col("nth"))
    offset = F.col("key").cast("decimal(38,0)") - own([lo for lo, _ in windows])
    part = F.floor(offset / own([max(1, -(-(hi - lo + 1) // each)) for lo, hi in windows])) + F.col("nth") * (each + 2)
    groups = rows.where(F.col("key") <= own([hi for _, hi in windows])).withColumn("part", part)
    found = groups.groupBy("part").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("bytes").alias("bytes"))
    return sorted((r["lo"], r["hi"], r["bytes"]) for r in found.collect())  # at most `blocks` rows and one for each window


def minimax_cuts(groups: DataFrame, shards: int, blocks: int = BLOCKS) -> tuple[int, list[int]]:
    """(bytes of the largest shard allowed, first key of each shard after the first) over ``groups(key, bytes)``.

    Groups with the same key count as one.  An empty table gives (0, [])."""
    whole = groups.groupBy("key").agg(F.sum("bytes").alias("bytes"))
    ends = whole.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("bytes").alias("bytes")).first()
    if ends["bytes"] is None:
        return 0, []
    largest = whole.orderBy(F.desc("bytes"), "key").limit(shards + 1).collect()
    alone = sorted((r["key"], r["bytes"]) for r in largest)
    # at most one group a shard can be above the capacity, so that the next one is a lower bound
    least = largest[-1]["bytes"] if len(largest) > shards else 1
    known, at, gaps = Blocks([(k, k, b) for k, b in alone]), ends["lo"], []
    for k, _ in alone:
        if at < k:
            gaps.append((at, k - 1))
        at = k + 1
    if at <= ends["hi"]:
        gaps.append((at, ends["hi"]))
    if gaps:
        known = Blocks(sorted(known.items + _split(groups, gaps, blocks)))
    while True:
        low, high = known.smallest(shards, least, False), known.smallest(shards, least, True)
        first, last = known.cuts(low, shards, True), known.cuts(high, shards, False)
        touched = set()
        for a, b in zip(first, last, strict=True):
            i = bisect_right(known.ends, a)
            while i < len(known.items) and (known.ends[i - 1] if i else 0) < b:
                if not known.atomic(i):
                    touched.add(i)
                i += 1
        if not touched:
            at = known.cuts(low, shards, False)
            keys = [known.items[bisect_right(known.ends, p)][0] for p in at[:-1] if p < known.total]
            return max(low, largest[0]["bytes"]), keys
        # every touched block is split on its own, so that each round makes all of them smaller
        finer = _split(groups, [known.items[i][:2] for i in sorted(touched)], blocks)
        known = Blocks(sorted([x for i, x in enumerate(known.items) if i not in touched] + finer))


def shard_documents(docs: DataFrame, shards: int = 16, blocks: int = BLOCKS) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with its shard under the law ``bytes``.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard, capacity.
    A null text counts as the empty text (size 1).  Equal texts, repeated rows
    and null ids included, share a shard; groups that share their first doc_id
    are kept together.  Other columns of ``docs`` are ignored.  capacity is the
    bytes of the largest shard allowed; a very long text is a group like others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest")), "shard-rows")
    groups = materialize(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes")).select("digest", F.coalesce("first", F.xxhash64("digest")).alias("key"), "bytes"), "shard-groups")
    capacity, cuts = minimax_cuts(groups, shards, blocks)
    shard = sum(((F.col("key") >= F.lit(k)).cast("int") for k in cuts), F.lit(0)).cast("int")
    placed = rows.join(groups.select("digest", "key"), "digest").select("doc_id", "size", "text_crc32", "digest", shard.alias("shard"))
    # the text is part of the key: rows that share an id, or have none, are spread like any others
    dealt = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lower(F.hex("digest")))), 1, 8), 16, 10).cast("long")
    bucket = (dealt % F.lit(buckets_for(rows.count()))).cast("int")
    out = numbered(placed, ["shard"], bucket, [F.col("doc_id"), F.col("digest")], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.lit(capacity).cast("long").alias("capacity"))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), 16)


#: Checksums bit by bit; the smallest capacity by bisection over the list of all groups, filled one shard a step.
ORACLE_SQL = """
with recursive bits(i, k, v) as (select i, 0, i from range(256) r(i) union all select i, k + 1, case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
steps as (select list(v order by i) as step from bits where k = 8),
r as (select doc_id, strlen(coalesce(text, ''))::bigint + 1 as size, sha256(coalesce(text, '')) as digest,
  xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda x: ('0x' || x)::bigint)), lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295)::bigint as text_crc32
  from documents, steps),
g as (select digest, min(doc_id) as key, sum(size)::bigint as bytes from r group by 1),
k as (select key, sum(bytes)::bigint as bytes from g group by 1),
p as (select key, bytes, sum(bytes) over (order by key)::bigint as upto from k),
ends as (select list(upto order by upto) as ends, max(upto) as total, max(bytes) as most from p),
tries(lo, hi, pos, n) as (
  select 1::bigint, total, 0::bigint, 0 from ends
  union all
  select case when new < total and n + 1 = 16 then cap + 1 else lo end, case when new = total then cap else hi end, case when new = total or n + 1 = 16 then 0 else new end, case when new = total or n + 1 = 16 then 0 else n + 1 end
  from (select *, coalesce(list_max(list_filter(ends, lambda x: x > pos and x <= pos + cap)), list_min(list_filter(ends, lambda x: x > pos)))::bigint as new
    from (select *, (lo + hi) // 2 as cap from tries where lo < hi), ends)),
best as (select max(lo) as cap from tries where lo = hi),
cuts(pos, n) as (
  select 0::bigint, 0 union all
  select coalesce(list_max(list_filter(ends, lambda x: x > pos and x <= pos + cap)), list_min(list_filter(ends, lambda x: x > pos)))::bigint, n + 1 from cuts, ends, best where pos < total),
placed as (select key, (select count(*) - 1 from cuts where pos <= upto - bytes)::int as shard from p),
rows as (select r.*, shard, ('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':' || digest), 1, 8))::bigint % (select greatest(1, (count(*) + 49999) // 50000) from r) as bucket from r join g using (digest) join placed using (key))
select doc_id, size, text_crc32, 'bytes' as law, shard, (row_number() over (partition by shard order by bucket, doc_id, digest) - 1)::bigint as slot, null::int as grown_shard, (select greatest(cap, most) from best, ends)::bigint as capacity
from rows
"""

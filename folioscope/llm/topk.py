"""Exact top-k search over binary codes by incremental multi-index hashing (op 1).

A code is cut into 16-bit segments, each with its own index.  A query looks up,
segment by segment, the codes that differ from it in 0, 1, 2, ... bits of that
segment.  After radius s in the first j + 1 of m segments and s - 1 in the rest,
every code within Hamming distance m * s + j has been met (pigeonhole), so a query is
done once the distance of its kth verified code is that small.

Equal codes are searched once.  Distinct codes are dealt into blocks of bounded
size; a task holds the index of one block and a run of distinct query codes, and
the best of all blocks are merged.  No task or driver holds all codes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioscope.llm.scratch import materialize

BITS = 16
MASKS = [np.array([sum(1 << b for b in c) for c in combinations(range(BITS), r)], np.uint16) for r in range(BITS + 1)]
HITS = 1 << 20  # places gathered at once by one look-up, or those of a single query
POP = np.array([bin(x).count("1") for x in range(1 << BITS)], np.uint8)


class SegmentIndex:
    """Codes of one block, with one sorted index for each segment."""

    def __init__(self, codes: np.ndarray):  # [n, segments] of uint16
        self.codes, self.segments = codes, codes.shape[1]
        self.order = [np.argsort(codes[:, j], kind="stable").astype(np.int32) for j in range(self.segments)]
        self.begin = [np.concatenate([[0], np.cumsum(np.bincount(codes[:, j], minlength=1 << BITS))]) for j in range(self.segments)]

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, code row, distance) of the k nearest codes; of codes at one distance the first ones.

        Where a look-up would gather more than ``HITS`` places, the queries are
        halved and searched one half after the other, so that memory is bounded
        by the codes of the block even where a segment is equal in all of them."""
        n, m = len(self.codes), self.segments
        k = min(k, n)
        met_q, met_c, met_d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        active = np.arange(len(queries))
        for radius in range(BITS + 1):
            for j in range(m):
                if not len(active):
                    return met_q, met_c, met_d
                values = queries[active, j][:, None] ^ MASKS[radius][None, :]
                first = self.begin[j][values].ravel()
                size = self.begin[j][values.astype(np.int64) + 1].ravel() - first
                if size.sum() > HITS and len(queries) > 1:
                    half = len(queries) // 2
                    one, two = self.search(queries[:half], k), self.search(queries[half:], k)
                    return np.concatenate([one[0], two[0] + half]), np.concatenate([one[1], two[1]]), np.concatenate([one[2], two[2]])
                who = np.repeat(np.repeat(active, values.shape[1]), size)
                place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
                code = self.order[j][place].astype(np.int64)
                if len(code):
                    # a code is new only if no earlier look-up has met it
                    other = POP[self.codes[code] ^ queries[who]]
                    fresh = np.ones(len(code), bool)
                    for i in range(m):
                        looked_up = radius if i < j else radius - 1
                        if i != j and looked_up >= 0:
                            fresh &= other[:, i] > looked_up
                    met_q = np.concatenate([met_q, who[fresh]])
                    met_c = np.concatenate([met_c, code[fresh]])
                    met_d = np.concatenate([met_d, other[fresh].sum(1, dtype=np.int64)])
                    # what cannot be among the k nearest is dropped
                    met_q, met_c, met_d = nearest(met_q, met_c, met_d, k)
                covered = m * radius + j
                near = np.bincount(met_q[met_d <= covered], minlength=len(queries))
                active = active[near[active] < k]
        return met_q, met_c, met_d


def nearest(q: np.ndarray, c: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k smallest distances of each query; of equal ones those of the first codes."""
    if not len(q):
        return q, c, d
    order = np.lexsort((c, d, q))
    q, c, d = q[order], c[order], d[order]
    begin = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    keep = np.arange(len(q)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(q)]]))) < k
    return q[keep], c[keep], d[keep]


def sign_codes(vectors: DataFrame, words: int | None = None) -> DataFrame:
    """(id, code) of ``vectors(id, embedding)``: bit i is set where component i is above 0.

    ``code`` is binary with ``words`` times eight bytes, by default enough for
    the longest vector; a longer vector than ``words`` allows is an error,
    missing components are 0.  Null vectors and null ids are left out."""
    if words is None:
        words = max(1, -(-(vectors.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0) // 64))
    width = words * 64

    def code(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            lists = batch.column(1)
            values = np.nan_to_num(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), nan=0.0)
            size = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
            bits = np.zeros((len(lists), width), bool)
            row = np.repeat(np.arange(len(lists)), size)
            col = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
            if len(size) and size.max() > width:
                raise ValueError(f"a vector of {size.max()} components does not fit {width} bits")
            bits[row, col] = values > 0
            packed = np.packbits(bits, axis=1, bitorder="little")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p.tobytes() for p in packed], pa.binary())], names=["id", "code"])

    return vectors.where("id is not null and embedding is not null").select(F.col("id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(code, "id long, code binary")


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, block: int = 1 << 18, run: int = 1 << 16) -> DataFrame:
    """The k nearest rows of ``codes(id, code)`` for each row of ``queries(id, code)``.

    Returns query_id, neighbor_id, distance, rank (from 1).  A query does not
    return a row with its own id; ties go to the smaller id; ids are taken as
    unique, and rows that repeat an id with the same code count once.  With
    fewer than k other rows all are returned.  Empty tables give no rows.

    At most about ``block`` distinct codes and ``run`` distinct queries meet in
    a task; queries are dealt finer while there are fewer tasks than shuffle
    partitions.
    """
    spark = codes.sparkSession
    ids = materialize(codes.distinct(), "topk-codes")
    # of equal codes, k + 1 ids are enough for any query
    first = ids.withColumn("rank", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("rank") <= k + 1)
    distinct = materialize(first.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "topk-distinct")
    asked = materialize(queries.distinct(), "topk-queries")
    blocks = max(1, -(-distinct.count() // block))
    n_asked = asked.select("code").distinct().count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = max(1, -(-n_asked // run), min(tasks // blocks, -(-n_asked // 64)))
    left = distinct.select("code", F.col("ids")[0].alias("lead"), F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int").alias("block")).withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))
    right = asked.select("code").distinct().select("code", F.pmod(F.xxhash64("code", F.lit(1)), F.lit(runs)).cast("int").alias("run")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(codes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(codes) or not len(queries):
            return pd.DataFrame({"query": pd.Series([], dtype=object), "code": pd.Series([], dtype=object), "distance": pd.Series([], dtype=np.int64)})
        codes = codes.sort_values("lead", kind="stable")  # so that of codes at the same distance those with the smallest ids come first
        index = SegmentIndex(np.frombuffer(b"".join(codes["code"]), np.uint16).reshape(len(codes), -1))
        sought = np.frombuffer(b"".join(queries["code"]), np.uint16).reshape(len(queries), -1)
        parts = []
        for at in range(0, len(sought), 256):
            q, c, d = index.search(sought[at : at + 256], k + 1)
            parts.append((q + at, c, d))
        q, c, d = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pd.DataFrame({"query": queries["code"].to_numpy()[q], "code": codes["code"].to_numpy()[c], "distance": d})

    met = left.groupBy("block", "run").cogroup(right.groupBy("block", "run")).applyInPandas(search, "query binary, code binary, distance long")
    met = materialize(met, "topk-met")
    best = met.join(distinct, "code").withColumn("id", F.explode("ids")).withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))).where(F.col("rank") <= k + 1).select("query", "id", "distance")
    best = materialize(best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("distance", "id"))).alias("best")), "topk-best")
    named = asked.withColumnRenamed("code", "query").join(best, "query")
    others = F.expr(f"slice(filter(best, b -> b.id <> id), 1, {k})")
    out = named.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "b"))
    return out.select("query_id", F.col("b.id").alias("neighbor_id"), F.col("b.distance").cast("long").alias("distance"), (F.col("at") + 1).cast("long").alias("rank"))


def op1_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    codes = materialize(sign_codes(vectors), "topk-signs")
    return top_k(codes, codes.where("id % 20 = 0"), k=10)


ORACLE_SQL = """
with c as (select distinct vec_id as id, list_transform(embedding, lambda x: (x > 0)::int) as bits from embeddings where embedding is not null and vec_id is not null),
p as (select a.id as query_id, b.id as neighbor_id, list_sum(list_transform(list_zip(a.bits, b.bits), lambda z: (z[1] <> z[2])::int))::bigint as distance
  from c a join c b on a.id <> b.id where a.id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by distance, neighbor_id) as rank from p)
select query_id, neighbor_id, distance, rank::bigint as rank from r where rank <= 10
"""

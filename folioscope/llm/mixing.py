"""Mixing sources to target weights by temperature (op 7, native).

Token shares p of the sources are raised to an exponent a in [0, 1] and
normalised.  The exponent is bisected until the mixture meets a target entropy
or a limit on how often the least represented source is repeated.  The weights
are then realised as permutations of each source: whole passes ("blocks") and a
last pass that stops where the token budget of the source is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioscope.llm.numbering import buckets_for, numbered
from folioscope.llm.scratch import materialize

STEPS = 5  # bisection steps that one aggregation evaluates together
FANOUT = 1 << STEPS


def token_count(text):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _sums(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(sum p^a, sum p^a log p) for each exponent, in one aggregation."""
    p = F.col("share")
    row = sources.agg(*(F.sum(F.pow(p, F.lit(a))).alias(f"z{i}") for i, a in enumerate(exponents)), *(F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"l{i}") for i, a in enumerate(exponents))).first()
    return [(row[f"z{i}"], row[f"l{i}"]) for i in range(len(exponents))]


def fit_exponent(sources: DataFrame, target_entropy: float | None = None, max_repeat: float | None = None) -> float:
    """Bisect the exponent over ``sources(share)``, to six decimals.

    ``target_entropy`` (nats): the largest exponent whose mixture reaches it, 0
    where none does.  ``max_repeat``: the smallest exponent for which no source
    is passed more than that many times as often as the largest one.  With both,
    the larger exponent holds.  One source, or none: 1.
    """
    ends = sources.agg(F.min("share").alias("least"), F.max("share").alias("most")).first()
    if ends["least"] is None or ends["least"] == ends["most"]:
        return 1.0
    answer = 0.0

    def bisect(good) -> float:
        """The end of [0, 1] side where ``good`` turns; good holds at exponents above it."""
        lo, hi = 0.0, 1.0
        while hi - lo > 1e-8:
            grid = [lo + (hi - lo) * i / FANOUT for i in range(1, FANOUT)]
            said = good(grid)
            for a, ok in zip(grid, said, strict=True):
                if ok:
                    hi = a
                    break
                lo = a
        return hi

    if max_repeat is not None:
        spread = math.log(ends["most"] / ends["least"])
        if spread > math.log(max_repeat):
            answer = bisect(lambda grid: [(1 - a) * spread <= math.log(max_repeat) for a in grid])
    if target_entropy is not None:
        over = bisect(lambda grid: [math.log(z) - a * s / z < target_entropy for a, (z, s) in zip(grid, _sums(sources, grid), strict=True)])
        answer = max(answer, over)
    return math.ceil(answer * 1e6) / 1e6  # upwards, so that the limit holds


def mixing_schedule(docs: DataFrame, max_repeat: float | None = 4.0, target_entropy: float | None = None, budget: int | None = None, seed: int = 0, columns: list[str] | None = None) -> DataFrame:
    """One row for each time a document is taken.

    ``docs(doc_id, text, source)``.  Without ``budget`` the largest source is
    passed exactly once, so that no document is lost; with it, ``budget`` tokens
    are shared out by weight.  Returns doc_id, source, n_tokens, pass (from 0),
    position (gapless in source and pass), weight and exponent.  ``columns``
    adds columns of ``docs`` under their own names.

    A null source is a source of its own; a text without words counts one token,
    so that it has a place in the permutation.  Repeated rows are each placed, in
    an order that rerun tasks find again; rows equal in id, text and ``columns``
    are interchangeable.  A very long text is one row of many tokens.
    """
    spark = docs.sparkSession
    extra = columns or []
    tokens = F.greatest(token_count(F.col("text")), F.lit(1)).cast("long")
    # the text is part of the key: rows that share an id, or have none, are spread like any others
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))
    rank = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")  # 60 bits
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))  # joins like plain keys, null included
    rows = docs.select(F.col("doc_id").alias("_id"), name.alias("_source"), tokens.alias("_tokens"), rank.alias("_rank"), F.struct(*(F.col(c) for c in extra)).alias("_extra") if extra else F.lit(None).cast("string").alias("_extra"))
    narrow = materialize(rows.drop("_extra"), "mix-rows")
    sums = narrow.groupBy("_source").agg(F.sum("_tokens").alias("total"), F.count(F.lit(1)).alias("n"))
    all_tokens = sums.agg(F.sum("total").alias("t"), F.max("total").alias("most"), F.sum("n").alias("n")).first()
    total, most, n = all_tokens["t"] or 1, all_tokens["most"] or 1, all_tokens["n"] or 0
    sources = materialize(sums.withColumn("share", F.col("total") / F.lit(float(total))), "mix-sources")
    a = fit_exponent(sources, target_entropy, max_repeat)
    z = sources.agg(F.sum(F.pow("share", F.lit(a))).alias("z")).first()["z"] or 1.0
    weight = F.pow("share", F.lit(a)) / F.lit(z)
    if budget is None:
        quota = F.greatest(F.col("total"), F.floor(F.col("total") * F.pow(F.lit(float(most)) / F.col("total"), F.lit(1 - a)) + F.lit(1e-6)))
    else:
        quota = F.round(weight * F.lit(float(budget)))
    quota = quota.cast("long")
    plan = sources.select("_source", F.round(weight, 9).alias("weight"), F.expr("total").alias("_total"), quota.alias("_quota")).withColumn("_whole", F.expr("_quota div _total")).withColumn("_rest", F.expr("_quota % _total"))

    # where in the permutation the last, partial pass of each source stops
    slices = max(64, buckets_for(n, 10_000))
    slice_of = F.expr(f"cast(_rank div {-(-(1 << 60) // slices)} as int)")
    cells = narrow.groupBy("_source", slice_of.alias("_slice")).agg(F.sum("_tokens").alias("_sum"))
    before = Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    cells = materialize(cells.join(plan, "_source"), "mix-cells")

    placed = (rows if extra else narrow).withColumn("_slice", slice_of).join(cells, ["_source", "_slice"])
    tie = [F.xxhash64("_extra")] if extra else []
    inside = Window.partitionBy("_source", "_slice").orderBy("_rank", "_id", "_tokens", *tie).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_tokens").over(inside), F.lit(0)))
    passes = F.col("_whole") + (F.col("_start") < F.col("_rest")).cast("long")
    taken = placed.withColumn("_passes", passes).where("_passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_passes") - 1)))
    if extra:
        return taken.select(F.col("_id").alias("doc_id"), "pass", "_extra")
    ordered = numbered(taken.withColumnRenamed("_slice", "_cell"), ["_source", "pass"], F.col("_cell"), [F.col("_rank"), F.col("_id"), F.col("_tokens")], "position")
    return ordered.select(F.col("_id").alias("doc_id"), F.expr("if(_source = 'null', null, substring(_source, 2))").alias("source"), F.col("_tokens").alias("n_tokens"), "pass", F.col("position").cast("long").alias("position"), "weight", F.lit(a).alias("exponent"))


def mix_documents(docs: DataFrame, **kwargs) -> DataFrame:
    """The rows of ``docs``, each as often as the schedule takes it, same columns."""
    return mixing_schedule(docs, columns=docs.columns, **kwargs).select("_extra.*")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mixing_schedule(spark.read.parquet(f"{sf_dir}/documents.parquet"), max_repeat=4.0)


ORACLE_SQL = r"""
with d as (select doc_id, source, greatest(1, len(regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+')))::bigint as n_tokens, ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as rank from documents),
t as (select source, sum(n_tokens)::bigint as total from d group by 1),
m as (select sum(total)::double as whole, max(total)::double as most, min(total)::double as least from t),
x as (select case when most = least then 1.0::double when ln(most / least) <= ln(4.0::double) then 0.0::double else ceil((1 - ln(4.0::double) / ln(most / least)) * 1e6) / 1e6 end as a from m),
z as (select sum(pow(total / whole, a)) as z from t, m, x),
q as (select source, total, round(pow(total / whole, a) / z, 9) as weight, a as exponent, greatest(total, floor(total * pow(most / total, 1 - a) + 1e-6)::bigint) as quota from t, m, x, z),
s as (select d.*, weight, exponent, quota // total as whole, quota % total as rest, coalesce(sum(n_tokens) over (partition by d.source order by rank, doc_id, n_tokens rows between unbounded preceding and 1 preceding), 0) as start from d join q using (source)),
p as (select *, unnest(range(0, whole + (start < rest)::int)) as pass from s)
select doc_id, source, n_tokens, pass::bigint as pass, (row_number() over (partition by source, pass order by rank, doc_id, n_tokens) - 1)::bigint as position, weight, exponent from p
"""

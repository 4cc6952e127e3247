"""URL filters from mined token combinations (op 3, native).

URLs become sets of tokens: host labels, path segments (digits as ``#``), query
keys, a fragment mark.  FP-growth over the URLs labelled bad finds token
combinations of any size; those with enough support and confidence for "block"
become rules, and a rule goes again where leaving out one of its tokens does not lower
its confidence.  Each rule is indexed under its rarest token, so that a URL only
meets rules whose rarest token it has.  Fixed host rules are applied first.

Tokens that stand together in every labelled URL, as the segments of one deep
path do, are one item: a rule needs one of them at most, and any of them will
do.  So copies of a long URL do not make two to the power of its length item
sets.  What good URLs have in common is not mined either, only counted.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.scratch import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
BLOCK = "!block"


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path; null or no ``://``: both empty.  Also _rest, what follows ``://``."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.expr(f"substring({url}, locate('://', {url}) + 3)")).otherwise(F.lit(""))
    df = df.withColumn("_rest", F.coalesce(rest, F.lit("")))
    return df.withColumn("host", F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), UPPER, LOWER)).withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))


def host_rule(rules: dict[str, str]) -> Column:
    """The longest rule whose host is the URL's or above it and whose path begins the URL's; else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r), r)):
        host, _, path = r.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        out = F.when(fits, F.lit(r)).otherwise(out)
    return out


def url_tokens() -> Column:
    """Sorted distinct tokens of a row with _rest, host and path."""
    return F.expr(r"""array_sort(array_distinct(concat(
        transform(filter(split(host, '[.]'), x -> x <> ''), x -> concat('h:', x)),
        transform(filter(split(path, '/'), x -> x <> ''), x -> concat('p:', regexp_replace(x, '[0-9]+', '#'))),
        transform(filter(split(regexp_extract(_rest, '^[^?#]*[?]([^#]*)', 1), '&'), x -> x <> ''), x -> concat('q:', split_part(x, '=', 1))),
        if(contains(_rest, '#'), array('f'), cast(array() as array<string>)))))""")


def token_items(sets: DataFrame) -> DataFrame:
    """(token, item) of ``sets(tokens)``, the distinct labelled token sets; tokens in the same sets are one item."""
    a, b = F.xxhash64("tokens").cast("decimal(38,0)"), F.xxhash64(F.lit(1), "tokens").cast("decimal(38,0)")
    where = sets.select(F.explode("tokens").alias("token"), a.alias("a"), b.alias("b")).groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    first = where.groupBy("n", "a", "b").agg(F.min("token").alias("item"))
    return where.join(first, ["n", "a", "b"]).select("token", "item")


def with_items(sets: DataFrame, items: DataFrame) -> DataFrame:
    """(tokens, items, name_of): the items of each token set, and of each item its last token in the set."""
    each = sets.select("tokens", F.explode("tokens").alias("token")).join(items, "token").groupBy("tokens", "item").agg(F.max("token").alias("token"))
    return each.groupBy("tokens").agg(F.map_from_entries(F.collect_list(F.struct("item", "token"))).alias("name_of")).select("tokens", F.array_sort(F.map_keys("name_of")).alias("items"), "name_of")


def contained(sets: DataFrame, index: DataFrame) -> DataFrame:
    """``sets(items)`` with every row of ``index(rarest, wanted)`` whose items they hold."""
    return sets.withColumn("rarest", F.explode("items")).join(index, "rarest").where(F.size(F.array_except("wanted", "items")) == 0)


def mine_rules(counted: DataFrame, least: int, min_confidence: float) -> DataFrame:
    """Rules (wanted, rarest, support, confidence) from ``counted(items, n, bad)``: rows and bad rows of each item set.

    A rule needs ``least`` bad rows with all its items, however many rows are
    labelled.  No labelled rows, or none that is bad: no rules."""
    spark = counted.sparkSession
    schema = "wanted array<string>, rarest string, support long, confidence double"
    n_bad = counted.agg(F.sum("bad").alias("n")).first()["n"] or 0
    if n_bad < least:
        return spark.createDataFrame([], schema)
    bad = counted.where("bad > 0").select("items", F.explode(F.sequence(F.lit(1).cast("long"), F.col("bad")))).select("items")
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_bad, minConfidence=1.0).fit(bad)
    mined = materialize(model.freqItemsets.select(F.array_sort("items").alias("wanted"), F.col("freq").alias("support")), "url-itemsets")
    single = counted.select(F.explode("items").alias("item"), "n").groupBy("item").agg(F.sum("n").alias("n_item"))
    rarest = mined.select("wanted", F.explode("wanted").alias("item")).join(single, "item").groupBy("wanted").agg(F.min(F.struct("n_item", "item"))["item"].alias("rarest"))
    mined = materialize(mined.join(rarest, "wanted"), "url-mined")
    # of all labelled rows with a mined combination: the bad ones are counted, the good ones are met here
    good = contained(counted.where("n > bad").select("items", (F.col("n") - F.col("bad")).alias("good")), mined.select("rarest", "wanted")).groupBy("wanted").agg(F.sum("good").alias("good"))
    sure = mined.join(good, "wanted", "left").withColumn("all", F.col("support") + F.coalesce("good", F.lit(0)))
    sure = sure.withColumn("confidence", F.col("support") / F.col("all")).where(F.col("support") >= F.lit(min_confidence) * F.col("all"))
    sure = materialize(sure.select("wanted", "rarest", "support", "confidence"), "url-sure")
    wider = sure.select("wanted", "confidence", F.explode("wanted").alias("left_out")).where(F.size("wanted") > 1).withColumn("parent", F.array_remove("wanted", F.col("left_out")))
    parents = sure.select(F.col("wanted").alias("parent"), F.col("confidence").alias("parent_confidence"))
    needless = wider.join(parents, "parent").where("parent_confidence >= confidence").select("wanted").distinct()
    return sure.join(needless, "wanted", "left_anti").select("wanted", "rarest", "support", "confidence")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: dict[str, str] | None = None, least: int = 10, min_confidence: float = 0.6) -> DataFrame:
    """A verdict for each row of ``pages(page_id, url)``.

    ``labels(page_id, bad)`` marks some pages; a page with several labels is bad
    if one says so, null labels are left out.  Returns page_id, host, path, rule,
    verdict, mined_rule, confidence.  A fixed rule decides; else a URL is
    blocked if a mined rule matches and allowed if none does.  Null URLs and
    URLs without ``://`` have no tokens and are allowed.  Repeated rows are each
    judged; the other columns of ``pages`` are ignored.  A very long URL has as
    many tokens as it has segments, and all of them count.  An empty table has
    no verdicts.
    """
    rules = HOST_RULES if rules is None else rules
    rows = url_parts(pages.select("page_id", "url")).withColumn("tokens", url_tokens()).withColumn("rule", host_rule(rules))
    rows = rows.select(F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule", "tokens")
    known = labels.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy("page_id").agg(F.bool_or("bad").alias("bad"))
    labelled = rows.where(F.size("tokens") > 0).join(known, "page_id").groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"))
    labelled = materialize(labelled, "url-labelled")
    items = materialize(token_items(labelled.select("tokens")), "url-items")
    counted = labelled.join(with_items(labelled.select("tokens"), items).select("tokens", "items"), "tokens").groupBy("items").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    mined = materialize(mine_rules(materialize(counted, "url-counted"), least, min_confidence), "url-rules")

    sets = with_items(rows.select("tokens").distinct(), items)
    found = contained(sets, mined)
    name = F.array_join(F.array_sort(F.transform("wanted", lambda x: F.col("name_of")[x])), " ")
    best = F.max(F.struct("confidence", "support", name.alias("name")))
    judged = materialize(found.groupBy("tokens").agg(best.alias("best")), "url-judged")
    out = rows.join(judged, "tokens", "left")
    fixed = F.lit(None).cast("string")
    for r, v in rules.items():
        fixed = F.when(F.col("rule") == r, F.lit(v)).otherwise(fixed)
    mined_verdict = F.when(F.col("best").isNotNull(), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce(fixed, mined_verdict).alias("verdict"), F.col("best.name").alias("mined_rule"), F.col("best.confidence").alias("confidence"))


def op3_urlrules(spark, sf_dir: str) -> DataFrame:
    """Bad pages are toxic ones or those of quality 0; where a null leaves that open, the label is left out."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return judge_urls(pages, labels)


#: Combinations are grown token by token, over every labelled row at each size.
ORACLE_SQL = r"""
with recursive base as (
  select page_id, case when url is null or not contains(url, '://') then '' else substr(url, instr(url, '://') + 3) end as rest from pages),
parts as (
  select page_id, rest, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from base),
tok as (
  select page_id, host, path, list_sort(list_distinct(
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x) ||
    list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'p:' || regexp_replace(x, '[0-9]+', '#', 'g')) ||
    list_transform(list_filter(string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> ''), lambda x: 'q:' || split_part(x, '=', 1)) ||
    case when contains(rest, '#') then ['f'] else [] end)) as tokens from parts),
lab as (select doc_id as page_id, bool_or(toxic = 1 or quality = 0) as bad from labels where (toxic = 1 or quality = 0) is not null group by 1),
train as (select page_id, tokens, bad from tok join lab using (page_id) where len(tokens) > 0),
one as (select page_id, unnest(tokens) as t from train where bad),
combos(w, support) as (
  select [t], count(*) from one group by 1 having count(*) >= 10
  union all
  select w, support from (select list_append(c.w, o.t) as w, count(*) as support from combos c join train r on r.bad and list_has_all(r.tokens, c.w) join one o on o.page_id = r.page_id and o.t > c.w[-1] group by 1) where support >= 10),
counted as (select w, support, (select count(*) from train where list_has_all(tokens, w)) as n_all from combos),
sure as (select w, support, support / n_all as confidence from counted where support >= 0.6 * n_all),
kept as (select * from sure s where not exists (select 1 from sure p where len(p.w) = len(s.w) - 1 and list_has_all(s.w, p.w) and p.confidence >= s.confidence)),
best as (select tokens, max({'confidence': confidence, 'support': support, 'name': array_to_string(w, ' ')}) as b
  from (select distinct tokens from tok) join kept on list_has_all(tokens, w) group by 1),
ruled as (select *, case
  when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
  when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
  when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
  when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule from tok)
select page_id, host, path, rule, case rule when 'net/' then 'block' when 'example.com/de/' then 'block' when 'example.net/en/' then 'allow' when 'org/fr/' then 'allow'
  else case when b is not null then 'block' else 'allow' end end as verdict, b.name as mined_rule, b.confidence as confidence
from ruled left join best using (tokens)
"""

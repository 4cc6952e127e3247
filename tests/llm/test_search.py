"""Vectors, URLs and the pipeline."""

from __future__ import annotations

import os
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import clashing
from pyspark.sql import functions as F

from folioscope.llm import registry, topk, urlrules

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("k", [1, 7])
def test_top_k(spark, k):
    rng = np.random.default_rng(k)
    centres = rng.normal(size=(5, 64))
    vectors = centres[rng.integers(0, 5, 300)] + rng.normal(size=(300, 64)) * 0.7
    vectors[100:160] = vectors[100]  # one hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1000, None), (None, vectors[0].tolist()), (1001, [1.0, None, -1.0]), (1002, []), (0, vectors[0].tolist())]
    codes = topk.sign_codes(clashing(spark.createDataFrame(rows, "id long, embedding array<double>").withColumnRenamed("id", "vec")).select(F.col("vec").alias("id"), "embedding"), 1)
    got = sorted((r["query_id"], r["rank"], r["neighbor_id"], r["distance"]) for r in topk.top_k(codes, codes.where("id % 20 = 0"), k).collect())
    bits = {i: np.array([x is not None and x > 0 for x in (v or [])] + [False] * (64 - len(v or []))) for i, v in rows if i is not None and v is not None}
    want = []
    for q in sorted(i for i in bits if i % 20 == 0):
        near = sorted((int((bits[q] != b).sum()), i) for i, b in bits.items() if i != q)[:k]
        want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    assert got == sorted(want)


def test_one_segment_for_all_codes(monkeypatch):
    """Where a segment is equal in all codes, a look-up meets the whole block; queries are then halved."""
    monkeypatch.setattr(topk, "HITS", 5000)
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    codes[:, 0] = 7
    codes[1000:1200] = codes[999]
    queries = codes[::100]
    q, c, d = topk.SegmentIndex(codes).search(queries, 5)
    every = topk.POP[queries[:, None, :] ^ codes[None, :, :]].sum(2, dtype=np.int64)
    for i in range(len(queries)):
        want = sorted((int(x), j) for j, x in enumerate(every[i]))[:5]
        assert sorted(zip(d[q == i].tolist(), c[q == i].tolist(), strict=True)) == want


def test_codes_are_as_wide_as_the_vectors(spark):
    vectors = spark.createDataFrame([(1, [1.0] * 70), (2, [-1.0] * 3), (3, None)], "id long, embedding array<double>")
    got = {r["id"]: bytes(r["code"]) for r in topk.sign_codes(vectors).collect()}
    assert got == {1: b"\xff" * 8 + b"\x3f" + bytes(7), 2: bytes(16)}
    with pytest.raises(Exception, match="does not fit"):
        topk.sign_codes(vectors, 1).collect()


def test_top_k_of_little(spark):
    few = spark.createDataFrame([(0, bytes(8)), (1, b"\xff" + bytes(7))], "id long, code binary")
    assert [tuple(r) for r in topk.top_k(few, few.where("id = 0"), 10).collect()] == [(0, 1, 8, 1)]
    assert topk.top_k(few.limit(0), few, 3).count() == 0
    assert topk.top_k(few, few.limit(0), 3).count() == 0


def test_urls(spark):
    urls = ["http://A.Example.NET/en/1?x=1", "https://net/", "http://net", "https://notnet/x", "ftp://x.org/fr/2#a", "http://example.com/de/", "nothing", None, "", "a://b://c/d", "http://h.net?q/", "http://EXAMPLE.net/en", "http://x.y/en/5?utm=1&b#f"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    out = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlrules.judge_urls(clashing(pages), labels).collect()}
    assert [out[i] for i in range(len(urls))] == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("net", "/", "net/", "block"), ("net", "", None, "allow"), ("notnet", "/x", None, "allow"), ("x.org", "/fr/2", "org/fr/", "allow"), ("example.com", "/de/", "example.com/de/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("b:", "//c/d", None, "allow"), ("h.net", "", None, "allow"), ("example.net", "/en", "net/", "block"), ("x.y", "/en/5", None, "allow")]


def test_mined_rules(spark):
    rows = [(i, f"http://{'casino' if i % 4 == 0 else 'news'}.site{i % 3}.org/{'win' if i % 8 == 0 else 'read'}/{i}") for i in range(200)]
    labels = [(i, i % 4 == 0) for i in range(160)] + [(3, None), (None, True)]
    out = {r["page_id"]: r for r in urlrules.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad boolean"), {}).collect()}
    assert all((out[i]["verdict"] == "block") == (i % 4 == 0) for i in range(200))
    assert {r["mined_rule"] for r in out.values()} <= {None, "h:casino", "p:win"}  # longer rules are no surer


def test_rules_of_any_length(spark):
    urls = [f"http://{a}.{b}.org/{c}?{d}=1" for a in ("a", "b") for b in ("c", "d") for c in ("e", "f") for d in ("g", "h")] * 12
    rows = [(i, u) for i, u in enumerate(urls)]
    labels = [(i, i % 16 == 0 or i % 16 == 6 and i % 3 > 0 or i % 16 == 15 and i < 160) for i in range(len(urls))]
    out = {r["page_id"]: r for r in urlrules.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad boolean"), {}).collect()}
    tokens = [frozenset(f"h:{a} h:{b} h:org p:{c} q:{d}".split()) for a in "ab" for b in "cd" for c in "ef" for d in "gh"] * 12
    sure = {}
    for w in {frozenset(c) for t in set(tokens) for n in range(1, 6) for c in combinations(sorted(t), n)}:
        bad = [b for t, (_, b) in zip(tokens, labels, strict=True) if w <= t]
        if sum(bad) >= 10 and sum(bad) >= 0.6 * len(bad):
            sure[w] = (sum(bad) / len(bad), sum(bad))
    kept = {w: s for w, s in sure.items() if not any(sure.get(w - {t}, (0, 0))[0] >= s[0] for t in w)}
    assert max(map(len, kept)) == 4
    for i, t in enumerate(tokens):
        best = max(((*s, " ".join(sorted(w))) for w, s in kept.items() if w <= t), default=(None, None, None))
        assert (out[i]["verdict"], out[i]["mined_rule"], out[i]["confidence"]) == ("block" if best[2] else "allow", best[2], best[0])
    assert out[0]["mined_rule"] == "h:a h:c p:e q:g"


@pytest.mark.parametrize("seed", range(3))
def test_rules_equal_those_of_all_combinations(spark, seed):
    """Tokens that always stand together are one item; the rules must be those of every combination all the same."""
    rng = np.random.default_rng(seed)
    shapes = ["http://{a}.{b}.org/{c}/{c}x/{c}y?{d}", "http://{a}.com/deep/er/{b}/{c}", "https://{a}.{b}.net/{d}#f"]
    urls = [rng.choice(shapes).format(**{k: k + "pq"[rng.integers(2)] for k in "abcd"}) for _ in range(400)]
    bad = [bool(("ap" in u and "cq" in u and rng.random() < 0.95) or rng.random() < 0.04) for u in urls]
    urls += ["http://ap.com/deep/er/bp/new", "http://ap.bp.org/cqy/other", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r["page_id"]: r for r in urlrules.judge_urls(pages, spark.createDataFrame(list(enumerate(bad)), "page_id long, bad boolean"), {}).collect()}
    rows = urlrules.url_parts(pages).withColumn("tokens", urlrules.url_tokens()).collect()
    tokens = {r["page_id"]: frozenset(r["tokens"]) for r in rows}
    sure = {}
    for w in {frozenset(c) for t in set(tokens.values()) for n in range(1, 8) for c in combinations(sorted(t), n)}:
        own = [b for i, b in enumerate(bad) if w <= tokens[i]]
        if sum(own) >= 10 and sum(own) >= 0.6 * len(own):
            sure[w] = (sum(own) / len(own), sum(own))
    kept = {w: s for w, s in sure.items() if not any(sure.get(w - {t}, (0, 0))[0] >= s[0] for t in w)}
    assert kept
    for i, t in tokens.items():
        best = max(((*s, " ".join(sorted(w))) for w, s in kept.items() if w <= t), default=(None, None, None))
        assert (out[i]["verdict"], out[i]["mined_rule"], out[i]["confidence"]) == ("block" if best[2] else "allow", best[2], best[0])


def test_copies_of_a_deep_url(spark):
    deep = "http://bad.org/" + "/".join(f"s{chr(97 + i)}" for i in range(40))
    rows = [(i, deep) for i in range(32)] + [(40 + i, f"http://fine.org/{'/'.join('abcdefgh'[: i % 8])}") for i in range(80)] + [(200, "http://other.org/sq"), (201, "x://" + "/y" * 50_000), (201, "x://" + "/y" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = urlrules.judge_urls(pages, spark.createDataFrame([(i, i < 32) for i, _ in rows[:112]], "page_id long, bad boolean"), {}).collect()
    assert len(out) == len(rows)
    assert all((r["verdict"] == "block") == (r["page_id"] < 32 or r["page_id"] == 200) for r in out)
    assert urlrules.judge_urls(pages.limit(0), spark.createDataFrame([(1, True)], "page_id long, bad boolean")).count() == 0


def test_a_bad_host_is_blocked_in_a_large_table(spark):
    n = 20_000
    pages = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://"), F.when(F.col("id") < 12, "spam").otherwise("fine"), F.lit(".org/x")).alias("url"))
    labels = spark.range(n).select(F.col("id").alias("page_id"), (F.col("id") < 12).alias("bad"))
    out = urlrules.judge_urls(pages, labels, {}).groupBy("verdict", "mined_rule", "confidence").count().collect()
    assert {tuple(r) for r in out} == {("block", "h:spam", 1.0, 12), ("allow", None, None, n - 12)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.execute(registry.ORACLE_SQL[name]).df(), registry.QUERIES[name](spark, SF).toPandas()
    assert sorted(want.columns) == sorted(got.columns)

    def plain(df):
        def cell(x):
            return None if not isinstance(x, str) and pd.isna(x) else int(x) if isinstance(x, float) and x == int(x) else x

        return sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)

    assert plain(want) == plain(got)


def test_pipeline_stages(spark, docs, rows, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
    item = " ".join(f"{rows[33][1]}".split()[:20])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen[name] = [r["doc_id"] for r in now.collect()]
        if name != "sharding":
            assert now.columns == docs.columns
    assert not {80, 81, 82, 83, 88} & set(seen["language"])
    assert not {70, 71, 60, 61} & set(seen["near_duplicates"]) and len(set(seen["near_duplicates"])) == len(seen["near_duplicates"])
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) == {33}
    assert set(seen["mixing"]) == set(seen["decontamination"]) and len(seen["sharding"]) == len(seen["mixing"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(repr, whole.select("doc_id", "shard").collect())) == sorted(map(repr, now.select("doc_id", "shard").collect()))


def test_no_stage_loses_a_clean_row(spark, tmp_path):
    """Rows that share an id, or have none: only leaks, copies and texts without a language go."""
    import corpus_pipeline

    rng = np.random.default_rng(12)
    prose = lambda n: " ".join("".join(rng.choice("the and tion er ing on at re es nd".split(), rng.integers(1, 4))) for _ in range(n))
    clean = [prose(60) for _ in range(40)]
    item = prose(25)
    rows = [(i, t, "en", f"src{i % 3}") for i, t in enumerate(clean[:20])]
    rows += [(3, clean[20], "en", "src0"), (3, clean[21], "en", "src0"), (None, clean[22], "en", "src1"), (None, clean[23], None, None), (None, clean[24], "en", "src1")]
    leaks = [(3, f"{clean[30]} {item}", "en", "src0"), (None, f"{item} {clean[31]}", "en", "src2")]
    copies = [(50, clean[0], "en", "src0"), (None, clean[22], "en", "src2")]
    odd = [(60, "", "en", "src0"), (61, None, "en", None), (None, "12 34", "en", "src0")]
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows + leaks + copies + odd, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["stage"]: (r["rows_in"], r["kept"], r["rejected"]) for r in corpus_pipeline.counts(spark, str(tmp_path))}
    n = len(rows)
    assert got["language"] == (n + 7, n + 3, 3)  # an id and a text that stand twice count once: the copy without an id
    assert got["near_duplicates"] == (n + 4, n + 2, 1)
    assert got["decontamination"] == (n + 2, n, 2)
    assert got["mixing"][1:] == (n, 0) and got["sharding"][1:] == (n, 0)


@pytest.mark.parametrize("name", ["language", "near_duplicates", "decontamination", "mixing", "sharding"])
def test_stages_of_nothing(spark, no_docs, name, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "an item of a few words to be found")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert dict(corpus_pipeline.STAGES)[name](spark, no_docs, str(tmp_path)).count() == 0

"""Operators over documents, against brute force."""

from __future__ import annotations

import copy
import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations, product

import held_out
import numpy as np
import pyarrow as pa
import pytest
from conftest import clashing, lower, words
from pyspark.sql import functions as F

from folioscope.llm import decontaminate, langid, licenses, mixing, neardup, pii, sharding, substrings
from folioscope.llm.components import components
from folioscope.llm.textvec import batches, grams, words_of

SF = "/root/testdata/sf0.001"
TEXTS = ["a b\tc", "", None, "Éa b", "x" * 100 + " y", " lead trail ", "a", "b\x0b\x0cc"]


@pytest.mark.parametrize("lowered", [False, True])
def test_word_hashes_depend_on_the_word_only(lowered):
    texts = [*TEXTS, "A B\tc"]
    w = words_of(pa.array(texts), lowered)
    h, at, seen = w.hashes(), 0, {}
    for i, t in enumerate(texts):
        own = words(lower(t) if lowered else t)
        assert w.first[i + 1] - w.first[i] == len(own)
        for x in own:
            assert seen.setdefault(x, h[at]) == h[at]
            at += 1
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 35])
def test_grams_tell_order(k):
    h = np.arange(1, 80, dtype=np.uint64)
    h[40 : 40 + 30] = h[3:33]
    g = grams(h, k)
    assert len(g) == len(h) - k + 1
    assert all((g[i] == g[j]) == (list(h[i : i + k]) == list(h[j : j + k])) for i in range(len(g)) for j in range(i))


def test_batches_keep_rows():
    b = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 50, "", "d"])], names=["text"])
    assert [x.num_rows for x in batches(iter([b]), "text", 10)] == [2, 1, 2]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (3, 1), (20, 21), (21, 22), (22, 23), (23, 24), (5, 5), (24, 30), (31, 30)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert {k: got.get(k, k) for k in (1, 2, 3, 8, 9, 5, 20, 24, 31)} == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 5: 5, 20: 20, 24: 20, 31: 20}


# --- sharding


def filled(sizes: list[int], cap: int) -> list[list[int]]:
    """Runs of groups filled up to ``cap``; a larger group is alone."""
    out, left = [], -1
    for i, s in enumerate(sizes):
        if s > left:
            out.append([])
            left = cap
        out[-1].append(i)
        left -= s
    return out


@pytest.mark.parametrize("blocks", [32, 4096])
@pytest.mark.parametrize("shards", [3, 16])
@pytest.mark.parametrize("giants", [(), (4000,), (60_000,), (60_000, 61_000), (60_000, 5, 9000, 30_000)])
def test_minimax_cuts(spark, blocks, shards, giants):
    rng = np.random.default_rng(blocks + shards)
    keys = np.sort(rng.choice(10**6, 200, replace=False)) - 5000
    sizes = rng.integers(1, 500, 200)
    sizes[17 : 17 + len(giants)] = giants
    cap, cuts = sharding.minimax_cuts(spark.createDataFrame(list(zip(keys.tolist(), sizes.tolist(), strict=True)), "key long, bytes long"), shards, blocks)
    least = next(c for c in range(1, 10**6) if len(filled(sizes.tolist(), c)) <= shards)
    assert cap == max(least, sizes.max())
    assert [int(keys[run[0]]) for run in filled(sizes.tolist(), least)[1:]] == cuts
    # no partition into runs has a smaller largest shard
    ends = np.concatenate([[0], np.cumsum(sizes)])
    worst = ends[1:].copy()
    for _ in range(shards - 1):
        worst = np.array([min(worst[j], min((max(worst[i], ends[j + 1] - ends[i + 1]) for i in range(j)), default=worst[j])) for j in range(200)])
    assert worst[-1] == max(sum(sizes[i] for i in run) for run in filled(sizes.tolist(), least)) <= cap


def test_a_huge_group_leaves_the_others_even(spark):
    rows = [(i, f"text {i} " * 5) for i in range(600)] + [(600 + i, "the same " * 10) for i in range(400)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 16)
    sizes = sorted(r["b"] for r in out.groupBy("shard").agg(F.sum("size").alias("b")).collect())
    assert len(sizes) == 16 and sizes[-1] == 400 * 91 and sizes[0] > 0.7 * sizes[-2]


def test_sharding(docs, rows, no_docs):
    out = sharding.shard_documents(clashing(docs), 4).collect()
    assert len(out) == len(rows)
    place, slots = defaultdict(set), defaultdict(list)
    for r in out:
        place[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(x) == 1 for x in place.values())  # equal texts stay together
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(4))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert want == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out)
    assert sharding.shard_documents(no_docs, 4).count() == 0


# --- mixing


def test_fit_exponent(spark):
    shares = spark.createDataFrame([(0.7,), (0.2,), (0.1,)], "share double")
    a = mixing.fit_exponent(shares, max_repeat=2.0)
    assert (0.7 / 0.1) ** (1 - a) <= 2.0 < (0.7 / 0.1) ** (1 - a + 1e-4)
    e = mixing.fit_exponent(shares, target_entropy=1.0)
    w = np.array([0.7, 0.2, 0.1]) ** e
    w /= w.sum()
    assert abs(-(w * np.log(w)).sum() - 1.0) < 1e-3
    assert mixing.fit_exponent(shares, max_repeat=100.0) == 0.0
    assert mixing.fit_exponent(shares.limit(1), max_repeat=2.0) == 1.0


def test_mixing(docs, rows, no_docs):
    out = mixing.mixing_schedule(clashing(docs), max_repeat=3.0).collect()
    tokens = Counter()
    for _, t, _, s, _ in rows:
        tokens[s] += max(1, len(words(t)))
    taken, passes, places = Counter(), defaultdict(Counter), defaultdict(list)
    for r in out:
        taken[r["source"]] += r["n_tokens"]
        passes[r["source"]][r["doc_id"], r["pass"]] += 1
        places[r["source"], r["pass"]].append(r["position"])
    assert {(r["doc_id"], r["source"]) for r in out} == {(i, s) for i, _, _, s, _ in rows}  # nothing is lost
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    assert max(r["pass"] for r in out) <= 2
    a, most = out[0]["exponent"], max(tokens.values())
    for s, n in tokens.items():
        quota = max(n, int(n * (most / n) ** (1 - a) + 1e-6))
        assert 0 <= taken[s] - quota < 30_001
    same = mixing.mix_documents(docs, max_repeat=3.0)
    assert same.columns == docs.columns and same.count() == len(out)
    assert mixing.mixing_schedule(no_docs).count() == 0 and mixing.mix_documents(no_docs).count() == 0


def test_rows_without_an_id_are_spread(spark):
    rows = [(None, f"text {i} of none", "s") for i in range(400)]
    out = mixing.mixing_schedule(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted(r["position"] for r in out.collect()) == list(range(400))
    extra = spark.createDataFrame([(None, "the same", "s", i) for i in range(50)], "doc_id long, text string, source string, n long")
    mixed = mixing.mix_documents(extra, max_repeat=2.0)
    assert sorted(r["n"] for r in mixed.collect()) == list(range(50))


def test_mixing_budget(docs):
    out = mixing.mixing_schedule(docs.where("text is not null and length(text) < 5000"), max_repeat=None, target_entropy=1.2, budget=4000).collect()
    assert abs(sum(r["n_tokens"] for r in out) - 4000) < 6 * 200


# --- language


def phrase_count(train: str, text: str) -> int:
    n, i = 0, 0
    for begin in range(0, len(text), langid.SEGMENT):
        part, i = text[begin : begin + langid.SEGMENT], 0
        while i < len(part):
            j = i + 1
            while j < len(part) and part[i : j + 1] in train:
                j += 1
            n, i = n + 1, j
    return n


def test_phrases_are_longest_matches():
    train = {"a": "the cat sat on the mat and the rat ran", "b": "der hund und die katze"}
    parser = langid.CrossParser(train)
    texts = ["the mat ran and the hund", "Der Rat, und 12 die CAT!", "zzz", "", "the " * 400]
    codes, size, letters, unseen = parser.encode(texts)
    got = parser.phrases(codes, size)
    assert not unseen.any()
    for row, t in enumerate(texts):
        plain = re.sub(r"[^a-zäöü]+", " ", t.lower()).strip(" ") if row != 4 else "the " * 400
        if row in (0, 2):
            assert got[row].tolist() == [phrase_count(langid.fold(train[k]), plain) for k in "ab"]
        assert letters[row] == sum(c.isalpha() for c in t)
    assert got[3].tolist() == [0, 0]


def test_language_identification(docs, rows, no_docs):
    out = langid.identify(clashing(docs), docs.where(~langid.held_out())).withColumn("held_out", langid.held_out()).collect()
    assert len(out) == len(rows)
    truth = {i: lang for i, _, lang, *_ in rows}
    for r in out:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        if r["doc_id"] in (80, 81, 82, 83):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None and r["doc_id"] < 66:
            assert r["lang_pred"] == truth[r["doc_id"]] and 0 <= r["score"] <= 1
    kept = {r["doc_id"] for r in langid.keep_identified(docs, docs.where(~langid.held_out())).collect()}
    assert kept >= set(range(66)) and not kept & {80, 81, 82, 83, 88}
    assert langid.identify(no_docs, no_docs).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, no_docs).collect()} == {"und"}


def test_every_label_is_learned_and_brief_texts_stay(spark, docs, monkeypatch):
    many = spark.createDataFrame([(i, f"label {chr(97 + i % 26)}{chr(97 + i // 26)} words of it", f"l{i:03d}") for i in range(600)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(many.where("doc_id < 40"), many).collect()}
    assert set(got.values()) <= {f"l{i:03d}" for i in range(600)} and sum(got[i] == f"l{i:03d}" for i in got) >= 30
    assert len(langid.training_sample(many, 64, 24_000, most_labels=7)) == 7
    monkeypatch.setattr(langid, "CELLS", 5000)
    parser = langid.CrossParser({"a": "abc " * 500, "b": "bcd " * 500})
    assert sum(t.size for t in parser.tables) <= 5000
    monkeypatch.undo()
    brief = spark.createDataFrame([(1, "a"), (2, "Né"), (3, "漢"), (4, "?"), (5, "tz")], "doc_id long, text string")
    assert {r["doc_id"] for r in langid.keep_identified(brief, docs.where(~langid.held_out())).collect()} == {1, 2, 5}


def plain_language(samples: dict, text: str) -> str | None:
    """The label with the fewest phrases by a parser that searches the training text."""
    if not any(c.isalpha() for c in text or ""):
        return "und"
    folded = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text.lower())).lstrip(" ")
    count = {k: phrase_count(langid.fold(v), folded) for k, v in samples.items()}
    return min(sorted(count), key=count.get)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_equals_a_plain_parser(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    samples = langid.training_sample(docs.where(~langid.held_out()), 64, 24_000)
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if len(r["text"] or "") < 1500}
    got = {r["doc_id"]: r["lang_pred"] for r in langid.op6_langid(spark, SF).collect()}
    assert len(texts) > 50 and all(got[i] == plain_language(samples, t) for i, t in texts.items())


# --- near duplicates


def linked_groups(rows, k: int, percent: int) -> list:
    """For each row the smallest id of the rows it is linked with; rows that share an id are rows of their own."""
    sets = []
    for _, t, *_ in rows:
        w = words(lower(t))
        sets.append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y) and find(a) != find(b):
            root[find(b)] = find(a)
    ids = defaultdict(list)
    for a, (i, *_) in enumerate(rows):
        ids[find(a)] += [i] if i is not None else []
    return [min(ids[find(a)], default=None) for a in range(len(rows))]


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, rows, k, percent):
    want = linked_groups(rows, k, percent)
    out = neardup.near_duplicates(clashing(docs), k, percent).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in out) == Counter((r[0], c) for r, c in zip(rows, want, strict=True))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_rows_that_share_an_id(spark):
    rng = np.random.default_rng(2)
    a, b, c, d = (" ".join(f"w{x}" for x in rng.integers(0, 5000, 80)) for _ in range(4))
    near = lambda t: t.replace(t.split()[40], "other")
    rows = [(1, a, 0), (1, b, 0), (2, c, 0), (2, near(a), 0), (None, near(b), 0), (None, d, 0), (None, d, 1), (None, near(d), 0), (3, c, 0), (3, c, 0), (4, None, 0), (4, None, 0), (None, "", 0), (5, near(near(c)), 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(3)
    out = neardup.near_duplicates(docs, 5, 80).collect()
    want = linked_groups(rows, 5, 80)
    assert Counter((r["doc_id"], r["component_id"]) for r in out) == Counter((r[0], x) for r, x in zip(rows, want, strict=True))
    kept = neardup.keep_one_of_each(docs)
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert kept.columns == docs.columns
    d_kept = [t for (i, t) in got if i is None and t]
    assert len(d_kept) == 1 and d_kept[0] in (d, near(d))
    assert got - Counter({(None, d_kept[0]): 1}) == Counter({(1, a): 1, (1, b): 1, (2, c): 1, (4, None): 2, (None, ""): 1})
    twins = neardup.keep_one_of_each(spark.createDataFrame([(7, d, 0)] * 9 + [(7, d, 1)] * 3, docs.schema)).collect()
    assert [(r["doc_id"], r["text"]) for r in twins] == [(7, d)]


def test_long_texts_in_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SHINGLES", 3000)
    monkeypatch.setattr(neardup, "UNPACKED", 4000)
    rng = np.random.default_rng(6)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 1200)]
    rows = []
    for i in range(24):
        w = list(base)
        for j in rng.choice(1200, rng.integers(10, 70), replace=False):
            w[j] = f"x{rng.integers(40)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(24)] == linked_groups(rows, 3, 85) and len(set(got.values())) > 1


def test_blocks_find_what_centres_leave(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):  # a mesh of near copies around the threshold
        w = list(base)
        for j in rng.choice(120, rng.integers(1, 9), replace=False):
            w[j] = f"x{rng.integers(6)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(neardup, "BLOCK", 16)
    want = linked_groups(rows, 3, 85)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(set(want)) > 1 and [got[i] for i in range(90)] == want


def test_near_duplicates_of_nothing(no_docs, docs):
    assert neardup.near_duplicates(no_docs).count() == 0
    kept = neardup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 4 in ids and not {70, 71, 72, 73, 74, 60, 61} & set(ids)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 1 << 63, 100).astype(np.uint64)])
    t = neardup.fast_similarity_sketch([np.unique(a), np.unique(b), a[:1], a[:0]], 256)
    assert (t[:3] != np.iinfo(np.uint64).max).all() and (t[3] == np.iinfo(np.uint64).max).all()
    assert abs((t[0] == t[1]).mean() - 0.6) < 0.12
    assert (1 - 0.85**neardup.ROWS) ** neardup.bands_for(85) <= neardup.MISS


# --- substrings


def removed(rows, length: int) -> Counter:
    count = Counter()
    for _, t, *_ in rows:
        w = words(t)
        count.update(tuple(w[i : i + length]) for i in range(len(w) - length + 1))
    out = Counter()
    for i, t, *_ in rows:
        w = words(t)
        gone = set()
        for s in range(len(w) - length + 1):
            if count[tuple(w[s : s + length])] > 1:
                gone.update(range(s, s + length))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("length", "k"), [(35, 8), (12, 4), (9, 9)])
def test_repeated_passages(docs, rows, length, k):
    more = [(200, "a b " * 60, None, None, None), (201, "z " + "a b " * 30 + "q", None, None, None), (202, "one " * 100, None, None, None)]
    spark = docs.sparkSession
    out = substrings.remove_repeats(clashing(docs.unionByName(spark.createDataFrame(more, docs.schema))), length, k).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out) == removed([*rows, *more], length)


def test_rows_that_repeat_without_an_id(spark):
    rng = np.random.default_rng(8)
    text = " ".join(f"w{x}" for x in rng.integers(0, 10_000, 150))
    rows = [(None, text)] * 40 + [(3, text)] * 20 + [(None, f"{text} and one end")] * 5 + [(4, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    gone = substrings.repeated_windows(substrings.keyed(docs), 35, 8)
    assert gone.count() == 3 and gone.agg(F.max(F.size("gone"))).first()[0] < 150  # each range once, however many rows
    out = substrings.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out) == removed(rows, 35)


def test_rightmost_minimum():
    rng = np.random.default_rng(3)
    v = rng.integers(0, 6, 200).astype(np.uint64)
    for width in (1, 2, 5, 28):
        at = substrings.rightmost_minimum(v, width)
        assert all(at[i] == i + width - 1 - int(np.argmin(v[i : i + width][::-1])) for i in range(len(at)))


def test_no_substrings(no_docs, docs):
    assert substrings.remove_repeats(no_docs).count() == 0
    assert "kept_text" in substrings.remove_repeats(docs, with_text=True).columns


def test_python_steps_get_small_batches(spark, monkeypatch, tmp_path):
    """Spark hands over up to 64 MB at once, which an executor holds several times outside its heap."""
    frame, setting, notes = type(spark.range(1)), "spark.sql.execution.arrow.maxBytesPerBatch", str(tmp_path)
    plain, before = frame.mapInArrow, spark.conf.get(setting)

    def noting(self, func, *args, **kwargs):
        def seen(it):
            for batch in it:
                with open(f"{notes}/{os.getpid()}", "a") as f:
                    f.write(f"{batch.nbytes}\n")
                yield batch

        return plain(self, lambda it: func(seen(it)), *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", noting)
    text = "array_join(transform(sequence(1, 250), i -> if(i = 1, md5(string(id)), md5(concat(id % 750, '-', i)))), ' ')"
    docs = spark.range(0, 1500, 1, 1).selectExpr("id as doc_id", f"{text} as text")
    assert {r["doc_id"] for r in neardup.keep_one_of_each(docs).collect()} == set(range(750))
    sizes = [int(x) for p in tmp_path.iterdir() for x in p.read_text().split()]
    assert sum(sizes) > 20_000_000 and max(sizes) < 5_000_000
    assert spark.conf.get(setting) == before


def test_kept_rows_stay_as_they_are(spark, docs):
    extra = docs.select("text", "lang", F.lit(1).alias("_nth"), F.lit(2).alias("_gone"), "doc_id")
    kept = neardup.keep_one_of_each(extra)
    assert kept.columns == extra.columns
    seen = Counter(r["doc_id"] for r in kept.collect())
    assert seen[4] == seen[5] == seen[6] == seen[None] == 1 and not seen.keys() & {*range(70, 75)}


# --- benchmark leaks


def test_leaks(spark, docs, rows):
    rng = np.random.default_rng(5)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "mo", "ri") for b in ("tel", "sun", "dor", "vi") for c in ("na", "po", "gu", "sh", "ek")]
    items = [(i, " ".join(rng.choice(vocabulary, n))) for i, n in enumerate([18, 40, 60, 30, 5])] + [(10, None), (11, "")]
    own = {i: t.split() for i, t in items if t}
    shuffled = [*own[1][:6], "new", *own[1][6:9], *own[1][10:22], "other", "word", *own[1][22:30], *own[1][30:]]
    planted = [
        (300, f"{rows[0][1]} {items[0][1].upper()}! {rows[1][1]}"), (301, f"{rows[2][1]} {' '.join(shuffled)} {rows[3][1]}"), (302, items[2][1].replace(" ", "\n*** ")),
        (303, " ".join(own[3][:12])), (304, " ".join(sorted(own[2]))), (305, f"a {items[4][1]} b"), (306, " ".join(reversed(own[4]))), (307, None),
    ]
    all_docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    found = decontaminate.find_leaks(clashing(all_docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(300, 0), (301, 1), (302, 2), (305, 4)}
    kept = decontaminate.without_leaks(docs.unionByName(spark.createDataFrame([(300, planted[0][1], None, None, None)], docs.schema)), spark.createDataFrame(items, "item_id long, text string"))
    assert kept.count() == len(rows) and kept.columns == docs.columns


def test_each_row_leaks_by_its_own_text(spark):
    item = "one of the items that must not be found in any text of the corpus"
    rows = [(1, f"before {item} after"), (1, "a clean text under the same id"), (None, item), (None, "clean without an id"), (None, "clean too"), (2, None), (3, ""), (3, f"again {item}")]
    docs = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], "doc_id long, text string, lang string, _leak string, _leak_text long")
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted((r for r in rows if item not in (r[1] or "")), key=repr)
    assert decontaminate.without_leaks(docs.limit(0), benchmark).count() == 0 and decontaminate.without_leaks(docs, benchmark.limit(0)).count() == len(rows)


def reworded(rng, item: list[str], words: list[str]) -> str:
    """About three words in ten replaced, two put in; the answer at the end stays."""
    out = [str(rng.choice(words)) if rng.random() < 0.3 and k < 0.7 * len(item) else x for k, x in enumerate(item)]
    for _ in range(2):
        out.insert(int(rng.integers(0, len(out) // 2)), "inserted")
    return " ".join(out)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_leaks_of_whole_tables(spark, tmp_path):
    """The query over all (document, item) pairs, and how many reworded items it finds."""
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    rng = np.random.default_rng(11)
    vocabulary = sorted({x for _, t in docs for x in words(t)[:50]})
    long_ones = [(i, t) for i, t in items if t and len(t.split()) >= 20]
    planted = [(10_000 + k, i, f"{docs[k][1][:300]} {reworded(rng, t.split(), vocabulary)} {docs[-k - 1][1][:300]}") for k, (i, t) in enumerate(long_ones * 3)]
    docs += [(d, t) for d, _, t in planted]
    for name, rows, schema in (("documents", docs, "doc_id long, text string"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = {(r["doc_id"], r["item_id"]): (r["common_words"], r["answer"]) for r in decontaminate.op2_decontaminate(spark, str(tmp_path)).collect()}
    named = decontaminate.Items([i for i, _ in items], decontaminate.hashed([t or "" for _, t in items]), decontaminate.hashed([decontaminate.answer_of(t or "") for _, t in items]))
    search = decontaminate.Search(named, decontaminate.Vocabulary(np.zeros(0, np.uint64)), np.zeros((0, 1), np.float32))
    expected = {(docs[t][0], items[i][0]): v for (t, i), v in leaks_of_all_windows(search, [t for _, t in docs]).items()}
    assert got == expected
    found = sum((d, i) in got for d, i, _ in planted)
    print(f"reworded items found: {found} of {len(planted)}")
    assert found >= 0.9 * len(planted)


def test_short_items_share_a_look_up():
    lines = ["red fox", "red hen", "old red fox", "a", "fox"]
    items = decontaminate.Items(list(range(5)), decontaminate.hashed(lines), decontaminate.hashed(lines))
    search = decontaminate.Search(items, decontaminate.benchmark_vocabulary(items), np.zeros((len(decontaminate.benchmark_vocabulary(items).hashes), 1), np.float32))
    texts = ["an old red fox ran", "red hen and red fox", "nothing", "", "a fox red"]
    got = set(search.leaks(words_of(pa.array(texts), lower=True, plain=True)))
    assert got == {(t, i) for t, text in enumerate(texts) for i, x in enumerate(lines) if f" {x} " in f" {text} "}


def test_item_words_in_both_layouts(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 90, n)) for n in (9, 40, 300, 8)]
    items = decontaminate.Items(list(range(4)), decontaminate.hashed(texts), decontaminate.hashed(texts))
    none = decontaminate.Vocabulary(np.zeros(0, np.uint64)), np.zeros((0, 1), np.float32)
    dense = decontaminate.Search(items, *none)
    monkeypatch.setattr(decontaminate, "DENSE", 0)
    sparse = decontaminate.Search(items, *none)
    assert dense.bits is not None and sparse.bits is None
    item = rng.integers(0, 4, (50, 1))
    number = rng.integers(-1, len(dense.all_words.hashes), (50, 70))
    expected = [len(set(n.tolist()) & set(dense.all_words.numbers(items.words[i]).tolist())) for (i,), n in zip(item, number, strict=True)]
    assert dense.different(item, number).tolist() == sparse.different(item, number).tolist() == expected


def leaks_of_all_windows(search, texts):
    """What comparing every window with every item finds."""
    w = words_of(pa.array(texts), lower=True, plain=True)
    found = {}
    for t, own in enumerate(np.split(w.hashes(), w.first[1:-1])):
        for i, item in enumerate(search.words):
            scale = decontaminate.scale_of(len(item))
            for begin in range(-(scale // 2), len(own) - scale // 2, scale // 4):
                said = search.settle(i, own[max(0, begin) : begin + 2 * scale].tolist())
                if said:
                    found[t, i] = max(said, found.get((t, i), (-1, False)))
    return found


def leaky(rng, item: list[str]) -> str:
    """Some of an item's words in their order, with words between them."""
    kept = [x for x in item if rng.random() < rng.choice([0.65, 0.8, 0.9, 1])]
    for _ in range(rng.integers(0, 5)):
        kept.insert(rng.integers(0, len(kept) + 1), "between")
    return " ".join(kept)


@pytest.mark.parametrize("hits", [1 << 20, 5])
@pytest.mark.parametrize("kinds", [60, 3000])
def test_no_leak_depends_on_the_latent_space(monkeypatch, hits, kinds):
    monkeypatch.setattr(decontaminate, "HITS", hits, raising=False)
    rng = np.random.default_rng(kinds)
    own = [[f"w{x}" for x in rng.integers(0, kinds, n)] for n in rng.integers(8, 60, 40)]
    own[:2] = ["same word again".split() * 5, ["one"] * 12]
    around = [" ".join(f"{'w' if k % 3 else 'v'}{x}" for x in rng.integers(0, kinds, 50)) for k in range(160)]
    texts = ["", *(f"{a} {leaky(rng, own[k % 40])} {around[k // 2]}" for k, a in enumerate(around)), ""]
    lines = [" ".join(x[:-4]) + "\n" + " ".join(x[-4:]) if k % 2 else " ".join(x) for k, x in enumerate(own)]
    items = decontaminate.Items(list(range(40)), decontaminate.hashed(lines), decontaminate.hashed([decontaminate.answer_of(x) for x in lines]))
    vocabulary = decontaminate.Vocabulary(np.unique(np.concatenate(items.words)))
    space = np.abs(rng.normal(size=(len(vocabulary.hashes), 1))).astype(np.float32) * np.where(np.arange(len(vocabulary.hashes)) % 2, 1, -1)[:, None]
    search = decontaminate.Search(items, vocabulary, space)
    expected = leaks_of_all_windows(search, texts)
    assert len(expected) > 80
    assert search.leaks(words_of(pa.array(texts), lower=True, plain=True)) == expected
    search.by_scale = {}  # not one window is near an item
    assert search.leaks(words_of(pa.array(texts), lower=True, plain=True)) == expected


def test_items_without_a_direction_are_found_without_their_first_word():
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu"
    items = decontaminate.Items([0, 1, 2, 3], decontaminate.hashed([text] * 4), decontaminate.hashed([decontaminate.answer_of(text)] * 4))
    vocabulary = decontaminate.benchmark_vocabulary(items)
    assert not len(vocabulary.hashes)
    search = decontaminate.Search(items, vocabulary, np.zeros((0, 1), np.float32))
    texts = [f"so {text.replace('alpha', 'other')} on", f"so {text.replace('alpha beta gamma delta', 'other')} on", "alpha beta gamma", text.replace(" theta iota kappa lam mu", "")]
    assert {k for k in search.leaks(words_of(pa.array(texts), lower=True, plain=True))} == {(t, i) for t in (0, 1) for i in range(4)}


def test_no_leaks(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs, none).count() == 0
    assert decontaminate.find_leaks(no_docs, spark.createDataFrame([(1, "some words of an item to be found in here")], "item_id long, text string")).count() == 0


def test_common_subsequence():
    a, b = [1, 2, 3, 2, 4], [2, 9, 1, 3, 4, 2, 4]
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert decontaminate.common_subsequence(decontaminate.places(a), len(a), b) == table[-1][-1]


# --- personal data


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t: str) -> list:
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(len(x.lstrip("0")) < 4 and int(x[-9:]) <= 255 for x in m[0].split(".")), "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if fine:
                out.append((kind, *m.span()))
    return out


HARD = [
    "a@b.c_foo@bar.com a@@b.co x@y @z.com é@a.b a.b@c.d.e-f.g@h.ij", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1..2.3.4 9.9.9.9.", "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000", "+1 (555) 123-4567 ++44 20 7946 0958+1 2 +1234567",
    "", "no data", "5" * 5000 + ".1.1.1", "😀 me@x.org 😀 10.0.0.1", 'token = "4f9c1e7ab2d05386c7e1f0a9b8d7c6e5f4a3b2c1"### in 1984 there were 12',
]


@pytest.mark.parametrize("text", HARD)
def test_pattern_spans(text):
    assert pii.pattern_spans(text) == base_spans(text)


def test_personal_data(spark, docs, no_docs):
    more = spark.createDataFrame([(500 + i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.find_personal_data(clashing(docs.select("doc_id", "text").unionByName(more))).collect()}
    for i, t in enumerate(HARD):
        base = base_spans(t)
        assert out[500 + i]["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) <= set(out[500 + i]["spans"].split(",")) | {""}
    assert out[508]["spans"] == "secret:9:49" and out[508]["n_added"] == out[508]["n_spans"] == 1
    assert out[0]["spans"] == "" and out[80]["n_email"] == 0
    assert pii.find_personal_data(no_docs).count() == 0


@pytest.fixture(scope="module")
def crf():
    return pii.Crf(pii.labelled_rows())


def test_crf_learns_its_table(crf):
    rows = pii.labelled_rows()
    got = pii.crf_spans([t for t, _ in rows], crf)
    assert sum(g == s for g, (_, s) in zip(got, rows, strict=True)) >= len(rows) - 1


def test_crf_on_lines_it_has_not_seen(crf):
    rows = pii.labelled_rows(held_out.HELD_OUT)
    known, found = Counter(), Counter()
    for g, (_, spans) in zip(pii.crf_spans([t for t, _ in rows], crf), rows, strict=True):
        for s in spans:
            known[s[0]] += 1
            found[s[0]] += s in g
    print({k: f"{found[k]} of {n}" for k, n in known.items()})
    assert sum(found.values()) >= 0.85 * sum(known.values())
    clean = held_out.CLEAN.strip().splitlines()
    assert not any(pii.crf_spans(clean, crf))


def test_no_stretch_is_passed_over(docs):
    texts = [t for t, _ in pii.labelled_rows()] + HARD + [f"Das {k.upper()} war da" for k in pii.KEY_OF] + [f"x, '{k.title()}': y" for k in pii.KEY_OF] + [r["text"] or "" for r in docs.collect()]
    worth = pii.worth_reading(texts)
    assert all(w or not list(pii.stretches(t)) for w, t in zip(worth, texts, strict=True)) and not worth.all()


def test_viterbi_against_every_labelling(crf):
    rng = np.random.default_rng(0)
    size = len(crf.labels)
    scores = [rng.normal(size=(n, size)) * 4 for n in (1, 2, 3, 4)]
    for x, path in zip(scores, crf.viterbi(scores), strict=True):
        best = max(product(range(size), repeat=len(x)), key=lambda p: crf.begin[p[0]] + sum(x[i, a] for i, a in enumerate(p)) + sum(crf.move[a, b] for a, b in zip(p, p[1:], strict=False)))
        assert tuple(path.tolist()) == best


def test_long_stretches(crf, monkeypatch):
    rng = np.random.default_rng(1)
    hashes = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(1000)]
    text = " ".join(f'token = "{h}"' for h in hashes)
    (found,) = pii.crf_spans([text], crf)
    assert len(found) == len(set(found)) and sum(text[a:b] in hashes for _, a, b in found) >= 990
    whole = pii.crf_spans([text[:20_000]], crf)
    monkeypatch.setattr(pii, "PART", 17)
    assert pii.crf_spans([text[:20_000]], crf) == whole
    monkeypatch.setattr(pii, "SHORT", 10**6)
    assert pii.crf_spans([text[:20_000]], crf) == whole


def spans_of_whole_chain(crf, text: str) -> list:
    """``features`` of every token, and Viterbi over the whole text."""
    cut = [m.span() for m in pii.TOKEN.finditer(text)]
    if not cut:
        return []
    tokens = [text[a:b] for a, b in cut]
    best, back = crf.emissions(tokens, 0) + crf.begin, []
    for i in range(1, len(tokens)):
        ways = best[:, None] + crf.move
        back.append(ways.argmax(0))
        best = ways.max(0) + crf.emissions(tokens, i)
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    found = pii.spans_of(crf, text, [a for a, _ in cut], [b for _, b in cut], np.array(path[::-1]))
    return sorted(set(found), key=lambda s: (s[1], s[2]))


CAPITALS = ["THE END OF ALL!! THINGS!! IS NEAR.\n" * 30, "Anna Bert Carla Dora " * 40, "a\u00a0b\u2003c\x1cd\x85e \u3000 É\u00fc!", '""\'=:;,()[]{}<>|`', "Mr " * 12 + "'" * 15 + " x", "A" * 70 + " " + "ab12" * 40]


def texts_for_crf(docs) -> list[str]:
    more = [" ".join(t for t, _ in pii.labelled_rows()), *held_out.CLEAN.splitlines(), *(t for t, _ in pii.labelled_rows(held_out.HELD_OUT))]
    return HARD + CAPITALS + more + [r["text"] or "" for r in docs.collect()]


def test_every_token_is_read(docs, crf, monkeypatch):
    texts = texts_for_crf(docs)
    want = [spans_of_whole_chain(crf, t) for t in texts]
    assert pii.crf_spans(texts, crf) == want
    monkeypatch.setattr(pii, "PART", 300)
    monkeypatch.setattr(pii, "SHORT", 5)
    assert pii.crf_spans(texts, crf) == want
    monkeypatch.setattr(pii, "MOST", 7)  # forgets what it met
    monkeypatch.setattr(crf, "reader", None)
    assert pii.crf_spans(texts, crf) == want


def test_every_token_is_read_with_any_weights(docs, crf, monkeypatch):
    rng, texts = np.random.default_rng(3), [t for t in texts_for_crf(docs) if len(t) < 5_000]
    for weight in (0.0, 0.3, 0.6):  # of O; with more of it, more of the chain falls into runs
        wild = copy.copy(crf)
        wild.emit, wild.move, wild.reader = rng.normal(size=crf.emit.shape), rng.normal(size=crf.move.shape) + crf.never, None
        wild.emit[:, 0] += weight
        want = [spans_of_whole_chain(wild, t) for t in texts]
        assert any(want)
        for part, short in ((1 << 17, 1024), (200, 6)):
            monkeypatch.setattr(pii, "PART", part)
            monkeypatch.setattr(pii, "SHORT", short)
            assert pii.crf_spans(texts, wild) == want


def test_spans_far_from_digits_and_key_words(spark):
    table = "agent {code:XQZZK} reports\nthe agent {code:BRRTV} is here\nan agent {code:KLMPS}, they say\nan agent of the firm\nthe agent came late\nTHE END"
    text = "much was said before that, and then " * 20 + "our agent WRTKL came by the mill"
    assert not list(pii.stretches(text))
    (row,) = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string"), pii.labelled_rows(table)).collect()
    assert row["spans"] == f"code:{text.index('WRTKL')}:{text.index('WRTKL') + 5}" and row["n_added"] == 1


def test_added_spans_lie_apart():
    rng = np.random.default_rng(5)
    for _ in range(200):
        added = sorted({("x", int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, 8), rng.integers(1, 9, 8), strict=True)}, key=lambda s: (s[1], s[2]))
        base = [("ip", int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, 4), rng.integers(1, 12, 4), strict=True)]
        want = []
        for s in added:
            if not any(s[1] < b and a < s[2] for _, a, b in [*base, *want]):
                want.append(s)
        assert pii.apart(added, base) == want


# --- licences


def test_licences(spark, docs, no_docs):
    texts = [
        "Under the MIT License. mit-license MIT\nLICENSE", "GNU General Public License, gnu general public; CC BY CC-BY 4.0 ccby", "Apache License 2.0 and the Mozilla Public License",
        "Permission is hereby granted, free of charge, to any person getting a copy of this software", "Permission was hereby granted, free of charge, to any person obtaining a copy of this software",
        "license", "", None, "x" * 100_000, "gnu lesser general public license",
    ]
    out = {r["doc_id"]: r for r in licenses.scan_licenses(clashing(docs.select("doc_id", "text").unionByName(spark.createDataFrame([(400 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")))).collect()}
    got = [(out[400 + i]["n_base"], out[400 + i]["first_word"], out[400 + i]["last_word"], out[400 + i]["base_labels"], out[400 + i]["labels"]) for i in range(len(texts))]
    assert got == [(3, 2, 6, "mit", "mit"), (3, 0, 9, "cc-by,gpl", "cc-by,gpl"), (1, 0, 0, "apache", "apache,mpl"), (0, None, None, "", "mit"), (0, None, None, "", ""), (0, None, None, "", ""), (0, None, None, "", ""), (0, None, None, "", ""), (0, None, None, "", ""), (0, None, None, "", "lgpl")]
    assert out[400]["n_words"] == 8 and out[400]["score"] == 1.0 and out[406]["n_words"] == 0
    assert licenses.scan_licenses(no_docs).count() == 0


def plain_licences(t: str, templates) -> set:
    """(label, start, agreed) by trying every place of every template."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    out = set()
    for x in templates:
        for s in range(len(w)):
            agreed = sum(s + j < len(w) and w[s + j] == y for j, y in enumerate(x.words))
            if agreed >= x.needed and all(tuple(w[s + o : s + o + len(k)]) == k for o, k in x.key_offsets()):
                out.add((x.label, s, agreed / len(x.words)))
    return out


def test_altered_licence_texts(spark):
    rng = np.random.default_rng(9)
    texts = []
    for i, x in enumerate(licenses.MORE * 3):
        w = list(x.words)
        for j in rng.choice(len(w), int(rng.integers(0, x.may_miss + 2)), replace=False):
            w[j] = "software" if i % 2 else "other"
        texts.append(" ".join(["the license of"] * int(rng.integers(0, 3)) + w + ["any"] * 5))
    texts.append("permission is hereby granted to the software as is " * 2000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = 0
    for r in licenses.scan_licenses(docs).collect():
        want = plain_licences(texts[r["doc_id"]], (*licenses.BASE, *licenses.MORE))
        assert r["labels"] == ",".join(sorted({x for x, *_ in want})) and r["score"] == max((a for *_, a in want), default=0)
        base = plain_licences(texts[r["doc_id"]], licenses.BASE)
        assert (r["n_base"], r["first_word"], r["last_word"]) == (len(base), min((s for _, s, _ in base), default=None), max((s for _, s, _ in base), default=None))
        found += r["labels"] != ""
    assert found > 40


def test_hundreds_of_templates(spark):
    rng = np.random.default_rng(3)
    many = tuple(licenses.template(f"l{i}", " ".join(f"w{x}" for x in rng.integers(0, 3000, 120)), 0.8) for i in range(300))
    docs = spark.createDataFrame([(i, "x " + " ".join(many[i * 7].words[: 120 - i]) + " y") for i in range(30)], "doc_id long, text string")
    out = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(docs, licenses.BASE, many).collect()}
    assert out == {i: f"l{i * 7}" if 120 - i >= 96 else "" for i in range(30)}

"""Language identification by cross-parsing entropy (op 6).

For each language a suffix automaton is built from labelled text.  A text is
parsed greedily into the longest phrases that occur in that training text; the
fewer phrases for each character, the lower the cross entropy.  The language
with the fewest phrases wins.

Only the automata are fitted on a bounded sample: for each label the
``train_texts`` training rows of smallest hash, ``train_chars`` characters of
them in all, or fewer where many labels or letters would make the automata
larger than ``CELLS``; labels beyond the ``most_labels`` with the most training
rows are not learned.  Prediction covers every whole text, cut into segments of
``SEGMENT`` characters that are parsed side by side; a segment border ends a
phrase in all languages alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioscope.llm.textvec import batches

SEGMENT = 512
UNKNOWN = "und"
LETTER = r"\p{L}"
CELLS = 1 << 26  # transitions of all automata together: 256 MB
BRIEF = 32  # characters; what is shorter is rejected only for letters that no language has


class SuffixAutomaton:
    """All substrings of a code sequence, as a dense table of transitions."""

    def __init__(self, codes: np.ndarray, alphabet: int):
        follow: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in codes.tolist():
            new = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in follow[p]:
                follow[p][c] = new
                p = link[p]
            if p != -1:
                q = follow[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(follow)
                    follow.append(dict(follow[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and follow[p].get(c) == q:
                        follow[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.table = np.full((len(follow), alphabet), -1, np.int32)
        for state, edges in enumerate(follow):
            for c, to in edges.items():
                self.table[state, c] = to


def fold(text: str) -> str:
    """Lower case; runs of what is not a letter become one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class CrossParser:
    """Automata of several languages over one alphabet."""

    def __init__(self, samples: dict[str, str]):
        self.labels = sorted(samples)
        folded = {k: fold(v) for k, v in samples.items()}
        letters = sorted({c for v in folded.values() for c in v if ord(c) < 0x110000})
        self.codes = np.zeros(0x110000, np.uint8 if len(letters) < 254 else np.uint16)  # 0: a letter never seen
        for i, c in enumerate(letters):
            self.codes[ord(c)] = i + 1
        self.alphabet = len(letters) + 1
        each = max(1, CELLS // (2 * self.alphabet * max(1, len(folded))))  # characters; an automaton has up to twice as many states
        folded = {k: v[:each] for k, v in folded.items()}
        self.tables = [SuffixAutomaton(self.codes[np.frombuffer(folded[k].encode("utf-32-le"), np.uint32)], self.alphabet).table for k in self.labels]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(folded codes, lengths, number of letters, number of letters never seen) of whole texts."""
        joined = "\x00".join(texts).lower() + "\x00"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        codes = self.codes[points]
        end = points == 0
        space = self.codes[32]
        known = codes > 0
        letter = known & (codes != space)
        odd = np.flatnonzero(~known & ~end)  # not in the alphabet: a foreign letter, a digit or a mark
        if len(odd):
            kinds = np.unique(points[odd])
            foreign = kinds[np.array([chr(x).isalpha() for x in kinds.tolist()], bool)]
            letter[odd] = np.isin(points[odd], foreign)
        gap = ~letter & ~end
        codes = np.where(gap, space, codes)
        lead = np.ones(len(points), bool)  # a gap counts once, and not where a text begins
        lead[1:] = ~(gap[:-1] | end[:-1])
        keep = end | letter | (gap & lead)
        ends = np.flatnonzero(end[keep])
        size = np.diff(np.concatenate([[-1], ends])) - 1
        letters, unseen = (np.diff(np.concatenate([[0], np.cumsum(x)[np.flatnonzero(end)]]))[: len(texts)] for x in (letter, letter & ~known))
        return codes[keep & ~end], size[: len(texts)], letters, unseen

    def phrases(self, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases of each text for each language: array [texts, languages]."""
        first = np.concatenate([[0], np.cumsum(size)])
        pieces = -(-size // SEGMENT)
        text = np.repeat(np.arange(len(size)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = first[text] + nth * SEGMENT
        length = np.minimum(SEGMENT, first[text + 1] - begin)
        order = np.argsort(-length, kind="stable")  # the lanes that go on are always the first ones
        begin, length, text = begin[order], length[order], text[order]
        going = np.searchsorted(-length, -np.arange(SEGMENT), side="left")
        out = np.zeros((len(size), len(self.labels)), np.int64)
        for which, table in enumerate(self.tables):
            flat = table.ravel()
            state = np.zeros(len(begin), np.int32)
            count = np.zeros(len(begin), np.int32)
            for step in range(int(length[0]) if len(length) else 0):
                n = going[step]
                c = codes[begin[:n] + step]
                to = flat[state[:n] * np.int32(self.alphabet) + c]
                stop = np.flatnonzero(to < 0)
                again = flat[c[stop]]  # the phrase ends before this letter, which starts the next one
                count[stop] += (state[stop] > 0).astype(np.int32) + (again < 0)  # or is one, where it was never seen
                to[stop] = np.maximum(again, 0)
                state[:n] = to
            out[:, which] = np.bincount(text, weights=count + (state > 0), minlength=len(size)).astype(np.int64)
        return out


def training_sample(rows: DataFrame, train_texts: int, train_chars: int, most_labels: int = 1000) -> dict[str, str]:
    """Up to ``train_chars`` characters of each label from ``rows(doc_id, text, lang)``.

    The ``most_labels`` labels with the most rows are taken; of equal ones those
    that sort first.  The rows of smallest hash are taken: first all rows below
    a hash limit that leaves about four times as many as wanted, then the first
    of them, so that no label is ever gathered in one task."""
    each = max(1, train_chars // train_texts)
    rows = rows.where(F.col("lang").isNotNull())
    rows = rows.select("lang", "text", F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))), 1, 8), 16, 10).cast("long").alias("hash"))
    labels = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_labels)
    share = F.least(F.lit(1.0), F.lit(4.0 * train_texts) / F.col("count"))
    rows = rows.join(F.broadcast(labels.select("lang", (share * F.lit(float(1 << 32))).alias("limit"))), "lang")  # most_labels rows
    few = rows.where(F.col("hash") < F.col("limit")).where(F.col("text").rlike(LETTER)).select("lang", "hash", "text")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "text"))
    middle = F.greatest(F.lit(1), (F.length("text") / 2 - each).cast("int"))  # past headings and notices
    chosen = few.withColumn("rank", rank).where(F.col("rank") <= train_texts).select("lang", "rank", F.substring(F.col("text"), middle, F.lit(2 * each)).alias("part"))
    out: dict[str, list[str]] = {}
    for r in sorted(chosen.collect(), key=lambda r: (r["lang"], r["rank"])):  # at most train_texts rows for each label
        out.setdefault(r["lang"], []).append(r["part"])
    return {k: " ".join(v)[:train_chars] for k, v in out.items()}


def identify(docs: DataFrame, training: DataFrame, train_texts: int = 64, train_chars: int = 24_000, most_labels: int = 1000) -> DataFrame:
    """lang_pred, score and phrase_rate for each row of ``docs(doc_id, text)``.

    Returns doc_id, lang_pred, score, phrase_rate (phrases of the best language
    for each character).  score is 1 - best/second, the margin between the two
    best languages, or 1 with a single language.  A null text, a text without a
    letter, and every text where nothing could be learned get ``und``, score 0
    and a null rate.  Ties go to the label that sorts first.  The time of a text
    grows with the number of labels.  Very long texts are parsed whole.
    """
    samples = training_sample(training, train_texts, train_chars, most_labels)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(CrossParser(samples) if samples else None)  # train_chars for each label

    def predict(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        for batch in batches(it, "text", 2_000_000):
            texts = [t.replace("\x00", " ") for t in pc.fill_null(batch.column(1), "").to_pylist()]
            n = len(texts)
            label, score, rate = [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan)
            if parser is not None:
                codes, size, letters, _ = parser.encode(texts)
                found = parser.phrases(codes, size)
                best = found.argmin(axis=1)
                ordered = np.sort(found, axis=1)
                fine = (letters > 0) & (size > 0)
                second = ordered[:, 1] if found.shape[1] > 1 else np.full(n, np.inf)
                score = np.where(fine, 1 - ordered[:, 0] / np.maximum(second, 1), 0.0)
                rate = np.where(fine, ordered[:, 0] / np.maximum(size, 1), np.nan)
                label = [parser.labels[b] if ok else UNKNOWN for b, ok in zip(best, fine, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64(), from_pandas=True)], names=["doc_id", "lang_pred", "score", "phrase_rate"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(predict, "doc_id long, lang_pred string, score double, phrase_rate double")


def held_out(doc_id="doc_id"):
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op6_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, docs.where(~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "phrase_rate")


def keep_identified(docs: DataFrame, training: DataFrame, most_phrases: float = 0.75, **kwargs) -> DataFrame:
    """The rows of ``docs`` whose language could be told, unchanged.

    Rejected are ``und`` texts and texts that no learned language explains: more
    than ``most_phrases`` phrases for each character, which foreign scripts
    reach and prose in a learned language does not.  A text of less than
    ``BRIEF`` characters has too few for that, and is rejected only if it also
    has a letter that was never seen in training."""
    samples = training_sample(training, kwargs.get("train_texts", 64), kwargs.get("train_chars", 24_000), kwargs.get("most_labels", 1000))
    shared = docs.sparkSession.sparkContext.broadcast(CrossParser(samples) if samples else None)

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        parser = shared.value
        if parser is None:
            return pa.array(np.zeros(len(texts), bool))
        out = []
        for part in batches(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), "text", 2_000_000):  # only these are Python strings at once
            codes, length, letters, unseen = parser.encode([t.replace("\x00", " ") for t in pc.fill_null(part.column(0), "").to_pylist()])
            fewest = parser.phrases(codes, length).min(axis=1)
            brief = (length < BRIEF) & (unseen == 0)
            out.append((letters > 0) & (brief | (fewest <= most_phrases * np.maximum(length, 1))))
        return pa.array(np.concatenate([np.zeros(0, bool), *out]))

    return docs.where(known(F.col("text")))

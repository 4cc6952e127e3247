"""Benchmark decontamination by latent semantic retrieval (op 2).

Passages of all documents are TF-IDF rows over the words of the benchmark (those
that are not in a large share of its items).  A randomised SVD of that matrix is
computed in one distributed pass: each task multiplies its rows by a random sign
matrix and back, sums are integers and so exact in any order, and the driver
solves a problem of the size of the vocabulary (Nystroem form).  A second pass
projects overlapping windows, compares them with the items by cosine in the
latent space, and settles every candidate by its longest common subsequence of
words with the item, and for paraphrases by the item's answer.

A latent space of bounded rank keeps little of some items, so windows also become
candidates by rare words: of each item (or its answer) as many as may be missing
in a leak, and two more, so that a leak holds two of them.
No window that holds a leak is passed over, whatever its cosine.

The items are the stated query set.  They are taken in blocks of at most
``ITEMS``, so that what is broadcast has a bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.scratch import materialize
from folioscope.llm.textvec import K1, U64, batches, mix, words_of

ITEMS = 4000  # benchmark items in one broadcast
ITEM_WORDS = 100_000  # and their words: 65 MB of sums in the driver, 85 MB of tables in a task, at most
PASSAGE = 64  # words in a row of the matrix
RANK, OVERSAMPLE = 64, 16
LEAST_SCALE = 16
STEPS = 4  # windows begin at every quarter of their length
COSINE = 0.45
COPY = 0.8  # share of an item's words in common that makes a copy
PARAPHRASE = 0.6  # share that makes a paraphrase, where the answer agrees
ANSWER = 0.8
DENSE = 1 << 22  # cells of the table of item words; beyond it sorted pairs take its place
SEARCHED = 700_000  # bytes of text searched at once, so that window sums stay in the processor's caches
SHORT = 8  # items with fewer words must occur word for word
HITS = 1 << 20  # places of rare words looked at in one step


@dataclass
class Items:
    ids: list
    words: list[np.ndarray]  # word hashes
    answers: list[np.ndarray]


def answer_of(text: str) -> str:
    """The last line of a text of several lines, else its last quarter."""
    lines = [x for x in text.splitlines() if x.strip()]
    if len(lines) > 1:
        return lines[-1]
    words = text.split()
    return " ".join(words[-max(2, len(words) // 4) :])


def hashed(texts: list[str]) -> list[np.ndarray]:
    w = words_of(pa.array(texts, pa.string()), lower=True, plain=True)
    return np.split(w.hashes(), w.first[1:-1])


def read_items(rows: list) -> Items:
    texts = [r["text"] or "" for r in rows]
    return Items([r["item_id"] for r in rows], hashed(texts), hashed([answer_of(t) for t in texts]))


class Vocabulary:
    """Word hashes with numbers, looked up through their leading bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.begin = np.searchsorted(self.hashes >> U64(46), np.arange((1 << 18) + 1, dtype=np.uint64)).astype(np.int32)
        self.depth = int(np.diff(self.begin).max(initial=0))

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        out = np.full(len(words), -1, np.int32)
        if not len(self.hashes):
            return out
        at = self.begin[(words >> U64(46)).astype(np.int64)]
        for _ in range(self.depth):
            hit = self.hashes[np.minimum(at, len(self.hashes) - 1)] == words
            out[hit] = np.minimum(at, len(self.hashes) - 1)[hit]
            at = at + 1
        return out


def benchmark_vocabulary(items: Items, most: float = 0.1) -> Vocabulary:
    """Words of the items but for those in more than ``most`` of them."""
    each = [np.unique(w) for w in items.words if len(w)]
    if not each:
        return Vocabulary(np.zeros(0, np.uint64))
    words, count = np.unique(np.concatenate(each), return_counts=True)
    return Vocabulary(words[count <= max(3, most * len(items.ids))])


def signs(vocabulary: Vocabulary, columns: int) -> np.ndarray:
    """[words, columns] of -1 and 1, from the words alone."""
    cells = vocabulary.hashes[:, None] ^ mix((np.arange(1, columns + 1, dtype=np.uint64)) * K1)[None, :]
    return np.where(mix(cells) >> U64(63), 1, -1).astype(np.int8)


def spread(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut every text into runs of ``width`` words: (first run of each text, run of each word)."""
    size = np.diff(first)
    runs = -(-size // width)
    base = np.concatenate([[0], np.cumsum(runs)])
    text = np.repeat(np.arange(len(size)), size)
    return base, base[text] + (np.arange(first[-1]) - first[text]) // width


def corpus_sketch(docs: DataFrame, vocabulary: Vocabulary, columns: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(passages, passages with each word, T'T S) over all documents; T: word counts of passages, S: signs."""
    n_words = len(vocabulary.hashes)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, np.ascontiguousarray(signs(vocabulary, columns).T.astype(np.float32))))

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, sign = shared.value
        passages, df, total = 0, np.zeros(n_words, np.int64), np.zeros((n_words, columns), np.int64)
        for batch in batches(it, "text", 2_000_000):
            w = words_of(batch.column(0), lower=True, plain=True)
            number = vocab.numbers(w.hashes())
            base, run = spread(w.first, PASSAGE)
            passages += int(base[-1])
            known = np.flatnonzero(number >= 0)
            word, run = number[known], run[known]
            if not len(known):
                continue
            begin = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))  # passages with any known word
            of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(run))))
            seen = np.unique(of * n_words + word)
            df += np.bincount(seen % n_words, minlength=n_words)
            order = np.argsort(word.astype(np.uint16) if n_words < 1 << 16 else word, kind="stable")
            by_word, first_of = of[order], np.flatnonzero(np.diff(word[order], prepend=-1))
            named = word[order][first_of]
            for c in range(columns):  # whole numbers below 2^24: exact in single precision
                y = np.add.reduceat(sign[c][word], begin)
                total[named, c] += np.add.reduceat(y[by_word], first_of).astype(np.int64)
        live = np.flatnonzero(df)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(total[live].ravel()), columns).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(live.astype(np.int64)), pa.array(df[live]), lists], names=["word", "df", "back"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([passages], pa.int64()), pa.array([[0] * columns], pa.list_(pa.int64()))], names=["word", "df", "back"])

    parts = docs.select("text").mapInArrow(sketch, "word long, df long, back array<long>")
    summed = parts.groupBy("word").agg(F.sum("df").alias("df"), *(F.sum(F.col("back")[i]).alias(f"b{i}") for i in range(columns)))
    found = summed.toArrow()  # a row for each word of the vocabulary, ITEM_WORDS at most
    word, count = found["word"].to_numpy(), found["df"].to_numpy()
    df, back, real = np.zeros(n_words), np.zeros((n_words, columns)), word >= 0
    df[word[real]] = count[real]
    for i in range(columns):
        back[word[real], i] = found[f"b{i}"].to_numpy()[real]
    return int(count[~real].sum()), df, back


def latent_space(vocabulary: Vocabulary, passages: int, df: np.ndarray, back: np.ndarray, rank: int) -> np.ndarray:
    """[words, rank]: IDF times the leading right singular vectors of the TF-IDF matrix, whitened.

    Each direction is divided by its singular value; otherwise the few
    directions of frequent words would make every passage like every item.

    With A = T D (D: IDF) and the test matrix D^-1 S, A'A D^-1 S = D T'T S, and the
    Nystroem form of A'A needs nothing else."""
    sign = signs(vocabulary, back.shape[1]).astype(np.float64)
    idf = np.log((passages + 1) / (df + 1)) + 1e-3
    y = idf[:, None] * back
    core = sign.T @ back
    core = (core + core.T) / 2
    value, vector = np.linalg.eigh(core)
    good = value > 1e-9 * max(value.max(initial=0), 1e-300)
    if not good.any():
        return np.zeros((len(idf), 1), np.float32)
    half = y @ (vector[:, good] / np.sqrt(value[good]))
    u, s, _ = np.linalg.svd(half, full_matrices=False)
    rank = min(rank, int((s > 1e-6 * s[0]).sum()))
    return (idf[:, None] * u[:, :rank] * (s[0] / s[:rank])).astype(np.float32)


def common_subsequence(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``masks``: the places of each word in the item, as bits."""
    row = full = (1 << n) - 1
    for w in words:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def places(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def consecutive(item: list[int], words: list[int]) -> bool:
    n = len(item)
    return any(words[i : i + n] == item for i in range(len(words) - n + 1))


def scale_of(n: int) -> int:
    return max(LEAST_SCALE, 1 << (n - 1).bit_length())


@dataclass
class Probe:
    """Words of an item of which a leak holds ``least`` positions at least."""

    item: int
    words: list[int]
    repeated: list[bool]  # the word has several positions in the item
    least: int


def rarest(words: np.ndarray, missing: int, cost: np.ndarray) -> tuple[list[int], list[bool], int, float]:
    """The cheapest word numbers with two positions more than may be ``missing``, or as many as there are."""
    word, count = np.unique(words, return_counts=True)
    order = np.lexsort((word, cost[word]))
    word, count = word[order], count[order]
    upto = min(int(np.searchsorted(np.cumsum(count), missing + 2)) + 1, len(word))
    word, count = word[:upto], count[:upto]
    return word.tolist(), (count > 1).tolist(), min(2, int(count.sum()) - missing), float(cost[word].sum())


def probes_of(item: int, words: np.ndarray, answer: np.ndarray, cost: np.ndarray) -> list[Probe]:
    """Probes one of which is met by every leak: a copy, or a paraphrase with its answer. Words are numbers."""
    n, a = len(words), len(answer)
    copy, loose = (rarest(words, n + int(-share * n // 1), cost) for share in (COPY, PARAPHRASE))
    if a and np.isin(answer, words).all():
        sure = rarest(answer, a + int(-ANSWER * a // 1), cost)
        if copy[3] + sure[3] < loose[3]:
            return [Probe(item, *copy[:3]), Probe(item, *sure[:3])]
    return [Probe(item, *loose[:3])]


class Search:
    """Items in the latent space, and what is needed to settle candidates.

    ``df``: in how many passages each word of the vocabulary is; it orders the rare words and decides nothing."""

    def __init__(self, items: Items, vocabulary: Vocabulary, space: np.ndarray, df: np.ndarray | None = None):
        self.vocabulary, self.space, self.ids = vocabulary, np.ascontiguousarray(space.T.astype(np.float64)), items.ids
        self.all_words = Vocabulary(np.unique(np.concatenate([*items.words, np.zeros(0, np.uint64)])))
        self.words = [w.tolist() for w in items.words]
        self.masks = [places(w) for w in self.words]
        self.answers = [w.tolist() for w in items.answers]
        self.answer_masks = [places(w) for w in self.answers]
        blind: list[tuple[int, int]] = []  # (word, item): short items are looked for around one of their words
        self.by_scale: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        own: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, w in enumerate(items.words):
            number = vocabulary.numbers(w)
            z = space[number[number >= 0]].sum(0)
            if 0 < len(w) < SHORT:
                rare = w[number >= 0]
                blind.append((int(rare[0] if len(rare) else w[0]), i))
            elif z.any():  # items without a direction are left to their rare words
                own.setdefault(scale_of(len(w)), []).append((i, z / np.linalg.norm(z)))
        for scale, found in own.items():
            self.by_scale[scale] = np.array([i for i, _ in found]), np.array([z for _, z in found], np.float32)
        self.blind = Vocabulary(np.unique(np.array([w for w, _ in blind], np.uint64)))
        number = self.blind.numbers(np.array([w for w, _ in blind], np.uint64))
        self.blind_item = np.array([i for _, i in blind], np.int64)[np.argsort(number, kind="stable")]
        self.blind_begin = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(self.blind.hashes)))]).astype(np.int64)
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.need, each = np.zeros(len(self.words), np.int64), []
        for i, w in enumerate(items.words):
            each.append(np.sort(self.all_words.numbers(np.unique(w))).astype(np.int64))
            self.need[i] = -int(-PARAPHRASE * len(w) // 1) - (len(w) - len(each[i]))
        self.width = len(self.all_words.hashes) + 1
        chunks = max(1, -(-max(map(len, each), default=1) // 64))
        self.bits, self.pairs = None, None
        if len(each) * chunks * self.width <= DENSE:  # the places of each item's words, 64 to a number: [numbers, items x words]
            self.bits = np.zeros((chunks, len(each) * self.width), np.uint64)
            for i, number in enumerate(each):
                place = np.arange(len(number))
                self.bits[place // 64, i * self.width + number] = U64(1) << (place % 64).astype(np.uint64)
        else:  # (item, word) pairs, as one sorted array of numbers
            self.pairs = np.concatenate([i * self.width + number for i, number in enumerate(each)])
        number = vocabulary.numbers(self.all_words.hashes)
        cost = np.full(len(number), 1e12)  # words in many items
        cost[number >= 0] = 1 if df is None else df[number[number >= 0]] + 1
        probes = [p for i, w in enumerate(self.words) if len(w) >= SHORT for p in probes_of(i, self.all_words.numbers(items.words[i]), self.all_words.numbers(items.answers[i]), cost)]
        size = [len(p.words) for p in probes]
        self.probe_item = np.array([p.item for p in probes], np.int64)
        self.probe_least = np.array([p.least for p in probes], np.int64)
        self.item_scale = np.array([scale_of(max(1, len(w))) for w in self.words], np.int64)
        self.probe_scale = self.item_scale[self.probe_item]
        self.anchor_probe = np.repeat(np.arange(len(probes)), size)
        self.anchor_word = np.array([w for p in probes for w in p.words], np.int64)
        self.anchor_repeated = np.array([r for p in probes for r in p.repeated], bool)
        self.is_anchor = np.zeros(self.width, bool)  # the last place is that of unknown words
        self.is_anchor[self.anchor_word] = True

    def enough(self, item: np.ndarray, begin: np.ndarray, end: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Whether the words begin..end hold as many different words of the item as a leak needs."""
        out = np.zeros(len(item), bool)
        width = int((end - begin).max(initial=0))
        step = max(1, (1 << 18) // max(1, width))
        for at in range(0, len(item), step):
            part = slice(at, at + step)
            place = begin[part, None] + np.arange(width)[None, :]
            number = np.where(place < end[part, None], numbers[np.minimum(place, len(numbers) - 1)], -1)
            out[part] = self.different(item[part, None], number) >= self.need[item[part]]
        return out

    def plausible(self, text: np.ndarray, item: np.ndarray, begin: np.ndarray, low: np.ndarray, high: np.ndarray, end: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Which candidates may hold enough: up to four neighbours with one item are looked at as one stretch."""
        if not len(item):
            return np.zeros(0, np.int64)
        near = (text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (begin[1:] >= begin[:-1]) & (4 * (begin[1:] - begin[:-1]) <= end[1:] - begin[1:])
        first = np.flatnonzero(np.concatenate([[True], ~near]))
        nth = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        group = np.flatnonzero(nth % 4 == 0)
        size = np.diff(np.append(group, len(item)))
        low, high, item = np.minimum.reduceat(low, group), np.maximum.reduceat(high, group), item[group]
        fine = high - low >= self.need[item]
        fine[fine] = self.enough(item[fine], low[fine], high[fine], numbers)
        return np.flatnonzero(np.repeat(fine, size))

    def different(self, item: np.ndarray, number: np.ndarray) -> np.ndarray:
        """How many different words of the row's item are among the row's word numbers (-1: none)."""
        if self.bits is not None:
            at = item * self.width + number  # -1 meets the last, empty column of the item before
            return sum(np.bitwise_count(np.bitwise_or.reduce(bits.take(at), axis=1)).astype(np.int64) for bits in self.bits)
        key = item.astype(np.int64) * self.width + number
        found = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        found = np.sort(np.where((number >= 0) & (self.pairs[found] == key), found, -1), axis=1)
        new = found >= 0
        new[:, 1:] &= found[:, 1:] != found[:, :-1]
        return new.sum(1)

    def settle(self, item: int, words: list[int]) -> tuple[int, bool] | None:
        """(words in common, is the answer there), or None where the item is not in ``words``."""
        n = len(self.words[item])
        lcs = common_subsequence(self.masks[item], n, words)
        if n < SHORT:
            return (n, True) if lcs == n and consecutive(self.words[item], words) else None
        if lcs < PARAPHRASE * n:
            return None
        own = self.answers[item]
        answer = common_subsequence(self.answer_masks[item], len(own), words) >= ANSWER * len(own)
        return (lcs, answer) if answer or lcs >= COPY * n else None

    def windows(self, first: np.ndarray, known: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(scale, first run of each text, [directions, runs] sums of the window that begins at each run).

        The runs of a scale are pairs of the runs of the scale before it."""
        scale, largest = min(self.by_scale), max(self.by_scale)
        base, run = spread(first, scale // STEPS)
        n = int(base[-1])
        sums, run = np.empty((len(self.space), n), np.float32), run[known]
        for c, row in enumerate(self.space):
            sums[c] = np.bincount(run, weights=row[word], minlength=n)
        while True:
            local = np.arange(n) - np.repeat(base[:-1], np.diff(base))
            left = np.repeat(np.diff(base), np.diff(base)) - local  # runs up to the end of the text
            window = sums
            for shift in (1, 2):
                own = window.copy()
                own[:, : n - shift] += window[:, shift:] * (left[: n - shift] > shift).astype(np.float32)
                if shift == 1:
                    pairs = own
                window = own
            yield scale, base, window
            if scale == largest:
                return
            sums = pairs[:, local % 2 == 0]
            base = np.concatenate([[0], np.cumsum(-(-np.diff(base) // 2))])
            scale, n = 2 * scale, int(base[-1])

    def candidates(self, first: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, item, first word, end) of windows near an item in the latent space."""
        known = np.flatnonzero(number >= 0)
        if not len(known) or not self.by_scale:
            return
        for scale, base, window in self.windows(first, known, number[known]):
            if scale not in self.by_scale:
                continue
            own, z = self.by_scale[scale]
            size = np.linalg.norm(window, axis=0)
            limit = np.where(size > 1e-9, COSINE * size, np.inf)
            for low in range(0, len(size), 16384):
                col, row = np.nonzero(z @ window[:, low : low + 16384] >= limit[low : low + 16384])
                text = np.searchsorted(base, row + low, side="right") - 1
                begin = first[text] + (row + low - base[text]) * (scale // STEPS) - scale // 2
                yield text, own[col], begin, begin + 2 * scale

    def anchored(self, first: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, item, first word, end) of every window with the rare words that a leak of the item holds.

        The windows are those of ``candidates``."""
        at = np.flatnonzero(self.is_anchor[numbers])
        word = numbers[at]
        by_word = at[np.argsort(word, kind="stable")]
        count = np.bincount(word, minlength=self.width)
        begin = np.cumsum(count) - count
        live = np.flatnonzero(count[self.anchor_word])
        if not len(live):
            return
        size = count[self.anchor_word[live]]
        upto, cut = np.cumsum(size), np.flatnonzero(np.diff(self.anchor_probe[live], append=-1)) + 1  # ends of probes
        low = 0
        while low < len(live):
            fits = np.searchsorted(upto[cut - 1], (upto[low - 1] if low else 0) + HITS, side="right")
            high = int(max(cut[fits - 1] if fits else 0, cut[np.searchsorted(cut, low, side="right")]))
            own, n = live[low:high], size[low:high]
            pair = np.repeat(np.arange(low, high), n)
            place = by_word[np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[self.anchor_word[own]], n)]
            order = np.argsort(self.anchor_probe[live[pair]] * (len(numbers) + 1) + place)
            yield self.around(first, live[pair[order]], place[order])
            low = high

    def around(self, first: np.ndarray, anchor: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
        """The windows around enough ``place``s of a probe's words; the places of each probe are in order."""
        probe = self.anchor_probe[anchor]
        least, scale = self.probe_least[probe], self.probe_scale[probe]
        alone = np.flatnonzero(least < 2)
        two = (least[:-1] >= 2) & (probe[1:] == probe[:-1]) & (place[1:] - place[:-1] < 2 * scale[:-1])
        two = np.flatnonzero(two & ((anchor[1:] != anchor[:-1]) | self.anchor_repeated[anchor[1:]]))
        left, right, probe = np.concatenate([place[alone], place[two]]), np.concatenate([place[alone], place[two + 1]]), np.concatenate([probe[alone], probe[two]])
        text = np.searchsorted(first, left, side="right") - 1
        same = right < first[text + 1]
        left, right, probe, text = left[same], right[same], probe[same], text[same]
        step = self.probe_scale[probe] // STEPS
        run = ((right - first[text]) // step - 5)[:, None] + np.arange(8)[None, :]  # windows begin two steps before their run and are eight steps long
        fine = (run >= 0) & (run <= ((left - first[text]) // step + 2)[:, None]) & (run * step[:, None] < (first[text + 1] - first[text])[:, None])
        row, col = np.nonzero(fine)
        key = np.unique(self.probe_item[probe[row]] * (first[-1] + 1) + first[text[row]] + run[row, col])
        item, where = key // (first[-1] + 1), key % (first[-1] + 1)
        text = np.searchsorted(first, where, side="right") - 1
        scale = self.item_scale[item]
        start = first[text] + (where - first[text]) * (scale // STEPS) - scale // 2
        return text, item, start, start + 2 * scale

    def around_words(self, text: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, item, first word, end) around the word by which each short item is looked for; one look-up for all."""
        number = self.blind.numbers(hashes)
        at = np.flatnonzero(number >= 0)
        size = np.diff(self.blind_begin)[number[at]]
        step = max(1, HITS // int(size.max(initial=1)))
        for low in range(0, len(at), step):
            own, n = at[low : low + step], size[low : low + step]
            place = np.repeat(own, n)
            item = self.blind_item[np.repeat(self.blind_begin[number[own]], n) + np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)]
            yield text[place], item, place - self.length[item], place + self.length[item] + 1

    def leaks(self, w) -> dict[tuple[int, int], tuple[int, bool]]:
        """(text, item) -> (words in common, answer) of a batch of words."""
        hashes = w.hashes()
        found: dict[tuple[int, int], tuple[int, bool]] = {}
        numbers = self.all_words.numbers(hashes)
        before = np.concatenate([[0], np.cumsum(numbers >= 0)])  # words of any item before each word
        anchored = self.anchored(w.first.astype(np.int64), numbers)
        numbers = numbers[numbers >= 0].astype(np.int64)
        parts = list(self.candidates(w.first, self.vocabulary.numbers(hashes)))
        parts += self.around_words(w.text, hashes)
        for text, item, begin, end in chain(parts, anchored):
            begin, end = np.maximum(begin, w.first[text]), np.minimum(end, w.first[text + 1])
            low, high = before[begin], before[end]
            some = self.plausible(text, item, begin, low, high, end, numbers)
            hit = some[self.enough(item[some], low[some], high[some], numbers)]
            for t, i, a, b in zip(text[hit].tolist(), item[hit].tolist(), begin[hit].tolist(), end[hit].tolist(), strict=True):
                said = self.settle(i, hashes[a:b].tolist())
                if said and said > found.get((t, i), (-1, False)):
                    found[t, i] = said
        return found


def leaks_by_row(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, digest, item_id, common_words, item_words, share, answer) of each row that leaks; digest: SHA-256 of its text."""
    spark = docs.sparkSession
    size = benchmark.agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0))).alias("words")).first()
    blocks = max(1, -(-size["n"] // ITEMS), -(-(size["words"] or 0) // ITEM_WORDS))
    fields = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("item_id", pa.int64()), ("common_words", pa.int64()), ("item_words", pa.int64()), ("share", pa.float64()), ("answer", pa.bool_())])
    schema = "doc_id long, digest string, item_id long, common_words long, item_words long, share double, answer boolean"
    out = None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for block in range(blocks):
        own = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select(F.col("item_id").cast("long").alias("item_id"), "text")
        items = read_items(own.distinct().orderBy("item_id", "text").collect())  # about ITEMS rows at most
        if not any(len(w) for w in items.words):
            continue
        vocabulary = benchmark_vocabulary(items)
        space, df = np.zeros((len(vocabulary.hashes), 1), np.float32), None
        if len(vocabulary.hashes):
            passages, df, back = corpus_sketch(rows, vocabulary, RANK + OVERSAMPLE)
            space = latent_space(vocabulary, passages, df, back, RANK)
        shared = spark.sparkContext.broadcast(Search(items, vocabulary, space, df))

        def search(it: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            who = shared.value
            for batch in batches(it, "text", SEARCHED):
                found = [(t, i, c, a) for (t, i), (c, a) in who.leaks(words_of(batch.column(1), lower=True, plain=True)).items()]
                ids = batch.column(0).to_pylist() if found else []
                digest = {t: hashlib.sha256(batch.column(1)[t].as_py().encode()).hexdigest() for t in {f[0] for f in found}}
                said = [{"doc_id": ids[t], "digest": digest[t], "item_id": who.ids[i], "common_words": c, "item_words": len(who.words[i]), "share": c / len(who.words[i]), "answer": a} for t, i, c, a in found]
                yield pa.RecordBatch.from_pylist(said, fields)

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items in the rows of ``docs(doc_id, text)``; ``benchmark(item_id, text)``.

    Returns doc_id, item_id, common_words (longest common subsequence, in
    words), item_words, share, answer.  An item leaks where ``COPY`` of its
    words are in common with a stretch about twice its length, or
    ``PARAPHRASE`` of them and ``ANSWER`` of its answer's.  Null and empty texts
    and items leak nothing; an item shorter than ``SHORT`` words must occur word
    for word.  Rows that repeat a doc_id are joined into one result row.  Texts
    of any length are searched whole, one batch each where they are long.
    """
    best = F.max(F.struct("share", "common_words", "item_words", "answer")).alias("best")
    return leaks_by_row(docs, benchmark).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.common_words", "best.item_words", "best.share", "best.answer")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, unchanged.

    Each row is judged by its own text: rows that share a doc_id with a leaking
    row, or lack one as it does, stay where their own text is clean."""
    leaking = materialize(leaks_by_row(docs, benchmark).select(F.col("doc_id").alias("_leak"), F.col("digest").alias("_leak_text")).distinct(), "leaking")
    same = docs["doc_id"].cast("long").eqNullSafe(leaking["_leak"]) & (F.sha2(docs["text"], 256) == leaking["_leak_text"])
    return docs.join(leaking, same, "left_anti")


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

"""Words, word hashes and n-gram hashes of whole Arrow text columns, in numpy.

Texts are never turned into Python strings here: words are found and hashed on
the UTF-8 bytes of the Arrow buffer.  A word is ``[^\\x20\\x09-\\x0D]+``.  Hashes
have 64 bits, are the same on every machine, and depend on content only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
K1, K2, K3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
MARKS = np.zeros(256, dtype=bool)  # ASCII that is neither a letter nor a digit
MARKS[[x for x in range(128) if not chr(x).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place)."""
    x ^= x >> U64(30)
    x *= K2
    x ^= x >> U64(27)
    x *= K3
    x ^= x >> U64(31)
    return x


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null is the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


@dataclass
class Words:
    """The words of several texts, text after text."""

    buf: np.ndarray  # bytes of all texts, then eight zeros
    start: np.ndarray  # first byte of each word
    end: np.ndarray
    text: np.ndarray  # which text a word is in
    first: np.ndarray  # for each text its first word; one entry more at the end

    def hashes(self) -> np.ndarray:
        """One 64-bit hash for each word."""
        size = self.end - self.start
        out = size.astype(np.uint64) * K1
        loads = np.ndarray((max(0, len(self.buf) - 7),), dtype="<u8", buffer=self.buf, strides=(1,))
        left, at, who = size, self.start, None
        while len(left):
            part = loads[at] & MASKS[np.minimum(left, 8)]
            if who is None:
                out = mix(out ^ part)
            else:
                out[who] = mix((out[who] * K1) ^ part)
            more = np.flatnonzero(left > 8)
            who = more if who is None else who[more]
            left, at = left[more] - 8, at[more] + 8
        return out


def words_of(texts: pa.Array, lower: bool, plain: bool = False) -> Words:
    """``lower`` folds A-Z; ``plain`` also folds Latin-1 letters and breaks words at every ASCII mark."""
    buf, offsets = raw_bytes(texts)
    n = len(buf)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = LOWER[buf] if lower or plain else buf
    if plain and n:
        upper = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1
        padded[upper] += 0x20
    space = (MARKS if plain else SPACE)[buf]
    before, after = np.ones(n + 1, bool), np.ones(n + 1, bool)  # is the byte before or after a break?
    before[1:] = space
    after[: max(0, n - 1)] = space[1:]
    before[offsets[:-1]] = True
    ends = offsets[1:][offsets[1:] > 0]
    after[ends - 1] = True
    start = np.flatnonzero(before[:n] & ~space)
    end = np.flatnonzero(after[:n] & ~space) + 1
    first = np.searchsorted(start, offsets)
    return Words(padded, start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of words[i : i + k] for each i that has k words after it (texts are not told apart)."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    out, done, power, size = None, 0, words, 1
    while True:  # k as a sum of powers of two; a power twice as long from two of the last
        if k & size:
            part = power[done : done + len(words) - k + 1]
            out = part.copy() if out is None else mix(out * K1 + part)
            done += size
        size *= 2
        if size > k:
            return mix(out + U64(k))
        half = size // 2
        power = mix(power[: len(power) - half] * K1 + (power[half:] ^ K3))


def batches(it: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text is alone."""
    for batch in it:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        total, begin = np.cumsum(size.astype(np.int64)), 0
        while begin < len(size):
            base = total[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(total, base + most, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop

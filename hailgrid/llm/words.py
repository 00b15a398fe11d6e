"""Words of a column of texts as numpy arrays over their UTF-8 bytes.

Every function works on one slice of an Arrow batch, so memory depends on the
slice size and on the longest single text only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

#: Bytes 0x20 and 0x09-0x0D part words; everything else belongs to one.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True

#: ASCII bytes other than digits and lower-case letters part words.
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:0x80] = True
NON_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False

#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def random_odd(seed: int, count: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the bounds of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = texts.buffers()
    offsets = np.frombuffer(bounds, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    content = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return content, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Byte bounds of the words; ``first[k]:first[k + 1]`` are the words of text k."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def joined(self, at: int, to: int) -> bytes:
        """Words at:to with single spaces between them."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[at:to], self.end[at:to], strict=True))


def split_words(data: np.ndarray, offsets: np.ndarray, parting: np.ndarray) -> Words:
    inside = ~parting[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # a word never runs into the next text
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def word_hashes(words: Words, seed: int) -> np.ndarray:
    """A 64-bit polynomial hash of each word with a random value per byte."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    lengths = words.end - words.start
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    letters = words.data[np.repeat(words.start, lengths) + place]
    base = random_odd(seed, 1)[0]
    powers = np.cumprod(np.full(int(lengths.max()), base, np.uint64))
    hashed = np.add.reduceat(random_odd(seed + 1, 256)[letters] * powers[place], first)
    return mixed(hashed)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Rabin-Karp: the polynomial hash of every run of ``length`` words, modulo 2**64.

    One running sum gives all runs; the sum between two places is shifted back
    by the inverse power of the base, which exists as the base is odd.
    """
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.uint64)
    base = int(random_odd(seed, 1)[0])
    inverse = pow(base, -1, 2**64)
    up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))
    down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - length, inverse, np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    return (sums[length:] - sums[:-length]) * down


def window_starts(words: Words, length: int) -> np.ndarray:
    """Index of the first word of every run of ``length`` words inside one text."""
    counts = np.maximum(words.counts - length + 1, 0)
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(words.first[:-1] - before, counts)

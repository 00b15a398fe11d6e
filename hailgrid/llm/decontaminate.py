"""Benchmark decontamination by Wu-Manber search over word sequences.

A window is a run of benchmark words that must not occur in a document. The
symbols of the search are words. For windows of one length, a shift table tells
from the last words read how far the search may move without missing a window;
where the shift is zero, the bucket of that suffix, and in it of the words at
the front, lists the windows to compare, byte by byte.

The windows of an item overlap, so they are places in one line of its words
and not texts of their own: a table takes some 20 bytes a window and the line.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hailgrid.llm.scratch import stored
from hailgrid.llm.words import LOWER, NON_ALNUM, Words, mixed, slices, split_words, utf8, word_hashes

SEED = 71
TABLE_BITS = 20
LANE = 256
#: Benchmark text that one pass over the documents searches for, in bytes. Its tables take about seven times as much.
PASS_BYTES = 8 << 20


def lowered_words(texts: pa.Array) -> Words:
    data, offsets = utf8(texts)
    return split_words(LOWER[data], offsets, NON_ALNUM)


def block_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for the ``size`` words that end at each place (places before that are meaningless)."""
    if size == 1 or not len(hashes):
        return hashes
    keys = hashes.copy()
    keys[1:] += hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)
    return keys


@dataclass
class Line:
    """Words of several texts, one blank between two words, and where each word starts and ends."""

    data: bytes
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, words: Words) -> Line:
        lengths = words.end - words.start
        start = np.cumsum(lengths + 1) - lengths - 1
        data = bytearray(b" ") * int((lengths + 1).sum())
        for at, a, b in zip(start.tolist(), words.start.tolist(), words.end.tolist(), strict=True):
            data[at : at + b - a] = words.data[a:b].tobytes()
        return cls(bytes(data), start.astype(np.int32), (start + lengths).astype(np.int32))


def hashes_in_parts(words: Words, part: int = 1 << 16) -> np.ndarray:
    """Hashes of all words, with the working memory of ``part`` words."""
    parts = [Words(words.data, words.start[k : k + part], words.end[k : k + part], words.first) for k in range(0, len(words.start), part)]
    return np.concatenate([np.zeros(0, np.uint64), *(word_hashes(p, SEED) for p in parts)])


@dataclass
class WindowTables:
    """Wu-Manber tables for the windows of one length."""

    length: int
    block: int
    shift: np.ndarray  # by the low bits of a block's hash
    buckets: np.ndarray  # hash of the suffix block and the first block of each window, in order
    first: np.ndarray  # first word of each window, in that order
    line: Line
    item: np.ndarray  # of each window, in that order
    names: list[str]

    @classmethod
    def build(cls, length: int, first: np.ndarray, item: np.ndarray, hashes: np.ndarray, line: Line, names: list[str]) -> WindowTables:
        """``first`` and ``item`` of every window; ``hashes`` of all words of the line."""
        block = min(2, length)
        keys = block_keys(hashes, block)
        slots = (keys & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int32)
        shift = np.full(1 << TABLE_BITS, length - block + 1, np.uint8 if length < 200 else np.int64)
        for place in range(block - 1, length):
            np.minimum.at(shift, slots[first + place], length - 1 - place)
        buckets = joint(keys, first + length - 1, length, block)
        order = np.argsort(buckets, kind="stable")
        return cls(length, block, shift, buckets[order], first[order].astype(np.int32), line, item[order].astype(np.int32), names)

    def search(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, str]]:
        """The first word and the item of every occurrence.

        Texts are cut into lanes of some hundred end places, which all move at
        once; a lane only bounds where a window may end, not what it may cover.
        """
        keys = block_keys(hashes, self.block)
        shifts = self.shift[(keys & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)]
        first, last = words.first[:-1] + self.length - 1, words.first[1:]
        lanes = np.maximum(-(-(last - first) // LANE), 0)
        begin = np.repeat(first - (np.cumsum(lanes) - lanes) * LANE, lanes) + np.arange(int(lanes.sum())) * LANE
        stop = np.minimum(begin + LANE, np.repeat(last, lanes))
        found = []
        while len(begin):
            step = shifts[begin].astype(np.int64)
            found.append(begin[step == 0])
            begin = begin + np.maximum(step, 1)
            on = begin < stop
            begin, stop = begin[on], stop[on]
        ends = np.concatenate(found) if found else np.zeros(0, np.int64)
        wanted = joint(keys, ends, self.length, self.block)
        low, high = (np.searchsorted(self.buckets, wanted, side) for side in ("left", "right"))
        line = self.line
        for k in np.flatnonzero(low < high).tolist():
            at = int(ends[k]) - self.length + 1
            text = words.joined(at, at + self.length)
            for n in range(int(low[k]), int(high[k])):
                a = int(self.first[n])
                if line.data[line.start[a] : line.end[a + self.length - 1]] == text:
                    yield at, self.names[self.item[n]]


def joint(keys: np.ndarray, ends: np.ndarray, length: int, block: int) -> np.ndarray:
    """One hash for the suffix block and the first block of windows that end at these places."""
    return mixed(keys[ends]) + keys[ends - length + block]


def window_tables(items: Iterable[tuple[str, str]], length: int) -> list[WindowTables]:
    """Tables by window length: ``length`` words, or all words of a shorter item."""
    names, texts = zip(*items, strict=True) if (items := list(items)) else ((), ())
    words = lowered_words(pa.array(texts, pa.string()))
    line, hashes = Line.of(words), hashes_in_parts(words)
    sizes = np.minimum(words.counts, length)
    out = []
    for size in np.unique(sizes[sizes > 0]).tolist():
        own = np.flatnonzero(sizes == size)
        number = words.counts[own] - size + 1
        item = np.repeat(own, number)
        first = np.repeat(words.first[own] - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))
        out.append(WindowTables.build(size, first, item, hashes, line, list(names)))
    return out


def scan(texts: pa.Array, tables: list[WindowTables]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """For each text: its number of words, the word runs that are hit (merged), and the items found."""
    words = lowered_words(texts)
    hashes = word_hashes(words, SEED)
    edge = np.zeros(len(words.start) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(len(texts))]
    for table in tables:
        for at, found in table.search(words, hashes):
            edge[at] += 1
            edge[at + table.length] -= 1
            items[int(np.searchsorted(words.first, at, "right")) - 1].add(found)
    runs: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    if edge.any():
        hit = np.cumsum(edge)[:-1] > 0
        for k in [k for k, x in enumerate(items) if x]:
            own = np.flatnonzero(np.diff(np.concatenate([[0], hit[words.first[k] : words.first[k + 1]], [0]])))
            runs[k] = list(zip(own[::2].tolist(), own[1::2].tolist(), strict=True))
    return words.counts, runs, items


RUNS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
OUT = "doc_id long, text string, n_words long, hit_words array<struct<start:int,stop:int>>, items array<string>"


def search_pass(docs: DataFrame, tables: list[WindowTables]) -> DataFrame:
    """One pass over the documents; finds of earlier passes are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, runs, items = scan(batch.column("text"), shared.value)
            if "items" in batch.schema.names:
                runs = [merged(a, [(x["start"], x["stop"]) for x in b]) for a, b in zip(runs, batch.column("hit_words").to_pylist(), strict=True)]
                items = [a | set(b) for a, b in zip(items, batch.column("items").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array(counts, pa.int64()),
                    pa.array([[{"start": a, "stop": b} for a, b in x] for x in runs], RUNS),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                names=["doc_id", "text", "n_words", "hit_words", "items"],
            )

    return docs.mapInArrow(find, OUT)


def merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(a + b):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def passes(benchmark: DataFrame, length: int, pass_bytes: int) -> Iterator[list[WindowTables]]:
    """Tables for one part of the benchmark after the other, each of about ``pass_bytes`` of text."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // pass_bytes) or 1
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    for k in range(count):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).collect()
        yield window_tables([(r["item"] or "", r["text"]) for r in part], length)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, length: int = 10, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Every occurrence of a benchmark window in the documents.

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored.
    Returns doc_id, text, n_words, hit_words (merged runs of word numbers, stop
    exclusive) and items (ids as strings, sorted as strings), one row per row of
    ``docs``, in one scan without a shuffle. Null or empty texts have no words,
    null items are skipped, repeated rows give repeated rows, and an empty
    benchmark hits nothing; no documents give no rows. Texts are read whole, in
    slices of about 2 MB; a longer one stands alone.

    The driver and every worker hold the tables of ``pass_bytes`` of benchmark
    text, some seven times that. A larger benchmark is searched in several
    passes; each ends in a table in the shared folder, so no task ever holds the
    tables of two.
    """
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for k, tables in enumerate(passes(benchmark, length, pass_bytes)):
        out = search_pass(stored(out, "hits") if k else out, tables)
    return out


def uncontaminated(docs: DataFrame, benchmark: DataFrame, length: int = 10, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The rows of ``docs``, with all columns, in which no benchmark window occurs.

    Null, empty and wordless texts stay, repeated rows stay or go together, and
    an empty benchmark keeps all. Passes are as in ``benchmark_hits``.
    """

    def clean(tables: list[WindowTables]):
        shared = docs.sparkSession.sparkContext.broadcast(tables)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                _, _, items = scan(batch.column("text"), shared.value)
                yield batch.filter(pa.array([not x for x in items], pa.bool_()))

        return keep

    out = docs
    for k, tables in enumerate(passes(benchmark, length, pass_bytes)):
        out = (stored(out, "uncontaminated") if k else out).mapInArrow(clean(tables), docs.schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """Digest per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = benchmark_hits(docs, benchmark, length)
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, x: n + (x["stop"] - x["start"]))
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )

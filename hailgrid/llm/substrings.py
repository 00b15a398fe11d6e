"""Substring dedup: repeated word windows, found by Rabin-Karp hashes counted in Spark.

Documents are dealt by hash into slices of about 2 MB of text. A slice sends
each distinct hash once, with a mark if it holds it several times, packed into
one binary value per counting bucket. A bucket answers with one bit per hash:
whether it occurs again anywhere. So a window that a third of all documents
share costs one entry per slice, and a window costs little more than its hash.
There are as many buckets as the bytes of text call for, one to a task, and a
fixed number of slices to a task, so no task grows with the corpus.

Only windows that may repeat are sent. The words of a window choose an anchor,
the short run of words with the smallest hash in it. Equal windows choose equal
anchors at different places, so a window whose anchor occurs once in the corpus
occurs once itself: this is exact and drops no window that repeats. Anchors are
counted first, in the same way; there are some 10 to 14 times fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hailgrid.llm.words import BLANKS, Words, mixed, rolling, slices, split_words, utf8, window_starts, word_hashes

SEEDS = (101, 202)
ANCHOR_SEED = 303
#: Words of an anchor, at most; a small window has anchors of half its size.
ANCHOR_WORDS = 8
#: Text of a slice, on average, in bytes, and its documents.
SLICE_BYTES = 2 << 20
SLICE_ROWS = 4096
#: Slices of a task.
SLICES = 4
#: Hashes that a bucket gets if every word starts a window to count, and a word and its blank take four bytes.
BUCKET_BYTES = 32 << 20
WORD_BYTES = 4

SENT = "bucket int, slice int, hashes binary, several binary"
ANSWER = "slice int, bucket int, again binary"


def blank_words(texts: pa.Array) -> Words:
    data, offsets = utf8(texts)
    return split_words(data, offsets, BLANKS)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every ``width`` neighbours, the leftmost one on ties."""
    best, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        n = len(best) - step
        later = best[step:] < best[:n]
        best, place = np.where(later, best[step:], best[:n]), np.where(later, place[step:], place[:n])
        have += step
    return place


def window_anchors(words: Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, the place of each window's anchor, and the run hash at every place."""
    starts = window_starts(words, window)
    size = min(ANCHOR_WORDS, -(-window // 2))
    values = mixed(rolling(hashes, size, ANCHOR_SEED))
    return starts, leftmost_least(values, window - size + 1)[starts] if len(starts) else starts, values


class Part:
    """Windows of a few documents of a slice."""

    def __init__(self, texts: pa.Array, window: int) -> None:
        self.words = blank_words(texts)
        self.hashes = word_hashes(self.words, SEEDS[0])
        self.window = window
        self.starts, self.places, self.values = window_anchors(self.words, self.hashes, window)

    def anchors(self) -> np.ndarray:
        """One hash for each distinct anchor place."""
        if not len(self.places):
            return np.zeros((0, 1), np.uint64)
        return self.values[self.places[np.concatenate([[True], self.places[1:] != self.places[:-1]])]].reshape(-1, 1)

    def candidates(self, again: np.ndarray) -> np.ndarray:
        """First words of the windows whose anchor occurs again."""
        return self.starts[np.isin(self.values[self.places], again)] if len(self.starts) else self.starts

    def window_hashes(self, starts: np.ndarray) -> np.ndarray:
        """Two independent Rabin-Karp hashes of each window, 128 bits together."""
        if not len(starts):
            return np.zeros((0, 2), np.uint64)
        other = word_hashes(self.words, SEEDS[1])
        return np.stack([rolling(h, self.window, s)[starts] for h, s in zip((self.hashes, other), SEEDS, strict=True)], axis=1)


def parts(table: pa.Table, window: int) -> Iterator[tuple[pa.RecordBatch, Part]]:
    for batch in slices(iter(table.combine_chunks().to_batches())):
        yield batch, Part(batch.column("text"), window)


def doubled(table: pa.Table) -> pa.Table:
    """A row that stands for several twice, so that none of its windows is alone."""
    copies = table.column("copies").to_numpy()
    return table.take(np.repeat(np.arange(len(copies)), np.minimum(copies, 2))) if (copies > 1).any() else table


def distinct(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows ordered by bucket, whether each occurs several times, and their buckets."""
    bucket = (hashes[:, 0] % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((*hashes.T[::-1], bucket))
    hashes, bucket = hashes[order], bucket[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]).any(axis=1)
    at = np.flatnonzero(first)
    return hashes[at], np.diff(np.append(at, len(hashes))) > 1, bucket[at]


def sent(slice_id: int, hashes: np.ndarray, buckets: int) -> pa.Table:
    hashes, several, bucket = distinct(hashes, buckets)
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    stop = np.append(at[1:], len(bucket))
    return pa.table(
        {
            "bucket": pa.array(bucket[at], pa.int32()),
            "slice": pa.array(np.full(len(at), slice_id), pa.int32()),
            "hashes": pa.array([hashes[a:b].tobytes() for a, b in zip(at, stop, strict=False)], pa.binary()),
            "several": pa.array([np.packbits(several[a:b]).tobytes() for a, b in zip(at, stop, strict=False)], pa.binary()),
        }
    )


def answered(sent_hashes: DataFrame, width: int, buckets: int) -> DataFrame:
    """For every bucket, in a task of its own: which of the hashes of each slice occur several times or in another slice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := list(batches)):
            return
        table = pa.Table.from_batches(held)
        blobs = [np.frombuffer(x, np.uint64).reshape(-1, width) for x in table.column("hashes").to_pylist()]
        sizes = np.array([len(x) for x in blobs])
        hashes = np.concatenate(blobs)
        several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table.column("several").to_pylist(), sizes, strict=True)])
        order = np.lexsort(hashes.T[::-1])
        ranked = hashes[order]
        first = np.ones(len(ranked), bool)
        first[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
        at = np.flatnonzero(first)
        size = np.diff(np.append(at, len(ranked)))
        again = np.empty(len(ranked), bool)
        again[order] = np.repeat((size > 1) | (np.add.reduceat(several[order].astype(np.int64), at) > 0), size)
        ends = np.cumsum(sizes)
        bits = pa.array([np.packbits(again[b - n : b]).tobytes() for b, n in zip(ends, sizes, strict=True)], pa.binary())
        yield from pa.table({"slice": table.column("slice"), "bucket": table.column("bucket"), "again": bits}).to_batches()

    return sent_hashes.repartitionById(buckets, "bucket").mapInArrow(count, ANSWER)


def marked(hashes: np.ndarray, answer: list[dict], buckets: int) -> np.ndarray:
    """The distinct hashes of a slice that occur again, from the answers of all buckets."""
    hashes, _, bucket = distinct(hashes, buckets)
    sizes = dict(zip(*np.unique(bucket, return_counts=True), strict=True))
    bits = [np.unpackbits(np.frombuffer(x["again"], np.uint8), count=sizes[x["bucket"]]) for x in sorted(answer, key=lambda x: x["bucket"])]
    return hashes[np.concatenate(bits).astype(bool)] if bits else hashes[:0]


def among(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which rows of ``hashes`` (two columns) are rows of ``wanted``."""
    pair = np.dtype([("a", np.uint64), ("b", np.uint64)])
    view = lambda x: np.ascontiguousarray(x).view(pair).reshape(-1)
    known = np.sort(view(wanted))
    if not len(known) or not len(hashes):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(known["a"], hashes[:, 0])
    out = np.zeros(len(hashes), bool)
    # equal first halves are next to each other; almost always there is one
    live = np.flatnonzero((at < len(known)) & (known["a"][np.minimum(at, len(known) - 1)] == hashes[:, 0]))
    while len(live):
        same = known["b"][at[live]] == hashes[live, 1]
        out[live[same]] = True
        live = live[~same]
        at[live] += 1
        live = live[at[live] < len(known)]
        live = live[known["a"][at[live]] == hashes[live, 0]]
    return out


def repeated_windows(
    docs: DataFrame, window: int = 35, slice_rows: int = SLICE_ROWS, slice_bytes: int = SLICE_BYTES, buckets: int | None = None
) -> DataFrame:
    """The maximal runs of words that repeated windows cover, and the text without them.

    docs: doc_id, text; other columns are ignored, whatever their names. A
    window is ``window`` words (parted by ASCII blanks) of one row; it repeats if
    its words start anywhere else, in the same row or another one. Returns
    doc_id, n_words, n_removed, removed (array of start, stop: word numbers, stop
    exclusive, merged, so maximal) and kept (the other words joined by one
    space), one row per row of ``docs``. Null, empty and short texts lose
    nothing; no rows give no rows. Rows alike in id and text are documents of
    their own, so each loses all windows; they travel as one row with their
    number. Windows are judged on the input. A slice holds ``slice_bytes`` of
    text on average, and any one text is whole in it. The texts are shuffled
    once (and once more before if there are rows alike); that exchange serves
    all three steps.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # one scan for the size of the table and whether rows are alike
    each = rows.groupBy("doc_id", F.xxhash64("text")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    n_rows, size, most = (x or 0 for x in each.agg(F.sum("n"), F.sum("size"), F.max("n")).first())
    n_slices = max(-(-n_rows // slice_rows), -(-size // slice_bytes), 1)
    buckets = buckets or max(-(-size // WORD_BYTES * 16 // BUCKET_BYTES), 1)
    folded = most > 1
    rows = rows.groupBy("doc_id", "text").agg(F.count("*").alias("copies")) if folded else rows.withColumn("copies", F.lit(1).cast("long"))
    # a slice number says which task it goes to; grouping by it moves nothing more
    tasks = -(-n_slices // SLICES)
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_slices)).cast("int").alias("slice")
    dealt = rows.select(number, "doc_id", "text", "copies").repartitionById(tasks, "slice")

    def send_anchors(key: tuple, table: pa.Table) -> pa.Table:
        found = [part.anchors() for _, part in parts(doubled(table), window)]
        return sent(key[0].as_py(), np.concatenate(found), buckets)

    def candidates(table: pa.Table, answer: list[dict]) -> Iterator[tuple[pa.RecordBatch, Part, np.ndarray, np.ndarray]]:
        again = marked(np.concatenate([p.anchors() for _, p in parts(table, window)]), answer, buckets)[:, 0] if answer else np.zeros(0, np.uint64)
        for batch, part in parts(table, window):
            starts = part.candidates(again)
            yield batch, part, starts, part.window_hashes(starts)

    def send_windows(key: tuple, table: pa.Table, answer: pa.Table) -> pa.Table:
        found = [h for *_, h in candidates(doubled(table), answer.to_pylist())]
        return sent(key[0].as_py(), np.concatenate(found) if found else np.zeros((0, 2), np.uint64), buckets)

    def cut(table: pa.Table, answer: pa.Table) -> pa.Table:
        told = answer.to_pylist()
        on_anchors = [x for x in told if not x["windows"]]
        on_windows = [x for x in told if x["windows"]]
        found = list(candidates(table, on_anchors))
        again = marked(np.concatenate([h for *_, h in found]), on_windows, buckets)
        out = []
        for batch, part, starts, hashes in found:
            edge = np.zeros(len(part.words.start) + 1, np.int64)
            starts = starts[among(hashes, again)]
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + window, -1)
            out.append(without(batch, part.words, np.cumsum(edge)[:-1] > 0))
        return pa.Table.from_batches(out)

    def by_slice(answers: DataFrame):
        return answers.repartitionById(tasks, "slice").groupBy("slice")

    anchor_answers = answered(dealt.groupBy("slice").applyInArrow(send_anchors, SENT), 1, buckets)
    window_answers = answered(dealt.groupBy("slice").cogroup(by_slice(anchor_answers)).applyInArrow(send_windows, SENT), 2, buckets)
    told = anchor_answers.withColumn("windows", F.lit(False)).union(window_answers.withColumn("windows", F.lit(True)))
    columns = "doc_id long, n_words long, n_removed long, removed array<struct<start:int,stop:int>>, kept string"
    out = dealt.groupBy("slice").cogroup(by_slice(told)).applyInArrow(cut, f"{columns}, copies long")
    whole = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))) if folded else out
    return whole.drop("copies", "copy")


def without(batch: pa.RecordBatch, words: Words, gone: np.ndarray) -> pa.RecordBatch:
    runs, kept, removed = [], [], []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        own = gone[a:b]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]]))) if own.any() else np.zeros(0, np.int64)
        runs.append([{"start": s, "stop": e} for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
        stay = a + np.flatnonzero(~own)
        kept.append(b" ".join(words.data[s:e].tobytes() for s, e in zip(words.start[stay].tolist(), words.end[stay].tolist(), strict=True)))
        removed.append(int(own.sum()))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(words.counts, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
            pa.array(kept, pa.binary()).cast(pa.string()),
            batch.column("copies"),
        ],
        names=["doc_id", "n_words", "n_removed", "removed", "kept", "copies"],
    )


def substring_digest(docs: DataFrame, window: int = 35) -> DataFrame:
    return repeated_windows(docs, window).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

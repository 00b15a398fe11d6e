"""Target-distribution importance resampling: the documents most like a target sample, with noise.

Texts are bags of hashed word runs. A bucket's gain is the logarithm of how much
more frequent it is in the target than in the corpus; a document's weight is the
mean gain of its features, and its score the weight with Gumbel noise, so that
taking the highest scores is drawing without replacement in proportion to the
weights. Both are computed on arrays, one slice of texts at a time.

The cutoff is found by weighted median of medians. Every part of the remaining
keys tells its size and its median; the median of these medians, weighted by
the sizes, has at least a quarter of the keys on either side, so counting the
keys above it discards a quarter at least and mostly about half. What remains is
written down whenever it has become much less. The last few thousand keys give
the exact cutoff; only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from hailgrid.llm.scratch import partitions, stored
from hailgrid.llm.words import LOWER, NON_ALNUM

BUCKETS = 10_000
RUN = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Keys of one part, whose median is taken in memory.
PART = 1 << 20
#: Remaining keys that the driver takes to find the exact cutoff.
LAST = 4096
#: Remaining keys are written anew when they are at most this share of those last written.
SHRUNK = 1 / 8

#: A-Z to a-z, bytes that part words to blanks.
_WORDS = bytes(np.where(NON_ALNUM[LOWER], 0x20, LOWER).astype(np.uint8))


def feature_buckets(text: str | None, run: int = RUN, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``run`` consecutive words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    if not words:
        return 0, np.zeros(0, np.int64)
    spaced = [b" " + w for w in words]
    found = [list(map(crc32, words))]
    for n in range(1, run):
        # the checksum of a run, continued over a blank and the next word
        found.append(list(map(crc32, spaced[n:], found[-1])))
    return len(words), np.concatenate([np.array(x, np.uint32) for x in found]).astype(np.int64) % buckets


def bucket_counts(texts: DataFrame, run: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket, as exact whole numbers; the driver gets one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                total += np.bincount(feature_buckets(text.as_py(), run, buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    out = np.zeros(buckets, np.int64)
    for r in rows.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(ratio)) of the smoothed shares of each bucket."""
    width, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratios = [float(t + 1) * float(s_all + width) / (float(s + 1) * float(t_all + width)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """1000 times standard Gumbel noise, rounded down, from a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def scores(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document, in one scan after the counts."""
    gains = bucket_gains(bucket_counts(docs, run, buckets), bucket_counts(target, run, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            words, features, sums = (np.zeros(len(ids), np.int64) for _ in range(3))
            for k, text in enumerate(batch.column("text")):
                words[k], own = feature_buckets(text.as_py(), run, buckets)
                features[k], sums[k] = len(own), shared.value[own].sum()
            weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
            noise = np.array([gumbel(i, seed) for i in ids], np.int64)
            columns = [pa.array(x) for x in (words, features, weight, weight + noise)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, SCORED)


# A key is a tuple that orders rows as they are drawn: the smallest first, no two alike.
KEY = ("worse", "no_id", "id", "n_features", "place")
Key = tuple[int, ...]


def keyed(scored: DataFrame) -> DataFrame:
    """Adds the key: higher scores first, then smaller ids (null last), fewer features, and the row's place."""
    return scored.withColumns(
        {
            "worse": -F.col("score"),
            "no_id": F.col("doc_id").isNull().cast("long"),
            "id": F.coalesce("doc_id", F.lit(0).cast("long")),
            "place": F.monotonically_increasing_id(),
        }
    )


def before(key: Key) -> Column:
    """Rows whose key is smaller."""
    return F.struct(*KEY) < key_struct(key)


def up_to(key: Key) -> Column:
    return F.struct(*KEY) <= key_struct(key)


def key_struct(key: Key) -> Column:
    return F.struct(*[F.lit(x).cast("long").alias(c) for c, x in zip(KEY, key, strict=True)])


def part_medians(keys: DataFrame, part: int) -> list[tuple[Key, int]]:
    """Median key and size of every part, a run of at most ``part`` rows of one task."""

    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def median() -> pa.RecordBatch:
            rows = np.concatenate(held, axis=1)
            mid = rows[:, np.lexsort(rows[::-1])[(rows.shape[1] - 1) // 2]]
            return pa.RecordBatch.from_arrays([*[pa.array([int(x)]) for x in mid], pa.array([rows.shape[1]])], names=[*KEY, "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, part):
                held.append(np.stack([c.to_numpy() for c in batch.slice(at, part).columns]))
                size += held[-1].shape[1]
                if size >= part:
                    yield median()
                    held, size = [], 0
        if size:
            yield median()

    found = keys.select(*KEY).mapInArrow(medians, ", ".join(f"{c} long" for c in (*KEY, "n"))).collect()
    return [(tuple(r)[:-1], r["n"]) for r in found]


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no medians")


def cutoff(keys: DataFrame, draw: int, total: int, part: int = PART, last: int = LAST) -> Key:
    """The key of the row that ``draw - 1`` of the ``total`` rows come before (0 < draw <= total)."""
    left, remaining, written, wanted = keys.select(*KEY), total, total, draw
    while remaining > last:
        pivot = weighted_median(part_medians(left, part))
        smaller = left.filter(before(pivot)).count()
        if smaller == wanted - 1:
            return pivot
        if smaller >= wanted:
            left, remaining = left.filter(before(pivot)), smaller
        else:  # the pivot is drawn too
            left, remaining, wanted = left.filter(~up_to(pivot)), remaining - smaller - 1, wanted - smaller - 1
        if remaining <= SHRUNK * written:
            left, written = stored(left, "remaining-keys"), remaining
    return sorted(tuple(r) for r in left.collect())[wanted - 1]


def ranked(winners: DataFrame) -> DataFrame:
    """Adds ``rank``: 1, 2, ... in order of the key, by sorted ranges and the sizes of those before."""
    spark = winners.sparkSession
    names = winners.columns
    sorted_rows = winners.repartitionByRange(partitions(spark), *KEY).sortWithinPartitions(*KEY)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, own), pa.int32()), pa.array(np.arange(at, at + n))], names=[*names, "range", "inside"])
            at += n

    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in winners.schema)}, range int, inside long"
    numbered = stored(sorted_rows.mapInArrow(number, schema), "winners")
    sizes = dict(tuple(r) for r in numbered.groupBy("range").count().collect())
    starts, at = [], 1
    for k in range(max(sizes, default=0) + 1):
        starts.append(F.lit(at).cast("long"))
        at += sizes.get(k, 0)
    return numbered.select(*names, (F.array(*starts)[F.col("range")] + F.col("inside")).alias("rank"))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    part: int = PART,
    last: int = LAST,
) -> DataFrame:
    """Every document with its score, and its rank if it is drawn.

    docs: doc_id, text; target: text; other columns are ignored, whatever their
    names. Of the N documents of at least ``least_words`` words,
    floor(percent * N / 100) are drawn. Returns doc_id, n_features, weight,
    score and rank (1, 2, ... in order of score, ties to the smaller doc_id;
    null if not drawn), one row per row of ``docs``.

    Null, empty and wordless texts have no features and weight 0 and are never
    drawn. Texts are read whole, one at a time. Rows alike in doc_id are rows of
    their own, drawn in order of n_features and then of their place in the
    table; a null doc_id has the noise of the empty id and comes last in a tie.
    Empty tables are counted as such: without a target, weights favour rare
    buckets; without documents there are no rows.

    The driver holds one number per bucket, one median per ``part`` of
    remaining keys (and at least one per task), and at most ``last`` keys.
    """
    table = stored(keyed(scores(docs, target, run, buckets, seed)), "scores")
    able = table.filter(F.col("n_words") >= least_words)
    total = able.count()
    draw = percent * total // 100
    columns = [F.col(c) for c in ("doc_id", "n_features", "weight", "score")]
    if not draw:
        return table.select(*columns, F.lit(None).cast("long").alias("rank"))
    edge = cutoff(able, draw, total, part, last)
    drawn = (F.col("n_words") >= least_words) & up_to(edge)
    winners = ranked(table.filter(drawn).select("doc_id", "weight", "score", *KEY))
    losers = table.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    return winners.select(*columns, "rank").unionByName(losers)

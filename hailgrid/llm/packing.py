"""Best-fit packing of token sequences by a linear grouping scheme.

Lengths are whole numbers up to the capacity, so the plan needs only how many
pieces have each length, a table as long as the capacity whatever the corpus.

1. Large lengths, in descending order, form groups of equal cardinality; each is
   rounded up to the largest of its group.
2. Configurations of these few sizes are chosen one after the other: the largest
   size left, and the sizes that fill the rest best (subset sums), as often as
   the supply allows.
3. Actual pieces take the places of rounded ones, which frees the difference.
4. Small lengths, in descending order, go where they leave least room; a new
   sequence is opened only when nothing fits.

The plan says for the n-th piece of a length which sequence and offset it gets.
Numbering the pieces of a length, and looking them up, is Spark's work.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hailgrid.llm.ranking import numbered
from hailgrid.llm.scratch import partitions, stored
from hailgrid.llm.tokens import Vocabulary, default_vocabulary, encoder

CAPACITY = 1024
GROUPS = 512
SMALL = 4  # a length is small up to capacity / SMALL
END = 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; only longer documents are cut, and the first piece takes the rest."""
    source = vocabulary or default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(source)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode(text), np.uint32(END))
                bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                out += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
            if out:
                columns = zip(*out, strict=True)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES)


Run = tuple[int, int]  # a length and how many pieces of it


def equal_groups(runs: list[Run], groups: int) -> list[list[Run]]:
    """Runs in descending order, cut into groups of equal cardinality (the last may be smaller)."""
    size = -(-sum(n for _, n in runs) // groups)
    out: list[list[Run]] = []
    room = 0
    for length, left in runs:
        while left:
            if not room:
                out.append([])
                room = size
            n = min(left, room)
            out[-1].append((length, n))
            room -= n
            left -= n
    return out


def fullest(sizes: list[int], supply: list[int], capacity: int) -> list[tuple[int, int]]:
    """The subset of pieces with the largest sum within ``capacity``: (group, number) pairs."""
    reached, mask = 1, (1 << (capacity + 1)) - 1
    came: dict[int, int] = {}
    for g, size in enumerate(sizes):
        if size > capacity:
            continue
        frontier = reached
        for _ in range(min(supply[g], capacity // size)):
            frontier = (frontier << size) & mask & ~reached
            if not frontier:
                break
            reached |= frontier
            bits = frontier
            while bits:
                low = bits & -bits
                came[low.bit_length() - 1] = g
                bits ^= low
        if reached >> capacity & 1:
            break
    total = reached.bit_length() - 1
    used: dict[int, int] = defaultdict(int)
    while total:
        g = came[total]
        used[g] += 1
        total -= sizes[g]
    return sorted(used.items())


def configurations(sizes: list[int], supply: list[int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Configurations that use up the supply, and how often each is used."""
    supply = list(supply)
    out = []
    for g, size in enumerate(sizes):
        while supply[g]:
            supply[g] -= 1
            config: dict[int, int] = defaultdict(int, fullest(sizes, supply, capacity - size))
            supply[g] += 1
            config[g] += 1
            times = min(supply[k] // n for k, n in config.items())
            for k, n in config.items():
                supply[k] -= n * times
            out.append((sorted(config.items()), times))
    return out


def substituted(groups: list[list[Run]], configs: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[tuple[int, ...], int]]:
    """Bins with actual lengths: (lengths, number of bins)."""
    queue = [[list(run) for run in group] for group in groups]
    out = []
    for config, times in configs:
        places = []
        for g, n in config:
            for _ in range(n):
                taken, left = [], times
                while left:
                    run = queue[g][0]
                    m = min(left, run[1])
                    taken.append((run[0], m))
                    run[1] -= m
                    left -= m
                    if not run[1]:
                        queue[g].pop(0)
                places.append(taken)
        ends = sorted({int(e) for taken in places for e in np.cumsum([m for _, m in taken])})
        at = 0
        bounds = [(np.cumsum([m for _, m in taken]), taken) for taken in places]
        for end in ends:
            out.append((tuple(taken[int(np.searchsorted(c, at, "right"))][0] for c, taken in bounds), end - at))
            at = end
    return out


def best_fit(bins: list[tuple[tuple[int, ...], int]], small: list[Run], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Put small pieces, in descending order, where they leave least room."""
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for lengths, n in bins:
        by_room[capacity - sum(lengths)].append((lengths, n))
    rooms = sorted(r for r in by_room)
    for length, left in small:
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                each = min(capacity // length, left)
                target, n, taken = capacity - each * length, left // each, (length,) * each
                left -= n * each
            else:
                room = rooms[k]
                lengths, have = by_room[room].pop()
                n = min(have, left)
                if have > n:
                    by_room[room].append((lengths, have - n))
                elif not by_room[room]:
                    del by_room[room]
                    rooms.pop(k)
                target, taken = room - length, (*lengths, length)
                left -= n
            if target not in by_room:
                rooms.insert(bisect_left(rooms, target), target)
            by_room[target].append((taken, n))
    return [x for runs in by_room.values() for x in runs]


def packing_plan(supply: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[tuple[int, ...], int]]:
    """All sequences as (lengths in order, number of such sequences)."""
    full = supply.get(capacity, 0)
    runs = sorted(((length, n) for length, n in supply.items() if n and length != capacity), reverse=True)
    large = [run for run in runs if run[0] > capacity // SMALL]
    small = [run for run in runs if run[0] <= capacity // SMALL]
    parts = equal_groups(large, groups) if large else []
    rounded = [part[0][0] for part in parts]
    configs = configurations(rounded, [sum(n for _, n in part) for part in parts], capacity)
    bins = best_fit(substituted(parts, configs), small, capacity)
    return [*([((capacity,), full)] if full else []), *bins]


def placement(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan by length: pieces from number ``rank`` on go to sequence ``base``, ``base`` + 1, ... at ``offset``."""
    next_rank: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for lengths, n in plan:
        offset = 0
        for length in lengths:
            rows.append((length, next_rank[length], base, offset))
            next_rank[length] += n
            offset += length
        base += n
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "base", "offset"), columns, strict=True))


PACKED = f"{PIECES}, sequence_id long, offset long"


def packed(docs: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Pieces of all documents and where they go.

    docs: doc_id, text; other columns are ignored. Returns doc_id, piece (from
    0), start (tokens of its document before it), length, ids_crc32,
    sequence_id and offset, one row per piece. Null and empty texts are one
    piece, the end token alone. Very long texts are encoded whole, one at a
    time, and a run of blanks, line breaks or one letter may have any length.
    Pieces of one length are numbered by a hash of their row. Repeated rows are
    packed like any other. No rows give no sequences.
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, capacity, vocabulary), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = spark.sparkContext.broadcast(placement(packing_plan(counts, capacity, groups)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = table.value
        first = {int(x): k for k, x in reversed(list(enumerate(plan["length"])))}
        last = {int(x): k + 1 for k, x in enumerate(plan["length"])}
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = np.empty(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                own = lengths == length
                a, b = first[length], last[length]
                row[own] = a + np.searchsorted(plan["rank"][a:b], ranks[own], "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(plan["base"][row] + ranks - plan["rank"][row]), pa.array(plan["offset"][row])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", partitions(spark))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, PACKED)

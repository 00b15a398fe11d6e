"""SimHash fingerprints and near-duplicate groups found through pivot distance tables.

A pivot table holds the Hamming distances of a fingerprint to many reference
fingerprints. Two fingerprints that differ in at most r bits differ by at most
r in every coordinate, so a larger difference discards a pair unseen.

References are fingerprints of the data. Around the first of them, the base,
lie more: the base with one pair of neighbouring bits flipped, for every pair.
What such a reference is farther or nearer than the base (2, 0 or -2) tells how
many of the two bits agree with the base, and does not change with any other
bit. These coordinates are parted into r + 3 families. A pair within r bits
differs in the coordinates of at most r families and agrees in those of three
at least: joining on the coordinates of three families finds every such pair.
Those that meet are discarded by the maximum difference over all coordinates,
and what survives is verified. No pair list of a whole group is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hailgrid.llm.components import connected
from hailgrid.llm.scratch import stored

BITS = 64
HASH_SEED = 42
KEPT = 3
#: Bits that a reference near the base has flipped.
FLIPPED = 2
#: Reference fingerprints drawn from the data, besides the base.
REFERENCES = 24
_PARTS = bytes(range(0x09, 0x0E)) + b" "
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLANK = bytes.maketrans(_PARTS, b" " * len(_PARTS))


def simhash(text: str | None, shingle: int) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; no word: zero."""
    from xxhash import xxh64_intdigest

    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).translate(_BLANK)
    words = [w for w in data.split(b" ") if w]
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    hashes = np.fromiter(
        map(xxh64_intdigest, [line[a:b] for a, b in zip(starts, stops, strict=True)], repeat(HASH_SEED)), np.uint64, n
    )
    # counts by bit: unpack in pieces, so that a very long text needs little memory
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 8192):
        part = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += part.sum(axis=0, dtype=np.uint16 if len(part) <= 8192 else np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint's 64 bits as a signed long) of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))], names=["doc_id", "text_hash", "fp"]
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(hashed, "doc_id long, text_hash long, fp long")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def references(fps: DataFrame, count: int, seed: int) -> list[int]:
    """Fingerprints of the data with the least hash, as many as there are up to ``count``."""
    return [r["fp"] for r in fps.select("fp").orderBy(F.xxhash64("fp", F.lit(seed)), "fp").limit(count).collect()]


def pivot_table(fps: DataFrame, base: int, others: list[int]) -> DataFrame:
    """fp; ``around``, the distances to the references around the base, less that to the base; ``pivots``, those to all others.

    A difference is -2, 0 or 2 and takes two bits of one number: 0, 1 or 2, the
    first reference lowest.
    """
    to_base = distance(F.col("fp"), F.lit(base))
    flips = [((1 << FLIPPED) - 1) << b for b in range(0, BITS, FLIPPED)]
    farther = [distance(F.col("fp"), F.lit(signed((base ^ flip) & (1 << BITS) - 1))) - to_base for flip in flips]
    codes = [F.shiftleft(F.shiftright(x + F.lit(FLIPPED), 1).cast("long"), FLIPPED * k) for k, x in enumerate(farther)]
    table = F.array(*[distance(F.col("fp"), F.lit(r)).cast("byte") for r in others])
    return fps.select("fp", reduce(Column.bitwiseOR, codes).alias("around"), table.alias("pivots"))


def family_masks(radius: int) -> list[int]:
    """Which bits of ``around`` hold the coordinates of each of radius + 3 families."""
    coordinates = BITS // FLIPPED
    bounds = [FLIPPED * round(coordinates * k / (radius + KEPT)) for k in range(radius + KEPT + 1)]
    return [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(bounds, bounds[1:], strict=False)]


def pivot_links(fps: DataFrame, radius: int, n_references: int = REFERENCES, seed: int = 9) -> DataFrame:
    """All pairs (a < b) of distinct fingerprints that differ in at most ``radius`` bits.

    fps: one row per distinct fingerprint, column fp.
    """
    return verified(surviving(fps, radius, n_references, seed), radius)


def surviving(fps: DataFrame, radius: int, n_references: int = REFERENCES, seed: int = 9) -> DataFrame:
    """Pairs (a < b) that agree on three families and differ by at most ``radius`` in the distance to every other reference; each once."""
    base, *refs = [*references(fps, n_references + 1, seed), 0][: n_references + 1]
    masks = family_masks(radius)
    kept = list(combinations(range(len(masks)), KEPT))
    # written down once: ten keys are made from each row, and both sides of the join read it
    table = stored(pivot_table(fps, base, refs), "pivots")
    of = lambda families: F.lit(signed(sum(masks[b] for b in families)))
    keys = [F.struct(F.lit(k).cast("short").alias("k"), F.col("around").bitwiseAND(of(families)).alias("key")) for k, families in enumerate(kept)]
    keyed = table.select("fp", "around", "pivots", F.inline(F.array(*keys)))
    left = keyed.select(F.col("fp").alias("a"), F.col("around").alias("ra"), F.col("pivots").alias("pa"), "k", "key")
    right = keyed.select(F.col("fp").alias("b"), F.col("around").alias("rb"), F.col("pivots").alias("pb"), "k", "key")
    pairs = left.join(right, ["k", "key"]).filter("a < b")
    near = F.lit(True)
    for n in range(len(refs)):
        near = near & (F.abs(F.col("pa")[n] - F.col("pb")[n]) <= radius)
    # a pair meets under every key it shares: only the first of them reports it
    differ = F.col("ra").bitwiseXOR(F.col("rb"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(of(families)) == 0, F.lit(k).cast("short")) for k, families in enumerate(kept)])
    return pairs.filter(near).filter(F.col("k") == first).select("a", "b")


def verified(pairs: DataFrame, radius: int) -> DataFrame:
    return pairs.filter(distance(F.col("a"), F.col("b")) <= radius)


def fingerprint_groups(hashed: DataFrame, radius: int) -> DataFrame:
    """By fingerprint: component_id, and ``first``, which names the one row of the group that stays.

    Equal fingerprints are one node, so copies cost one row each, however many
    there are.
    """
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = stored(hashed.groupBy("fp").agg(F.min("doc_id").alias("component_id"), F.min(name).alias("first")), "simhash-nodes")
    links = pivot_links(nodes.select("fp"), radius)
    members = stored(connected(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "simhash-members")
    best = (
        members.join(nodes, members.node == nodes.fp)
        .groupBy("root")
        .agg(F.min("component_id").alias("group_id"), F.min("first").alias("group_first"))
    )
    grouped = members.join(best, "root").select(F.col("node").alias("fp"), "group_id", "group_first")
    named = nodes.join(grouped, "fp", "left").select(
        "fp", F.coalesce("group_id", "component_id").alias("component_id"), F.coalesce("group_first", "first").alias("first")
    )
    # as a table, it meets the rows in a join of two shuffles, which Spark can split where a fingerprint is hot
    return stored(named, "simhash-groups")


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Near-duplicate groups: fingerprints within ``radius`` bits are linked, transitively.

    docs: doc_id, text; other columns are ignored. Returns doc_id, fp and
    component_id, the smallest doc_id of the group, one row per row of
    ``docs``. Null, empty and blank texts have fingerprint zero and are linked
    like any other. A null doc_id is a component_id only if its group has no
    other.
    """
    hashed = stored(fingerprints(docs, shingle), "simhash")
    return hashed.join(fingerprint_groups(hashed, radius), "fp").select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs``, with all columns, that stay if each near-duplicate group keeps one.

    The row with the smallest doc_id stays; null ids come last, ties go by a
    hash of the text, and of rows alike in both one stays. Null, empty and blank
    texts are one group. Texts are read whole, one at a time. Columns may have
    any names and come back as they were; an empty table stays empty.
    """
    hashed = stored(fingerprints(docs, shingle), "simhash")
    # every fingerprint of a group names the same row
    names = fingerprint_groups(hashed, radius).select("first.doc_id", "first.text_hash").distinct()
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    keep = names.select(key.alias("id"), F.col("text_hash").alias("hash"), F.col("doc_id").isNull().alias("none"))
    # a row travels as one column, so none of its own names can clash with a key
    keyed = docs.select(key.alias("id"), F.xxhash64(F.col("text").cast("string")).alias("hash"), F.col("doc_id").isNull().alias("none"), F.struct("*").alias("row"))
    return keyed.join(keep, ["id", "hash", "none"], "left_semi").dropDuplicates(["id", "hash", "none"]).select("row.*")

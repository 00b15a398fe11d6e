"""MinHash fingerprints of documents: universal hash permutations over word shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hailgrid.llm.scratch import partitions, stored
from hailgrid.llm.words import BLANKS, LOWER, mixed, random_odd, rolling, slices, split_words, utf8, window_starts, word_hashes

SHINGLE = 5
PERMUTATIONS = 128
BANDS = 32
THRESHOLD = 0.8
_WORD_SEED, _SHINGLE_SEED, _A_SEED, _B_SEED = 11, 12, 13, 14


def shingle_hashes(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and their number by text; a text of fewer words is one shingle, one of none has none."""
    data, offsets = utf8(texts)
    words = split_words(LOWER[data], offsets, BLANKS)
    hashes = word_hashes(words, _WORD_SEED)
    counts = words.counts
    long = np.maximum(counts - size + 1, 0)
    number = np.where(counts > 0, np.maximum(long, 1), 0)
    first = np.cumsum(number) - number
    out = np.empty(int(number.sum()), np.uint64)
    place = np.arange(int(long.sum())) + np.repeat(first - (np.cumsum(long) - long), long)
    if len(place):
        out[place] = rolling(hashes, size, _SHINGLE_SEED)[window_starts(words, size)]
    for k in np.flatnonzero((counts > 0) & (counts < size)):
        own = hashes[words.first[k] : words.first[k + 1]]
        out[first[k]] = rolling(own, len(own), _SHINGLE_SEED)[0]
    return mixed(out), number


def signatures(hashes: np.ndarray, number: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """One row per text: for each permutation, 16 bits of the smallest permuted shingle hash.

    A permutation is x -> a * x + b modulo 2**64 with odd a (multiply-shift, a
    universal family). Texts without words get all ones.
    """
    out = np.full((len(number), permutations), 0xFFFF, np.uint16)
    some = np.flatnonzero(number)
    if not len(some):
        return out
    first = (np.cumsum(number) - number)[some]
    a, b = random_odd(_A_SEED, permutations), random_odd(_B_SEED, permutations)
    buffer = np.empty_like(hashes)
    for k in range(permutations):
        np.multiply(hashes, a[k], out=buffer)
        np.add(buffer, b[k], out=buffer)
        out[some, k] = (np.minimum.reduceat(buffer, first) >> np.uint64(24)).astype(np.uint16)
    return out


def hexadecimal(signature: np.ndarray) -> list[str]:
    line = signature.astype(">u2").tobytes().hex()
    width = 4 * signature.shape[1]
    return [line[k * width : (k + 1) * width] for k in range(len(signature))]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def banded(signature: np.ndarray) -> np.ndarray:
    """The bands of each signature, one 64-bit number a band."""
    return signature.reshape(len(signature), BANDS, -1).view(np.uint64)[:, :, 0]


def shingle_sets(hashes: np.ndarray, number: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum(number)
    return [np.unique(hashes[e - n : e]) for e, n in zip(ends, number, strict=True)]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets; two empty ones are alike."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    whole = len(a) + len(b) - shared
    return shared / whole if whole else 1.0


def in_order_with_next(docs: DataFrame) -> DataFrame:
    """Texts in ranges of ascending doc_id, each range sorted and ending with a copy of the text after it.

    Range bounds are ids that occur (approximate quantiles), as many as there
    are shuffle partitions. The rows at a bound are also copied to the end of
    the range before, and the first rows of all to the end of the last range.
    Column role: 0 a row of the range, 1 the copy after it. Null ids come last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = partitions(spark)
    quantiles = [k / n for k in range(1, n)] or [0.5]
    least, found = rows.agg(F.min("doc_id"), F.percentile_approx("doc_id", quantiles, 100 * n)).first()
    bounds = np.array(sorted({x for x in found or [] if x > least}), np.int64)

    @F.pandas_udf("array<int>")
    def places(doc_id: pd.Series) -> pd.Series:
        known = doc_id.notna().to_numpy()
        ids = doc_id.fillna(0).astype("int64").to_numpy()
        own = np.where(known, np.searchsorted(bounds, ids, "right"), len(bounds))
        out = [[2 * k] for k in own.tolist()]
        for k in np.flatnonzero(known & np.isin(ids, bounds)).tolist():
            out[k].append(2 * (int(own[k]) - 1) + 1)
        for k in np.flatnonzero((ids == least) & known if least is not None else ~known).tolist():
            out[k].append(2 * len(bounds) + 1)
        return pd.Series(out)

    dealt = rows.withColumn("at", F.explode(places("doc_id")))
    dealt = dealt.select("doc_id", "text", F.expr("at div 2").cast("int").alias("range"), (F.col("at") % 2).cast("int").alias("role"))
    return dealt.repartitionById(len(bounds) + 1, "range").sortWithinPartitions("range", "role", F.col("doc_id").asc_nulls_last(), "text")


FINGERPRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
    "bands_edited int, bands_next int, jaccard_edited double, jaccard_next double"
)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    docs: doc_id, text; other columns are ignored. The edited text has its last
    floor(n / 2) characters replaced by the first as many (or all) of the next
    text in ascending doc_id; the first follows the last, ties go by text, and
    null ids come last. Null counts as empty; all texts without words have the
    same fingerprint and likeness 1 to each other. Returns one row per row of
    ``docs``; a single document is its own next one. Both likenesses come with
    the number of bands the signatures share and the Jaccard similarity of all
    shingles, which verifies them. The texts are shuffled once.
    """

    def compared(texts: list[str], after: str) -> dict[str, list]:
        following = [*texts[1:], after]
        edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for t, u in zip(texts, following, strict=True)]
        shingles, changed = shingle_hashes(pa.array([*texts, after], pa.string())), shingle_hashes(pa.array(edited, pa.string()))
        own, new = signatures(*shingles), signatures(*changed)
        sets, other = shingle_sets(*shingles), shingle_sets(*changed)
        return {
            "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(e.encode("utf-8")).hexdigest() for e in edited],
            "fingerprint": hexadecimal(own[:-1]),
            "edited_fingerprint": hexadecimal(new),
            "near_edited": likeness(own[:-1], new),
            "near_next": likeness(own[:-1], own[1:]),
            "bands_edited": (banded(own[:-1]) == banded(new)).sum(axis=1).astype(np.int32),
            "bands_next": (banded(own[:-1]) == banded(own[1:])).sum(axis=1).astype(np.int32),
            "jaccard_edited": [jaccard(a, b) for a, b in zip(sets, other, strict=False)],
            "jaccard_next": [jaccard(a, b) for a, b in zip(sets, sets[1:], strict=False)],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list[int | None], list[str], int] = ([], [], -1)

        def answer(after: str) -> Iterator[pa.RecordBatch]:
            if held[0]:
                out = {"doc_id": pa.array(held[0], pa.int64()), **compared(held[1], after)}
                yield pa.RecordBatch.from_pydict(out)

        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            places = np.stack([batch.column("range").to_numpy(), batch.column("role").to_numpy()], axis=1)
            ids = batch.column("doc_id").to_pylist()
            at = 0
            while at < len(ids):
                # rows of one range and role
                part, role = places[at].tolist()
                to = at + int(np.argmax((places[at:] != places[at]).any(axis=1))) if (places[at:] != places[at]).any() else len(ids)
                yield from answer(texts[at])
                held = ([], [], part) if role else (ids[at:to], texts[at:to], part)
                at = to

    return in_order_with_next(docs).mapInArrow(run, FINGERPRINTS)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of different texts whose shingle sets have a Jaccard similarity of ``threshold`` or more.

    Candidates share a band of the signature; their Jaccard similarity is then
    computed from all shingles. Equal texts are one class, named by its
    smallest doc_id: returns a, b (class names, a < b) and jaccard. At 0.8, a
    pair is missed with a probability below one in a million. Null texts and
    texts without words are like none. Pairs are listed, so a band that many
    different texts share costs as many candidates as they have pairs.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            shingles = shingle_hashes(batch.column("text"))
            sets = [x.view(np.int64) for x in shingle_sets(*shingles)]
            bands = banded(signatures(*shingles)).view(np.int64)
            signed = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(bands), pa.list_(pa.int64())), pa.array(sets, pa.list_(pa.int64()))],
                names=["doc_id", "bands", "shingles"],
            )
            yield signed.filter(pa.array(shingles[1] > 0))

    distinct = docs.filter("text is not null").groupBy("text").agg(F.min(F.col("doc_id").cast("long")).alias("doc_id"))
    signed = stored(distinct.mapInArrow(sign, "doc_id long, bands array<long>, shingles array<long>"), "minhash")
    keys = signed.select("doc_id", F.posexplode("bands").alias("band", "key"))
    left, right = keys.withColumnRenamed("doc_id", "a"), keys.withColumnRenamed("doc_id", "b")
    pairs = left.join(right, ["band", "key"]).filter("a < b").select("a", "b").distinct()
    sets = signed.select("doc_id", "shingles")
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    jaccard = shared / (F.size("sa") + F.size("sb") - shared)
    return both.select("a", "b", jaccard.alias("jaccard")).filter(F.col("jaccard") >= threshold)

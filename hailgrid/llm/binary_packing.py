"""Sequences without padding and without a document boundary: power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as
many of the capacity as it holds, then the binary digits of the rest, the
largest first. Every piece is a sequence of its own; sequences of one length
form a bucket, and a batch is drawn from one bucket. So nothing is padded, and
no sequence has tokens of two documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hailgrid.llm.ranking import numbered
from hailgrid.llm.scratch import partitions, stored
from hailgrid.llm.tokens import Vocabulary, default_vocabulary, encoder

CAPACITY = 2048
END = 1
#: Pieces in one output batch; a longer document is handed on in several.
BATCH = 1 << 16

CUT = pa.schema([(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def binary_lengths(n: int, capacity: int) -> np.ndarray:
    """Powers of two, in descending order, that add up to ``n``; only ``capacity`` may repeat."""
    rest = n % capacity
    digits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.concatenate([np.full(n // capacity, capacity, np.int64), np.array(digits, np.int64)])


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: Vocabulary | None = None) -> DataFrame:
    """The pieces of every document, its end token included."""
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError(f"capacity must be a power of two, not {capacity}")
    source = vocabulary or default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(source)
        for batch in batches:
            found: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py()), np.uint32(end))
                lengths = binary_lengths(len(ids), capacity)
                stops = np.cumsum(lengths)
                for length, stop in zip(lengths.tolist(), stops.tolist(), strict=True):
                    found.append((doc_id.as_py(), stop - length, length, zlib.crc32(ids[stop - length : stop].tobytes()), len(ids)))
                if len(found) >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=CUT)
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=CUT)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES)


def binary_packed(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Sequences of power-of-two lengths, one piece each.

    docs: doc_id, text; other columns are ignored, whatever their names.
    Returns doc_id, start (tokens of its document before it), length,
    ids_crc32, doc_tokens, sequence_id, offset (always 0) and ``number``, the
    place of the sequence in the bucket of its length: 0, 1, ... without gaps,
    in an order that a hash of the row mixes. The sequence_id follows from both:
    ``number * digits + log2(length)``, where the capacity has ``digits`` binary
    digits.

    Null and empty texts are one piece, the end token alone. Very long texts are
    encoded whole, one at a time. Repeated rows are packed like any other and
    get sequences of their own; a null doc_id stays null. No rows give no
    sequences. The pieces, a few numbers each, are written once and numbered by
    bucket in hashed parts, so a bucket may hold any share of them.
    """
    pieces = stored(token_pieces(docs, capacity, end, vocabulary), "binary-pieces")
    numbers = numbered(pieces, ["length"], ["doc_id", "start", "ids_crc32"], "number", partitions(docs.sparkSession))
    digit = (F.length(F.bin("length")) - 1).cast("long")
    return numbers.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("number") * F.lit(capacity.bit_length()).cast("long") + digit).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "number",
    )

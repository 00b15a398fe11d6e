"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text is the vector of its character n-grams (one to three UTF-8 bytes of the
lower-cased text, everything but letters read as blank), hashed into a fixed
number of features, square roots of counts times inverse document frequency,
scaled to length one. Each language has a few centroids from spherical k-means.
The nearest centroid by cosine names the language. Prose of another kind than
the known texts is farther from their centroids than they are, but has one
language it is clearly nearest to; a text of another language has not. So a
text farther than nearly all known texts of its size is rejected if a second
language is about as near, or if it is very far from all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hailgrid.llm.words import utf8

#: Hashed features for n-grams of one, two and three bytes.
WIDTHS = (256, 2048, 4096)
FEATURES = sum(WIDTHS)
CENTROIDS = 3
ROUNDS = 15
#: Labelled documents the classifier is fitted on, in expectation; every language has an equal share.
FIT_ROWS = 3072
#: Share of the low cosine of known texts of its size below which a text is far from all centroids.
MARGIN = 0.5
#: A far text is rejected if its cosine to a second language is more than this share of its best, or if its best is
#: less than this share of that bar. Both depend on the logarithm to base 2 of the number of n-grams, less SIZE:
#: the share at SIZE, the change for each doubling, and the bounds. Chosen on docstrings of half of 35 modules and the
#: foreign passages of the tests; other docstrings test it.
SIZE = 9.2
AMBIGUOUS = (0.935, -0.03, 0.86, 1.0)
VERY_FAR = (0.54, 0.12, 0.4, 0.72)
#: The low cosine of a size is this quantile, over this many known texts at least (a quarter of all, if there are
#: few): of so many, one odd text is left out.
LOW = 0.01
ENOUGH = 100
UNKNOWN = "und"
CHUNK = 256
CHUNK_BYTES = 2 << 20
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def ngram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of hashed n-grams, one row per text; a row without letters is zero."""
    lowered = [t.lower() if has_letter(t) else "" for t in texts]
    data, offsets = utf8(pa.array(lowered, pa.string()))
    data = _BLANK[data].astype(np.int32)  # a code of three bytes fits
    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(offsets))
    # a run of blanks counts as one
    stay = np.ones(len(data), bool)
    stay[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20) | (row[1:] != row[:-1])
    data, row = data[stay], row[stay]
    counts = np.zeros((len(texts), FEATURES), np.int64)
    base, code = 0, data
    for n, width in enumerate(WIDTHS, 1):
        if n > 1:
            code = code[:-1] * 256 + data[n - 1 :]
        feature = code if n == 1 else (code.astype(np.int64) * 0x9E3779B1 >> 13) % width
        place = (row[: len(code)].astype(np.int64) * width + feature)[row[: len(code)] == row[n - 1 :]]
        counts[:, base : base + width] = np.bincount(place, minlength=len(texts) * width).reshape(len(texts), width)
        base += width
    return counts


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that are counted together: bounded in number and, but for one long text, in size."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if k > at and (k - at == CHUNK or size > CHUNK_BYTES):
            yield at, k
            at, size = k, len(t or "")
    if at < len(texts):
        yield at, len(texts)


def size_log(counts: np.ndarray) -> np.ndarray:
    """Logarithm to base 2 of the number of n-grams."""
    return np.log2(np.maximum(counts.sum(axis=1), 1))


def size_class(counts: np.ndarray) -> np.ndarray:
    return size_log(counts).astype(np.int64)


def share(size: np.ndarray, line: tuple[float, float, float, float]) -> np.ndarray:
    at, slope, low, high = line
    return np.clip(at + slope * (size - SIZE), low, high)


@dataclass
class Model:
    labels: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray  # cosine below which a text is far, by size class

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        """Counts as vectors; 32-bit floats are changed in place."""
        x = np.sqrt(counts, out=counts) if counts.dtype == np.float32 else np.sqrt(counts, dtype=np.float32)
        x *= self.idf
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
        x /= np.where(norm > 0, norm, 1)
        return x

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine to the nearest centroid, and whether the text is rejected."""
        counts = ngram_counts(texts)
        size = size_log(counts)
        blank = counts.sum(axis=1) == 0
        if not self.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosines = self.vectors(counts) @ self.centroids.T
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(texts)), best], 0, 1).astype(np.float64)
        score[blank] = 0.0
        names = np.array(self.labels)
        second = np.where(names[best][:, None] == names[None, :], 0, cosines).max(axis=1)
        bar = self.least[np.minimum(size.astype(np.int64), len(self.least) - 1)]
        unlike = (second > share(size, AMBIGUOUS) * score) | (score < share(size, VERY_FAR) * bar)
        return [UNKNOWN if b else self.labels[k] for b, k in zip(blank, best, strict=True)], score, blank | (score < bar) & unlike


def k_means(x: np.ndarray, k: int, seed: int = 4) -> np.ndarray:
    """Spherical k-means from randomly drawn rows."""
    centres = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[own == n].sum(axis=0) if (own == n).any() else centres[n] for n in range(len(centres))])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres


def train(counts: np.ndarray, langs: list[str]) -> Model:
    """The classifier for rows of counts (32-bit floats, used up) of texts with a letter."""
    idf = (np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))) + 1).astype(np.float32)
    model = Model([], np.zeros((0, FEATURES), np.float32), idf, np.zeros(1))
    if not langs:
        return model
    size = size_class(counts)
    x, names = model.vectors(counts), np.array(langs)
    for lang in sorted(set(langs)):
        centres = k_means(x[names == lang], CENTROIDS)
        model.labels += [lang] * len(centres)
        model.centroids = np.vstack([model.centroids, centres])
    cosine, least = (x @ model.centroids.T).max(axis=1), []
    # A size with too few known texts is taken together with the sizes next to it, as few as will do.
    enough = max(1, min(ENOUGH, len(size) // 4))
    for n in range(int(size.max()) + 1):
        away = np.abs(size - n)
        near = away <= np.sort(away)[enough - 1]
        least.append(MARGIN * float(np.quantile(cosine[near], LOW)))
    model.least = np.array(least)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fitted_model(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The classifier, from about ``fit_rows`` labelled, not held-out documents, drawn by hash.

    The driver holds one vector for each of them, whatever the corpus.
    """
    known = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return train(np.zeros((0, FEATURES), np.float32), [])
    each = fit_rows / len(counts)
    bound = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int((1 << 30) * min(1.0, each / n)))])
    drawn = known.filter(F.col("text").isNotNull()).filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < bound[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts):
                rows = ngram_counts(texts[a:b]).astype(np.uint32)
                places = [np.flatnonzero(x) for x in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang").slice(a, b - a),
                        pa.array([p.astype(np.uint16).tobytes() for p in places], pa.binary()),
                        pa.array([x[p].tobytes() for x, p in zip(rows, places, strict=True)], pa.binary()),
                    ],
                    names=["lang", "features", "counts"],
                )

    found = drawn.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(count, "lang string, features binary, counts binary")
    lettered = found.filter(F.length("features") > 0)
    rows = sorted(lettered.collect(), key=lambda r: (r["lang"], bytes(r["features"]), bytes(r["counts"])))
    dense = np.zeros((len(rows), FEATURES), np.float32)
    for k, r in enumerate(rows):
        dense[k, np.frombuffer(r["features"], np.uint16)] = np.frombuffer(r["counts"], np.uint32)
    return train(dense, [r["lang"] for r in rows])


def languages(docs: DataFrame, known: DataFrame | None = None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Predicted language of every text.

    docs: doc_id, text; known (``docs`` unless given): doc_id, text, lang, from
    whose not held-out rows the classifier learns. Returns doc_id, held_out,
    lang_pred, score (cosine to the nearest centroid, 0 to 1) and rejected, one
    row per row of ``docs``, without a shuffle. Null texts and texts without a
    letter are ``und``, score 0, rejected. Without labelled rows everything
    is. Ties go to the language first in order. A null doc_id is not held out.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fitted_model(docs if known is None else known, fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts):
                lang, score, rejected = model.value.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                    names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
                )

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def known_languages(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, with all columns, that the classifier does not reject.

    It learns from the rows of ``docs`` that are not held out. Null texts and
    texts without a letter go, and all rows if none is labelled; rows alike stay
    or go together. Texts are read whole; an empty table stays empty.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted_model(docs, fit_rows))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts):
                yield batch.slice(a, b - a).filter(pa.array(~model.value.predict(texts[a:b])[2]))

    return docs.mapInArrow(keep, docs.schema)

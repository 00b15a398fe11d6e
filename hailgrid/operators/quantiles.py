"""Exact quantiles of any number of values."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame, functions as F

BINS = 1024


@dataclass(frozen=True)
class Span:
    """Values from lo to hi: how many there are, and how many are smaller than all of them."""

    lo: float
    hi: float
    rows: int
    before: int

    def holds(self, rank: int) -> bool:
        return self.before <= rank < self.before + self.rows


LARGEST = 1.7976931348623157e308


def _bin(value: Column, span: Span, bins: int) -> Column:
    """Least and largest value of a span are never in one bin, so every pass narrows it."""
    lo, hi = max(span.lo, -LARGEST), min(span.hi, LARGEST)
    width = hi / 2 - lo / 2  # of halves, so that it is a number for the widest span too
    if not width:
        return F.when(value == F.lit(span.lo), F.lit(0)).otherwise(F.lit(bins - 1))
    held = F.greatest(F.lit(lo), F.least(F.lit(hi), value))
    return F.least(F.floor((held / 2 - F.lit(lo / 2)) / F.lit(width) * bins), F.lit(bins - 1)).cast("int")


def order_statistics(df: DataFrame, column: str, ranks: list[int], bins: int = BINS, whole: Span | None = None) -> dict[int, float]:
    """The values at these places (from 0) of the sorted column.

    Spans of values that hold a wanted place are cut into equal bins, and one
    pass counts each bin and takes its least and largest value; the bin with
    the place is the next span. A span of one value is an answer, so a pass
    more is needed only where values lie close together: a few, whatever the
    number of rows. A pass sends ``bins`` rows per span and task, and the driver
    gets ``bins`` rows per span; no task ever gathers values.
    """
    value = F.col(column).cast("double")
    rows = df.select(value.alias("value")).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    if whole is None:
        whole = _whole(rows)
    spans = {rank: whole for rank in ranks if whole is not None and whole.holds(rank)}
    while open_ := sorted({s for s in spans.values() if s.lo < s.hi}, key=lambda s: s.lo):
        inside = F.lit(None).cast("int")
        at = F.lit(None).cast("int")
        for k, span in enumerate(open_):
            own = F.col("value").between(span.lo, span.hi)
            inside = F.when(own, F.lit(k)).otherwise(inside)
            at = F.when(own, _bin(F.col("value"), span, bins)).otherwise(at)
        counted = rows.select("value", inside.alias("span"), at.alias("bin")).filter("span IS NOT NULL").groupBy("span", "bin")
        parts = counted.agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n")).orderBy("span", "bin").collect()
        finer: dict[Span, list[Span]] = {span: [] for span in open_}
        for r in parts:
            span = open_[r["span"]]
            done = finer[span]
            before = done[-1].before + done[-1].rows if done else span.before
            done.append(Span(r["lo"], r["hi"], r["n"], before))
        for rank, span in spans.items():
            if span in finer:
                spans[rank] = next(s for s in finer[span] if s.holds(rank))
    return {rank: span.lo for rank, span in spans.items()}


def _whole(rows: DataFrame) -> Span | None:
    lo, hi, n = rows.agg(F.min("value"), F.max("value"), F.count("*")).first()
    return Span(lo, hi, n, 0) if n else None


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float], bins: int = BINS) -> list[float | None]:
    """Quantiles by linear interpolation between the two neighbouring values.

    Null and NaN are left out; without values every quantile is None. Values
    are compared as doubles. ``df`` is scanned once per pass, one column wide.
    """
    value = F.col(column).cast("double")
    whole = _whole(df.select(value.alias("value")).filter(F.col("value").isNotNull() & ~F.isnan("value")))
    if whole is None:
        return [None] * len(probabilities)
    places = [p * (whole.rows - 1) for p in probabilities]
    found = order_statistics(df, column, sorted({r for x in places for r in (floor(x), ceil(x))}), bins, whole)
    out = []
    for x in places:
        lo, hi = found[floor(x)], found[ceil(x)]
        out.append(lo if lo == hi else lo + (hi - lo) * (x - floor(x)))
    return out


def quantile_table(df: DataFrame, column: str, probabilities: list[float], bins: int = BINS) -> DataFrame:
    """One row per probability: probability, value."""
    found = exact_quantiles(df, column, probabilities, bins)
    return df.sparkSession.createDataFrame(list(zip(map(float, probabilities), found, strict=True)), "probability double, value double")

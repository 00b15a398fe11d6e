"""Top rows, arg-max rows, shares of smaller rows, last rows of a series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hailgrid.operators.balance import SLOT_KEYS


def top_n(df: DataFrame, value: str, n: int, *ties: str) -> DataFrame:
    """The n largest rows. Each task keeps n rows, so nothing is sorted as a whole."""
    return df.orderBy(F.desc(value), *ties).limit(n)


def first_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def largest_row(df: DataFrame, value: str, *ties: str) -> DataFrame:
    return top_n(df, value, 1, *ties)


def largest_per(df: DataFrame, keys: list[str], value: str, tie: str, *keep: str) -> DataFrame:
    """The row with the largest value of every group, ties to the smaller ``tie``.

    One grouping of partial maxima: a group of any size costs each task one row.
    """
    best = F.struct(F.col(value).alias("value"), (-F.col(tie)).alias("order"), *keep)
    top = df.groupBy(*keys).agg(F.max(best).alias("best"))
    return top.select(*keys, (-F.col("best.order")).alias(tie), F.col("best.value").alias(value), *[F.col(f"best.{c}") for c in keep])


def busier_than(slots: DataFrame, value: str = "prediction") -> DataFrame:
    """Percentage of a slot's zones with a strictly smaller value."""
    group = Window.partitionBy(*SLOT_KEYS)
    below = F.rank().over(group.orderBy(value)) - 1
    return slots.withColumn("busier_than_pct", below / F.count("*").over(group) * 100)


def last_rows(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The last n rows of every series."""
    series = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_row", F.row_number().over(series)).filter(F.col("_row") <= n).drop("_row")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().orderBy(key)

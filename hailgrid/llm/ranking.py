"""Numbering rows within a group without gathering the group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def numbered(df: DataFrame, by: list[str], order: list[str], name: str, buckets: int) -> DataFrame:
    """Adds ``name``: 0, 1, ... without gaps within ``by``.

    A group is dealt over ``buckets`` by a hash of ``order``. Rows are numbered
    in their bucket, and the counts of the buckets before are added. So a group
    may hold any share of the rows. ``df`` is read twice: hand in a stored table.
    """
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = dealt.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order)) - 1
    return (
        dealt.withColumn("_inside", inside)
        .join(before, [*by, "_bucket"])
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("long"))
        .drop("_bucket", "_inside", "_before")
    )

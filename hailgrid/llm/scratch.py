"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hailgrid.sources.tables import scratch_store


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    The files are deleted once no plan that reads them can be reached any more.
    """
    return scratch_store(df.sparkSession, label).write(df, "table")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

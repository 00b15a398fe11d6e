"""Broadcast hints that depend on a known bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Zone-sized tables are a few dozen bytes per row, so this stays well below 100 MB.
MAX_BROADCAST_ROWS = 1_000_000


def fits_broadcast(max_rows: int) -> bool:
    return max_rows <= MAX_BROADCAST_ROWS


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only if ``max_rows``, a proven upper bound, is small.

    Beyond it Spark plans a shuffled join, which adaptive execution can still
    turn into a broadcast or split where a key is hot.
    """
    return F.broadcast(df) if fits_broadcast(max_rows) else df


# Rows that the driver may hold for a plan that reads them several times.
MAX_LOCAL_ROWS = 50_000


def local_within(df: DataFrame, max_rows: int) -> DataFrame:
    """The rows as a local table if ``max_rows``, a proven upper bound, is small.

    A plan then reads them as often as it likes without a job or a file of
    their own. Beyond the bound ``df`` comes back as it is: store it first.
    """
    if max_rows > MAX_LOCAL_ROWS:
        return df
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def shuffle_partitions(df: DataFrame) -> int:
    """The session's shuffle width, for the few places that must fix a partition count."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

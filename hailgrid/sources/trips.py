"""Trip sources and the raw trip sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hailgrid.functions.clock import parse_ts
from hailgrid.schemas import RAW_TRIP_TYPES
from hailgrid.sources.tables import require_columns


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw columns as text."""
    return require_columns(spark.read.option("header", True).csv(path), list(RAW_TRIP_TYPES))


def read_trips_csv(spark: SparkSession, path: str, keep_text: bool = False) -> DataFrame:
    """Raw trips from CSV files with a header line.

    Columns are found by header name, so extra columns and any column order
    are fine. All text is cast here: no inference pass over the data, and a
    malformed value becomes null in its own row only. Whole numbers may be
    written as decimals. ``unparsed_values`` counts what was lost. With
    ``keep_text``, ``raw_text`` is the whole row as it came, as JSON.
    """
    return typed_trips(read_raw_csv(spark, path), keep_text)


def typed_trips(raw: DataFrame, keep_text: bool = False) -> DataFrame:
    text = [F.to_json(F.struct("*")).alias("raw_text")] if keep_text else []
    return raw.select("id", *[value.alias(name) for name, value in _typed().items()], *text)


def _typed() -> dict[str, Column]:
    """Every column but the id, read from its text."""
    times = {"pickup_ts": "pickup_datetime", "dropoff_ts": "dropoff_datetime"}
    numbers = {name: kind for name, kind in RAW_TRIP_TYPES.items() if kind in ("double", "int")}
    return {name: parse_ts(F.col(text)) for name, text in times.items()} | {name: _number(name, kind) for name, kind in numbers.items()}


def _number(name: str, kind: str) -> Column:
    """A whole number may be written as a decimal; one with a fraction is malformed."""
    value = F.col(name).try_cast("double")
    return value if kind == "double" else F.when(value == F.floor(value), value.try_cast(kind))


def unparsed_values(raw: DataFrame) -> DataFrame:
    """For each column, how many rows have text that could not be read, and the number of rows."""
    source = {"pickup_ts": "pickup_datetime", "dropoff_ts": "dropoff_datetime"}
    lost = [
        F.count_if((F.length(F.trim(source.get(name, name))) > 0) & value.isNull()).alias(name) for name, value in _typed().items()
    ]
    return raw.agg(*lost, F.count("*").alias("total_rows"))


def write_trips_csv(trips: DataFrame, path: str) -> None:
    """Write trips in the raw layout. Timestamps go out as text with all their digits."""
    (
        trips.withColumnsRenamed({"pickup_ts": "pickup_datetime", "dropoff_ts": "dropoff_datetime"})
        .select(
            *[
                F.col(name).cast("string") if kind == "timestamp_ntz" else F.col(name)
                for name, kind in RAW_TRIP_TYPES.items()
            ]
        )
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def trips_from_events(events: DataFrame) -> DataFrame:
    """A deterministic trips table computed from an event log.

    Every column is arithmetic on ``event_id``, so another SQL engine gives
    the same values. Ends lie in and around the default box, denser towards
    its lower corner, and a share of the rows breaks each cleaning rule.
    """

    def coordinate(start: float, factor: int, span: int, groups: int, step: int) -> str:
        offset = f"((event_id * {factor}) % {span}) % ({step} + (event_id % {groups}) * {step})"
        return f"{start}D + {offset} / 10000D"

    seconds = "CAST(30 + (event_id * 37) % 11400 AS INT)"
    return events.selectExpr(
        "event_id AS id",
        "ts AS pickup_ts",
        f"timestampadd(SECOND, {seconds}, ts) AS dropoff_ts",
        f"{coordinate(-74.06, 7919, 3800, 19, 200)} AS pickup_longitude",
        f"{coordinate(40.54, 104729, 4200, 13, 300)} AS pickup_latitude",
        f"{coordinate(-74.06, 15485863, 3800, 17, 200)} AS dropoff_longitude",
        f"{coordinate(40.54, 1299709, 4200, 11, 300)} AS dropoff_latitude",
        f"{seconds} AS trip_duration",
        "CAST(event_id % 7 AS INT) AS passenger_count",
    )

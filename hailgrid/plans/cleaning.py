"""Raw trips to clean trips."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from hailgrid.functions.geo import zone_id
from hailgrid.operators.filters import broken_rules, is_valid_trip
from hailgrid.params import RideParams
from hailgrid.sources.tables import ResultStore

CHECKED = "checked_trips"
CLEAN_COLUMNS = ["id", "pickup_ts", "dropoff_ts", "date", "hour", "zone_id", "drop_zone_id", "trip_duration", "passenger_count"]


def clean_trips(trips: DataFrame, params: RideParams) -> DataFrame:
    """Valid trips with date, hour and the zones of both ends. One filter, no shuffle."""
    grid = params.grid
    return trips.filter(is_valid_trip(params)).select(
        "id",
        "pickup_ts",
        "dropoff_ts",
        F.to_date("pickup_ts").alias("date"),
        F.hour("pickup_ts").alias("hour"),
        zone_id("pickup_longitude", "pickup_latitude", grid).alias("zone_id"),
        zone_id("dropoff_longitude", "dropoff_latitude", grid).alias("drop_zone_id"),
        "trip_duration",
        "passenger_count",
    )


def checked_trips(trips: DataFrame, params: RideParams) -> DataFrame:
    """Every trip: the clean columns of a valid one, or ``reasons``, the names of the rules it breaks.

    A rejected trip keeps its id, its four ends (null in valid ones, whose
    zones say enough) and, where the reader kept it, its ``raw_text``.
    """
    broken = broken_rules(params)
    reasons = F.filter(F.array(*[F.when(lost, F.lit(name)) for name, lost in broken.items()]), lambda r: r.isNotNull())
    marked = trips.withColumn("reasons", reasons)
    kept = F.size("reasons") == 0
    grid = params.grid
    zones = {
        "zone_id": zone_id("pickup_longitude", "pickup_latitude", grid),
        "drop_zone_id": zone_id("dropoff_longitude", "dropoff_latitude", grid),
    }
    ends = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
    text = F.when(~kept, F.col("raw_text")) if "raw_text" in trips.columns else F.lit(None).cast("string")
    return marked.select(
        "id",
        "pickup_ts",
        "dropoff_ts",
        F.to_date("pickup_ts").alias("date"),
        F.hour("pickup_ts").alias("hour"),
        *[F.when(kept, zone).alias(name) for name, zone in zones.items()],
        "trip_duration",
        "passenger_count",
        "reasons",
        *[F.when(~kept, F.col(end)).alias(end) for end in ends],
        text.alias("raw_text"),
        kept.alias("kept"),
    )


@dataclass(frozen=True)
class CheckedTrips:
    """Both sides of the stored table, and how many rows went where."""

    clean: DataFrame
    rejected: DataFrame
    counts: dict[str, int]

    def count_table(self) -> DataFrame:
        rows = [(rule, int(n)) for rule, n in self.counts.items()]
        return self.clean.sparkSession.createDataFrame(rows, "rule string, trips long")


def split_trips(store: ResultStore, trips: DataFrame, params: RideParams, in_date_order: bool = False) -> CheckedTrips:
    """Write valid and rejected trips in one scan, and count them on the way.

    One table holds both, partitioned by ``kept`` and ``date``, so a reader of
    one side never opens a file of the other. The counts (total, kept,
    rejected, and one per rule; a trip that breaks several counts in each) are
    observed behind the shuffle by date, in the tasks that write: a task that
    runs again after a lost executor is counted once. Trips that come in date
    order are written as they are.
    """
    checked = checked_trips(trips, params)
    if not in_date_order:
        checked = checked.hint("rebalance", "kept", "date")
    counts = Observation("checked")
    rules = [F.count_if(F.array_contains("reasons", name)).alias(name) for name in broken_rules(params)]
    seen = checked.observe(counts, F.count("*").alias("total"), F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("rejected"), *rules)
    table = store.write(seen, CHECKED, partition_by=["kept", "date"])
    rejected = table.filter("NOT kept").drop("kept", "zone_id", "drop_zone_id")
    return CheckedTrips(table.filter("kept").select(*CLEAN_COLUMNS), rejected, dict(counts.get))

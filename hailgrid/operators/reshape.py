"""Tables laid out for display."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hailgrid.functions.clock import day_name
from hailgrid.functions.geo import zone_lat, zone_lon
from hailgrid.functions.text import code_label, hour_label
from hailgrid.params import GridSpec

HOUR_COLUMNS = [f"h{hour:02d}" for hour in range(24)]

# How the two driver columns are called in a chart legend.
SERIES_LABELS = {"required_drivers": "Required", "available_drivers": "Available"}


def week_matrix(profile: DataFrame, value: str = "avg_city_trips") -> DataFrame:
    """One row per weekday, Sunday first, one column per hour."""
    wide = profile.groupBy("dow").pivot("hour", list(range(24))).agg(F.first(value))
    named = wide.withColumnsRenamed({str(hour): name for hour, name in enumerate(HOUR_COLUMNS)})
    return named.withColumn("day", day_name(F.col("dow"))).select("dow", "day", *HOUR_COLUMNS).orderBy("dow")


def drivers_long(allocation: DataFrame) -> DataFrame:
    """Required and available drivers as one row each, with the hour as a label."""
    times = allocation.select(
        hour_label(F.col("pickup_hour")).alias("time"),
        "day_of_week",
        *[F.col(name).cast("long").alias(name) for name in SERIES_LABELS],
    )
    long = times.unpivot(["time", "day_of_week"], list(SERIES_LABELS), "series", "drivers")
    return long.withColumn("series", code_label(F.col("series"), SERIES_LABELS))


def zone_map(zones: DataFrame, grid: GridSpec) -> DataFrame:
    """Zones with centre and a marker size that grows with their share of the largest zone.

    ``zones`` is read twice, for the maximum and for the rows: hand in a stored table.
    """
    size = F.col("total_trips") / zones.agg(F.max("total_trips")).scalar() * 35 + 8
    return zones.select(
        "zone_id",
        "total_trips",
        zone_lon(F.col("zone_id"), grid).alias("longitude"),
        zone_lat(F.col("zone_id"), grid).alias("latitude"),
        size.alias("map_size"),
    )


def with_demand_level(zones: DataFrame, lower: float = 0.33, upper: float = 0.66) -> DataFrame:
    """Low up to the lower quantile of trips, Medium up to the upper one, High above.

    The exact quantiles are one aggregate, combined from counts per value.
    ``zones`` is read twice: hand in a stored table.
    """
    cuts = zones.agg(F.percentile("total_trips", F.array(F.lit(lower), F.lit(upper)))).scalar()
    trips, cut = F.col("total_trips"), F.col("_cuts")
    level = F.when(trips <= cut[0], "Low").when(trips <= cut[1], "Medium").otherwise("High")
    return zones.withColumn("_cuts", cuts).withColumn("demand_level", level).drop("_cuts")

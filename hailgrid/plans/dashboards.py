"""The tables behind a dashboard: key figures, selections, curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hailgrid.functions.geo import zone_lat, zone_lon
from hailgrid.functions.number import non_negative, percent
from hailgrid.functions.text import hour_label, zone_label
from hailgrid.operators.balance import STATUS
from hailgrid.operators.filters import hours_between, with_levels
from hailgrid.operators.ranking import largest_row, top_n
from hailgrid.operators.reshape import with_demand_level
from hailgrid.params import GridSpec

SHORTAGE = STATUS[True]


def selection_kpis(hourly: DataFrame, first: int, last: int) -> DataFrame:
    """Trips of the selected hours, their share of all trips, and the mean per hour."""
    chosen = F.col("pickup_hour").between(first, last)
    selected = F.sum(F.when(chosen, F.col("total_trips")))
    return hourly.agg(
        F.sum("total_trips").alias("all_trips"),
        selected.alias("selected_trips"),
        percent(selected, F.sum("total_trips")).alias("share_pct"),
        F.avg(F.when(chosen, F.col("total_trips"))).alias("mean_per_hour"),
        F.count_if(chosen).alias("hours"),
    )


def peak_hour(hourly: DataFrame, first: int = 0, last: int = 23) -> DataFrame:
    peak = largest_row(hours_between(hourly, first, last), "total_trips", "pickup_hour")
    return peak.withColumn("label", hour_label(F.col("pickup_hour")))


def peak_day(daily: DataFrame) -> DataFrame:
    return largest_row(daily, "total_trips", "day_number")


def ranked_zones(zones: DataFrame, levels: list[str], n: int) -> DataFrame:
    """The busiest zones of the chosen demand levels, with a label."""
    chosen = with_levels(with_demand_level(zones), levels)
    return top_n(chosen, "total_trips", n, "zone_id").withColumn("zone", zone_label(F.col("zone_id")))


def status_counts(allocation: DataFrame) -> DataFrame:
    return (
        allocation.groupBy(F.col("allocation_status").alias("status"))
        .agg(F.count("*").alias("records"))
        .orderBy(F.desc("records"), "status")
    )


def worst_shortfall(allocation: DataFrame) -> DataFrame:
    """The slot whose need exceeds the drivers at hand the most; no row without a shortage."""
    short = allocation.filter(F.col("allocation_status") == SHORTAGE)
    gaps = short.withColumn("gap", F.col("required_drivers") - F.col("available_drivers"))
    worst = largest_row(gaps, "gap", "pickup_hour", "day_of_week")
    return worst.select(
        hour_label(F.col("pickup_hour")).alias("time"),
        "day_of_week",
        "required_drivers",
        "available_drivers",
        "gap",
    )


def predicted_by_hour(pred_grid: DataFrame) -> DataFrame:
    return pred_grid.groupBy("hour").agg(F.sum("prediction").alias("prediction")).orderBy("hour")


def slot_kpis(allocated: DataFrame, moves: DataFrame, fleet: int, keys: list[str]) -> DataFrame:
    """Per slot: trips, drivers needed, fleet, drivers moved, unmet need, and the fleet's shortage."""
    moved = moves.groupBy(*keys).agg(F.sum("drivers").alias("moved"))
    totals = allocated.groupBy(*keys).agg(
        F.sum("prediction").alias("trips"),
        F.sum("needed").alias("needed"),
        F.sum("short_now").alias("short_now"),
        F.sum("short_after").alias("unmet"),
    )
    return (
        totals.join(moved, keys, "left")
        .fillna(0, ["moved"])
        .withColumn("fleet", F.lit(fleet).cast("long"))
        .withColumn("shortage", non_negative(F.col("needed") - F.col("fleet")))
    )


def estimated_shortage(slots: DataFrame, keys: list[str]) -> DataFrame:
    """The second dashboard's estimate: the need of the whole slot rounded up once."""
    totals = slots.groupBy(*keys, "fleet", "trips_per_driver").agg(F.sum("prediction").alias("trips"))
    required = F.ceil(F.round(F.col("trips"), 6) / F.col("trips_per_driver"))
    return (
        totals.withColumn("required_drivers", required)
        .withColumn("shortage", non_negative(F.col("required_drivers") - F.col("fleet")))
        .drop("trips_per_driver")
    )


def zone_day_curve(pred_grid: DataFrame, zone: int, dow: int) -> DataFrame:
    """Prediction and history over the hours of one weekday in one zone."""
    curve = pred_grid.filter((F.col("zone_id") == zone) & (F.col("dow") == dow))
    return curve.select("hour", "prediction", "hist_mean").orderBy("hour")


def with_missing_centres(zones: DataFrame, grid: GridSpec) -> DataFrame:
    """Add lon and lat to a zone table that lacks them."""
    centres = {"lon": zone_lon(F.col("zone_id"), grid), "lat": zone_lat(F.col("zone_id"), grid)}
    return zones.withColumns({name: value for name, value in centres.items() if name not in zones.columns})

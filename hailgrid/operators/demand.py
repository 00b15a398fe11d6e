"""Demand counts over trips. All of them combine partial counts before the shuffle, so a hot
hour, weekday or zone costs each task one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hailgrid.functions.clock import day_name, hour_start
from hailgrid.functions.geo import zone_id, zone_lat, zone_lon
from hailgrid.functions.number import ratio
from hailgrid.operators.filters import pickup_in_box
from hailgrid.operators.sizes import broadcast_within
from hailgrid.params import COARSE_GRID, GridSpec, RideParams


def trip_count(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count("*").alias("total_trips"))


def trip_totals(trips: DataFrame, by: list[str], grid: GridSpec = COARSE_GRID) -> DataFrame:
    """Trips, duration and passengers by any of date, hour and zone_id of the pickup.

    The reports below add such totals up, so one scan of the trips, stored by
    all three keys, serves all of them: at most one row per calendar hour and
    cell. A single report groups by its own key only, and adding up again then
    needs no second shuffle. Pickups outside the box have a null zone, pickups
    whose time did not parse a null date and hour; the reports by time leave the
    latter out, and ``unparsed_pickups`` counts them.
    """
    inside = F.when(pickup_in_box(grid), zone_id("pickup_longitude", "pickup_latitude", grid))
    keys = {"date": F.to_date("pickup_ts"), "hour": F.hour("pickup_ts"), "zone_id": inside}
    return trips.groupBy(*[keys[name].alias(name) for name in by]).agg(
        F.count("*").alias("trips"),
        F.sum("trip_duration").alias("seconds"),
        F.count("trip_duration").alias("timed_trips"),
        F.sum("passenger_count").alias("passengers"),
        F.count("passenger_count").alias("counted_trips"),
    )


def _mean_minutes() -> Column:
    return F.round(ratio(F.sum("seconds"), F.sum("timed_trips")) / 60, 2)


def _mean_passengers() -> Column:
    return F.round(ratio(F.sum("passengers"), F.sum("counted_trips")), 2)


def hourly_demand(totals: DataFrame) -> DataFrame:
    """Trips by hour of day."""
    return (
        totals.filter("hour IS NOT NULL")
        .groupBy(F.col("hour").alias("pickup_hour"))
        .agg(F.sum("trips").alias("total_trips"))
        .orderBy("pickup_hour")
    )


def daily_demand(totals: DataFrame) -> DataFrame:
    """Trips by weekday. The name follows from the number, so it is added after grouping."""
    return (
        totals.filter("date IS NOT NULL")
        .groupBy(F.dayofweek("date").alias("day_number"))
        .agg(F.sum("trips").alias("total_trips"))
        .select("day_number", day_name(F.col("day_number")).alias("day_name"), "total_trips")
        .orderBy("day_number")
    )


def average_duration(totals: DataFrame) -> DataFrame:
    return totals.agg(_mean_minutes().alias("average_duration_minutes"))


def average_passengers(totals: DataFrame) -> DataFrame:
    return totals.agg(_mean_passengers().alias("average_passengers"))


def slot_demand(totals: DataFrame) -> DataFrame:
    """Trips over the whole period per hour of day and weekday."""
    slot = [F.col("hour").alias("pickup_hour"), F.dayofweek("date").alias("day_of_week")]
    timed = totals.filter("date IS NOT NULL AND hour IS NOT NULL")
    return timed.groupBy(*slot).agg(F.sum("trips").alias("total_trips"))


def unparsed_pickups(totals: DataFrame) -> DataFrame:
    """Trips without a readable pickup time, which no report by hour, weekday or slot contains."""
    lost = F.sum(F.when(F.col("date").isNull() | F.col("hour").isNull(), F.col("trips")))
    return totals.agg(F.coalesce(lost, F.lit(0)).alias("unparsed_pickups"), F.sum("trips").alias("total_trips"))


def zone_demand(totals: DataFrame) -> DataFrame:
    """Demand, mean duration and mean passengers per pickup zone, busiest zone first."""
    return (
        totals.filter(F.col("zone_id").isNotNull())
        .groupBy("zone_id")
        .agg(
            F.sum("trips").alias("total_trips"),
            _mean_minutes().alias("avg_trip_duration_minutes"),
            _mean_passengers().alias("avg_passengers"),
        )
        .orderBy(F.desc("total_trips"), "zone_id")
    )


def zone_quality(totals: DataFrame) -> DataFrame:
    """How many trips start inside the box and how many are removed."""
    valid = F.coalesce(F.sum(F.when(F.col("zone_id").isNotNull(), F.col("trips"))), F.lit(0))
    return totals.agg(
        F.sum("trips").alias("total_records"),
        valid.alias("valid_records"),
        (F.sum("trips") - valid).alias("removed_records"),
    )


def zone_hour_totals(clean: DataFrame, dropoffs: bool = True) -> DataFrame:
    """Pickups, drop-offs and pickup seconds per cell and hour: all that later steps need of the trips.

    Each trip is unfolded into its two ends inside the scan, so one pass and one
    shuffle of partial sums count both. The result has at most one row per grid
    cell and hour; store it, and zones, timeline and series follow from it
    without another look at the trips.
    """
    ends = ["struct(zone_id AS zone_id, pickup_ts AS at, 1L AS demand, 0L AS dropoffs, trip_duration AS seconds)"]
    if dropoffs:
        ends.append("struct(drop_zone_id AS zone_id, dropoff_ts AS at, 0L AS demand, 1L AS dropoffs, 0 AS seconds)")
    return (
        clean.selectExpr(f"inline(array({', '.join(ends)}))")
        .groupBy("zone_id", hour_start("at").alias("ts"))
        .agg(*[F.sum(name).alias(name) for name in ("demand", "dropoffs", "seconds")])
    )


def zone_totals(clean: DataFrame) -> DataFrame:
    """Pickups and their seconds per cell, for the zone table alone: no grouping by hour."""
    return clean.groupBy("zone_id").agg(F.count("*").alias("demand"), F.sum("trip_duration").alias("seconds"))


def busiest_zones(totals: DataFrame, params: RideParams) -> DataFrame:
    """The busiest pickup zones with their centre. Ties in volume go to the smaller zone id."""
    per_zone = totals.groupBy("zone_id").agg(
        F.sum("demand").alias("total_trips"),
        F.round(ratio(F.sum("seconds"), F.sum("demand")) / 60, 2).alias("avg_trip_min"),
    )
    return (
        per_zone.filter("total_trips > 0")
        .orderBy(F.desc("total_trips"), "zone_id")
        .limit(params.top_zones)
        .select(
            "zone_id",
            "total_trips",
            "avg_trip_min",
            zone_lon(F.col("zone_id"), params.grid).alias("lon"),
            zone_lat(F.col("zone_id"), params.grid).alias("lat"),
        )
    )


def pickup_span(totals: DataFrame) -> Column:
    """First and last hour with a pickup anywhere, as one scalar struct of two partial aggregates."""
    busy_hour = F.when(F.col("demand") > 0, F.col("ts"))
    return totals.agg(F.struct(F.min(busy_hour).alias("first_hour"), F.max(busy_hour).alias("last_hour"))).scalar()


def top_zones(totals: DataFrame, params: RideParams) -> DataFrame:
    """The busiest zones, and beside each the first and last hour with a pickup anywhere.

    ``totals`` is read for the zones and for the span: hand in a stored table.
    """
    span = pickup_span(totals)
    return busiest_zones(totals, params).withColumns({name: span[name] for name in ("first_hour", "last_hour")})


def _modelled(totals: DataFrame, zones: DataFrame, params: RideParams) -> DataFrame:
    return totals.join(broadcast_within(zones.select("zone_id"), params.max_zones), "zone_id", "left_semi")


def zone_hour_pickups(totals: DataFrame, zones: DataFrame, params: RideParams) -> DataFrame:
    """Pickups per modelled zone and hour; hours without any have no row."""
    return _modelled(totals.filter("demand > 0"), zones, params).select("zone_id", "ts", "demand")


def zone_hour_dropoffs(totals: DataFrame, zones: DataFrame, params: RideParams) -> DataFrame:
    """Drop-offs per modelled zone and hour: drivers who just became free there."""
    return _modelled(totals.filter("dropoffs > 0"), zones, params).select("zone_id", "ts", "dropoffs")

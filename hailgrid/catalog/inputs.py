"""Inputs the registered queries share.

Some write or collect a bounded table while a query is being built, so even
``explain()`` of such a query runs jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hailgrid.functions.clock import HOURS_PER_WEEK
from hailgrid.operators import zone_hours
from hailgrid.operators.balance import with_scenarios
from hailgrid.operators.demand import (
    busiest_zones,
    slot_demand,
    top_zones,
    trip_totals,
    zone_demand,
    zone_hour_totals,
    zone_totals,
)
from hailgrid.operators.filters import pickup_in_box
from hailgrid.operators.sizes import local_within
from hailgrid.params import COARSE_GRID, FINE_GRID, RideParams
from hailgrid.plans.cleaning import clean_trips
from hailgrid.plans.dashboards import with_missing_centres
from hailgrid.plans.features import zone_hour_data
from hailgrid.sources.tables import ResultStore, scratch_store
from hailgrid.sources.trips import trips_from_events

PARAMS = RideParams(
    grid=COARSE_GRID, top_zones=20, train_end="2024-01-22", fleet=100, trips_per_driver=2.0
)
# The settings of the published jobs: cells of 0.01 degrees, 200 zones, 3000 drivers.
FINE = RideParams(grid=FINE_GRID, train_end="2024-01-22")
SCARCE_FLEET = 5
SCENARIOS = [(100, 2.0), (5, 2.0), (40, 1.0), (10, 3.0)]
SHIFT = (7, 18)


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return trips_from_events(spark.read.parquet(f"{sf}/events.parquet"))


def totals(spark: SparkSession, sf: str, *by: str) -> DataFrame:
    return trip_totals(trips(spark, sf), list(by), PARAMS.grid)


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Pickup points inside the box."""
    return trips(spark, sf).filter(pickup_in_box(PARAMS.grid)).select(
        "id", F.col("pickup_longitude").alias("lon"), F.col("pickup_latitude").alias("lat")
    )


def clean(spark: SparkSession, sf: str, params: RideParams = PARAMS) -> DataFrame:
    return clean_trips(trips(spark, sf), params)


def zones(spark: SparkSession, sf: str) -> DataFrame:
    """The modelled zones with their span, from stored totals."""
    return top_zones(stored_totals(spark, sf), PARAMS)


def zone_table(spark: SparkSession, sf: str) -> DataFrame:
    """The modelled zones alone: one grouping by zone."""
    return busiest_zones(zone_totals(clean(spark, sf)), PARAMS)


def stored_zones(spark: SparkSession, sf: str) -> DataFrame:
    return scratch_store(spark, "zones").write(zone_table(spark, sf), "zones")


def stored_totals(spark: SparkSession, sf: str, params: RideParams = PARAMS) -> DataFrame:
    """Totals per cell and hour, written to the shared folder.

    Zones and series both start from them, so without the copy the trips would
    be scanned once for each.
    """
    store = scratch_store(spark, "totals")
    return store.write(zone_hour_totals(clean(spark, sf, params)), "zone_hour_totals")


def all_zones(spark: SparkSession, sf: str) -> DataFrame:
    return zone_demand(totals(spark, sf, "zone_id"))


def counted_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Every zone's demand, counted now, for queries that read it for a bound and for the rows: a row per cell at most."""
    return local_within(all_zones(spark, sf), PARAMS.grid.n_cells)


def modelled_zones(counted: DataFrame, params: RideParams) -> DataFrame:
    """The modelled zones with their span; the grid and the totals both meet them, so they are planned once."""
    return local_within(top_zones(counted, params), params.max_zones)


def dense(spark: SparkSession, sf: str, params: RideParams = PARAMS) -> DataFrame:
    counted = stored_totals(spark, sf, params)
    filled = zone_hours.dense_demand(counted, modelled_zones(counted, params), params)
    return zone_hours.with_zone_calendar(filled, params.grid.stride)


def features(spark: SparkSession, sf: str, params: RideParams = PARAMS) -> DataFrame:
    counted = stored_totals(spark, sf, params)
    return zone_hours.feature_table(zone_hour_data(counted, modelled_zones(counted, params), params))


def stored_features(spark: SparkSession, sf: str) -> DataFrame:
    """The features as a table, for queries that read them more than once."""
    return scratch_store(spark, "features").write(features(spark, sf), "features")


def slot_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Slot totals with the mean of the hour over all weekdays as a reproducible prediction."""
    same_hour = Window.partitionBy("pickup_hour")
    return slot_demand(totals(spark, sf, "date", "hour")).withColumn("prediction", F.avg("total_trips").over(same_hour))


@dataclass(frozen=True)
class WeekTables:
    """The series, its summary by weekly slot, and the zone and slot tables derived from it."""

    store: ResultStore
    zones: DataFrame
    data: DataFrame
    hist: DataFrame
    supply: DataFrame
    pred_grid: DataFrame


def week_tables(spark: SparkSession, sf: str, params: RideParams = PARAMS) -> WeekTables:
    """The tables of the allocation queries, which read each of them several times.

    One grouping of the series gives its summary by weekly slot, at most 168
    rows a zone; zones, history and supply all follow from it. So the trips are
    scanned once and the series is grouped once.
    """
    data = dense(spark, sf, params)
    summary = local_within(zone_hours.slot_summary(data, params.train_end), HOURS_PER_WEEK * params.max_zones)
    totals_by_zone = summary.groupBy("zone_id").agg(F.sum("trips").alias("total_trips"))
    top = with_missing_centres(totals_by_zone, params.grid)
    hist = zone_hours.hist_of(summary)
    # The historical mean stands in for the model, so that SQL can follow.
    typical = F.round("hist_mean", 2)
    pred_grid = hist.select("zone_id", "dow", "hour", typical.alias("hist_mean"), typical.alias("prediction"))
    return WeekTables(scratch_store(spark, "week"), top, data, hist, zone_hours.supply_of(summary), pred_grid)


def one_fleet(slots: DataFrame, fleet: int) -> DataFrame:
    return with_scenarios(slots, [(fleet, PARAMS.trips_per_driver)])

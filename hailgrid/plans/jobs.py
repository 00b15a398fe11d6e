"""Stages that read and write a result store, and a command line for spark-submit.

    spark-submit --py-files hailgrid.zip hailgrid/plans/jobs.py --base hdfs:///data/rides --raw hdfs:///data/trips.csv

Every stage starts from stored tables, so a lost stage is rerun on its own and
no plan grows across stages.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from hailgrid.operators import balance, zone_hours
from hailgrid.operators.demand import slot_demand, top_zones, trip_totals, zone_hour_totals
from hailgrid.operators.filters import split_by_date
from hailgrid.params import COARSE_GRID, FINE_GRID, GridSpec, RideParams
from hailgrid.plans import forecasting, reports
from hailgrid.plans.allocation import allocate
from hailgrid.plans.cleaning import split_trips
from hailgrid.plans.features import slot_tables, zone_hour_data
from hailgrid.sources.tables import ResultStore
from hailgrid.sources.trips import read_raw_csv, read_trips_csv, typed_trips, unparsed_values

MODEL_PATH = "models/gbt"
TOTALS = "trip_totals"
ZONE_TOTALS = "zone_hour_totals"


def report_stage(store: ResultStore, trips: DataFrame, grid: GridSpec = COARSE_GRID) -> None:
    """Add the trips up once, store the totals, and write the reports from them as CSV."""
    totals = store.write(trip_totals(trips, reports.TOTALS_BY, grid), TOTALS)
    for name, table in {**reports.demand_report(totals), **reports.zone_report(totals)}.items():
        store.write_csv(table, name)


def slot_forecast_stage(store: ResultStore, trees: int = 50) -> None:
    """Forecast slot totals from the stored trip totals, then allocate from the stored forecast."""
    (totals,) = store.require(TOTALS)
    slots = store.write(slot_demand(totals), "slot_demand")
    predictions = store.write_csv(forecasting.slot_forecast(slots, trees), "demand_predictions")
    store.write_csv(balance.simple_allocation(predictions), "driver_allocation")


def clean_stage(store: ResultStore, trips: DataFrame, params: RideParams, in_date_order: bool = False) -> None:
    """Store clean and rejected trips in one scan, then read the clean ones once for the totals that zones and series follow from.

    Trips that come in date order are written as they are; others are shuffled by date.
    """
    checked = split_trips(store, trips, params, in_date_order)
    store.write(checked.count_table(), "clean_counts")
    totals = store.write(zone_hour_totals(checked.clean), ZONE_TOTALS)
    zones = top_zones(totals, params)
    store.write(zones.select("zone_id", "total_trips", "avg_trip_min", "lon", "lat"), "zones")
    store.write(zones.select("first_hour", "last_hour").limit(1), "timeline")


def feature_stage(store: ResultStore, params: RideParams) -> None:
    """Compute the dense series once, store it, and derive the other tables from the stored copy."""
    totals, zones, timeline = store.require(ZONE_TOTALS, "zones", "timeline")
    spans = zones.withColumns(
        {name: timeline.select(name).scalar() for name in ("first_hour", "last_hour")}
    )
    data = store.write(zone_hour_data(totals, spans, params), "zone_hours", "date")
    summary = store.write(zone_hours.slot_summary(data, params.train_end), "slot_summary")
    for name, table in slot_tables(data, summary).items():
        store.write(table, name)
    store.write(zone_hours.feature_table(data), "features", date_column="date")


def train_stage(
    store: ResultStore, params: RideParams, boost: forecasting.BoostParams = forecasting.BoostParams()
) -> None:
    (features,) = store.require("features")
    train, test = split_by_date(features, params.train_end)
    model = forecasting.train_boosted(train, boost)
    model.write().overwrite().save(store.path(MODEL_PATH))
    scored = store.write(forecasting.held_out_predictions(model, test), "scored")
    metrics = store.write(forecasting.model_metrics(scored), "metrics")
    store.write(forecasting.model_gains(metrics), "metric_gain")
    store.write(scored.drop("lag_168"), "test_preds")


def grid_stage(store: ResultStore, params: RideParams = RideParams()) -> None:
    (hist,) = store.require("hist")
    model = PipelineModel.load(store.path(MODEL_PATH))
    store.write(forecasting.predict_grid(model, hist, params.grid.stride), "pred_grid")


def allocation_stage(store: ResultStore, params: RideParams, variant: str = "a") -> None:
    """Plan once, derive the moves from the written plan. ``variant`` tells which sign ``gap`` has."""
    pred_grid, zones, supply = store.require("pred_grid", "zones", "supply_proxy")
    allocated, moved = allocate(pred_grid, zones, supply, params, variant, store)
    if variant == "b":
        moved = moved.withColumnRenamed("distance_km", "km")
    store.write(allocated.withColumn("variant", F.lit(variant)), "allocation")
    columns = ["from_zone", "to_zone", "drivers", "km", "dow", "hour"]
    store.write(moved.select(*columns).withColumn("variant", F.lit(variant)), "allocation_moves")


def run_all(
    store: ResultStore,
    raw_path: str,
    params: RideParams,
    boost: forecasting.BoostParams = forecasting.BoostParams(),
    variant: str = "a",
    trees: int = 50,
    in_date_order: bool = False,
) -> None:
    """Reports, slot forecast, and the five stages from clean trips to allocation."""
    report_stage(store, read_trips_csv(store.spark, raw_path))
    slot_forecast_stage(store, trees)
    clean_stage(store, read_trips_csv(store.spark, raw_path, keep_text=True), params, in_date_order)
    feature_stage(store, params)
    train_stage(store, params, boost)
    grid_stage(store, params)
    allocation_stage(store, params, variant)


def inspect_stage(store: ResultStore, raw_path: str) -> None:
    """Columns, first rows, row count and unreadable values of the raw trips, printed."""
    raw = read_raw_csv(store.spark, raw_path)
    raw.printSchema()
    for table in [*reports.inspect_trips(typed_trips(raw)).values(), unparsed_values(raw)]:
        table.show(truncate=False)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--base", required=True, help="storage root of all results")
    parser.add_argument("--raw", help="raw trips CSV; needed by the stages that read raw trips")
    parser.add_argument(
        "--stage",
        default="all",
        choices=["all", "inspect", "reports", "slot-forecast", "clean", "features", "train", "grid", "allocation"],
    )
    parser.add_argument("--fleet", type=int, default=RideParams.fleet)
    parser.add_argument("--trips-per-driver", type=float, default=RideParams.trips_per_driver)
    parser.add_argument("--train-end", default=RideParams.train_end)
    parser.add_argument("--variant", default="a", choices=["a", "b"], help="allocation rules")
    parser.add_argument("--cell", type=float, default=FINE_GRID.cell, help="cell size in degrees")
    parser.add_argument("--top-zones", type=int, default=RideParams.top_zones)
    parser.add_argument("--in-date-order", action="store_true", help="raw trips come in order of date: write without a shuffle")
    args = parser.parse_args()

    spark = SparkSession.builder.appName(f"hailgrid-{args.stage}").getOrCreate()
    store = ResultStore(spark, args.base)
    params = replace(
        RideParams(),
        fleet=args.fleet,
        trips_per_driver=args.trips_per_driver,
        train_end=args.train_end,
        grid=replace(FINE_GRID, cell=args.cell),
        top_zones=args.top_zones,
    )
    if args.stage in ("all", "inspect", "reports", "clean") and not args.raw:
        parser.error(f"stage {args.stage} needs --raw")
    stages = {
        "all": lambda: run_all(store, args.raw, params, variant=args.variant, in_date_order=args.in_date_order),
        "inspect": lambda: inspect_stage(store, args.raw),
        "reports": lambda: report_stage(store, read_trips_csv(spark, args.raw)),
        "slot-forecast": lambda: slot_forecast_stage(store),
        "clean": lambda: clean_stage(store, read_trips_csv(spark, args.raw, keep_text=True), params, args.in_date_order),
        "features": lambda: feature_stage(store, params),
        "train": lambda: train_stage(store, params),
        "grid": lambda: grid_stage(store, params),
        "allocation": lambda: allocation_stage(store, params, args.variant),
    }
    stages[args.stage]()
    spark.stop()


if __name__ == "__main__":
    main()

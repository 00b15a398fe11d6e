"""Stages end to end on a result store, and the plans behind them."""

import os
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from hailgrid.catalog.inputs import PARAMS, clean, features, trips
from hailgrid.operators import demand
from hailgrid.plans import forecasting, jobs
from hailgrid.plans.allocation import allocate
from hailgrid.schemas import RESULT_SCHEMAS
from hailgrid.sources.tables import MissingInput, ResultStore, remove_scratch, shared_folder
from hailgrid.sources.trips import read_raw_csv, read_trips_csv, unparsed_values, write_trips_csv

SF = "/root/testdata/sf0.001"
QUICK = forecasting.BoostParams(rounds=2, depth=2)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("rides"))
    raw = f"{base}/raw"
    write_trips_csv(trips(spark, SF), raw)
    store = ResultStore(spark, base)
    jobs.run_all(store, raw, PARAMS, QUICK)
    jobs.report_stage(store, read_trips_csv(spark, raw))
    jobs.slot_forecast_stage(store, trees=3)
    return store


PARQUET = [
    "zones", "timeline", "hist", "supply_proxy", "demand_profile", "metrics", "test_preds", "pred_grid",
    "allocation", "allocation_moves", "clean_counts", "metric_gain",
]
BY_BATCH = ["zone_hour_batches", "zone_hour_merged", "slot_merged"]
CSV = [name for name in RESULT_SCHEMAS if name not in PARQUET + BY_BATCH]


@pytest.mark.parametrize("name", PARQUET)
def test_stored_tables_have_their_declared_schema(spark, store, name):
    plain = spark.read.parquet(store.path(name))
    declared = store.read(name)
    assert dict(plain.dtypes) == dict(declared.dtypes)
    assert declared.count() == plain.count() > 0


@pytest.mark.parametrize("name", CSV)
def test_reports_read_back(store, name):
    table = store.read_csv(name)
    assert table.count() > 0
    assert table.filter(F.col(table.columns[0]).isNull()).count() == 0


@pytest.mark.parametrize(
    ("name", "by", "report"),
    [
        ("hourly_demand", ["hour"], demand.hourly_demand),
        ("daily_demand", ["date"], demand.daily_demand),
        ("average_duration", [], demand.average_duration),
        ("average_passengers", [], demand.average_passengers),
        ("zone_demand", ["zone_id"], demand.zone_demand),
        ("quality_counts", ["zone_id"], demand.zone_quality),
    ],
)
def test_reports_from_shared_totals_equal_their_own_scan(spark, store, name, by, report):
    alone = report(demand.trip_totals(trips(spark, SF), by))
    assert sorted(map(tuple, store.read_csv(name).collect())) == sorted(map(tuple, alone.collect()))


def test_one_report_shuffles_its_groups_once(spark):
    plan = plan_of(demand.hourly_demand(demand.trip_totals(trips(spark, SF), ["hour"])))
    assert plan.count("Exchange hashpartitioning") == 1


def test_csv_with_other_columns_is_refused(spark, store):
    spark.range(3).write.mode("overwrite").option("header", True).csv(store.path("daily_demand_other"))
    reader = spark.read.schema(RESULT_SCHEMAS["hourly_demand"]).option("header", True).option("enforceSchema", False)
    with pytest.raises(Exception, match="CSV"):
        reader.csv(store.path("daily_demand_other")).collect()


def test_tables_fit_together(store):
    zones, hist, grid = store.read("zones"), store.read("hist"), store.read("pred_grid")
    allocation = store.read("allocation")
    assert zones.count() == PARAMS.top_zones
    assert hist.count() == grid.count() == allocation.count() == PARAMS.top_zones * 168
    assert {row.model for row in store.read("metrics").collect()} == {
        forecasting.MODEL, forecasting.SLOT_MEAN, forecasting.LAST_WEEK,
    }
    sums = allocation.groupBy("dow", "hour").agg(F.sum("current").alias("n"))
    assert [row.n for row in sums.select("n").distinct().collect()] == [PARAMS.fleet]


def test_stages_give_the_same_features_as_one_plan(spark, store):
    names = ["zone_id", "ts", "demand", "dropoffs", "hist_mean", "lag_168"]
    stored = store.read("features").select(*names)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, features(spark, SF).select(*names).collect()))


def test_moves_start_from_the_written_allocation(store, tmp_path):
    other = ResultStore(store.spark, str(tmp_path))
    tables = [store.read(name) for name in ("pred_grid", "zones", "supply_proxy")]
    for variant in ("a", "b"):
        _, moved = allocate(*tables, PARAMS, variant, other)
        plan = plan_of(moved)
        assert "supply_proxy" not in plan and "Window" not in plan


def test_a_stored_model_predicts_the_same(spark, store):
    features_ = store.read("features")
    model = forecasting.train_boosted(features_.filter("date < '2024-01-22'"), QUICK)
    path = store.path("models/again")
    model.write().overwrite().save(path)
    hist = store.read("hist")
    again = forecasting.predict_grid(PipelineModel.load(path), hist)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, forecasting.predict_grid(model, hist).collect()))


def test_fit_is_checkpointed_and_measured(spark, store):
    trees = PipelineModel.load(store.path(jobs.MODEL_PATH)).stages[-1]
    assert trees.getCacheNodeIds() and trees.getCheckpointInterval() == QUICK.checkpoint_interval
    assert spark.sparkContext.getCheckpointDir() is not None
    mae = {r.model: r.mae for r in store.read("metrics").collect()}
    gain = {r.baseline: (r.model_mae, r.baseline_mae, r.gain) for r in store.read("metric_gain").collect()}
    model = mae.pop(forecasting.MODEL)
    assert gain == {name: (model, own, pytest.approx(1 - model / own)) for name, own in mae.items()}


def test_cleaning_counts_what_it_removes(spark, store):
    counts = {r.rule: r.trips for r in store.read("clean_counts").collect()}
    assert counts["total"] == counts["kept"] + counts["rejected"] == trips(spark, SF).count()
    assert store.read("clean").count() == counts["kept"] and store.read("rejected").count() == counts["rejected"]
    assert store.read("rejected").filter("raw_text IS NULL").count() == 0


def test_a_malformed_pickup_time_costs_its_own_trip_only(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_trips_csv(trips(spark, SF), raw)
    lines = spark.read.option("header", True).csv(raw)
    broken = F.when(F.col("id") == "7", "yesterday").otherwise(F.col("pickup_datetime"))
    lines.withColumn("pickup_datetime", broken).write.option("header", True).csv(f"{raw}-broken")
    store = ResultStore(spark, str(tmp_path))
    jobs.report_stage(store, read_trips_csv(spark, f"{raw}-broken"))
    jobs.slot_forecast_stage(store, trees=2)
    assert store.read_csv("hourly_demand").agg(F.sum("total_trips")).first()[0] == trips(spark, SF).count() - 1
    assert tuple(demand.unparsed_pickups(store.read(jobs.TOTALS)).first()) == (1, trips(spark, SF).count())
    lost = unparsed_values(read_raw_csv(spark, f"{raw}-broken")).first().asDict()
    assert lost["pickup_ts"] == 1 and sum(lost.values()) == 1 + lost["total_rows"]


def test_inspection_shows_schema_rows_and_losses(store, capsys):
    jobs.inspect_stage(store, store.path("raw"))
    shown = capsys.readouterr().out
    assert "pickup_datetime: string" in shown and "total_trips" in shown and "total_rows" in shown


def test_any_table_can_be_exported(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    table = spark.createDataFrame([(1, "High"), (2, None)], "zone_id long, demand_level string")
    assert sorted(map(tuple, store.write_csv(table, "levels").collect())) == [(1, "High"), (2, None)]


def test_scratch_is_removed(spark):
    path = shared_folder(spark, "gone")
    spark.range(3).write.parquet(path)
    remove_scratch(spark)
    assert not os.path.exists(path)


def test_second_variant_runs_from_the_store(store, tmp_path):
    other = ResultStore(store.spark, str(tmp_path))
    for name in ("pred_grid", "zones", "supply_proxy"):
        other.write(store.read(name), name)
    jobs.allocation_stage(other, replace(PARAMS, fleet=7), variant="b")
    assert other.read("allocation").filter("current > 7").count() == 0
    assert other.read("allocation_moves").count() > 0


def test_stage_without_its_input_stops(spark, tmp_path):
    with pytest.raises(MissingInput):
        jobs.feature_stage(ResultStore(spark, str(tmp_path)), PARAMS)


# ---- plans ----------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dates_prune_partitions_and_columns_prune_the_scan(store):
    plan = plan_of(store.read("clean").filter("date = DATE'2024-01-10'").groupBy("zone_id").count())
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters: [isnotnull(date" in scan
    assert "ReadSchema: struct<zone_id:bigint>" in scan
    train = plan_of(store.read("features").filter("date < DATE'2024-01-22'").select("demand"))
    assert "PartitionFilters: [isnotnull(date" in train


def test_trips_are_scanned_once_and_shuffled_as_partial_sums(spark):
    plan = plan_of(demand.zone_hour_totals(clean(spark, SF)))
    assert plan.count("FileScan parquet") == plan.count("Exchange ") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
    assert plan.index("Exchange ") < plan.index("partial_sum")


def test_features_read_only_stored_totals_and_shuffle_only_modelled_ones(spark):
    plan = plan_of(features(spark, SF))
    assert "events.parquet" not in plan
    # Totals outside the modelled zones and hours go before they are shuffled: a bounded
    # broadcast of the zones meets them in the scan, below the union with the empty grid.
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert plan.index("Union") < plan.index("BroadcastHashJoin")
    assert "Window [min" not in plan and "Exchange SinglePartition, ENSURE_REQUIREMENTS" not in plan.split("Subquery")[0]


def test_zone_table_is_broadcast_only_within_its_bound(spark, store):
    totals, zones = store.read("zone_hour_totals"), store.read("zones")
    assert "BroadcastHashJoin" in plan_of(demand.zone_hour_pickups(totals, zones, PARAMS))
    wide = replace(PARAMS, top_zones=10**7, grid=replace(PARAMS.grid, lon_max=1e9))
    assert "SortMergeJoin" in plan_of(demand.zone_hour_pickups(totals, zones.hint("merge"), wide))

"""Tables that change in place: rejected rows, replaced partitions, totals by batch, and the life of scratch tables."""

import os
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hailgrid.catalog.inputs import PARAMS, clean, trips
from hailgrid.operators.demand import zone_hour_totals
from hailgrid.operators.filters import is_valid_trip, quality_counts
from hailgrid.plans import increments
from hailgrid.plans.cleaning import checked_trips, clean_trips, split_trips
from hailgrid.sources.tables import ResultStore, remove_scratch, scratch_store, shared_folder, sweep_scratch
from hailgrid.sources.trips import read_trips_csv, write_trips_csv

SF = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    return ResultStore(spark, str(tmp_path))


def rows(df, *names):
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=repr)


# ---- rejected trips -------------------------------------------------------


def test_every_trip_is_on_one_side(spark, store):
    raw = trips(spark, SF)
    checked = split_trips(store, raw, PARAMS)
    total, valid, removed = quality_counts(raw, is_valid_trip(PARAMS)).first()
    assert (checked.counts["total"], checked.counts["kept"], checked.counts["rejected"]) == (total, valid, removed)
    assert rows(checked.clean) == rows(clean_trips(raw, PARAMS))
    assert {r["id"] for r in checked.clean.collect()} | {r["id"] for r in checked.rejected.collect()} == {r["id"] for r in raw.collect()}
    assert checked.rejected.count() == removed and checked.rejected.filter("size(reasons) = 0").count() == 0
    for rule in ("pickup_place", "duration", "passengers"):
        assert checked.counts[rule] == checked.rejected.filter(F.array_contains("reasons", rule)).count() > 0


def test_a_side_is_read_alone(spark, store):
    checked = split_trips(store, trips(spark, SF), PARAMS)
    plan = checked.clean.filter("date = DATE'2024-01-10'").select("zone_id")._jdf.queryExecution().executedPlan().toString()
    assert "kept" in plan.split("PartitionFilters:")[1].split("]")[0] and "ReadSchema: struct<zone_id:bigint>" in plan
    assert store.read("clean").count() == checked.counts["kept"] and store.read("rejected").count() == checked.counts["rejected"]


@pytest.mark.parametrize("in_date_order", [False, True])
def test_unreadable_values_are_kept_as_text(spark, store, tmp_path, in_date_order):
    damaged = trips(spark, SF).limit(50).withColumn("pickup_ts", F.when(F.col("id") % 2 == 0, F.lit("soon")).otherwise(F.col("pickup_ts").cast("string")))
    write_trips_csv(damaged, str(tmp_path / "raw"))
    checked = split_trips(store, read_trips_csv(spark, str(tmp_path / "raw"), keep_text=True), PARAMS, in_date_order)
    lost = checked.rejected.filter(F.array_contains("reasons", "pickup_time"))
    assert lost.count() == checked.counts["pickup_time"] == damaged.filter("id % 2 = 0").count()
    assert {r[0] for r in lost.select(F.get_json_object("raw_text", "$.pickup_datetime")).collect()} == {"soon"}
    assert lost.filter("date IS NOT NULL").count() == 0
    assert checked.rejected.filter("raw_text IS NULL").count() == 0


def test_nulls_break_every_rule(spark):
    empty = trips(spark, SF).limit(1).select([F.lit(None).cast(t).alias(c) for c, t in trips(spark, SF).dtypes])
    assert checked_trips(empty, PARAMS).first()["reasons"] == ["pickup_time", "dropoff_time", "pickup_place", "dropoff_place", "duration", "passengers"]


def test_no_trips_give_two_empty_sides(spark, store):
    checked = split_trips(store, trips(spark, SF).limit(0), PARAMS)
    assert checked.clean.count() == checked.rejected.count() == 0 and set(checked.counts.values()) == {0}


# ---- single partitions ----------------------------------------------------

DAYS = [(1, date(2024, 1, 1)), (2, date(2024, 1, 1)), (3, date(2024, 1, 2)), (4, date(2024, 1, 3))]


def test_one_date_is_replaced_and_others_stay(spark, store):
    make = lambda data: spark.createDataFrame(data, "id long, date date")
    store.write(make(DAYS), "days", date_column="date")
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(store.path("days") + "/date=2024-01-03") for f in names}
    for _ in range(2):  # a rerun changes nothing
        table = store.replace(make([(9, date(2024, 1, 1))]), "days", ["date"])
        assert rows(table) == rows(make([(9, date(2024, 1, 1)), *DAYS[2:]]))
    after = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(store.path("days") + "/date=2024-01-03") for f in names}
    assert before == after


def test_a_partition_in_scope_without_rows_is_emptied(spark, store):
    make = lambda data: spark.createDataFrame(data, "id long, date date")
    store.write(make(DAYS), "days", date_column="date")
    table = store.replace(make(DAYS[:1]), "days", ["date"], [(date(2024, 1, 1),), (date(2024, 1, 2),)])
    assert rows(table) == rows(make([DAYS[0], DAYS[3]]))
    with pytest.raises(Exception, match="outside the partitions"):
        store.replace(make(DAYS), "days", ["date"], [(date(2024, 1, 1),)])
    assert rows(spark.read.parquet(store.path("days")), "id") == [(1,), (4,)]
    with pytest.raises(ValueError):
        store.replace(make(DAYS[:1]), "days", ["date"], [("../x",)])


def test_a_table_may_be_replaced_from_itself(spark, store):
    make = lambda data: spark.createDataFrame(data, "id long, date date")
    table = store.write(make(DAYS), "days", date_column="date")
    table = store.replace(table.filter("id = 2"), "days", ["date"])
    assert rows(table, "id") == [(2,), (3,), (4,)]


# ---- totals by batch ------------------------------------------------------


def test_batches_merge_to_one_run_in_any_order(spark, store):
    cleaned = clean(spark, SF)
    days = [r["date"] for r in cleaned.select("date").distinct().orderBy("date").collect()]
    rng = random.Random(1)
    cut = sorted(rng.sample(days, 3))
    parts = [cleaned.filter((F.col("date") >= lo) & (F.col("date") < hi)) for lo, hi in zip([days[0], *cut], [*cut, date(2100, 1, 1)], strict=True)]
    for k in (2, 0, 3, 1, 0):
        touched = increments.add_batch(store, parts[k], f"part-{k}")
    # a night trip ends on the first day of the next part: that day is touched too
    assert cut[0] in touched or touched[-1] < cut[0]
    want = zone_hour_totals(cleaned)
    names = ["zone_id", "ts", "demand", "dropoffs", "seconds"]
    assert rows(increments.merged_totals(store), *names) == rows(want, *names)
    slots = want.groupBy("zone_id", F.dayofweek("ts").alias("dow"), F.hour("ts").alias("hour")).agg(
        F.sum("demand").alias("demand"), F.sum("dropoffs").alias("dropoffs"), F.sum("seconds").alias("seconds"), F.count("*").alias("busy_hours")
    )
    assert rows(increments.merged_slots(store), *slots.columns) == rows(slots)


def test_a_batch_that_shrinks_takes_its_old_hours_back(spark, store):
    kinds = "zone_id long, pickup_ts timestamp_ntz, drop_zone_id long, dropoff_ts timestamp_ntz, trip_duration int"
    at = lambda day, hour: datetime(2024, 1, day, hour)
    first = [(1, at(1, 9), 2, at(1, 10), 60), (1, at(2, 23), 3, at(3, 0), 90)]
    increments.add_batch(store, spark.createDataFrame(first, kinds), "a")
    increments.add_batch(store, spark.createDataFrame([(1, at(3, 0), 1, at(3, 0), 5)], kinds), "b")
    assert increments.add_batch(store, spark.createDataFrame(first[:1], kinds), "a") == [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]
    assert rows(increments.merged_totals(store), "zone_id", "ts", "demand", "dropoffs", "seconds") == [
        (1, at(1, 9), 1, 0, 60), (1, at(3, 0), 1, 1, 5), (2, at(1, 10), 0, 1, 0)
    ]
    assert rows(increments.merged_slots(store), "zone_id", "dow", "hour", "demand") == [(1, 2, 9, 1), (1, 4, 0, 1), (2, 2, 10, 0)]
    assert increments.add_batch(store, spark.createDataFrame([], kinds), "empty") == []


# ---- scratch tables -------------------------------------------------------


def test_scratch_is_empty_once_a_result_is_consumed(spark):
    from hailgrid.catalog import QUERIES

    sweep_scratch(spark, collect=True)
    before = set(sweep_scratch(spark))
    result = QUERIES["zone_hour_features"](spark, SF)
    folders = set(sweep_scratch(spark, collect=True)) - before
    assert folders and all(os.path.exists(f) for f in folders)
    count = result.groupBy("zone_id").count()
    del result  # a derived table still reads it
    assert not set(sweep_scratch(spark, collect=True)) < folders and all(os.path.exists(f) for f in folders)
    assert count.count() > 0
    del count
    for _ in range(5):
        if not folders & set(sweep_scratch(spark, collect=True)):
            break
    assert not any(os.path.exists(f) for f in folders)


def test_an_open_store_keeps_its_tables(spark):
    store = scratch_store(spark, "open")
    store.write(spark.range(5), "numbers")
    assert store.base in sweep_scratch(spark, collect=True)
    assert store.read("numbers").count() == 5


def test_model_queries_fit_again_when_their_folder_is_gone(spark):
    from hailgrid.catalog import forecasts

    forecasts._FITTED[spark.sparkContext.applicationId, "nowhere"] = (shared_folder(spark, "model") + "/m", "s")
    remove_scratch(spark)
    with pytest.raises(Exception, match="nowhere"):
        forecasts._fitted(spark, "nowhere")

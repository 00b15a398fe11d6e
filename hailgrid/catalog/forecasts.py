"""Forecast queries. Fitted trees have no SQL twin; their inputs, splits and baselines do."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, SparkSession, functions as F

from hailgrid.catalog.inputs import PARAMS, dense, features, stored_features, totals, week_tables
from hailgrid.catalog.registry import query
from hailgrid.catalog.sql import TRAIN_END, day_number, with_tables
from hailgrid.operators import accuracy, zone_hours
from hailgrid.operators.demand import slot_demand
from hailgrid.operators.filters import in_hash_fraction, split_by_date
from hailgrid.plans import forecasting
from hailgrid.plans.jobs import MODEL_PATH
from hailgrid.sources.tables import ResultStore, is_held, scratch_store, shared_folder

METRICS_SQL = """SELECT 'baseline_zone_hour_dow_mean' AS model, {mean} AS mae, {mean_rmse} AS rmse FROM test
UNION ALL SELECT 'baseline_same_slot_last_week', {lag}, {lag_rmse} FROM test""".format(
    mean="round(avg(abs(demand - hist_mean)), 6)",
    mean_rmse="round(sqrt(avg(pow(demand - hist_mean, 2))), 6)",
    lag="round(avg(abs(demand - lag_168)), 6)",
    lag_rmse="round(sqrt(avg(pow(demand - lag_168, 2))), 6)",
)
TEST_SQL = f"test AS MATERIALIZED (SELECT * FROM features WHERE date >= {TRAIN_END})"


#: By application and input: the paths of the boosted trees and of the test dates they scored.
_FITTED: dict[tuple[str, str], tuple[str, str]] = {}


def _fitted(spark: SparkSession, sf: str) -> tuple[str, str]:
    """One fit serves a session's model queries, until its folder is removed."""
    key = spark.sparkContext.applicationId, sf
    if not (key in _FITTED and is_held(_FITTED[key][0])):
        store = ResultStore(spark, shared_folder(spark, "model"))
        train, test = split_by_date(stored_features(spark, sf), PARAMS.train_end)
        model = forecasting.train_boosted(train)
        model.write().overwrite().save(store.path(MODEL_PATH))
        store.write(forecasting.held_out_predictions(model, test), "scored")
        _FITTED[key] = store.path(MODEL_PATH), store.path("scored")
    return _FITTED[key]


def _held_out(spark, sf):
    """The test dates, scored by the model fitted on the train dates of the stored features."""
    return spark.read.parquet(_fitted(spark, sf)[1])


def _slot_forecast(spark, sf):
    store = scratch_store(spark, "slots")
    return forecasting.slot_forecast(store.write(slot_demand(totals(spark, sf, "date", "hour")), "slot_demand"))


def _rounded(metrics):
    return metrics.select("model", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


@query(
    "hash_split",
    with_tables(
        f"""SELECT *, CAST('0x' || substr(md5('42:' || pickup_hour || ':' || day_of_week), 1, 8) AS BIGINT) % 10000 < 8000
  AS is_train
FROM (SELECT CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, {day_number('pickup_ts')} AS day_of_week,
  count(*) AS total_trips FROM trips GROUP BY ALL)""",
        "trips",
    ),
)
def hash_split(spark, sf):
    side = in_hash_fraction(["pickup_hour", "day_of_week"], 0.8, 42)
    return slot_demand(totals(spark, sf, "date", "hour")).withColumn("is_train", side)


@query("rf_slot_forecast")
def rf_slot_forecast(spark, sf):
    return _slot_forecast(spark, sf)


@query("gbt_forecast")
def gbt_forecast(spark, sf):
    return _held_out(spark, sf).select("zone_id", "ts", "demand", "prediction")


@query("test_preds")
def test_preds(spark, sf):
    scored = _held_out(spark, sf).drop("lag_168")
    return scored.withColumn("error", F.col("prediction") - F.col("demand"))


@query("model_metrics")
def model_metrics(spark, sf):
    return forecasting.model_metrics(_held_out(spark, sf))


@query("baseline_metrics", with_tables(METRICS_SQL, "features", extra=TEST_SQL))
def baseline_metrics(spark, sf):
    _, test = split_by_date(features(spark, sf), PARAMS.train_end)
    return _rounded(forecasting.baseline_metrics(test))


@query(
    "metric_gain",
    with_tables(
        """SELECT round(avg(abs(demand - hist_mean)), 6) AS model_mae, round(avg(abs(demand - lag_168)), 6) AS baseline_mae,
  round(1 - avg(abs(demand - hist_mean)) / avg(abs(demand - lag_168)), 6) AS gain FROM test""",
        "features",
        extra=TEST_SQL,
    ),
)
def metric_gain(spark, sf):
    _, test = split_by_date(features(spark, sf), PARAMS.train_end)
    gain = accuracy.metric_gain(forecasting.baseline_metrics(test), forecasting.SLOT_MEAN, forecasting.LAST_WEEK)
    return gain.select(*[F.round(name, 6).alias(name) for name in gain.columns])


@query(
    "typical_grid",
    with_tables(
        """SELECT zone_id, dow, hour, s / n AS hist_mean, CAST(dow IN (1, 7) AS INTEGER) AS is_weekend,
  CAST(zone_id // 100 AS INTEGER) AS zone_x, CAST(zone_id % 100 AS INTEGER) AS zone_y, s / n AS lag_168 FROM stats""",
        "stats",
    ),
)
def typical_grid(spark, sf):
    return forecasting.typical_week(zone_hours.hist_mean(dense(spark, sf), PARAMS.train_end))


def _pred_grid(spark, sf):
    """Load the stored model and score every zone and weekly slot."""
    model = PipelineModel.load(_fitted(spark, sf)[0])
    return forecasting.predict_grid(model, week_tables(spark, sf).hist)


@query("pred_grid")
def pred_grid(spark, sf):
    return _pred_grid(spark, sf)


# What SQL can say of the fitted results: keys, actuals, baselines, bounds.


@query(
    "test_preds_keys",
    with_tables("SELECT zone_id, ts, demand, hist_mean, true AS not_negative FROM test", "features", extra=TEST_SQL),
)
def test_preds_keys(spark, sf):
    return _held_out(spark, sf).select("zone_id", "ts", "demand", "hist_mean", (F.col("prediction") >= 0).alias("not_negative"))


@query("pred_grid_keys", with_tables("SELECT zone_id, dow, hour, hist_mean, true AS not_negative FROM pred_grid", "pred_grid"))
def pred_grid_keys(spark, sf):
    return _pred_grid(spark, sf).select("zone_id", "dow", "hour", "hist_mean", (F.col("prediction") >= 0).alias("not_negative"))


@query("model_metrics_baselines", with_tables(METRICS_SQL, "features", extra=TEST_SQL))
def model_metrics_baselines(spark, sf):
    metrics = forecasting.model_metrics(_held_out(spark, sf))
    return _rounded(metrics.filter(F.col("model") != forecasting.MODEL))


@query(
    "rf_slot_keys",
    with_tables(
        f"""SELECT *, true AS in_range FROM (SELECT CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, {day_number('pickup_ts')} AS day_of_week,
  count(*) AS total_trips FROM trips GROUP BY ALL)
WHERE CAST('0x' || substr(md5('42:' || pickup_hour || ':' || day_of_week), 1, 8) AS BIGINT) % 10000 >= 8000""",
        "trips",
    ),
)
def rf_slot_keys(spark, sf):
    """A forest averages totals it has seen, so no forecast leaves their range."""
    forecast = _slot_forecast(spark, sf)
    seen = slot_demand(totals(spark, sf, "date", "hour")).agg(F.struct(F.min("total_trips").alias("lo"), F.max("total_trips").alias("hi"))).scalar()
    inside = F.col("prediction").between(seen["lo"], seen["hi"])
    return forecast.select("pickup_hour", "day_of_week", "total_trips", inside.alias("in_range"))


# What must hold of fitted values, whatever they are.


@query(
    "model_checks",
    with_tables(
        """SELECT 'baseline_zone_hour_dow_mean' AS baseline, count(*) AS rows, CAST(0 AS BIGINT) AS other_when_reloaded,
  CAST(0 AS BIGINT) AS out_of_reach, true AS same_mae, true AS same_rmse, true AS same_gain, true AS beats_last_week,
  round(avg(abs(demand - hist_mean)), 6) AS baseline_mae FROM test
UNION ALL SELECT 'baseline_same_slot_last_week', count(*), 0, 0, true, true, true, true, round(avg(abs(demand - lag_168)), 6) FROM test""",
        "features",
        extra=TEST_SQL,
    ),
)
def model_checks(spark, sf):
    """The stored model scores the test dates as it did; its errors are recomputed from single rows.

    No prediction lies beyond the sums of the trees' extreme leaves, the gain
    follows from both errors, and the model does better than last week's value.
    """
    model = PipelineModel.load(_fitted(spark, sf)[0])
    lo, hi = (max(x, 0.0) for x in forecasting.leaf_bounds(model.stages[-1]))
    scored = _held_out(spark, sf)
    _, test = split_by_date(stored_features(spark, sf), PARAMS.train_end)
    anew = forecasting.predict(model, test).select("zone_id", "ts", F.col("prediction").alias("anew"))
    error = F.col("prediction") - F.col("demand")
    found = (
        scored.join(anew, ["zone_id", "ts"], "full")
        .agg(
            F.struct(
                F.count("*").alias("rows"),
                F.count_if(~F.col("anew").eqNullSafe(F.col("prediction"))).alias("other"),
                F.count_if(~F.coalesce(F.col("prediction").between(lo - 1e-9, hi + 1e-9), F.lit(False))).alias("out"),
                (F.sum(F.abs(error)) / F.count("*")).alias("mae"),
                F.sqrt(F.sum(error * error) / F.count("*")).alias("rmse"),
                (F.sum(F.abs(F.col("demand") - F.col("lag_168"))) / F.count("*")).alias("last_week"),
            )
        )
        .scalar()
    )
    close = lambda a, b: F.abs(a - b) < 1e-9
    metrics = scratch_store(spark, "metrics").write(forecasting.model_metrics(scored), "metrics")
    rmse = metrics.filter(F.col("model") == forecasting.MODEL).select("rmse").scalar()
    return forecasting.model_gains(metrics).select(
        "baseline",
        found["rows"].alias("rows"),
        found["other"].alias("other_when_reloaded"),
        found["out"].alias("out_of_reach"),
        close(F.col("model_mae"), found["mae"]).alias("same_mae"),
        close(rmse, found["rmse"]).alias("same_rmse"),
        close(F.col("gain"), 1 - found["mae"] / F.col("baseline_mae")).alias("same_gain"),
        (found["mae"] < found["last_week"]).alias("beats_last_week"),
        F.round("baseline_mae", 6).alias("baseline_mae"),
    )


@query(
    "grid_checks",
    with_tables(
        """SELECT zone_id, dow, hour, hist_mean, true AS in_reach, true AS same_alone FROM pred_grid""",
        "pred_grid",
    ),
)
def grid_checks(spark, sf):
    """Every slot of the grid is within the leaves' reach, and predicted alike from a grid in another order."""
    model = PipelineModel.load(_fitted(spark, sf)[0])
    lo, hi = (max(x, 0.0) for x in forecasting.leaf_bounds(model.stages[-1]))
    hist = week_tables(spark, sf).hist
    turned = forecasting.predict_grid(model, hist.repartitionByRange(3, F.desc("hour"), "zone_id"))
    other = turned.select("zone_id", "dow", "hour", F.col("prediction").alias("other"))
    grid = forecasting.predict_grid(model, hist).join(other, ["zone_id", "dow", "hour"])
    inside = F.col("prediction").between(lo - 0.005, hi + 0.005)
    return grid.select("zone_id", "dow", "hour", "hist_mean", inside.alias("in_reach"), (F.col("prediction") == F.col("other")).alias("same_alone"))


@query(
    "rf_slot_checks",
    with_tables(
        f"""SELECT pickup_hour, day_of_week, true AS is_mean_of_trees FROM (SELECT CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
  {day_number('pickup_ts')} AS day_of_week FROM trips GROUP BY ALL)
WHERE CAST('0x' || substr(md5('42:' || pickup_hour || ':' || day_of_week), 1, 8) AS BIGINT) % 10000 >= 8000""",
        "trips",
    ),
)
def rf_slot_checks(spark, sf):
    """Every forecast of the forest is the mean of what its trees say one by one."""
    slots = scratch_store(spark, "slots").write(slot_demand(totals(spark, sf, "date", "hour")), "slot_demand")
    model, test = forecasting.fitted_forest(slots)
    scored, forest = model.transform(test), model.stages[-1]
    for k, tree in enumerate(forest.trees):
        scored = tree.setPredictionCol(f"tree_{k}").transform(scored)
    mean = reduce(Column.__add__, [F.col(f"tree_{k}") for k in range(len(forest.trees))]) / len(forest.trees)
    return scored.select("pickup_hour", "day_of_week", (F.abs(F.col("prediction") - mean) < 1e-6).alias("is_mean_of_trees"))

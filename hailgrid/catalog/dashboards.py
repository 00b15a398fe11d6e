"""Queries behind dashboard figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from hailgrid.catalog.allocation import ALLOC_SIMPLE, SLOT_PREDICTIONS, simple
from hailgrid.catalog.inputs import PARAMS, SHIFT, counted_zones, dense, features, slot_predictions, stored_features, totals, week_tables
from hailgrid.catalog.registry import query
from hailgrid.catalog.sql import TRAIN_END, center, day_number, with_tables
from hailgrid.operators import accuracy, demand, reshape, zone_hours
from hailgrid.operators.filters import hours_between, split_by_date, with_levels
from hailgrid.operators.ranking import largest_per
from hailgrid.plans import dashboards

FIRST, LAST = SHIFT
HOURLY = """hourly AS MATERIALIZED (
SELECT CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, count(*) AS total_trips FROM trips GROUP BY 1
)"""
LEVELS = """levels AS MATERIALIZED (
SELECT zone_id, total_trips, CASE WHEN total_trips <= q[1] THEN 'Low' WHEN total_trips <= q[2] THEN 'Medium'
  ELSE 'High' END AS demand_level
FROM zone_demand, (SELECT quantile_cont(total_trips, [0.33, 0.66]) AS q FROM zone_demand)
)"""


def _hourly(spark, sf):
    return demand.hourly_demand(totals(spark, sf, "hour"))


def _rounded(df, *names):
    return df.withColumns({name: F.round(name, 6) for name in names})


@query(
    "selection_kpis",
    with_tables(
        f"""SELECT CAST(sum(total_trips) AS BIGINT) AS all_trips,
  CAST(sum(total_trips) FILTER (WHERE chosen) AS BIGINT) AS selected_trips,
  round(sum(total_trips) FILTER (WHERE chosen) / sum(total_trips) * 100, 6) AS share_pct,
  round(avg(total_trips) FILTER (WHERE chosen), 6) AS mean_per_hour, count(*) FILTER (WHERE chosen) AS hours
FROM (SELECT *, pickup_hour BETWEEN {FIRST} AND {LAST} AS chosen FROM hourly)""",
        "trips",
        extra=HOURLY,
    ),
)
def selection_kpis(spark, sf):
    return _rounded(dashboards.selection_kpis(_hourly(spark, sf), FIRST, LAST), "share_pct", "mean_per_hour")


@query(
    "peak_hour",
    with_tables(
        f"""SELECT *, lpad(CAST(pickup_hour AS VARCHAR), 2, '0') || ':00' AS label FROM hourly
WHERE pickup_hour BETWEEN {FIRST} AND {LAST} ORDER BY total_trips DESC, pickup_hour LIMIT 1""",
        "trips",
        extra=HOURLY,
    ),
)
def peak_hour(spark, sf):
    return dashboards.peak_hour(_hourly(spark, sf), FIRST, LAST)


@query(
    "peak_day",
    with_tables(
        f"""SELECT {day_number('pickup_ts')} AS day_number, dayname(pickup_ts) AS day_name, count(*) AS total_trips
FROM trips GROUP BY ALL ORDER BY total_trips DESC, day_number LIMIT 1""",
        "trips",
    ),
)
def peak_day(spark, sf):
    return dashboards.peak_day(demand.daily_demand(totals(spark, sf, "date")))


@query("demand_level", with_tables("SELECT * FROM levels", "zone_demand", extra=LEVELS))
def demand_level(spark, sf):
    return reshape.with_demand_level(counted_zones(spark, sf)).select("zone_id", "total_trips", "demand_level")


@query(
    "demand_level_filter",
    with_tables("SELECT * FROM levels WHERE demand_level IN ('High', 'Low')", "zone_demand", extra=LEVELS),
)
def demand_level_filter(spark, sf):
    leveled = reshape.with_demand_level(counted_zones(spark, sf))
    return with_levels(leveled, ["High", "Low"]).select("zone_id", "total_trips", "demand_level")


def _ranked_sql(level: str, n: int) -> str:
    return with_tables(
        f"""SELECT zone_id, total_trips, 'Zone ' || zone_id AS zone FROM levels WHERE demand_level = '{level}'
ORDER BY total_trips DESC, zone_id LIMIT {n}""",
        "zone_demand",
        extra=LEVELS,
    )


@query("busiest_zone", _ranked_sql("Medium", 1))
def busiest_zone(spark, sf):
    return dashboards.ranked_zones(counted_zones(spark, sf), ["Medium"], 1).select("zone_id", "total_trips", "zone")


@query("ranked_zones", _ranked_sql("High", 10))
def ranked_zones(spark, sf):
    return dashboards.ranked_zones(counted_zones(spark, sf), ["High"], 10).select("zone_id", "total_trips", "zone")


@query(
    "hour_range_filter",
    with_tables(
        f"SELECT * FROM slot_predictions WHERE pickup_hour BETWEEN {FIRST} AND {LAST}", "trips", extra=SLOT_PREDICTIONS
    ),
)
def hour_range_filter(spark, sf):
    return hours_between(slot_predictions(spark, sf), FIRST, LAST)


@query(
    "allocation_status_counts",
    with_tables(
        "SELECT allocation_status AS status, count(*) AS records FROM alloc_simple GROUP BY 1", "trips", extra=ALLOC_SIMPLE
    ),
)
def allocation_status_counts(spark, sf):
    return dashboards.status_counts(simple(spark, sf))


@query(
    "worst_shortfall",
    with_tables(
        """SELECT lpad(CAST(pickup_hour AS VARCHAR), 2, '0') || ':00' AS time, day_of_week, required_drivers,
  available_drivers, required_drivers - available_drivers AS gap
FROM alloc_simple WHERE allocation_status = 'Driver Shortage' ORDER BY gap DESC, pickup_hour, day_of_week LIMIT 1""",
        "trips",
        extra=ALLOC_SIMPLE,
    ),
)
def worst_shortfall(spark, sf):
    return dashboards.worst_shortfall(simple(spark, sf))


@query(
    "alloc_unpivot",
    with_tables(
        """SELECT lpad(CAST(pickup_hour AS VARCHAR), 2, '0') || ':00' AS time, day_of_week, 'Required' AS series,
  required_drivers AS drivers FROM alloc_simple
UNION ALL SELECT lpad(CAST(pickup_hour AS VARCHAR), 2, '0') || ':00', day_of_week, 'Available',
  CAST(available_drivers AS BIGINT) FROM alloc_simple""",
        "trips",
        extra=ALLOC_SIMPLE,
    ),
)
def alloc_unpivot(spark, sf):
    return reshape.drivers_long(simple(spark, sf))


@query(
    "error_metrics",
    with_tables(
        """SELECT round(avg(abs(e)), 6) AS mae, round(avg(abs(e) / nullif(total_trips, 0)) * 100, 6) AS mape,
  round(1 - sum(e * e) / sum((total_trips - mean) * (total_trips - mean)), 6) AS r2
FROM (SELECT *, prediction - total_trips AS e, avg(total_trips) OVER () AS mean FROM slot_predictions)""",
        "trips",
        extra=SLOT_PREDICTIONS,
    ),
)
def error_metrics(spark, sf):
    return _rounded(accuracy.error_summary(slot_predictions(spark, sf)), "mae", "mape", "r2")


@query(
    "pred_range",
    with_tables(
        """SELECT least(min(total_trips), min(prediction)) AS lo, greatest(max(total_trips), max(prediction)) AS hi
FROM slot_predictions""",
        "trips",
        extra=SLOT_PREDICTIONS,
    ),
)
def pred_range(spark, sf):
    return accuracy.value_range(slot_predictions(spark, sf))


@query(
    "error_histogram",
    with_tables(
        f"""SELECT CAST(least(floor((e - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS rows
FROM (SELECT e, min(e) OVER () AS lo, max(e) OVER () AS hi
  FROM (SELECT hist_mean - demand AS e FROM features WHERE date >= {TRAIN_END})) GROUP BY 1""",
        "features",
    ),
)
def error_histogram(spark, sf):
    _, test = split_by_date(stored_features(spark, sf), PARAMS.train_end)
    errors = test.select((F.col("hist_mean") - F.col("demand")).alias("error"))
    return accuracy.error_histogram(errors, 30)


ROUND_STEPS = ", ".join(f"{m} * pow(CAST(10 AS DOUBLE), CAST(floor(log10((hi - lo) / 30)) AS DOUBLE) + {e})" for e in (0, 1) for m in (1, 2, 5))


@query(
    "error_histogram_rounded",
    with_tables(
        f"""SELECT CAST(floor(e / step) AS BIGINT) AS bin, step, floor(e / step) * step AS lo, count(*) AS rows
FROM (SELECT e, list_filter([{ROUND_STEPS}], lambda s: floor(hi / s) - floor(lo / s) < 30)[1] AS step
  FROM (SELECT e, min(e) OVER () AS lo, max(e) OVER () AS hi
    FROM (SELECT hist_mean - demand AS e FROM features WHERE date >= {TRAIN_END}))) GROUP BY ALL""",
        "features",
    ),
)
def error_histogram_rounded(spark, sf):
    """At most 30 bins whose edges are multiples of 1, 2 or 5 times a power of ten."""
    _, test = split_by_date(stored_features(spark, sf), PARAMS.train_end)
    errors = test.select((F.col("hist_mean") - F.col("demand")).alias("error"))
    return accuracy.error_histogram_rounded(errors, 30)


@query(
    "daily_actual_vs_pred",
    with_tables(
        f"""SELECT date, CAST(sum(demand) AS BIGINT) AS demand, round(sum(hist_mean), 6) AS prediction
FROM features WHERE date >= {TRAIN_END} GROUP BY date""",
        "features",
    ),
)
def daily_actual_vs_pred(spark, sf):
    _, test = split_by_date(features(spark, sf), PARAMS.train_end)
    predicted = test.select("ts", "demand", F.col("hist_mean").alias("prediction"))
    return _rounded(accuracy.daily_actual_and_predicted(predicted), "prediction")


@query(
    "busiest_test_zone",
    with_tables(
        f"""SELECT zone_id, CAST(sum(demand) AS BIGINT) AS demand FROM features WHERE date >= {TRAIN_END}
GROUP BY zone_id ORDER BY demand DESC, zone_id LIMIT 1""",
        "features",
    ),
)
def busiest_test_zone(spark, sf):
    _, test = split_by_date(features(spark, sf), PARAMS.train_end)
    totals = test.groupBy("zone_id").agg(F.sum("demand").alias("demand"))
    return dashboards.largest_row(totals, "demand", "zone_id")


@query(
    "predicted_by_hour",
    with_tables("SELECT hour, round(sum(prediction), 6) AS prediction FROM pred_grid GROUP BY hour", "pred_grid"),
)
def predicted_by_hour(spark, sf):
    return _rounded(dashboards.predicted_by_hour(week_tables(spark, sf).pred_grid), "prediction")


@query(
    "predicted_peak_hour",
    with_tables(
        """SELECT hour, round(sum(prediction), 6) AS prediction FROM pred_grid
GROUP BY hour ORDER BY prediction DESC, hour LIMIT 1""",
        "pred_grid",
    ),
)
def predicted_peak_hour(spark, sf):
    hours = _rounded(dashboards.predicted_by_hour(week_tables(spark, sf).pred_grid), "prediction")
    return dashboards.largest_row(hours, "prediction", "hour")


@query(
    "zone_day_curve",
    with_tables("SELECT hour, prediction, hist_mean FROM pred_grid WHERE zone_id = 0 AND dow = 5", "pred_grid"),
)
def zone_day_curve(spark, sf):
    return dashboards.zone_day_curve(week_tables(spark, sf).pred_grid, zone=0, dow=5)


@query(
    "profile_pivot",
    with_tables(
        "SELECT dow, CASE dow WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday' WHEN 4 THEN 'Wednesday' "
        "WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' ELSE 'Saturday' END AS day, "
        + ", ".join(f"max(avg_city_trips) FILTER (WHERE hour = {h}) AS h{h:02d}" for h in range(24))
        + " FROM demand_profile GROUP BY dow",
        "demand_profile",
    ),
)
def profile_pivot(spark, sf):
    return reshape.week_matrix(zone_hours.demand_profile(dense(spark, sf)))


@query(
    "zone_map_size",
    with_tables(
        f"""SELECT zone_id, total_trips, lon AS longitude, lat AS latitude, total_trips / max(total_trips) OVER () * 35 + 8
  AS map_size FROM (SELECT zone_id, total_trips, {center('zone_id')} FROM zone_demand)""",
        "zone_demand",
    ),
)
def zone_map_size(spark, sf):
    return reshape.zone_map(counted_zones(spark, sf), PARAMS.grid)


@query(
    "busiest_zone_per_slot",
    with_tables(
        """SELECT dow, hour, zone_id, prediction FROM pred_grid
QUALIFY row_number() OVER (PARTITION BY dow, hour ORDER BY prediction DESC, zone_id) = 1""",
        "pred_grid",
    ),
)
def busiest_zone_per_slot(spark, sf):
    grid = week_tables(spark, sf).pred_grid
    return largest_per(grid, ["dow", "hour"], "prediction", "zone_id")

"""Queries over the zone x hour series."""

from __future__ import annotations

from pyspark.sql import functions as F

from hailgrid.catalog.inputs import FINE, PARAMS, clean, dense, features, modelled_zones, stored_features, stored_totals
from hailgrid.catalog.registry import query
from hailgrid.catalog.sql import TRAIN_END, day_number, tables, with_tables
from hailgrid.operators import demand, zone_hours
from hailgrid.operators.demand import zone_hour_totals
from hailgrid.operators.filters import split_by_date
from hailgrid.operators.ranking import distinct_keys, last_rows
from hailgrid.plans import increments
from hailgrid.plans.increments import add_batch
from hailgrid.sources.tables import scratch_store

CELL_HOURS = """cell_hours AS MATERIALIZED (
SELECT zone_id, ts, CAST(sum(p) AS BIGINT) AS demand, CAST(sum(d) AS BIGINT) AS dropoffs, CAST(sum(s) AS BIGINT) AS seconds FROM (
  SELECT zone_id, date_trunc('hour', pickup_ts) AS ts, 1 AS p, 0 AS d, trip_duration AS s FROM clean
  UNION ALL SELECT drop_zone_id, date_trunc('hour', dropoff_ts), 0, 1, 0 FROM clean) GROUP BY ALL
)"""

DENSE = "zone_id, ts, date, hour, dow, is_weekend, zone_x, zone_y, demand, dropoffs"


@query("hour_timeline", with_tables("SELECT ts FROM hours", "hours"))
def hour_timeline(spark, sf):
    return zone_hours.hour_timeline(zone_hour_totals(clean(spark, sf), dropoffs=False))


@query("zone_hour_demand", with_tables("SELECT * FROM pickups", "pickups"))
def zone_hour_demand(spark, sf):
    totals = stored_totals(spark, sf)
    return demand.zone_hour_pickups(totals, modelled_zones(totals, PARAMS), PARAMS)


@query("zone_hour_dropoffs", with_tables("SELECT * FROM dropoffs", "dropoffs"))
def zone_hour_dropoffs(spark, sf):
    totals = stored_totals(spark, sf)
    return demand.zone_hour_dropoffs(totals, modelled_zones(totals, PARAMS), PARAMS)


@query("dense_demand", with_tables(f"SELECT {DENSE} FROM dense", "dense"))
def dense_demand(spark, sf):
    return dense(spark, sf)


@query("lag_168", with_tables("SELECT zone_id, ts, demand, CAST(lag_168 AS DOUBLE) AS lag_168 FROM data", "data"))
def lag_168(spark, sf):
    lagged = zone_hours.with_weekly_lag(dense(spark, sf))
    return lagged.select("zone_id", "ts", "demand", F.col("lag_168").cast("double").alias("lag_168"))


@query(
    "lag_168_sparse",
    with_tables(
        """SELECT zone_id, ts, demand, CAST(CASE WHEN ts - INTERVAL 168 HOUR >= (SELECT min(date_trunc('hour', pickup_ts)) FROM clean)
  THEN coalesce(sum(demand) OVER (PARTITION BY zone_id ORDER BY ts RANGE BETWEEN INTERVAL 168 HOUR PRECEDING AND INTERVAL 168 HOUR PRECEDING), 0)
  END AS DOUBLE) AS lag_168
FROM cell_hours""",
        "clean",
        extra=CELL_HOURS,
    ),
)
def lag_168_sparse(spark, sf):
    """Last week's demand for every cell of the grid, modelled or not, at the hours in which anything happened."""
    lagged = zone_hours.with_sparse_lag(stored_totals(spark, sf))
    return lagged.select("zone_id", "ts", "demand", F.col("lag_168").cast("double").alias("lag_168"))


def _in_batches(spark, sf):
    """The clean trips added as three batches, the second of them twice and with other trips the first time."""
    store, trips = scratch_store(spark, "batches"), clean(spark, sf)
    part = lambda k: trips.filter(F.col("id") % 3 == k)
    add_batch(store, part(0), "a")
    add_batch(store, trips.filter("id % 5 = 0"), "b")
    add_batch(store, part(2), "c")
    add_batch(store, part(1), "b")
    return store


@query("merged_totals", with_tables("SELECT zone_id, ts, demand, dropoffs, seconds FROM cell_hours", "clean", extra=CELL_HOURS))
def merged_totals(spark, sf):
    """Totals by cell and hour, added up batch by batch."""
    return increments.merged_totals(_in_batches(spark, sf))


@query(
    "merged_slots",
    with_tables(
        f"""SELECT zone_id, {day_number('ts')} AS dow, CAST(hour(ts) AS INTEGER) AS hour, CAST(sum(demand) AS BIGINT) AS demand,
  CAST(sum(dropoffs) AS BIGINT) AS dropoffs, CAST(sum(seconds) AS BIGINT) AS seconds, count(*) AS busy_hours
FROM cell_hours GROUP BY ALL""",
        "clean",
        extra=CELL_HOURS,
    ),
)
def merged_slots(spark, sf):
    """Sums by cell, weekday and hour, kept up to date batch by batch."""
    return increments.merged_slots(_in_batches(spark, sf))


@query("hist_mean_loo", with_tables("SELECT zone_id, ts, dow, hour, demand, hist_mean FROM data", "data"))
def hist_mean_loo(spark, sf):
    return zone_hours.with_hist_mean(dense(spark, sf), PARAMS.train_end).select(
        "zone_id", "ts", "dow", "hour", "demand", "hist_mean"
    )


@query("zone_hour_features", with_tables(f"SELECT {DENSE}, hist_mean, lag_168 FROM features", "features"))
def zone_hour_features(spark, sf):
    return features(spark, sf)


@query("hist_mean", with_tables("SELECT zone_id, dow, hour, s / n AS hist_mean FROM stats", "stats"))
def hist_mean(spark, sf):
    return zone_hours.hist_mean(dense(spark, sf), PARAMS.train_end)


@query("supply_proxy", with_tables("SELECT * FROM supply_proxy", "supply_proxy"))
def supply_proxy(spark, sf):
    return zone_hours.supply_proxy(dense(spark, sf))


@query("demand_profile", with_tables("SELECT * FROM demand_profile", "demand_profile"))
def demand_profile(spark, sf):
    return zone_hours.demand_profile(dense(spark, sf))


@query(
    "time_split",
    with_tables(
        f"""SELECT CASE WHEN date < {TRAIN_END} THEN 'train' ELSE 'test' END AS side, zone_id, date,
  count(*) AS rows, CAST(sum(demand) AS BIGINT) AS demand FROM features GROUP BY ALL""",
        "features",
    ),
)
def time_split(spark, sf):
    def per_day(rows, side):
        sums = rows.groupBy("zone_id", "date").agg(F.count("*").alias("rows"), F.sum("demand").alias("demand"))
        return sums.select(F.lit(side).alias("side"), "zone_id", "date", "rows", "demand")

    train, test = split_by_date(stored_features(spark, sf), PARAMS.train_end)
    return per_day(train, "train").unionByName(per_day(test, "test"))


@query(
    "distinct_zones",
    with_tables("SELECT DISTINCT zone_id FROM features", "features"),
)
def distinct_zones(spark, sf):
    return distinct_keys(features(spark, sf), "zone_id")


@query(
    "last_week_series",
    with_tables(
        """SELECT zone_id, ts, demand, hist_mean FROM features
QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY ts DESC) <= 168""",
        "features",
    ),
)
def last_week_series(spark, sf):
    return last_rows(features(spark, sf), "zone_id", "ts", 168).select("zone_id", "ts", "demand", "hist_mean")


@query(
    "zone_hour_features_fine",
    with_tables(f"SELECT {DENSE}, hist_mean, lag_168 FROM features", "features", ctes=tables(FINE, [(FINE.fleet, FINE.trips_per_driver)])),
)
def zone_hour_features_fine(spark, sf):
    """Cells of 0.01 degrees and 200 zones."""
    return features(spark, sf, FINE)

"""The zone x hour time series: zero filling, lag, historical means, weekly-slot summaries.

Everything here works on totals per cell and hour, a number of rows set by the
grid and the period and not by the count of trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hailgrid.functions.clock import HOURS_PER_WEEK, with_calendar
from hailgrid.functions.geo import zone_x, zone_y
from hailgrid.operators.filters import before_date
from hailgrid.operators.sizes import broadcast_within, shuffle_partitions
from hailgrid.params import ZONE_STRIDE, RideParams

SLOT = ["zone_id", "dow", "hour"]
EVERY_HOUR = "explode(sequence(first_hour, last_hour, INTERVAL 1 HOUR)) AS ts"
FEATURES = ["hour", "dow", "is_weekend", "zone_x", "zone_y", "hist_mean", "lag_168"]


def hour_timeline(totals: DataFrame) -> DataFrame:
    """Every hour from the first to the last pickup, busy or not."""
    busy = totals.filter("demand > 0")
    return busy.agg(F.min("ts").alias("first_hour"), F.max("ts").alias("last_hour")).selectExpr(EVERY_HOUR)


def dense_demand(totals: DataFrame, zones: DataFrame, params: RideParams) -> DataFrame:
    """Pickups and drop-offs for every zone and every hour, zeros included.

    ``zones`` carries ``first_hour`` and ``last_hour``, so each zone unfolds its
    own timeline and no zones-by-hours join is needed. Totals of other zones and
    of hours outside the span are dropped before anything moves; the empty grid
    is put under the rest and one grouping fills it.
    """
    spans = broadcast_within(zones.select("zone_id", "first_hour", "last_hour"), params.max_zones)
    spread = zones.repartition(min(shuffle_partitions(zones), params.max_zones), "zone_id")
    grid = spread.selectExpr("zone_id", EVERY_HOUR, "0L AS demand", "0L AS dropoffs")
    counted = totals.join(spans, "zone_id").filter("ts BETWEEN first_hour AND last_hour")
    return (
        grid.unionByName(counted.select("zone_id", "ts", "demand", "dropoffs"))
        .groupBy("zone_id", "ts")
        .agg(F.sum("demand").alias("demand"), F.sum("dropoffs").alias("dropoffs"))
    )


def with_zone_calendar(dense: DataFrame, stride: int = ZONE_STRIDE) -> DataFrame:
    zone = F.col("zone_id")
    return with_calendar(dense).withColumns({"zone_x": zone_x(zone, stride), "zone_y": zone_y(zone, stride)})


def with_weekly_lag(dense: DataFrame) -> DataFrame:
    """Demand one week earlier. The series is dense, so 168 rows back is 168 hours back."""
    series = Window.partitionBy("zone_id").orderBy("ts")
    return dense.withColumn("lag_168", F.lag("demand", HOURS_PER_WEEK).over(series))


def with_sparse_lag(totals: DataFrame, hours: int = HOURS_PER_WEEK) -> DataFrame:
    """Demand some hours earlier, for totals that hold only hours in which something happened.

    The frame goes by time and not by rows: it holds the one row of that
    earlier hour, if there is one. An hour without a row had no demand; before
    the first pickup anywhere nothing is known (null). So all cells of the grid
    get a lag, and no empty hour is ever made. ``totals`` is read for the first
    hour and for the rows: hand in a stored table.
    """
    hour = f"INTERVAL {hours} HOURS"
    earlier = F.expr(f"sum(demand) OVER (PARTITION BY zone_id ORDER BY ts RANGE BETWEEN {hour} PRECEDING AND {hour} PRECEDING)")
    first = totals.agg(F.min(F.when(F.col("demand") > 0, F.col("ts")))).scalar()
    known = F.expr(f"ts - {hour}") >= first
    return totals.withColumn(f"lag_{hours}", F.when(known, F.coalesce(earlier, F.lit(0))))


def with_hist_mean(data: DataFrame, train_end: str, min_rows: int = 1) -> DataFrame:
    """Mean train demand of the row's zone, weekday and hour.

    A train row leaves its own value out. If it is the only train row of its
    slot it keeps its own value; ``min_rows=2`` gives null there instead. The
    window is partitioned within zones, so behind ``with_weekly_lag`` it sorts
    again but moves no row.
    """
    slot = Window.partitionBy(*SLOT)
    is_train = before_date(train_end)
    total = F.sum(F.when(is_train, F.col("demand"))).over(slot)
    rows = F.count(F.when(is_train, F.lit(1))).over(slot)
    data = data.withColumns({"slot_total": total, "slot_rows": rows})
    others = (F.col("slot_total") - F.col("demand")) / F.nullif(F.col("slot_rows") - 1, F.lit(0))
    plain = F.col("slot_total") / F.nullif(F.col("slot_rows"), F.lit(0))
    mean = F.when(is_train & (F.col("slot_rows") > 1), others)
    if min_rows > 1:
        mean = mean.when(is_train & (F.col("slot_rows") < min_rows), F.lit(None))
    return data.withColumn("hist_mean", mean.otherwise(plain)).drop("slot_total", "slot_rows")


def slot_summary(data: DataFrame, train_end: str) -> DataFrame:
    """Mean train demand, mean drop-offs and their sum per zone, weekday and hour, from one grouping.

    The sum of drop-offs is what shares are taken by: every zone has the same
    dates in a slot, so sums share like means, and whole numbers share exactly.
    ``trips`` are the pickups of all dates.
    """
    train = F.when(before_date(train_end), F.col("demand"))
    return data.groupBy(*SLOT).agg(
        (F.sum(train) / F.nullif(F.count(train), F.lit(0))).alias("hist_mean"),
        F.avg("dropoffs").alias("avg_dropoffs"),
        F.sum("dropoffs").alias("dropoffs"),
        F.sum("demand").alias("trips"),
    )


def hist_of(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("hist_mean").isNotNull()).select(*SLOT, "hist_mean")


def supply_of(summary: DataFrame) -> DataFrame:
    return summary.select(*SLOT, "avg_dropoffs", "dropoffs")


def hist_mean(data: DataFrame, train_end: str) -> DataFrame:
    """Mean train demand per zone, weekday and hour."""
    return (
        data.filter(before_date(train_end))
        .groupBy(*SLOT)
        .agg((F.sum("demand") / F.count("*")).alias("hist_mean"))
    )


def supply_proxy(data: DataFrame) -> DataFrame:
    """Mean and sum of drop-offs per zone, weekday and hour over all dates, zeros included."""
    return data.groupBy(*SLOT).agg(F.avg("dropoffs").alias("avg_dropoffs"), F.sum("dropoffs").alias("dropoffs"))


def demand_profile(data: DataFrame) -> DataFrame:
    """Mean over dates of the total of all modelled zones, per weekday and hour."""
    per_date = data.groupBy("date", "dow", "hour").agg(F.sum("demand").alias("trips"))
    return per_date.groupBy("dow", "hour").agg(F.round(F.avg("trips"), 1).alias("avg_city_trips"))


def feature_table(data: DataFrame) -> DataFrame:
    """Model input: rows that have a value one week earlier."""
    return data.filter(F.col("lag_168").isNotNull()).select(
        "zone_id", "ts", "date", *FEATURES, "demand", "dropoffs"
    )

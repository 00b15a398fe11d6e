"""Queries over single trips: sources, sinks, filters, scalar functions, simple reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from hailgrid.catalog.inputs import PARAMS, all_zones, clean, points, stored_zones, totals, trips, zone_table
from hailgrid.catalog.registry import query
from hailgrid.catalog.sql import LAT_MIN, LON_MIN, CELL, day_number, in_box, with_tables, zone
from hailgrid.functions import clock, geo
from hailgrid.functions.text import hour_label, zone_label
from hailgrid.operators import demand, nearest
from hailgrid.operators.filters import is_valid_trip, pickup_in_box, quality_counts
from hailgrid.operators.quantiles import quantile_table
from hailgrid.operators.ranking import first_n, top_n
from hailgrid.plans.cleaning import split_trips
from hailgrid.sources.tables import leased, scratch_store, shared_folder
from hailgrid.sources.trips import read_trips_csv, write_trips_csv

GRID = PARAMS.grid
PICKUP_ZONE = zone("pickup_longitude", "pickup_latitude")


@query("csv_roundtrip", with_tables("SELECT * FROM trips", "trips"))
def csv_roundtrip(spark, sf):
    path = shared_folder(spark, "csv")
    write_trips_csv(trips(spark, sf), path)
    return leased(read_trips_csv(spark, path), path).withColumn("id", F.col("id").cast("long"))


@query("csv_decimal_roundtrip", with_tables("SELECT * FROM trips", "trips"))
def csv_decimal_roundtrip(spark, sf):
    """Whole numbers written as decimals are read back as whole numbers."""
    path = shared_folder(spark, "csv-decimal")
    decimals = {name: F.format_string("%d.0", name) for name in ("passenger_count", "trip_duration")}
    write_trips_csv(trips(spark, sf).withColumns(decimals), path)
    return leased(read_trips_csv(spark, path), path).withColumn("id", F.col("id").cast("long"))


@query(
    "report_csv_roundtrip",
    with_tables(
        "SELECT CAST(dayofweek(pickup_ts) + 1 AS INTEGER) AS day_number, dayname(pickup_ts) AS day_name, "
        "count(*) AS total_trips FROM trips GROUP BY ALL",
        "trips",
    ),
)
def report_csv_roundtrip(spark, sf):
    store = scratch_store(spark, "report")
    return store.write_csv(demand.daily_demand(totals(spark, sf, "date")), "daily_demand")


@query("parquet_roundtrip", with_tables("SELECT * FROM clean", "clean"))
def parquet_roundtrip(spark, sf):
    store = scratch_store(spark, "parquet")
    return store.write(clean(spark, sf), "clean")


@query(
    "partition_scan",
    with_tables("SELECT * FROM clean WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'", "clean"),
)
def partition_scan(spark, sf):
    store = scratch_store(spark, "by-date")
    stored = store.write(clean(spark, sf), "clean", date_column="date")
    first, last = F.lit("2024-01-10").cast("date"), F.lit("2024-01-16").cast("date")
    return stored.filter(F.col("date").between(first, last))


REWRITTEN = "2024-01-12"


@query(
    "replaced_date",
    with_tables(
        f"SELECT * FROM clean WHERE date <> DATE '{REWRITTEN}' OR passenger_count >= 3",
        "clean",
    ),
)
def replaced_date(spark, sf):
    """One date is written again with fewer trips; all other dates stay as they were."""
    store = scratch_store(spark, "replaced")
    table = store.write(clean(spark, sf), "trips_by_date", date_column="date")
    again = table.filter((F.col("date") == F.lit(REWRITTEN).cast("date")) & (F.col("passenger_count") >= 3))
    return store.replace(again, "trips_by_date", ["date"], [(REWRITTEN,)])


def _damaged(spark, sf):
    """The trips as CSV in which some times and numbers cannot be read, read back with their text."""
    path = shared_folder(spark, "damaged")
    rows = trips(spark, sf).withColumns(
        {
            "pickup_ts": F.when(F.col("id") % 13 == 0, F.lit("no time")).otherwise(F.col("pickup_ts").cast("string")),
            "trip_duration": F.when(F.col("id") % 17 == 0, F.lit("long")).otherwise(F.col("trip_duration").cast("string")),
        }
    )
    write_trips_csv(rows, path)
    return leased(read_trips_csv(spark, path, keep_text=True), path).withColumn("id", F.col("id").cast("long"))


REASONS = f"""reasons AS MATERIALIZED (
SELECT *, list_filter([CASE WHEN id % 13 = 0 THEN 'pickup_time' END,
  CASE WHEN NOT ({in_box('pickup')}) THEN 'pickup_place' END, CASE WHEN NOT ({in_box('dropoff')}) THEN 'dropoff_place' END,
  CASE WHEN id % 17 = 0 OR NOT trip_duration BETWEEN {PARAMS.min_seconds} AND {PARAMS.max_seconds} THEN 'duration' END,
  CASE WHEN NOT passenger_count > 0 THEN 'passengers' END], lambda r: r IS NOT NULL) AS reasons FROM trips
)"""


@query(
    "rejected_trips",
    with_tables(
        """SELECT id, array_to_string(reasons, ',') AS reasons, CASE WHEN id % 17 = 0 THEN 'long' ELSE CAST(trip_duration AS VARCHAR) END AS duration_text,
  pickup_longitude, pickup_latitude FROM reasons WHERE len(reasons) > 0""",
        "trips",
        extra=REASONS,
    ),
)
def rejected_trips(spark, sf):
    """Trips that are not valid, why, and what was written where a number should be."""
    rejected = split_trips(scratch_store(spark, "checked"), _damaged(spark, sf), PARAMS).rejected
    return rejected.select(
        "id",
        F.concat_ws(",", "reasons").alias("reasons"),
        F.get_json_object("raw_text", "$.trip_duration").alias("duration_text"),
        "pickup_longitude",
        "pickup_latitude",
    )


@query(
    "checked_counts",
    with_tables(
        """SELECT 'total' AS rule, count(*) AS trips FROM reasons UNION ALL SELECT 'kept', count(*) FILTER (WHERE len(reasons) = 0) FROM reasons
UNION ALL SELECT 'rejected', count(*) FILTER (WHERE len(reasons) > 0) FROM reasons
UNION ALL SELECT r, count(id) FROM (SELECT unnest(['pickup_time', 'dropoff_time', 'pickup_place', 'dropoff_place', 'duration', 'passengers']) AS r)
  LEFT JOIN reasons ON list_contains(reasons, r) GROUP BY r""",
        "trips",
        extra=REASONS,
    ),
)
def checked_counts(spark, sf):
    """How many trips the cleaning run saw, kept and rejected, and for which rules, counted while it wrote."""
    return split_trips(scratch_store(spark, "checked"), _damaged(spark, sf), PARAMS).count_table()


@query(
    "duration_quantiles",
    with_tables(
        """SELECT p AS probability, CASE p WHEN 0 THEN q[1] WHEN 0.05 THEN q[2] WHEN 0.25 THEN q[3] WHEN 0.5 THEN q[4] WHEN 0.9 THEN q[5] WHEN 0.999 THEN q[6] ELSE q[7] END AS value
FROM (SELECT quantile_cont(CAST(trip_duration AS DOUBLE), [0, 0.05, 0.25, 0.5, 0.9, 0.999, 1]) AS q FROM trips), (SELECT unnest([CAST(0 AS DOUBLE), 0.05, 0.25, 0.5, 0.9, 0.999, 1]) AS p)""",
        "trips",
    ),
)
def duration_quantiles(spark, sf):
    """Exact quantiles over all trips, without a buffer that grows with their distinct values."""
    return quantile_table(trips(spark, sf), "trip_duration", [0, 0.05, 0.25, 0.5, 0.9, 0.999, 1])


@query("preview_head", with_tables("SELECT * FROM trips ORDER BY id LIMIT 10", "trips"))
def preview_head(spark, sf):
    return first_n(trips(spark, sf), 10, "id")


@query("trip_count", with_tables("SELECT count(*) AS total_trips FROM trips", "trips"))
def trip_count(spark, sf):
    return demand.trip_count(trips(spark, sf))


@query(
    "bbox_filter",
    with_tables(f"SELECT id, pickup_longitude AS lon, pickup_latitude AS lat FROM trips WHERE {in_box('pickup')}", "trips"),
)
def bbox_filter(spark, sf):
    return points(spark, sf)


@query("clean_trips", with_tables("SELECT * FROM clean", "clean"))
def clean_trips(spark, sf):
    return clean(spark, sf)


def _quality_sql(rule: str) -> str:
    return with_tables(
        f"""SELECT count(*) AS total_records, count(*) FILTER (WHERE {rule}) AS valid_records,
  count(*) - count(*) FILTER (WHERE {rule}) AS removed_records FROM trips""",
        "trips",
    )


@query("quality_counts", _quality_sql(in_box("pickup")))
def pickup_quality(spark, sf):
    return quality_counts(trips(spark, sf), pickup_in_box(GRID))


@query("zone_quality_counts", _quality_sql(in_box("pickup")))
def zone_quality(spark, sf):
    return demand.zone_quality(totals(spark, sf, "zone_id"))


@query(
    "clean_quality_counts",
    _quality_sql(
        f"{in_box('pickup')} AND {in_box('dropoff')} AND trip_duration BETWEEN 60 AND 10800 AND passenger_count > 0"
    ),
)
def clean_quality(spark, sf):
    return quality_counts(trips(spark, sf), is_valid_trip(PARAMS))


@query(
    "hourly_demand",
    with_tables(
        "SELECT CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, count(*) AS total_trips FROM trips GROUP BY 1", "trips"
    ),
)
def hourly_demand(spark, sf):
    return demand.hourly_demand(totals(spark, sf, "hour"))


@query(
    "daily_demand",
    with_tables(
        f"SELECT {day_number('pickup_ts')} AS day_number, dayname(pickup_ts) AS day_name, "
        "count(*) AS total_trips FROM trips GROUP BY ALL",
        "trips",
    ),
)
def daily_demand(spark, sf):
    return demand.daily_demand(totals(spark, sf, "date"))


@query(
    "avg_duration",
    with_tables("SELECT round(avg(trip_duration) / 60, 2) AS average_duration_minutes FROM trips", "trips"),
)
def avg_duration(spark, sf):
    return demand.average_duration(totals(spark, sf))


@query(
    "avg_passengers",
    with_tables("SELECT round(avg(passenger_count), 2) AS average_passengers FROM trips", "trips"),
)
def avg_passengers(spark, sf):
    return demand.average_passengers(totals(spark, sf))


@query("zone_demand", with_tables("SELECT * FROM zone_demand", "zone_demand"))
def zone_demand(spark, sf):
    return all_zones(spark, sf)


@query(
    "slot_demand",
    with_tables(
        f"SELECT CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, {day_number('pickup_ts')} AS day_of_week, "
        "count(*) AS total_trips FROM trips GROUP BY ALL",
        "trips",
    ),
)
def slot_demand(spark, sf):
    return demand.slot_demand(totals(spark, sf, "date", "hour"))


@query("top_zones", with_tables("SELECT * FROM top_zones", "top_zones"))
def top_zones(spark, sf):
    return zone_table(spark, sf)


@query(
    "top_n_zones",
    with_tables(
        "SELECT zone_id, total_trips, 'Zone ' || zone_id AS zone FROM top_zones "
        "ORDER BY total_trips DESC, zone_id LIMIT 15",
        "top_zones",
    ),
)
def top_n_zones(spark, sf):
    top = top_n(zone_table(spark, sf), "total_trips", 15, "zone_id")
    return top.select("zone_id", "total_trips", zone_label(F.col("zone_id")).alias("zone"))


@query(
    "time_features",
    with_tables(
        f"""SELECT id, TRY_CAST(CAST(pickup_ts AS VARCHAR) AS TIMESTAMP) AS parsed_ts,
  TRY_CAST('not a time ' || id AS TIMESTAMP) AS malformed_ts,
  CAST(hour(pickup_ts) AS INTEGER) AS hour, {day_number('pickup_ts')} AS dow, dayname(pickup_ts) AS day_name,
  CAST(pickup_ts AS DATE) AS date, date_trunc('hour', pickup_ts) AS hour_ts,
  CAST({day_number('pickup_ts')} IN (1, 7) AS INTEGER) AS is_weekend,
  CAST(pickup_ts AS DATE) < DATE '2024-01-22' AS is_train FROM trips""",
        "trips",
    ),
)
def time_features(spark, sf):
    ts = F.col("pickup_ts")
    dow = F.dayofweek(ts)
    return trips(spark, sf).select(
        "id",
        clock.parse_ts(ts.cast("string")).alias("parsed_ts"),
        clock.parse_ts(F.concat(F.lit("not a time "), F.col("id").cast("string"))).alias("malformed_ts"),
        F.hour(ts).alias("hour"),
        dow.alias("dow"),
        clock.day_name(dow).alias("day_name"),
        F.to_date(ts).alias("date"),
        clock.hour_start("pickup_ts").alias("hour_ts"),
        clock.is_weekend(dow).alias("is_weekend"),
        (F.to_date(ts) < F.lit(PARAMS.train_end).cast("date")).alias("is_train"),
    )


@query(
    "prev_slot",
    with_tables(
        f"""SELECT dow, hour, CAST(CASE WHEN hour > 0 THEN dow WHEN dow = 1 THEN 7 ELSE dow - 1 END AS INTEGER) AS prev_dow,
  CAST(CASE WHEN hour = 0 THEN 23 ELSE hour - 1 END AS INTEGER) AS prev_hour, trips
FROM (SELECT {day_number('pickup_ts')} AS dow, CAST(hour(pickup_ts) AS INTEGER) AS hour, count(*) AS trips
  FROM trips GROUP BY ALL)""",
        "trips",
    ),
)
def prev_slot(spark, sf):
    slots = demand.slot_demand(totals(spark, sf, "date", "hour"))
    before = clock.previous_slot(F.col("day_of_week"), F.col("pickup_hour"))
    return slots.select(
        F.col("day_of_week").alias("dow"),
        F.col("pickup_hour").alias("hour"),
        clock.slot_dow(before).alias("prev_dow"),
        clock.slot_hour(before).alias("prev_hour"),
        F.col("total_trips").alias("trips"),
    )


@query(
    "zone_codec",
    with_tables(
        f"""SELECT id, zone_id, CAST(zone_id // 100 AS INTEGER) AS zone_x, CAST(zone_id % 100 AS INTEGER) AS zone_y,
  {LON_MIN} + (zone_id // 100 + CAST(0.5 AS DOUBLE)) * {CELL} AS lon,
  {LAT_MIN} + (zone_id % 100 + CAST(0.5 AS DOUBLE)) * {CELL} AS lat
FROM (SELECT id, {PICKUP_ZONE} AS zone_id FROM trips WHERE {in_box('pickup')})""",
        "trips",
    ),
)
def zone_codec(spark, sf):
    coded = points(spark, sf).select("id", geo.zone_id("lon", "lat", GRID).alias("zone_id"))
    zone_col = F.col("zone_id")
    return coded.select(
        "id",
        "zone_id",
        geo.zone_x(zone_col).alias("zone_x"),
        geo.zone_y(zone_col).alias("zone_y"),
        geo.zone_lon(zone_col, GRID).alias("lon"),
        geo.zone_lat(zone_col, GRID).alias("lat"),
    )


@query(
    "zone_distance",
    with_tables(
        f"""SELECT id, CAST(dx * dx + dy * dy AS INTEGER) AS cells_squared,
  round(sqrt(pow(dx * {CELL} * CAST(84.4 AS DOUBLE), 2) + pow(dy * {CELL} * CAST(111.2 AS DOUBLE), 2)), 6) AS km,
  round(sqrt(CAST(dx * dx + dy * dy AS DOUBLE)) * {CELL} * 111, 6) AS flat_km
FROM (SELECT id, zone_id // 100 - drop_zone_id // 100 AS dx, zone_id % 100 - drop_zone_id % 100 AS dy FROM clean)""",
        "clean",
    ),
)
def zone_distance(spark, sf):
    start, end = F.col("zone_id"), F.col("drop_zone_id")
    return clean(spark, sf).select(
        "id",
        geo.cell_distance_squared(start, end).alias("cells_squared"),
        F.round(geo.km_between(start, end, GRID), 6).alias("km"),
        F.round(geo.degree_km_between(start, end, GRID), 6).alias("flat_km"),
    )


@query(
    "display_labels",
    with_tables(
        """SELECT 'Zone ' || zone_id AS zone, lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS time,
  CASE dayofweek(date) WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday'
    WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' ELSE 'Saturday' END AS day, count(*) AS trips
FROM clean GROUP BY ALL""",
        "clean",
    ),
)
def display_labels(spark, sf):
    counted = clean(spark, sf).groupBy("zone_id", "hour", F.dayofweek("date").alias("dow")).agg(
        F.count("*").alias("trips")
    )
    return counted.select(
        zone_label(F.col("zone_id")).alias("zone"),
        hour_label(F.col("hour")).alias("time"),
        clock.day_name(F.col("dow")).alias("day"),
        "trips",
    )


POINTS_SQL = f"""points AS MATERIALIZED (
SELECT id, pickup_longitude AS lon, pickup_latitude AS lat, {PICKUP_ZONE} AS own FROM trips WHERE {in_box('pickup')}
)"""


@query(
    "unmodelled_points",
    with_tables(
        "SELECT own AS zone_id, id, lon, lat FROM points p "
        "WHERE NOT EXISTS (SELECT 1 FROM top_zones z WHERE z.zone_id = p.own)",
        "top_zones",
        extra=POINTS_SQL,
    ),
)
def unmodelled_points(spark, sf):
    return nearest.unmodelled_points(points(spark, sf), stored_zones(spark, sf), PARAMS)


@query(
    "nearest_zone",
    with_tables(
        """SELECT id, p.lon, p.lat, bool_or(z.zone_id = own) AS modelled,
  CASE WHEN bool_or(z.zone_id = own) THEN any_value(own) ELSE
    arg_min(z.zone_id, ((z.lon - p.lon) * (z.lon - p.lon) + (z.lat - p.lat) * (z.lat - p.lat), z.zone_id)) END AS zone_id
FROM points p CROSS JOIN top_zones z GROUP BY id, p.lon, p.lat""",
        "top_zones",
        extra=POINTS_SQL,
    ),
)
def nearest_zone(spark, sf):
    return nearest.nearest_zone(points(spark, sf), stored_zones(spark, sf), PARAMS)


@query(
    "nearest_zone_all",
    with_tables(
        f"""SELECT id, any_value(p.lon) AS lon, any_value(p.lat) AS lat, coalesce(bool_or(z.zone_id = own), false) AS modelled,
  CASE WHEN any_value(p.lon) IS NULL THEN -1 WHEN coalesce(bool_or(z.zone_id = own), false) THEN any_value(own) ELSE
    arg_min(z.zone_id, ((z.lon - p.lon) * (z.lon - p.lon) + (z.lat - p.lat) * (z.lat - p.lat), z.zone_id)) END AS zone_id
FROM (SELECT id, lon, pickup_latitude AS lat, CASE WHEN lon IS NOT NULL AND {in_box('pickup')} THEN {PICKUP_ZONE} END AS own
  FROM (SELECT *, CASE WHEN id % 11 <> 0 THEN pickup_longitude END AS lon FROM trips)) p CROSS JOIN top_zones z GROUP BY id""",
        "top_zones",
    ),
)
def nearest_zone_all(spark, sf):
    """All pickups, also those outside the box, and every eleventh without a longitude (zone -1 here)."""
    lon = F.when(F.col("id") % 11 != 0, F.col("pickup_longitude"))
    everywhere = trips(spark, sf).select("id", lon.alias("lon"), F.col("pickup_latitude").alias("lat"))
    found = nearest.nearest_zone(everywhere, stored_zones(spark, sf), PARAMS)
    return found.withColumn("zone_id", F.coalesce("zone_id", F.lit(-1)))

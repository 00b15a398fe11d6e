"""Small hand-made tables for the rules that bulk data does not show."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hailgrid.functions import clock, geo
from hailgrid.functions.text import code_label
from hailgrid.operators import accuracy, balance, moves, nearest, reshape, zone_hours
from hailgrid.operators.demand import top_zones, zone_hour_totals
from hailgrid.operators.filters import hash_split, is_valid_trip, quality_counts, with_levels
from hailgrid.operators.ranking import largest_per
from hailgrid.operators.shares import apportion
from hailgrid.params import COARSE_GRID, FINE_GRID, GridSpec, RideParams
from hailgrid.plans import dashboards
from hailgrid.plans.allocation import allocate
from hailgrid.plans.cleaning import clean_trips
from hailgrid.schemas import RAW_TRIP_TYPES
from hailgrid.sources.tables import MissingInput, ResultStore, shared_folder
from hailgrid.sources.trips import read_trips_csv


def rows(df):
    """All rows in order of their values, nulls last."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is None, v) for v in row])


# ---- grid -----------------------------------------------------------------


@pytest.mark.parametrize(("grid", "x", "y"), [(COARSE_GRID, 6, 8), (FINE_GRID, 34, 40)])
def test_box_is_closed_and_upper_edges_open_extra_cells(spark, grid, x, y):
    corners = spark.createDataFrame(
        [(-74.05, 40.55), (-73.70, 40.95), (-74.0500001, 40.6), (-73.9, 40.9500001)], "lon double, lat double"
    )
    inside = corners.filter(geo.in_box("lon", "lat", grid))
    assert rows(inside.select(geo.zone_id("lon", "lat", grid))) == [(0,), (x * 100 + y,)]
    assert (grid.n_x, grid.n_y) == (x + 1, y + 1)


def test_zone_id_decodes(spark):
    zones = spark.createDataFrame([(0,), (608,), (307,)], "z long")
    z = F.col("z")
    decoded = zones.select("z", geo.zone_x(z), geo.zone_y(z), geo.zone_lon(z, COARSE_GRID), geo.zone_lat(z, COARSE_GRID))
    for zone, x, y, lon, lat in rows(decoded):
        assert (x, y) == divmod(zone, 100)
        assert lon == pytest.approx(-74.05 + (x + 0.5) * 0.05)
        assert lat == pytest.approx(40.55 + (y + 0.5) * 0.05)


def test_grid_higher_than_the_zone_code_is_refused():
    with pytest.raises(ValueError):
        GridSpec(cell=0.001)


# ---- sources and cleaning -------------------------------------------------

HEADER = "vendor_id," + ",".join(reversed(RAW_TRIP_TYPES)) + "\n"


def write_csv(tmp_path, lines):
    folder = tmp_path / "raw"
    folder.mkdir()
    for number, line in enumerate(lines):
        (folder / f"part-{number}.csv").write_text(HEADER + line + "\n")
    return str(folder)


def trip(duration=600, passengers=1, pickup="2016-03-01 10:00:00", dropoff="2016-03-01 10:10:00", lon="-73.98"):
    values = {
        "id": "id1",
        "pickup_datetime": pickup,
        "dropoff_datetime": dropoff,
        "pickup_longitude": lon,
        "pickup_latitude": "40.75",
        "dropoff_longitude": "-73.95",
        "dropoff_latitude": "40.78",
        "passenger_count": str(passengers),
        "trip_duration": str(duration),
    }
    return "2," + ",".join(values[name] for name in reversed(RAW_TRIP_TYPES))


def test_csv_columns_are_found_by_name_and_bad_values_cost_one_row(spark, tmp_path):
    good = [trip(60), trip(10800)]
    bad = [
        trip(59),
        trip(10801),
        trip(passengers=0),
        trip(pickup="not a time"),
        trip(dropoff="2016-13-01 00:00:00"),
        trip(lon="-80.0"),
        trip(lon="east"),
        trip(duration="long"),
    ]
    raw = read_trips_csv(spark, write_csv(tmp_path, good + bad))
    params = RideParams()
    kept = clean_trips(raw, params)
    assert sorted(row.trip_duration for row in kept.collect()) == [60, 10800]
    assert rows(quality_counts(raw, is_valid_trip(params))) == [(10, 2, 8)]
    row = kept.first()
    start, end = (math.floor((lon + 74.05) / 0.01) * 100 for lon in (-73.98, -73.95))
    assert (row.date, row.hour) == (date(2016, 3, 1), 10)
    assert (row.zone_id, row.drop_zone_id) == (start + math.floor((40.75 - 40.55) / 0.01), end + 23)


def test_missing_columns_and_empty_tables_stop_the_job(spark, tmp_path):
    folder = tmp_path / "x"
    folder.mkdir()
    (folder / "a.csv").write_text("id,trip_duration\n1,2\n")
    with pytest.raises(MissingInput, match="pickup_datetime"):
        read_trips_csv(spark, str(folder))
    store = ResultStore(spark, str(tmp_path))
    with pytest.raises(MissingInput, match="cannot be read"):
        store.require("hist")
    store.write(spark.createDataFrame([], "zone_id long, dow int, hour int, hist_mean double"), "hist")
    with pytest.raises(MissingInput, match="empty"):
        store.require("hist")


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "a"), shared_folder(spark, "a")
    assert first.startswith(root) and second.startswith(root) and first != second


# ---- calendar -------------------------------------------------------------


def test_hours_do_not_depend_on_the_session_time_zone(spark):
    # 02:30 on that day does not exist in New York.
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2016-03-13 02:30:59.5' AS ts")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        floored = clock.with_calendar(frame.select(clock.hour_start("ts").alias("ts"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(floored) == (datetime(2016, 3, 13, 2), date(2016, 3, 13), 2, 1, 1)


def test_slots_go_round_the_week(spark):
    slots = spark.createDataFrame([(1, 0), (2, 0), (7, 23), (4, 12)], "dow int, hour int")
    before = clock.previous_slot(F.col("dow"), F.col("hour"))
    after = clock.next_slot(F.col("dow"), F.col("hour"))
    shown = slots.select(
        "dow", "hour", *[f(s) for s in (before, after) for f in (clock.slot_dow, clock.slot_hour)]
    )
    assert rows(shown) == [
        (1, 0, 7, 23, 1, 1),
        (2, 0, 1, 23, 2, 1),
        (4, 12, 4, 11, 4, 13),
        (7, 23, 7, 22, 1, 0),
    ]


def test_unknown_code_has_no_label(spark):
    frame = spark.createDataFrame([("a",), ("z",)], "c string")
    assert rows(frame.select("c", code_label(F.col("c"), {"a": "First"}))) == [("a", "First"), ("z", None)]


# ---- series ---------------------------------------------------------------


def test_leave_one_out_mean(spark):
    data = spark.createDataFrame(
        [
            (1, 2, 8, date(2024, 1, 1), 10),
            (1, 2, 8, date(2024, 1, 8), 20),
            (1, 2, 8, date(2024, 1, 22), 99),
            (2, 2, 8, date(2024, 1, 1), 7),
            (2, 2, 8, date(2024, 1, 22), 8),
            (3, 2, 8, date(2024, 1, 22), 5),
        ],
        "zone_id long, dow int, hour int, date date, demand long",
    )
    means = zone_hours.with_hist_mean(data, "2024-01-22").select("zone_id", "date", "hist_mean")
    assert [row[2] for row in rows(means)] == [20.0, 10.0, 15.0, 7.0, 7.0, None]
    strict = zone_hours.with_hist_mean(data, "2024-01-22", min_rows=2).select("zone_id", "date", "hist_mean")
    assert [row[2] for row in rows(strict)] == [20.0, 10.0, 15.0, None, 7.0, None]


def test_dense_series_covers_every_hour_and_drops_late_dropoffs(spark):
    clean = spark.createDataFrame(
        [
            (5, 6, datetime(2024, 1, 1, 22, 59), datetime(2024, 1, 2, 0, 1), 60),
            (5, 5, datetime(2024, 1, 2, 1, 0), datetime(2024, 1, 2, 3, 0), 60),
            (6, 9, datetime(2024, 1, 2, 1, 30), datetime(2024, 1, 2, 1, 40), 60),
            (5, 6, datetime(2024, 1, 2, 1, 30), datetime(2024, 1, 2, 1, 40), 60),
            (9, 5, datetime(2024, 1, 1, 21, 30), datetime(2024, 1, 1, 22, 0), 60),
            (6, 5, datetime(2024, 1, 1, 23, 0), datetime(2024, 1, 1, 23, 5), 60),
        ],
        "zone_id long, drop_zone_id long, pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, trip_duration int",
    )
    params = RideParams(grid=COARSE_GRID, top_zones=2)
    totals = zone_hour_totals(clean)
    dense = zone_hours.dense_demand(totals, top_zones(totals, params), params)
    got = {(z, ts.hour): (p, d) for z, ts, p, d in rows(dense)}
    assert len(got) == 2 * 5
    assert {k: v for k, v in got.items() if v != (0, 0)} == {
        (5, 22): (1, 1),
        (5, 23): (0, 1),
        (6, 23): (1, 0),
        (6, 0): (0, 1),
        (5, 1): (2, 0),
        (6, 1): (1, 1),
    }
    assert len(rows(zone_hours.hour_timeline(totals))) == 5


def test_equal_volumes_rank_by_zone(spark):
    clean = spark.createDataFrame(
        [(z, datetime(2024, 1, 1, h), 60) for z in (7, 3, 5) for h in (1, 2)],
        "zone_id long, pickup_ts timestamp_ntz, trip_duration int",
    )
    top = top_zones(zone_hour_totals(clean, dropoffs=False), RideParams(grid=COARSE_GRID, top_zones=2))
    assert [row.zone_id for row in top.orderBy("zone_id").collect()] == [3, 5]


# ---- shares and allocation ------------------------------------------------


def test_apportion_ties_zeros_and_totals(spark):
    weights = spark.createDataFrame(
        [(1, 10, 1.0, 2), (1, 11, 1.0, 2), (1, 12, 1.0, 2), (2, 10, 0.0, 5), (2, 11, 0.0, 5), (3, 9, 0.3, 7), (4, 1, 2.0, 0)],
        "slot int, zone_id long, w double, total int",
    )
    split = apportion(weights, "w", "total", ["slot"], "n").select("slot", "zone_id", "n")
    assert rows(split) == [(1, 10, 1), (1, 11, 1), (1, 12, 0), (2, 10, 0), (2, 11, 0), (3, 9, 7), (4, 1, 0)]


def test_shares_leave_columns_of_any_name_alone(spark):
    data = [(1, 1, 3, 10, "mine", "too", 5, 2.5), (1, 2, 1, 10, "yours", None, 6, 3.5)]
    frame = spark.createDataFrame(data, "g int, zone_id long, w long, total int, _units string, `__Units` string, _base int, _RANK double")
    split = apportion(frame, "w", "total", ["g"], "n")
    assert split.columns == [*frame.columns, "n"]
    assert sorted(map(tuple, split.collect())) == [(*data[0], 8), (*data[1], 2)]


def test_shares_of_very_large_fleets_do_not_overflow(spark):
    fleet = 3_000_000_000_000
    weights = spark.createDataFrame([(1, z, float(z) * 1e6, fleet) for z in (1, 2, 3)], "s int, zone_id long, w double, n long")
    assert rows(apportion(weights, "w", "n", ["s"], "part").select("zone_id", "part")) == [
        (1, fleet // 6), (2, fleet // 3), (3, fleet // 2)
    ]


SLOTS = "dow int, hour int, zone_id long, zone_x int, zone_y int, prediction double, avg_dropoffs double"


def slots_of(spark, rows_, fleet, rate=2.0):
    return balance.with_scenarios(spark.createDataFrame([(1, 0, *row) for row in rows_], SLOTS), [(fleet, rate)])


def test_allocation_with_enough_and_with_scarce_drivers(spark):
    zones = [(0, 0, 0, 9.0, 0.0), (1, 0, 1, 3.0, 3.0), (300, 3, 0, 0.0, 1.0)]
    columns = ["zone_id", "needed", "current", "assigned", "gap", "short_now", "short_after"]
    enough = balance.allocate_zones(slots_of(spark, zones, 8)).select(*columns)
    assert rows(enough) == [(0, 5, 0, 5, 5, 5, 0), (1, 2, 6, 2, -4, 0, 0), (300, 0, 2, 0, -2, 0, 0)]
    scarce = balance.allocate_zones(slots_of(spark, zones, 4)).select(*columns)
    assert rows(scarce) == [(0, 5, 0, 3, 3, 5, 2), (1, 2, 3, 1, -2, 0, 1), (300, 0, 1, 0, -1, 0, 0)]
    none = balance.allocate_zones(slots_of(spark, zones, 0)).select(*columns)
    assert rows(none) == [(0, 5, 0, 0, 0, 5, 5), (1, 2, 0, 0, 0, 2, 2), (300, 0, 0, 0, 0, 0, 0)]


def test_no_supply_spreads_the_fleet_evenly_or_not_at_all(spark):
    zones = [(0, 0, 0, 2.0, 0.0), (1, 0, 1, 2.0, 0.0), (2, 0, 2, 2.0, 0.0)]
    even = balance.allocate_zones(slots_of(spark, zones, 5)).select("zone_id", "current")
    assert rows(even) == [(0, 2), (1, 2), (2, 1)]
    floored = balance.allocate_zones_by_floor(slots_of(spark, zones, 5)).select("zone_id", "current", "gap")
    assert rows(floored) == [(0, 0, -1), (1, 0, -1), (2, 0, -1)]


def open_zones(spark, wants):
    data = [(1, 0, zone, zone // 100, zone % 100, gap) for zone, gap in wants.items()]
    return spark.createDataFrame(data, "dow int, hour int, zone_id long, zone_x int, zone_y int, gap long")


def test_largest_want_is_served_first_from_the_nearest_zone(spark):
    # Zone 1 wants more than zone 3, and zone 2 lies between them.
    allocated = open_zones(spark, {1: 4, 3: 2, 2: -3, 500: -3, 7: 0})
    moved = moves.rebalancing_moves(allocated, COARSE_GRID)
    assert rows(moved.select("from_zone", "to_zone", "drivers")) == [(2, 1, 3), (500, 1, 1), (500, 3, 2)]
    km = {(row.from_zone, row.to_zone): row.km for row in moved.collect()}
    assert km[(2, 1)] == round(0.05 * 111.2, 2)
    assert km[(500, 3)] == round(math.hypot(5 * 0.05 * 84.4, 3 * 0.05 * 111.2), 2)


def test_second_variant_serves_zones_by_id_and_leaves_need_open(spark):
    planned = open_zones(spark, {1: -4, 3: -2, 2: 3}).withColumns({"needed": F.lit(4), "current": F.lit(3)})
    moved = moves.rebalancing_moves_by_zone(planned, COARSE_GRID)
    assert rows(moved.select("from_zone", "to_zone", "drivers")) == [(2, 1, 3)]
    after = moves.apply_moves(planned, moved).select("zone_id", "assigned", "short_after")
    assert rows(after) == [(1, 6, 0), (2, 0, 4), (3, 3, 1)]


def test_equally_near_givers_go_by_id_and_empty_sides_give_no_moves(spark):
    assert rows(
        moves.rebalancing_moves(open_zones(spark, {101: 1, 100: -1, 102: -1}), COARSE_GRID).select("from_zone")
    ) == [(100,)]
    assert rows(moves.first_choice(open_zones(spark, {101: 1, 102: -1, 100: -1}))) == [(1, 0, 101, 1, 100, 2)]
    for wants in ({1: 3}, {1: -3}, {1: 0}):
        assert moves.rebalancing_moves(open_zones(spark, wants), COARSE_GRID).count() == 0


def test_unknown_variant_is_refused(spark):
    with pytest.raises(ValueError):
        allocate(*[spark.range(1)] * 3, RideParams(), variant="c")


# ---- errors, levels, points -----------------------------------------------


def test_errors_with_zero_and_constant_actuals(spark):
    predictions = spark.createDataFrame([(0, 1.0), (10, 12.0), (20, 20.0)], "total_trips long, prediction double")
    summary = accuracy.error_summary(predictions).first()
    assert (summary.mae, summary.mape) == (1.0, pytest.approx(10.0))
    assert summary.r2 == pytest.approx(1 - 5 / 200)
    constant = spark.createDataFrame([(5, 4.0), (5, 6.0)], "total_trips long, prediction double")
    assert math.isnan(accuracy.error_summary(constant).first().r2)


def test_histogram_puts_the_largest_error_into_the_last_bin(spark):
    errors = spark.createDataFrame([(float(e),) for e in (0, 1, 2, 3, 4, None) if e is not None], "error double")
    assert rows(accuracy.error_histogram(errors, 4)) == [(0, 1), (1, 1), (2, 1), (3, 2)]
    same = spark.createDataFrame([(2.0,), (2.0,)], "error double")
    assert rows(accuracy.error_histogram(same, 4)) == [(0, 2)]


def test_levels_are_closed_above_and_survive_equal_quantiles(spark):
    zones = spark.createDataFrame([(i, i * 10) for i in range(1, 101)], "zone_id long, total_trips long")
    counts = dict(rows(reshape.with_demand_level(zones).groupBy("demand_level").count()))
    assert counts == {"Low": 33, "Medium": 33, "High": 34}
    flat = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 9)], "zone_id long, total_trips long")
    leveled = reshape.with_demand_level(flat).select("zone_id", "demand_level")
    assert [level for _, level in rows(leveled)] == ["Low", "Low", "Low", "High"]
    assert with_levels(reshape.with_demand_level(flat), []).count() == 0


def test_nearest_zone_prefers_own_cell_and_reaches_outside_points(spark):
    params = RideParams(grid=COARSE_GRID, top_zones=3)
    zones = spark.createDataFrame([(0,), (202,), (608,)], "zone_id long")
    zones = dashboards.with_missing_centres(zones, COARSE_GRID)
    points = spark.createDataFrame(
        [(1, -74.04, 40.56), (2, -73.93, 40.66), (3, -73.70, 40.95), (4, -73.94, 40.72), (5, -80.0, 30.0), (6, -74.0, 40.6)],
        "id int, lon double, lat double",
    )
    found = nearest.nearest_zone(points, zones, params).select("id", "zone_id", "modelled")
    assert rows(found)[:5] == [(1, 0, True), (2, 202, True), (3, 608, True), (4, 202, False), (5, 0, False)]
    assert rows(nearest.unmodelled_points(points, zones, params).select("id")) == [(4,), (5,), (6,)]


def test_no_shortage_gives_no_worst_row(spark):
    table = spark.createDataFrame([(1, 2, 30.0)], "pickup_hour int, day_of_week int, prediction double")
    plenty = balance.simple_allocation(table)
    assert rows(plenty) == [(1, 2, 30.0, 10, 3000, 2990, "Sufficient Drivers")]
    assert dashboards.worst_shortfall(plenty).count() == 0
    short = dashboards.worst_shortfall(balance.simple_allocation(table, available=4))
    assert rows(short) == [("01:00", 2, 10, 4, 6)]


def test_hash_split_ignores_layout_and_keeps_every_row(spark):
    frame = spark.range(2000).withColumn("b", F.col("id") % 7)
    one, rest = hash_split(frame.repartition(1), ["id", "b"])
    again, _ = hash_split(frame.repartition(8), ["id", "b"])
    assert one.count() + rest.count() == 2000
    assert 1500 < one.count() < 1700
    assert sorted(one.collect()) == sorted(again.collect())
    other, _ = hash_split(frame, ["id", "b"], seed=7)
    assert sorted(one.collect()) != sorted(other.collect())


# ---- exact shares -----------------------------------------------------------


def test_shares_of_26_week_means_are_exact(spark):
    """A slot of 26 dates: sums of drop-offs share exactly where rounded means lose drivers."""
    data = spark.createDataFrame(
        [(zone, 1, 0, 1, 1 if day < total else 0) for zone, total in enumerate((1, 5, 7, 13)) for day in range(26)],
        "zone_id long, dow int, hour int, demand int, dropoffs long",
    )
    supply = zone_hours.supply_proxy(data)
    zones = spark.createDataFrame([(z, 0.0, 0.0, 1) for z in range(4)], "zone_id long, lon double, lat double, total_trips long")
    grid = spark.createDataFrame([(z, 1, 0, 1.0) for z in range(4)], "zone_id long, dow int, hour int, prediction double")
    slots = balance.with_scenarios(balance.slot_frame_same_hour(grid, zones, supply, 10), [(26, 1.0)])
    floored = balance.allocate_zones_by_floor(slots).select("zone_id", "current")
    assert rows(floored) == [(0, 1), (1, 5), (2, 7), (3, 13)]
    assert rows(apportion(slots, "dropoffs", "fleet", ["dow", "hour"], "n").select("zone_id", "n")) == rows(floored)


# ---- points, numbers, groups -------------------------------------------------


def test_points_without_both_coordinates_have_no_zone(spark):
    params = RideParams(grid=COARSE_GRID, top_zones=2)
    zones = dashboards.with_missing_centres(spark.createDataFrame([(0,), (202,)], "zone_id long"), COARSE_GRID)
    nan = float("nan")
    points = spark.createDataFrame(
        [(1, None, None), (2, nan, 40.6), (3, -73.93, None), (4, -73.93, nan), (5, -73.93, 40.66), (6, -80.0, 30.0)],
        "id int, lon double, lat double",
    )
    found = rows(nearest.nearest_zone(points, zones, params).select("id", "zone_id", "modelled"))
    assert found == [(1, None, False), (2, None, False), (3, None, False), (4, None, False), (5, 202, True), (6, 0, False)]


def test_a_grid_of_millions_of_cells_is_joined_not_broadcast(spark):
    grid = GridSpec(cell=0.0002, stride=10_000)
    assert grid.n_cells > 3_000_000
    params = RideParams(grid=grid, top_zones=50)
    zones = spark.createDataFrame([(x * 35 * 10_000 + y * 40,) for x in range(7) for y in range(7)], "zone_id long")
    zones = dashboards.with_missing_centres(zones, grid)
    points = spark.range(500).selectExpr("id", "-74.05D + (id * 37 % 500) * 0.0007D AS lon", "40.55D + (id * 91 % 500) * 0.0008D AS lat")
    found = nearest.nearest_zone(points, zones, params)
    centres = [(r.zone_id, r.lon, r.lat) for r in zones.collect()]
    for row in found.collect():
        if not row.modelled:
            best = min(((x - row.lon) * (x - row.lon) + (y - row.lat) * (y - row.lat), zone) for zone, x, y in centres)
            assert row.zone_id == best[1]


def test_whole_numbers_may_be_written_as_decimals(spark, tmp_path):
    raw = read_trips_csv(spark, write_csv(tmp_path, [trip("455.0", "2.0"), trip("1e3"), trip("10.5"), trip("99999999999")]))
    assert rows(raw.select("trip_duration", "passenger_count").fillna(-1)) == [(-1, 1), (-1, 1), (455, 2), (1000, 1)]


def test_largest_per_group_prefers_the_smaller_id(spark):
    table = spark.createDataFrame([(1, 5, 2.0), (1, 3, 2.0), (1, 4, 1.0), (2, 9, 0.0)], "dow int, zone_id long, prediction double")
    assert rows(largest_per(table, ["dow"], "prediction", "zone_id")) == [(1, 3, 2.0), (2, 9, 0.0)]

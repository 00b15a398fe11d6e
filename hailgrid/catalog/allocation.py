"""Driver allocation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hailgrid.catalog.inputs import FINE, PARAMS, SCARCE_FLEET, SCENARIOS, one_fleet, slot_predictions, week_tables
from hailgrid.catalog.registry import query
from hailgrid.catalog.sql import ALLOCATION, CELL, day_number, greedy, moved_km, tables, with_tables
from hailgrid.operators import balance, moves
from hailgrid.operators.filters import slot_rows
from hailgrid.operators.ranking import busier_than, top_n
from hailgrid.operators.shares import apportion
from hailgrid.plans.allocation import allocate, what_if, with_cells
from hailgrid.plans.dashboards import estimated_shortage, slot_kpis

AVAILABLE = 20
COLUMNS = ALLOCATION.split(", ")

SLOT_PREDICTIONS = f"""slot_predictions AS MATERIALIZED (
SELECT *, avg(total_trips) OVER (PARTITION BY pickup_hour) AS prediction
FROM (SELECT CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, {day_number('pickup_ts')} AS day_of_week,
  count(*) AS total_trips FROM trips GROUP BY ALL)
)"""
ALLOC_SIMPLE = f"""{SLOT_PREDICTIONS},
alloc_simple AS MATERIALIZED (
SELECT pickup_hour, day_of_week, round(prediction, 2) AS predicted_demand,
  CAST(ceil(prediction / 3) AS BIGINT) AS required_drivers, {AVAILABLE} AS available_drivers,
  {AVAILABLE} - CAST(ceil(prediction / 3) AS BIGINT) AS driver_difference,
  CASE WHEN {AVAILABLE} >= ceil(prediction / 3) THEN 'Sufficient Drivers' ELSE 'Driver Shortage' END AS allocation_status
FROM slot_predictions
)"""


def _slots(week):
    return balance.slot_frame(week.pred_grid, week.zones, week.supply, PARAMS.max_zones)


def _allocated(week, fleet=PARAMS.fleet):
    return balance.allocate_zones(one_fleet(_slots(week), fleet))


def _stored(week, fleet=PARAMS.fleet):
    """The allocation as a table: moves and key figures read it instead of planning it again."""
    return week.store.write(_allocated(week, fleet), "allocation")


def _floored(week):
    slots = balance.slot_frame_same_hour(week.pred_grid, week.zones, week.supply, PARAMS.max_zones)
    return with_cells(balance.allocate_zones_by_floor(one_fleet(slots, PARAMS.fleet)))


def simple(spark, sf):
    return balance.simple_allocation(slot_predictions(spark, sf), 3, AVAILABLE)


@query("alloc_simple", with_tables("SELECT * FROM alloc_simple", "trips", extra=ALLOC_SIMPLE))
def alloc_simple(spark, sf):
    return simple(spark, sf)


@query("slot_frame", with_tables("SELECT * FROM slot_frame", "slot_frame"))
def slot_frame(spark, sf):
    return _slots(week_tables(spark, sf))


@query("slot_frame_b", with_tables("SELECT * FROM slot_frame_b", "slot_frame_b"))
def slot_frame_b(spark, sf):
    week = week_tables(spark, sf)
    return balance.slot_frame_same_hour(week.pred_grid, week.zones, week.supply, PARAMS.max_zones)


@query(
    "busier_than_pct",
    with_tables(
        """SELECT a.zone_id, a.dow, a.hour, a.prediction,
  count(*) FILTER (WHERE b.prediction < a.prediction) / CAST(count(*) AS DOUBLE) * 100 AS busier_than_pct
FROM pred_grid a JOIN pred_grid b ON a.dow = b.dow AND a.hour = b.hour GROUP BY ALL""",
        "pred_grid",
    ),
)
def busier_than_pct(spark, sf):
    grid = week_tables(spark, sf).pred_grid
    return busier_than(grid).select("zone_id", "dow", "hour", "prediction", "busier_than_pct")


@query(
    "apportion_current",
    with_tables(
        """SELECT dow, hour, zone_id, dropoffs,
  CASE WHEN sum(dropoffs) OVER (PARTITION BY dow, hour) > 0 THEN current ELSE 0 END AS current
FROM allocation JOIN slot_frame USING (dow, hour, zone_id)""",
        "allocation",
    ),
)
def apportion_current(spark, sf):
    slots = one_fleet(_slots(week_tables(spark, sf)), PARAMS.fleet)
    split = apportion(slots, "dropoffs", "fleet", balance.SLOT_KEYS, "current")
    return split.select("dow", "hour", "zone_id", "dropoffs", "current")


@query("alloc_zone", with_tables(f"SELECT {ALLOCATION} FROM allocation WHERE dow = 5 AND hour = 18", "allocation"))
def alloc_zone(spark, sf):
    return slot_rows(_allocated(week_tables(spark, sf)), 5, 18).select(*COLUMNS)


@query("alloc_zone_scarce", with_tables(f"SELECT {ALLOCATION} FROM scarce_allocation", "scarce_allocation"))
def alloc_zone_scarce(spark, sf):
    return _allocated(week_tables(spark, sf), SCARCE_FLEET).select(*COLUMNS)


@query("allocation_all_slots", with_tables(f"SELECT {ALLOCATION} FROM allocation", "allocation"))
def allocation_all_slots(spark, sf):
    week = week_tables(spark, sf)
    return allocate(week.pred_grid, week.zones, week.supply, PARAMS)[0]


@query(
    "alloc_scenarios",
    with_tables(f"SELECT fleet, trips_per_driver, {ALLOCATION} FROM scenario_zones", "scenario_zones"),
)
def alloc_scenarios(spark, sf):
    week = week_tables(spark, sf)
    return what_if(week.pred_grid, week.zones, week.supply, PARAMS, SCENARIOS)


MOVES_SQL = greedy(
    f"SELECT from_zone, to_zone, drivers, {moved_km()} AS km, dow, hour FROM moves",
    "allocation",
    "gap",
    "t.wants DESC, t.zone_id",
)


@query("allocation_moves", MOVES_SQL)
def allocation_moves(spark, sf):
    week = week_tables(spark, sf)
    return allocate(week.pred_grid, week.zones, week.supply, PARAMS)[1]


@query(
    "scarce_moves",
    greedy(
        f"SELECT from_zone, to_zone, drivers, {moved_km()} AS km, dow, hour FROM moves",
        "scarce_allocation",
        "gap",
        "t.wants DESC, t.zone_id",
    ),
)
def scarce_moves(spark, sf):
    return moves.rebalancing_moves(_allocated(week_tables(spark, sf), SCARCE_FLEET), PARAMS.grid)


@query(
    "top_moves",
    greedy(
        f"""SELECT from_zone, to_zone, drivers, {moved_km()} AS km, dow, hour FROM moves
ORDER BY drivers DESC, dow, hour, from_zone, to_zone LIMIT 50""",
        "allocation",
        "gap",
        "t.wants DESC, t.zone_id",
    ),
)
def top_moves(spark, sf):
    moved = moves.rebalancing_moves(_allocated(week_tables(spark, sf)), PARAMS.grid)
    return top_n(moved, "drivers", 50, "dow", "hour", "from_zone", "to_zone")


@query(
    "move_candidates",
    with_tables(
        """SELECT t.dow, t.hour, t.zone_id, t.gap, g.zone_id AS from_zone,
  CAST(count(*) OVER (PARTITION BY t.dow, t.hour, t.zone_id) AS INTEGER) AS candidates
FROM allocation t JOIN allocation g ON g.dow = t.dow AND g.hour = t.hour AND g.gap < 0
WHERE t.gap > 0
QUALIFY row_number() OVER (PARTITION BY t.dow, t.hour, t.zone_id ORDER BY
  (g.zone_x - t.zone_x) * (g.zone_x - t.zone_x) + (g.zone_y - t.zone_y) * (g.zone_y - t.zone_y), g.zone_id) = 1""",
        "allocation",
    ),
)
def move_candidates(spark, sf):
    return moves.first_choice(_stored(week_tables(spark, sf)))


CHOICES = 5


@query(
    "move_candidates_ranked",
    with_tables(
        f"""SELECT dow, hour, zone_id, gap, rank, from_zone, spare, {moved_km()} AS km FROM (
  SELECT t.dow, t.hour, t.zone_id, t.gap, g.zone_id AS from_zone, t.zone_id AS to_zone, -g.gap AS spare,
    CAST(row_number() OVER (PARTITION BY t.dow, t.hour, t.zone_id ORDER BY
      (g.zone_x - t.zone_x) * (g.zone_x - t.zone_x) + (g.zone_y - t.zone_y) * (g.zone_y - t.zone_y), g.zone_id) AS INTEGER) AS rank
  FROM allocation t JOIN allocation g ON g.dow = t.dow AND g.hour = t.hour AND g.gap < 0
  WHERE t.gap > 0
) WHERE rank <= {CHOICES}""",
        "allocation",
    ),
)
def move_candidates_ranked(spark, sf):
    """The nearest giving zones of every wanting zone, in order."""
    return moves.ranked_choices(_stored(week_tables(spark, sf)), PARAMS.grid, CHOICES)


@query(
    "alloc_zone_b",
    with_tables(
        "SELECT dow, hour, zone_id, prediction, needed, current, gap, CAST(short_now AS BIGINT) AS short_now FROM floored",
        "floored",
    ),
)
def alloc_zone_b(spark, sf):
    return _floored(week_tables(spark, sf)).select(
        "dow", "hour", "zone_id", "prediction", "needed", "current", "gap", "short_now"
    )


@query(
    "allocation_moves_b",
    greedy(
        f"""SELECT from_zone, to_zone, drivers, round(sqrt(CAST(pow(from_zone // 100 - to_zone // 100, 2)
  + pow(from_zone % 100 - to_zone % 100, 2) AS DOUBLE)) * {CELL} * 111, 6) AS distance_km, dow, hour FROM moves""",
        "floored",
        "wants",
        "t.zone_id",
    ),
)
def allocation_moves_b(spark, sf):
    moved = moves.rebalancing_moves_by_zone(_floored(week_tables(spark, sf)), PARAMS.grid)
    return moved.withColumn("distance_km", F.round("distance_km", 6))


@query(
    "apply_moves",
    greedy(
        """SELECT f.dow, f.hour, f.zone_id, f.needed, f.current,
  CAST(f.current + coalesce(i.n, 0) - coalesce(o.n, 0) AS BIGINT) AS assigned,
  CAST(greatest(f.needed - (f.current + coalesce(i.n, 0) - coalesce(o.n, 0)), 0) AS BIGINT) AS short_after
FROM floored f
LEFT JOIN (SELECT dow, hour, to_zone, sum(drivers) AS n FROM moves GROUP BY ALL) i
  ON i.dow = f.dow AND i.hour = f.hour AND i.to_zone = f.zone_id
LEFT JOIN (SELECT dow, hour, from_zone, sum(drivers) AS n FROM moves GROUP BY ALL) o
  ON o.dow = f.dow AND o.hour = f.hour AND o.from_zone = f.zone_id""",
        "floored",
        "wants",
        "t.zone_id",
    ),
)
def apply_moves(spark, sf):
    week = week_tables(spark, sf)
    allocated, _ = allocate(week.pred_grid, week.zones, week.supply, PARAMS, variant="b", store=week.store)
    return allocated.select("dow", "hour", "zone_id", "needed", "current", "assigned", "short_after")


@query(
    "slot_kpis",
    greedy(
        f"""SELECT dow, hour, round(sum(prediction), 6) AS trips, CAST(sum(needed) AS BIGINT) AS needed,
  CAST(sum(short_now) AS BIGINT) AS short_now, CAST(sum(short_after) AS BIGINT) AS unmet,
  CAST(coalesce(any_value(m.moved), 0) AS BIGINT) AS moved, CAST({PARAMS.fleet} AS BIGINT) AS fleet,
  CAST(greatest(sum(needed) - {PARAMS.fleet}, 0) AS BIGINT) AS shortage
FROM allocation LEFT JOIN (SELECT dow, hour, sum(drivers) AS moved FROM moves GROUP BY ALL) m USING (dow, hour)
GROUP BY dow, hour""",
        "allocation",
        "gap",
        "t.wants DESC, t.zone_id",
    ),
)
def all_slot_kpis(spark, sf):
    allocated = _stored(week_tables(spark, sf))
    moved = moves.rebalancing_moves(allocated, PARAMS.grid)
    kpis = slot_kpis(allocated, moved, PARAMS.fleet, balance.SLOT_KEYS)
    return kpis.withColumn("trips", F.round("trips", 6))


@query(
    "slot_shortage_b",
    with_tables(
        f"""SELECT dow, hour, CAST({SCARCE_FLEET} AS BIGINT) AS fleet, round(sum(prediction), 6) AS trips,
  CAST(ceil(round(sum(prediction), 6) / {PARAMS.trips_per_driver}) AS BIGINT) AS required_drivers,
  CAST(greatest(ceil(round(sum(prediction), 6) / {PARAMS.trips_per_driver}) - {SCARCE_FLEET}, 0) AS BIGINT) AS shortage
FROM slot_frame_b GROUP BY dow, hour""",
        "slot_frame_b",
    ),
)
def slot_shortage_b(spark, sf):
    week = week_tables(spark, sf)
    slots = balance.slot_frame_same_hour(week.pred_grid, week.zones, week.supply, PARAMS.max_zones)
    shortage = estimated_shortage(one_fleet(slots, SCARCE_FLEET), balance.SLOT_KEYS)
    return shortage.withColumn("trips", F.round("trips", 6))


FINE_TABLES = tables(FINE, [(FINE.fleet, FINE.trips_per_driver)])


@query("allocation_fine", with_tables(f"SELECT {ALLOCATION} FROM allocation", "allocation", ctes=FINE_TABLES))
def allocation_fine(spark, sf):
    """Cells of 0.01 degrees, 200 zones, 3000 drivers."""
    week = week_tables(spark, sf, FINE)
    return allocate(week.pred_grid, week.zones, week.supply, FINE)[0]

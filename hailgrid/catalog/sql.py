"""Common table expressions of the SQL twins.

They are written independently of the operators: joins where the operators
group, windows where they join.
"""

from __future__ import annotations

from hailgrid.catalog.inputs import PARAMS, SCARCE_FLEET, SCENARIOS
from hailgrid.params import RideParams

GRID = PARAMS.grid
CELL = f"CAST('{GRID.cell}' AS DOUBLE)"
LON_MIN = f"CAST('{GRID.lon_min}' AS DOUBLE)"
LAT_MIN = f"CAST('{GRID.lat_min}' AS DOUBLE)"
TRAIN_END = f"DATE '{PARAMS.train_end}'"


def in_box(end: str) -> str:
    return (
        f"{end}_longitude BETWEEN {LON_MIN} AND CAST('{GRID.lon_max}' AS DOUBLE) "
        f"AND {end}_latitude BETWEEN {LAT_MIN} AND CAST('{GRID.lat_max}' AS DOUBLE)"
    )


def zone(lon: str, lat: str, cell: str = CELL) -> str:
    return (
        f"CAST(floor(({lon} - {LON_MIN}) / {cell}) AS BIGINT) * 100 "
        f"+ CAST(floor(({lat} - {LAT_MIN}) / {cell}) AS BIGINT)"
    )


def center(id_column: str, cell: str = CELL) -> str:
    return (
        f"{LON_MIN} + ({id_column} // 100 + CAST(0.5 AS DOUBLE)) * {cell} AS lon, "
        f"{LAT_MIN} + ({id_column} % 100 + CAST(0.5 AS DOUBLE)) * {cell} AS lat"
    )


def day_number(column: str) -> str:
    return f"CAST(dayofweek({column}) + 1 AS INTEGER)"


def _coordinate(start: str, factor: int, span: int, groups: int, step: int) -> str:
    return (
        f"CAST('{start}' AS DOUBLE) + (((event_id * {factor}) % {span}) "
        f"% ({step} + (event_id % {groups}) * {step})) / CAST(10000 AS DOUBLE)"
    )


def tables(params: RideParams, scenarios: list[tuple[int, float]]) -> dict[str, tuple[list[str], str]]:
    """Name -> (names it reads, text). All grids here share the default box."""
    cell = f"CAST('{params.grid.cell}' AS DOUBLE)"
    train_end = f"DATE '{params.train_end}'"
    return {
        "trips": (
            [],
            f"""SELECT event_id AS id, ts AS pickup_ts,
  ts + to_seconds(CAST(30 + (event_id * 37) % 11400 AS INTEGER)) AS dropoff_ts,
  {_coordinate('-74.06', 7919, 3800, 19, 200)} AS pickup_longitude,
  {_coordinate('40.54', 104729, 4200, 13, 300)} AS pickup_latitude,
  {_coordinate('-74.06', 15485863, 3800, 17, 200)} AS dropoff_longitude,
  {_coordinate('40.54', 1299709, 4200, 11, 300)} AS dropoff_latitude,
  CAST(30 + (event_id * 37) % 11400 AS INTEGER) AS trip_duration,
  CAST(event_id % 7 AS INTEGER) AS passenger_count
FROM events""",
        ),
        "clean": (
            ["trips"],
            f"""SELECT id, pickup_ts, dropoff_ts, CAST(pickup_ts AS DATE) AS date,
  CAST(hour(pickup_ts) AS INTEGER) AS hour,
  {zone('pickup_longitude', 'pickup_latitude', cell)} AS zone_id,
  {zone('dropoff_longitude', 'dropoff_latitude', cell)} AS drop_zone_id,
  trip_duration, passenger_count
FROM trips
WHERE {in_box('pickup')} AND {in_box('dropoff')}
  AND trip_duration BETWEEN {params.min_seconds} AND {params.max_seconds} AND passenger_count > 0""",
        ),
        "zone_demand": (
            ["trips"],
            f"""SELECT {zone('pickup_longitude', 'pickup_latitude', cell)} AS zone_id, count(*) AS total_trips,
  round(avg(trip_duration) / 60, 2) AS avg_trip_duration_minutes,
  round(avg(passenger_count), 2) AS avg_passengers
FROM trips WHERE {in_box('pickup')} GROUP BY 1""",
        ),
        "top_zones": (
            ["clean"],
            f"""SELECT zone_id, count(*) AS total_trips, round(avg(trip_duration) / 60, 2) AS avg_trip_min,
  {center('zone_id', cell)}
FROM clean GROUP BY zone_id ORDER BY total_trips DESC, zone_id LIMIT {params.top_zones}""",
        ),
        "hours": (
            ["clean"],
            """SELECT unnest(generate_series(date_trunc('hour', min(pickup_ts)),
  date_trunc('hour', max(pickup_ts)), INTERVAL 1 HOUR)) AS ts FROM clean""",
        ),
        "pickups": (
            ["clean", "top_zones"],
            """SELECT c.zone_id, date_trunc('hour', pickup_ts) AS ts, count(*) AS demand
FROM clean c JOIN top_zones z ON c.zone_id = z.zone_id GROUP BY 1, 2""",
        ),
        "dropoffs": (
            ["clean", "top_zones"],
            """SELECT c.drop_zone_id AS zone_id, date_trunc('hour', dropoff_ts) AS ts, count(*) AS dropoffs
FROM clean c JOIN top_zones z ON c.drop_zone_id = z.zone_id GROUP BY 1, 2""",
        ),
        "dense": (
            ["top_zones", "hours", "pickups", "dropoffs"],
            f"""SELECT z.zone_id, h.ts, coalesce(p.demand, 0) AS demand, coalesce(d.dropoffs, 0) AS dropoffs,
  CAST(h.ts AS DATE) AS date, CAST(hour(h.ts) AS INTEGER) AS hour, {day_number('h.ts')} AS dow,
  CAST({day_number('h.ts')} IN (1, 7) AS INTEGER) AS is_weekend,
  CAST(z.zone_id // 100 AS INTEGER) AS zone_x, CAST(z.zone_id % 100 AS INTEGER) AS zone_y
FROM top_zones z CROSS JOIN hours h
LEFT JOIN pickups p ON p.zone_id = z.zone_id AND p.ts = h.ts
LEFT JOIN dropoffs d ON d.zone_id = z.zone_id AND d.ts = h.ts""",
        ),
        "stats": (
            ["dense"],
            f"""SELECT zone_id, dow, hour, CAST(sum(demand) AS DOUBLE) AS s, count(*) AS n
FROM dense WHERE date < {train_end} GROUP BY ALL""",
        ),
        "data": (
            ["dense", "stats"],
            f"""SELECT d.*, lag(demand, 168) OVER (PARTITION BY d.zone_id ORDER BY ts) AS lag_168,
  CASE WHEN date < {train_end} AND n > 1 THEN (s - demand) / (n - 1) ELSE s / n END AS hist_mean
FROM dense d LEFT JOIN stats t ON t.zone_id = d.zone_id AND t.dow = d.dow AND t.hour = d.hour""",
        ),
        "features": (["data"], "SELECT * FROM data WHERE lag_168 IS NOT NULL"),
        "supply_proxy": (
            ["dense"],
            """SELECT zone_id, dow, hour, avg(dropoffs) AS avg_dropoffs, CAST(sum(dropoffs) AS BIGINT) AS dropoffs
FROM dense GROUP BY zone_id, dow, hour""",
        ),
        "demand_profile": (
            ["dense"],
            """SELECT dow, hour, round(avg(trips), 1) AS avg_city_trips
FROM (SELECT date, dow, hour, sum(demand) AS trips FROM dense GROUP BY ALL) GROUP BY ALL""",
        ),
        "pred_grid": (
            ["stats"],
            "SELECT zone_id, dow, hour, round(s / n, 2) AS hist_mean, round(s / n, 2) AS prediction FROM stats",
        ),
        "slot_frame": (
            ["pred_grid", "top_zones", "supply_proxy"],
            """SELECT g.*, z.lon, z.lat, coalesce(s.avg_dropoffs, 0) AS avg_dropoffs, coalesce(s.dropoffs, 0) AS dropoffs,
  CAST(g.zone_id // 100 AS INTEGER) AS zone_x, CAST(g.zone_id % 100 AS INTEGER) AS zone_y
FROM pred_grid g JOIN top_zones z ON z.zone_id = g.zone_id
LEFT JOIN supply_proxy s ON s.zone_id = g.zone_id
  AND s.hour = CASE WHEN g.hour = 0 THEN 23 ELSE g.hour - 1 END
  AND s.dow = CASE WHEN g.hour > 0 THEN g.dow WHEN g.dow = 1 THEN 7 ELSE g.dow - 1 END""",
        ),
        "slot_frame_b": (
            ["pred_grid", "top_zones", "supply_proxy"],
            """SELECT g.*, z.lat, z.lon, z.total_trips, coalesce(s.avg_dropoffs, 0) AS avg_dropoffs,
  coalesce(s.dropoffs, 0) AS dropoffs
FROM pred_grid g LEFT JOIN top_zones z ON z.zone_id = g.zone_id
LEFT JOIN supply_proxy s ON s.zone_id = g.zone_id AND s.hour = g.hour AND s.dow = g.dow""",
        ),
        "fleets": (
            [],
            "SELECT * FROM (VALUES "
            + ", ".join(f"(CAST({f} AS BIGINT), CAST({r} AS DOUBLE))" for f, r in scenarios)
            + ") v(fleet, trips_per_driver)",
        ),
        "weighted": (
            ["slot_frame", "fleets"],
            """SELECT *, CAST(ceil(prediction / trips_per_driver) AS BIGINT) AS needed,
  CASE WHEN sum(dropoffs) OVER slot > 0 THEN dropoffs ELSE 1 END AS supply_units,
  CAST(round(prediction * 100) AS BIGINT) AS demand_units
FROM slot_frame CROSS JOIN fleets
WINDOW slot AS (PARTITION BY fleet, trips_per_driver, dow, hour)""",
        ),
        "divided": (
            ["weighted"],
            """SELECT *, sum(needed) OVER slot AS all_needed,
  fleet * supply_units // sum(supply_units) OVER slot AS supply_base,
  fleet * supply_units % sum(supply_units) OVER slot AS supply_rest,
  coalesce(fleet * demand_units // nullif(sum(demand_units) OVER slot, 0), 0) AS demand_base,
  coalesce(fleet * demand_units % nullif(sum(demand_units) OVER slot, 0), 0) AS demand_rest,
  sum(demand_units) OVER slot > 0 AS has_demand
FROM weighted WINDOW slot AS (PARTITION BY fleet, trips_per_driver, dow, hour)""",
        ),
        "shared": (
            ["divided"],
            """SELECT *,
  supply_base + CASE WHEN row_number() OVER (PARTITION BY fleet, trips_per_driver, dow, hour
      ORDER BY supply_rest DESC, zone_id) <= fleet - sum(supply_base) OVER slot THEN 1 ELSE 0 END AS current_drivers,
  CASE WHEN all_needed <= fleet THEN needed ELSE
    demand_base + CASE WHEN has_demand AND row_number() OVER (PARTITION BY fleet, trips_per_driver, dow, hour
      ORDER BY demand_rest DESC, zone_id) <= fleet - sum(demand_base) OVER slot THEN 1 ELSE 0 END END AS assigned
FROM divided WINDOW slot AS (PARTITION BY fleet, trips_per_driver, dow, hour)""",
        ),
        "scenario_zones": (
            ["shared"],
            """SELECT fleet, trips_per_driver, dow, hour, zone_id, zone_x, zone_y, prediction, needed,
  CAST(current_drivers AS BIGINT) AS current, CAST(assigned AS BIGINT) AS assigned,
  CAST(assigned - current_drivers AS BIGINT) AS gap,
  CAST(greatest(needed - current_drivers, 0) AS BIGINT) AS short_now,
  CAST(greatest(needed - assigned, 0) AS BIGINT) AS short_after
FROM shared""",
        ),
        "allocation": (
            ["scenario_zones"],
            f"SELECT * FROM scenario_zones WHERE fleet = {params.fleet} AND trips_per_driver = {params.trips_per_driver}",
        ),
        "scarce_allocation": (
            ["scenario_zones"],
            f"SELECT * FROM scenario_zones WHERE fleet = {SCARCE_FLEET} AND trips_per_driver = {params.trips_per_driver}",
        ),
        "floored": (
            ["slot_frame_b"],
            f"""SELECT *, needed - current AS wants, current - needed AS gap, greatest(needed - current, 0) AS short_now
FROM (SELECT dow, hour, zone_id, CAST(zone_id // 100 AS INTEGER) AS zone_x,
    CAST(zone_id % 100 AS INTEGER) AS zone_y, prediction,
    CAST(ceil(prediction / {params.trips_per_driver}) AS BIGINT) AS needed,
    CAST(coalesce(dropoffs * {params.fleet}
      // nullif(sum(dropoffs) OVER (PARTITION BY dow, hour), 0), 0) AS BIGINT) AS current
  FROM slot_frame_b)""",
        ),
    }


CTES = tables(PARAMS, SCENARIOS)

ALLOCATION = "dow, hour, zone_id, prediction, needed, current, assigned, gap, short_now, short_after"


def _needed(names: tuple[str, ...], ctes: dict[str, tuple[list[str], str]]) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in ctes[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return order


def with_tables(
    body: str,
    *names: str,
    extra: str = "",
    recursive: bool = False,
    ctes: dict[str, tuple[list[str], str]] = CTES,
) -> str:
    """A statement that reads the named expressions and everything they read."""
    parts = [f"{name} AS MATERIALIZED (\n{ctes[name][1]}\n)" for name in _needed(names, ctes)]
    if extra:
        parts.append(extra)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body


def greedy(body: str, source: str, wants: str, order: str) -> str:
    """Statement over ``moves``: wanting zones served one after another from the nearest givers.

    A recursive step serves one wanting zone per slot. ``cap`` is what each
    giver of the slot still has, in order of its id.
    """
    extra = f"""open_zones AS MATERIALIZED (
SELECT dow, hour, zone_id, zone_x, zone_y, CAST({wants} AS BIGINT) AS wants FROM {source} WHERE {wants} <> 0
),
givers AS MATERIALIZED (
SELECT dow, hour, list(zone_id ORDER BY zone_id) AS ids, list(-wants ORDER BY zone_id) AS cap
FROM open_zones WHERE wants < 0 GROUP BY dow, hour
),
ranked AS MATERIALIZED (
SELECT t.dow, t.hour, t.zone_id, t.wants, g.ids,
  row_number() OVER (PARTITION BY t.dow, t.hour ORDER BY {order}) AS turn,
  [((ids[i] // 100 - t.zone_x) * (ids[i] // 100 - t.zone_x)
    + (ids[i] % 100 - t.zone_y) * (ids[i] % 100 - t.zone_y)) * 1000 + i
   for i in range(1, len(ids) + 1)] AS nearness
FROM open_zones t JOIN givers g ON g.dow = t.dow AND g.hour = t.hour WHERE t.wants > 0
),
turns AS (
SELECT dow, hour, CAST(0 AS BIGINT) AS turn, CAST(NULL AS BIGINT) AS to_zone, ids, cap,
  CAST(NULL AS BIGINT[]) AS taken FROM givers
UNION ALL
SELECT s.dow, s.hour, s.turn, s.zone_id, s.ids,
  [s.cap[i] - s.taken[i] for i in range(1, len(s.ids) + 1)], s.taken
FROM (SELECT p.dow, p.hour, r.turn, r.zone_id, r.ids, p.cap,
    [greatest(0, least(p.cap[i], r.wants - CAST(coalesce(list_sum(
        [p.cap[j] for j in range(1, len(r.ids) + 1) if r.nearness[j] < r.nearness[i]]), 0) AS BIGINT)))
     for i in range(1, len(r.ids) + 1)] AS taken
  FROM turns p JOIN ranked r ON r.dow = p.dow AND r.hour = p.hour AND r.turn = p.turn + 1) s
),
moves AS MATERIALIZED (
SELECT * FROM (SELECT dow, hour, unnest(ids) AS from_zone, to_zone, unnest(taken) AS drivers
  FROM turns WHERE turn > 0) WHERE drivers > 0
)"""
    return with_tables(body, source, extra=extra, recursive=True)


def moved_km() -> str:
    dx = f"((from_zone // 100 - to_zone // 100) * {CELL} * CAST(84.4 AS DOUBLE))"
    dy = f"((from_zone % 100 - to_zone % 100) * {CELL} * CAST(111.2 AS DOUBLE))"
    return f"round(sqrt({dx} * {dx} + {dy} * {dy}), 2)"

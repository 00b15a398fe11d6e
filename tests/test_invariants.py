"""Random tables against plain definitions, conservation laws, independence of data layout."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from hailgrid.catalog.inputs import PARAMS, clean, one_fleet, trips, week_tables, zones
from hailgrid.operators import balance, moves, nearest, zone_hours
from hailgrid.operators.demand import top_zones, zone_hour_pickups, zone_hour_totals
from hailgrid.operators.shares import apportion
from hailgrid.params import COARSE_GRID, RideParams
from hailgrid.plans import dashboards, forecasting
from hailgrid.plans.allocation import allocate

SF = "/root/testdata/sf0.001"


def largest_remainder(weights, total):
    whole = sum(weights)
    if total <= 0 or whole <= 0:
        return [0] * len(weights)
    exact = [Fraction(total) * w / whole for w in weights]
    parts = [math.floor(e) for e in exact]
    order = sorted(range(len(weights)), key=lambda i: (parts[i] - exact[i], i))
    for i in order[: total - sum(parts)]:
        parts[i] += 1
    return parts


def test_apportion_against_definition(spark):
    rng = random.Random(1)
    data, want = [], {}
    for group in range(200):
        total = rng.choice([0, 1, 5, 17, 100, 3000])
        weights = [rng.choice([0, 1, 2, 3, rng.randrange(1000)]) for _ in range(rng.randrange(1, 25))]
        for zone, (weight, part) in enumerate(zip(weights, largest_remainder(weights, total))):
            data.append((group, zone, weight, total))
            want[group, zone] = part
    frame = spark.createDataFrame(data, "g int, zone_id long, w long, total int").repartition(5)
    for weight in ("w", "half"):
        source = frame.withColumn("half", F.col("w") / 2)
        split = apportion(source, weight, "total", ["g"], "n")
        assert {(r.g, r.zone_id): r.n for r in split.collect()} == want


def serve(wants, largest_first):
    """One driver at a time: the next wanting zone takes from the nearest zone that still has one."""
    left = {z: -w for z, w in wants.items() if w < 0}
    takers = sorted((z for z, w in wants.items() if w > 0), key=lambda z: (-wants[z] if largest_first else 0, z))
    moved = {}
    for taker in takers:
        for _ in range(wants[taker]):
            open_ = [z for z, n in left.items() if n > 0]
            if not open_:
                break
            near = min(open_, key=lambda z: ((z // 100 - taker // 100) ** 2 + (z % 100 - taker % 100) ** 2, z))
            left[near] -= 1
            moved[near, taker] = moved.get((near, taker), 0) + 1
    return moved


@pytest.mark.parametrize("largest_first", [True, False])
def test_moves_against_one_driver_at_a_time(spark, largest_first):
    rng = random.Random(2)
    data, want = [], {}
    for slot in range(60):
        cells = rng.sample([x * 100 + y for x in range(7) for y in range(9)], rng.randrange(1, 30))
        wants = {zone: rng.randrange(-6, 7) for zone in cells}
        sign = 1 if largest_first else -1
        data += [(slot % 7 + 1, slot // 7, z, z // 100, z % 100, sign * w) for z, w in wants.items()]
        for (source, target), n in serve(wants, largest_first).items():
            want[slot % 7 + 1, slot // 7, source, target] = n
    frame = spark.createDataFrame(data, "dow int, hour int, zone_id long, zone_x int, zone_y int, gap long")
    operator = moves.rebalancing_moves if largest_first else moves.rebalancing_moves_by_zone
    got = operator(frame.repartition(3), COARSE_GRID).collect()
    assert {(r.dow, r.hour, r.from_zone, r.to_zone): r.drivers for r in got} == want
    assert len(got) == len(want)


def test_nearest_zone_against_all_pairs(spark):
    rng = random.Random(3)
    params = RideParams(grid=COARSE_GRID, top_zones=9)
    cells = rng.sample([x * 100 + y for x in range(7) for y in range(9)], 9)
    table = dashboards.with_missing_centres(spark.createDataFrame([(z,) for z in cells], "zone_id long"), COARSE_GRID)
    points = [(i, rng.uniform(-74.2, -73.55), rng.uniform(40.4, 41.1)) for i in range(3000)]
    # Cell corners and edges, where rounding decides the cell.
    points += [
        (10000 + 100 * i + j, -74.05 + 0.025 * i, 40.55 + 0.025 * j) for i in range(15) for j in range(17)
    ]
    frame = spark.createDataFrame(points, "id int, lon double, lat double")
    centres = [(r.zone_id, r.lon, r.lat) for r in table.collect()]
    for row in nearest.nearest_zone(frame.repartition(4), table, params).collect():
        if not row.modelled:
            best = min(
                ((x - row.lon) * (x - row.lon) + (y - row.lat) * (y - row.lat), zone) for zone, x, y in centres
            )
            assert row.zone_id == best[1]
        else:
            x, y = math.floor((row.lon + 74.05) / 0.05), math.floor((row.lat - 40.55) / 0.05)
            assert row.zone_id == x * 100 + y


def test_series_keeps_every_modelled_pickup(spark):
    cleaned, top = clean(spark, SF), zones(spark, SF)
    totals = zone_hour_totals(cleaned)
    dense = zone_hours.dense_demand(totals, top, PARAMS)
    hours = zone_hours.hour_timeline(totals).count()
    total = dense.agg(F.count("*"), F.sum("demand"), F.countDistinct("zone_id", "ts")).first()
    assert total[0] == total[2] == PARAMS.top_zones * hours
    assert total[1] == cleaned.join(top, "zone_id", "left_semi").count()


@pytest.fixture(scope="module")
def week(spark):
    return week_tables(spark, SF)


@pytest.mark.parametrize("fleet", [0, 1, 5, 100])
def test_allocation_adds_up(spark, week, fleet):
    slots = balance.slot_frame(week.pred_grid, week.zones, week.supply, PARAMS.max_zones)
    allocated = balance.allocate_zones(one_fleet(slots, fleet))
    sums = allocated.groupBy("dow", "hour").agg(
        *[F.sum(name).alias(name) for name in ("needed", "current", "assigned")],
        F.sum("prediction").alias("trips"),
    )
    for row in sums.collect():
        assert row.current == fleet
        assert row.assigned == (row.needed if row.needed <= fleet else fleet)
    moved = moves.rebalancing_moves(allocated, COARSE_GRID)
    assert moved.filter("drivers <= 0 OR from_zone = to_zone").count() == 0
    flow = moves.apply_moves(allocated.drop("short_after"), moved)
    changed = flow.join(allocated.select("dow", "hour", "zone_id", F.col("assigned").alias("goal")), ["dow", "hour", "zone_id"])
    # Every want is met, and no zone gives more than it has to spare.
    assert changed.filter("(goal >= current AND assigned <> goal) OR (goal < current AND assigned < goal)").count() == 0


def test_results_do_not_depend_on_layout(spark, week):
    def fingerprint(parts):
        grid, supply = week.pred_grid.repartition(parts), week.supply.repartition(parts)
        allocated, moved = allocate(grid, week.zones.repartition(parts), supply, PARAMS)
        return sorted(map(tuple, allocated.collect())), sorted(map(tuple, moved.collect()))

    assert fingerprint(1) == fingerprint(7)
    cleaned = clean(spark, SF)
    a, b = (
        sorted(map(tuple, zone_hours.dense_demand(zone_hour_totals(c), zones(spark, SF), PARAMS).collect()))
        for c in (cleaned.coalesce(1), cleaned.repartition(6))
    )
    assert a == b


def test_predictions_are_never_negative_and_cover_the_week(spark, week):
    data = zone_hours.with_hist_mean(zone_hours.with_weekly_lag(week.data), PARAMS.train_end)
    table = zone_hours.feature_table(data)
    model = forecasting.train_boosted(table.filter("date < '2024-01-22'"), forecasting.BoostParams(rounds=2, depth=2))
    grid = forecasting.predict_grid(model, week.hist)
    keys = grid.agg(F.count("*"), F.countDistinct("zone_id", "dow", "hour"), F.min("prediction")).first()
    assert keys[0] == keys[1] == week.hist.count()
    assert keys[2] >= 0


def test_hot_zone_holding_a_third_of_all_trips(spark):
    """The same counts as a plain grouping when one zone, and one hour, dominate."""
    third = trips(spark, SF).count() // 2
    base = clean(spark, SF)
    first = base.orderBy("id").limit(1)
    hot = first.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(third)))).drop("copy")
    skewed = base.unionByName(hot)
    totals = zone_hour_totals(skewed)
    top = top_zones(totals, PARAMS)
    dense = zone_hours.dense_demand(totals, top, PARAMS).filter("demand > 0").select("zone_id", "ts", "demand")
    assert sorted(map(tuple, dense.collect())) == sorted(map(tuple, zone_hour_pickups(totals, top, PARAMS).collect()))
    plain = skewed.join(top, "zone_id", "left_semi").groupBy("zone_id", F.date_trunc("hour", "pickup_ts").alias("ts"))
    assert sorted(dense.agg(F.sum("demand"), F.count("*")).first()) == sorted(
        plain.count().agg(F.sum("count"), F.count("*")).first()
    )
    assert dense.agg(F.max("demand")).first()[0] > third

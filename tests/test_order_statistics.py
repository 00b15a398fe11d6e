"""Quantiles, rounded bins, lags by time and ranked choices against plain definitions."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hailgrid.catalog.inputs import PARAMS, clean, dense, one_fleet, week_tables
from hailgrid.operators import accuracy, balance, moves, zone_hours
from hailgrid.operators.demand import zone_hour_totals
from hailgrid.operators.quantiles import exact_quantiles, order_statistics
from hailgrid.params import COARSE_GRID, GridSpec

SF = "/root/testdata/sf0.001"


# ---- quantiles ------------------------------------------------------------

PROBABILITIES = [0, 0.001, 0.1, 1 / 3, 0.5, 0.75, 0.99, 1]
rng = random.Random(7)
VALUES = {
    "few": [3.0, 1.0, 2.0],
    "one": [5.0],
    "equal": [2.5] * 100,
    "ties": [float(rng.randrange(5)) for _ in range(500)],
    "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(500)],
    "close": [1 + k * 2**-52 for k in range(300)] + [1e9],
    "ends": [float("inf"), float("-inf"), 0.0, -0.0, 1.7976931348623157e308, -1.7976931348623157e308, 5e-324, 1.0],
    "hot": [7.0] * 400 + [rng.gauss(0, 1) for _ in range(200)],
}


@pytest.mark.parametrize(("name", "bins"), [*[(name, 1024) for name in VALUES], ("ties", 2), ("few", 2)])
def test_order_statistics_are_the_sorted_values(spark, name, bins):
    values = VALUES[name]
    data = [(v,) for v in values] + [(None,), (float("nan"),)]
    frame = spark.createDataFrame(data, "v double").repartition(3)
    ranks = sorted({0, len(values) // 3, len(values) // 2, len(values) - 1})
    got = order_statistics(frame, "v", ranks, bins)
    assert [got[r] for r in ranks] == [sorted(values)[r] for r in ranks]


def test_quantiles_interpolate(spark):
    for name in ("few", "one", "ties", "hot"):
        frame = spark.createDataFrame([(v,) for v in VALUES[name]], "v double")
        assert exact_quantiles(frame, "v", PROBABILITIES) == pytest.approx(np.quantile(VALUES[name], PROBABILITIES).tolist(), rel=1e-12)
    assert exact_quantiles(frame.limit(0), "v", [0.5]) == [None]
    assert exact_quantiles(spark.createDataFrame([(None,)], "v int"), "v", [0.5, 1]) == [None, None]


# ---- bins -----------------------------------------------------------------


@pytest.mark.parametrize("values, step", [([0.0, 29.0], 1), ([-3.2, 3.1], 0.5), ([0.0, 0.0], 1), ([-1.0, 1000.0], 50), ([0.1, 0.13], 0.002), ([0, 60.0], 5)])
def test_steps_are_round_and_as_small_as_they_can_be(spark, values, step):
    frame = spark.createDataFrame([(float(v),) for v in [*values, values[0]]] + [(None,)], "error double")
    found = accuracy.error_histogram_rounded(frame, 30).collect()
    assert [*{r["step"] for r in found}] == pytest.approx([step])
    assert sum(r["rows"] for r in found) == 3
    assert max(r["bin"] for r in found) - min(r["bin"] for r in found) < 30
    assert accuracy.error_histogram_rounded(frame.limit(0), 30).count() == 0


def test_every_error_lies_in_its_bin(spark):
    values = [rng.gauss(0, 3) for _ in range(500)]
    found = accuracy.error_histogram_rounded(spark.createDataFrame([(v,) for v in values], "error double"), 12).collect()
    step = found[0]["step"]
    want = {}
    for v in values:
        want[math.floor(v / step)] = want.get(math.floor(v / step), 0) + 1
    assert {r["bin"]: r["rows"] for r in found} == want and len(want) <= 12


# ---- lag by time ----------------------------------------------------------


def test_sparse_lag_is_the_dense_one_where_both_are(spark):
    totals = zone_hour_totals(clean(spark, SF))
    sparse = zone_hours.with_sparse_lag(totals).select("zone_id", "ts", F.col("lag_168").alias("sparse"))
    full = zone_hours.with_weekly_lag(dense(spark, SF)).select("zone_id", "ts", "lag_168")
    both = full.join(sparse, ["zone_id", "ts"])
    assert both.count() > 100 and both.filter("lag_168 > 0").count() > 0
    assert both.filter(~F.col("lag_168").eqNullSafe(F.col("sparse"))).count() == 0


def test_sparse_lag_knows_nothing_before_the_first_pickup(spark):
    start = datetime(2024, 1, 1)
    at = lambda h: start + timedelta(hours=h)
    data = [(1, at(0), 4), (1, at(2), 1), (1, at(3), 2), (2, at(1), 0), (2, at(-1), 0)]
    totals = spark.createDataFrame(data, "zone_id long, ts timestamp_ntz, demand long")
    got = {(r.zone_id, r.ts): r.lag_2 for r in zone_hours.with_sparse_lag(totals, 2).collect()}
    assert got == {(1, at(0)): None, (1, at(2)): 4, (1, at(3)): 0, (2, at(1)): None, (2, at(-1)): None}
    assert zone_hours.with_sparse_lag(totals.limit(0)).count() == 0


# ---- ranked choices -------------------------------------------------------


@pytest.mark.parametrize("k, radius", [(1, None), (3, 1), (3, None), (50, 2)])
def test_ranked_choices_against_all_pairs(spark, k, radius):
    grid = GridSpec(cell=0.02)  # 18 x 21 cells
    data, want = [], {}
    for slot in range(40):
        cells = rng.sample([x * 100 + y for x in range(grid.n_x) for y in range(grid.n_y)], rng.choice([1, 5, 60, 200]))
        gaps = {zone: rng.choice([-2, -1, 0, 1, 3]) if slot % 4 else rng.choice([1, 2, 2, -1]) for zone in cells}
        data += [(slot % 7 + 1, slot // 7, z, z // 100, z % 100, g) for z, g in gaps.items()]
        givers = [z for z, g in gaps.items() if g < 0]
        for taker, g in gaps.items():
            if g > 0:
                near = sorted(givers, key=lambda z: ((z // 100 - taker // 100) ** 2 + (z % 100 - taker % 100) ** 2, z))[:k]
                want.update({(slot % 7 + 1, slot // 7, taker, n + 1): (z, g, -gaps[z]) for n, z in enumerate(near)})
    frame = spark.createDataFrame(data, "dow int, hour int, zone_id long, zone_x int, zone_y int, gap long")
    got = moves.ranked_choices(frame, grid, k, radius=radius).collect()
    assert {(r.dow, r.hour, r.zone_id, r["rank"]): (r.from_zone, r.gap, r.spare) for r in got} == want
    assert len(got) == len(want)


def test_ranked_choices_of_nothing(spark):
    frame = spark.createDataFrame([], "dow int, hour int, zone_id long, zone_x int, zone_y int, gap long")
    assert moves.ranked_choices(frame, COARSE_GRID).count() == 0


def test_first_rank_is_the_first_choice(spark):
    week = week_tables(spark, SF)
    slots = balance.slot_frame(week.pred_grid, week.zones, week.supply, PARAMS.max_zones)
    allocated = balance.allocate_zones(one_fleet(slots, 20))
    first = {(r.dow, r.hour, r.zone_id): r.from_zone for r in moves.first_choice(allocated).collect()}
    ranked = moves.ranked_choices(allocated, PARAMS.grid, 2).filter("rank = 1").collect()
    assert {(r.dow, r.hour, r.zone_id): r.from_zone for r in ranked} == first


def test_moves_stay_in_the_jvm(spark):
    frame = spark.createDataFrame([(1, 2, 3, 0, 3, 1), (1, 2, 4, 0, 4, -1)], "dow int, hour int, zone_id long, zone_x int, zone_y int, gap long")
    plan = moves.rebalancing_moves(frame, COARSE_GRID)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

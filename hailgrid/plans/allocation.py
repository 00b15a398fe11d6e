"""Driver allocation for all weekly slots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hailgrid.functions.geo import zone_x, zone_y
from hailgrid.operators import balance, moves
from hailgrid.params import ZONE_STRIDE, RideParams
from hailgrid.sources.tables import ResultStore


def allocate(
    pred_grid: DataFrame,
    zones: DataFrame,
    supply: DataFrame,
    params: RideParams,
    variant: str = "a",
    store: ResultStore | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Zone table and moves of every slot for one fleet.

    With a ``store`` the planned table is written there, and the moves and what
    follows start from the written copy, so the allocation is planned once.

    Variant "a" splits the fleet by drop-offs of the previous hour and spreads
    scarcity by prediction. Variant "b" uses drop-offs of the same hour, floors
    the shares, and lets the moves decide who is served.
    """
    scenario = [(params.fleet, params.trips_per_driver)]

    def planned(table: DataFrame) -> DataFrame:
        return store.write(table, "allocation_planned") if store else table

    if variant == "a":
        slots = balance.slot_frame(pred_grid, zones, supply, params.max_zones, params.grid.stride)
        allocated = planned(balance.allocate_zones(balance.with_scenarios(slots, scenario)))
        moved = moves.rebalancing_moves(allocated, params.grid)
    elif variant == "b":
        slots = balance.slot_frame_same_hour(pred_grid, zones, supply, params.max_zones)
        floored = planned(with_cells(balance.allocate_zones_by_floor(balance.with_scenarios(slots, scenario)), params.grid.stride))
        moved = moves.rebalancing_moves_by_zone(floored, params.grid)
        if store:
            moved = store.write(moved, "moves_planned")
        allocated = moves.apply_moves(floored, moved)
    else:
        raise ValueError(f"unknown variant {variant!r}")
    return allocated.select(*balance.SLOT_KEYS, "zone_id", "prediction", *balance.ALLOCATION_COLUMNS), moved


def with_cells(slots: DataFrame, stride: int = ZONE_STRIDE) -> DataFrame:
    return slots.withColumns({"zone_x": zone_x(F.col("zone_id"), stride), "zone_y": zone_y(F.col("zone_id"), stride)})


def what_if(
    pred_grid: DataFrame,
    zones: DataFrame,
    supply: DataFrame,
    params: RideParams,
    scenarios: list[tuple[int, float]],
) -> DataFrame:
    """The zone table for several fleets and trip rates in one plan."""
    slots = balance.slot_frame(pred_grid, zones, supply, params.max_zones, params.grid.stride)
    keys = ["fleet", "trips_per_driver", *balance.SLOT_KEYS]
    allocated = balance.allocate_zones(balance.with_scenarios(slots, scenarios), keys)
    return allocated.select(*keys, "zone_id", "prediction", *balance.ALLOCATION_COLUMNS)

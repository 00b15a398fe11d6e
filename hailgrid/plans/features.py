"""Totals per cell and hour to model features and weekly-slot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hailgrid.operators import zone_hours
from hailgrid.params import RideParams


def zone_hour_data(totals: DataFrame, zones: DataFrame, params: RideParams) -> DataFrame:
    """The dense series with calendar columns, weekly lag and historical mean."""
    dense = zone_hours.dense_demand(totals, zones, params)
    lagged = zone_hours.with_weekly_lag(zone_hours.with_zone_calendar(dense, params.grid.stride))
    return zone_hours.with_hist_mean(lagged, params.train_end)


def slot_tables(data: DataFrame, summary: DataFrame) -> dict[str, DataFrame]:
    """History and supply from the stored slot summary, the city profile from the series."""
    return {
        "hist": zone_hours.hist_of(summary),
        "supply_proxy": zone_hours.supply_of(summary),
        "demand_profile": zone_hours.demand_profile(data),
    }

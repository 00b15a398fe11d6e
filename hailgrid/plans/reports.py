"""Descriptive reports over raw trips."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hailgrid.operators import demand
from hailgrid.operators.ranking import first_n


def inspect_trips(trips: DataFrame, rows: int = 10) -> dict[str, DataFrame]:
    """A look at the first rows by id, and the row count."""
    return {"head": first_n(trips, rows, "id"), "trip_count": demand.trip_count(trips)}


TOTALS_BY = ["date", "hour", "zone_id"]


def demand_report(totals: DataFrame) -> dict[str, DataFrame]:
    """Four tables from ``demand.trip_totals``; store the totals first and the trips are read once."""
    return {
        "hourly_demand": demand.hourly_demand(totals),
        "daily_demand": demand.daily_demand(totals),
        "average_duration": demand.average_duration(totals),
        "average_passengers": demand.average_passengers(totals),
    }


def zone_report(totals: DataFrame) -> dict[str, DataFrame]:
    return {"quality_counts": demand.zone_quality(totals), "zone_demand": demand.zone_demand(totals)}

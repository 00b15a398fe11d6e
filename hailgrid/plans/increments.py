"""Totals that grow by batches: a batch is added, or run again, without reading the trips of any other.

Three tables hold what is known:

zone_hour_batches  totals by cell and hour of one batch of clean trips,
                   partitioned by date and batch
zone_hour_merged   the sums over all batches, partitioned by date
slot_merged        their sums by cell, weekday and hour, partitioned by weekday

A trip belongs to one batch, but its hours may not belong to one date (a trip
ends after midnight, a late file holds an old day). So every batch keeps its own
partial totals, and adding it recomputes the dates and weekdays it touches, from
the partial totals of just these. A batch that runs again replaces its own
partitions first, so its trips are never counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hailgrid.operators.demand import zone_hour_totals
from hailgrid.sources.tables import ResultStore

BATCHES = "zone_hour_batches"
MERGED = "zone_hour_merged"
SLOTS = "slot_merged"
SUMS = ["demand", "dropoffs", "seconds"]


def _dates_of(store: ResultStore, batch: str) -> set:
    """The dates a batch has totals of, from the names of partitions."""
    if not store.exists(BATCHES):
        return set()
    known = store.read(BATCHES).filter(F.col("batch") == batch)
    return {r["date"] for r in known.select("date").distinct().collect()}


def add_batch(store: ResultStore, clean: DataFrame, batch: str) -> list:
    """Add one batch of clean trips to the stored totals; returns the dates that were recomputed.

    The driver holds the dates of the batch. Batches may come in any order;
    they must not be added at the same time.
    """
    before = _dates_of(store, batch)
    totals = zone_hour_totals(clean).withColumns({"date": F.to_date("ts"), "batch": F.lit(batch)})
    staged = store.write(totals, f"staged/{batch}")
    touched = before | {r["date"] for r in staged.select("date").distinct().collect()}
    store.replace(staged, BATCHES, ["date", "batch"], [(date, batch) for date in sorted(touched)])
    refresh(store, sorted(touched))
    return sorted(touched)


def refresh(store: ResultStore, dates: list) -> None:
    """Recompute the merged totals of some dates, and the slot sums of their weekdays."""
    if not dates:
        return
    parts = store.read(BATCHES).filter(F.col("date").isin(dates))
    merged = parts.groupBy("date", "zone_id", "ts").agg(*[F.sum(name).alias(name) for name in SUMS])
    table = store.replace(merged.select("zone_id", "ts", *SUMS, "date"), MERGED, ["date"], [(date,) for date in dates])
    weekdays = sorted({date.isoweekday() % 7 + 1 for date in dates})
    slots = (
        table.filter(F.dayofweek("date").isin(weekdays))
        .groupBy(F.dayofweek("date").alias("dow"), "zone_id", F.hour("ts").alias("hour"))
        .agg(*[F.sum(name).alias(name) for name in SUMS], F.count("*").alias("busy_hours"))
    )
    store.replace(slots.select("zone_id", "hour", *SUMS, "busy_hours", "dow"), SLOTS, ["dow"], [(dow,) for dow in weekdays])


def merged_totals(store: ResultStore) -> DataFrame:
    """Totals by cell and hour over all batches, as ``zone_hour_totals`` of all their trips gives them."""
    return store.read(MERGED).drop("date")


def merged_slots(store: ResultStore) -> DataFrame:
    """Sums by cell, weekday and hour over all batches, and how many hours of the slot had any trip."""
    return store.read(SLOTS)

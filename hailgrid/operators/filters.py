"""Row selection: validity rules, splits, slots, ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hailgrid.functions.geo import in_box
from hailgrid.params import GridSpec, RideParams


def pickup_in_box(grid: GridSpec) -> Column:
    return in_box("pickup_longitude", "pickup_latitude", grid)


def dropoff_in_box(grid: GridSpec) -> Column:
    return in_box("dropoff_longitude", "dropoff_latitude", grid)


def is_valid_trip(params: RideParams) -> Column:
    """Both ends in the box, a plausible duration, passengers, and timestamps that parsed."""
    plausible = F.expr(
        f"trip_duration BETWEEN {params.min_seconds} AND {params.max_seconds} AND passenger_count > 0 "
        "AND pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL"
    )
    return pickup_in_box(params.grid) & dropoff_in_box(params.grid) & plausible


def broken_rules(params: RideParams) -> dict[str, Column]:
    """Each rule of ``is_valid_trip`` by name, and whether a trip breaks it; a missing or unreadable value does."""
    rules = {
        "pickup_time": F.col("pickup_ts").isNotNull(),
        "dropoff_time": F.col("dropoff_ts").isNotNull(),
        "pickup_place": pickup_in_box(params.grid),
        "dropoff_place": dropoff_in_box(params.grid),
        "duration": F.col("trip_duration").between(params.min_seconds, params.max_seconds),
        "passengers": F.col("passenger_count") > 0,
    }
    return {name: ~F.coalesce(kept, F.lit(False)) for name, kept in rules.items()}


def quality_counts(df: DataFrame, valid: Column) -> DataFrame:
    """Total, valid and removed rows in one pass. A null condition counts as removed."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_if(valid).alias("valid_records"),
        (F.count("*") - F.count_if(valid)).alias("removed_records"),
    )


def before_date(end: str, column: str = "date") -> Column:
    return F.col(column) < F.lit(end).cast("date")


def split_by_date(df: DataFrame, end: str, column: str = "date") -> tuple[DataFrame, DataFrame]:
    """Rows before ``end`` and the rest."""
    earlier = before_date(end, column)
    return df.filter(earlier), df.filter(~earlier)


def in_hash_fraction(keys: list[str], fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the keys, chosen by a hash of the key and the seed.

    Unlike ``randomSplit`` the choice does not depend on how rows are laid out
    over partitions, so a lost executor or another cluster size cannot move a
    row from one side to the other.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(key).cast("string") for key in keys])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10000
    return bucket < round(fraction * 10000)


def hash_split(
    df: DataFrame, keys: list[str], fraction: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    chosen = in_hash_fraction(keys, fraction, seed)
    return df.filter(chosen), df.filter(~chosen)


def slot_rows(df: DataFrame, dow: int, hour: int) -> DataFrame:
    return df.filter((F.col("dow") == dow) & (F.col("hour") == hour))


def hours_between(df: DataFrame, first: int, last: int, column: str = "pickup_hour") -> DataFrame:
    return df.filter(F.col(column).between(first, last))


def with_levels(df: DataFrame, levels: list[str]) -> DataFrame:
    """Rows at the chosen demand levels; choosing none gives an empty table."""
    if not levels:
        return df.filter(F.lit(False))
    return df.filter(F.col("demand_level").isin(*levels))

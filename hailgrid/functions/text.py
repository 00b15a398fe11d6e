"""Labels shown next to ids and codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zone_label(zone: Column) -> Column:
    return F.concat(F.lit("Zone "), zone.cast("string"))


def hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def code_label(code: Column, labels: dict[str, str]) -> Column:
    """Look a code up in a small literal table; unknown codes become null."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), code)

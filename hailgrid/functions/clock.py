"""Calendar and weekly-slot expressions over zone-less timestamps.

``date_trunc`` and ``date_format`` go through the session time zone, so hours
near a daylight-saving change would move; everything here stays on
TIMESTAMP_NTZ and is independent of the session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOURS_PER_WEEK = 7 * 24

# Weekday 1 is Sunday.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def parse_ts(text: Column) -> Column:
    """Text to timestamp; anything malformed becomes null instead of failing the job."""
    return text.try_cast("timestamp_ntz")


def hour_start(ts: str) -> Column:
    """Start of the hour, for grouping many rows; rows without a timestamp are dropped.

    Tumbling windows are plain arithmetic on the stored number. They cost next
    to nothing, where calendar functions build date objects for every row.
    """
    return F.window(ts, "1 hour").start


def day_name(dow: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in DAY_NAMES]), dow)


def is_weekend(dow: Column) -> Column:
    return dow.isin(1, 7).cast("int")


def slot_index(dow: Column, hour: Column) -> Column:
    """Hour of the week, 0 = Sunday 00:00 ... 167 = Saturday 23:00."""
    return ((dow - 1) * 24 + hour).cast("int")


def slot_dow(slot: Column) -> Column:
    return (F.floor(slot / 24) + 1).cast("int")


def slot_hour(slot: Column) -> Column:
    return (slot % 24).cast("int")


def previous_slot(dow: Column, hour: Column) -> Column:
    return F.pmod(slot_index(dow, hour) - 1, F.lit(HOURS_PER_WEEK)).cast("int")


def next_slot(dow: Column, hour: Column) -> Column:
    return F.pmod(slot_index(dow, hour) + 1, F.lit(HOURS_PER_WEEK)).cast("int")


def with_calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add date, hour, dow (1 = Sunday) and is_weekend."""
    return df.selectExpr(
        "*",
        f"to_date({ts}) AS date",
        f"hour({ts}) AS hour",
        f"dayofweek({ts}) AS dow",
        f"CAST(dayofweek({ts}) IN (1, 7) AS INT) AS is_weekend",
    )

"""Guarded arithmetic. Spark raises on division by zero, so denominators go through nullif."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def non_negative(value: Column) -> Column:
    return F.greatest(value, F.lit(0))


def whole_quotient(a: Column, b: Column) -> Column:
    """Integer quotient, exact beyond the range a double can hold."""
    return F.call_function("div", a, b)

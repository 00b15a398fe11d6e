"""Integer apportionment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

WEIGHT_SCALE = 1_000_000

# The product of two longs needs more than 64 bits.
WIDE = "CAST({} AS DECIMAL(19, 0))"


def weight_units(df: DataFrame, weight: str) -> Column:
    """Weights as whole numbers, so that sums do not depend on the order of rows.

    Whole weights are taken as they are; fractional ones count in millionths,
    which is exact for the two digits of a prediction and not for a mean: share
    by the sum behind it.
    """
    if isinstance(df.schema[weight].dataType, IntegralType):
        return F.col(weight).cast("long")
    return F.round(F.col(weight) * WEIGHT_SCALE).cast("long")


def apportion(
    df: DataFrame, weight: str, total: str, keys: list[str], into: str, tie: str = "zone_id"
) -> DataFrame:
    """Split the integer ``total`` of each group over its rows by the largest-remainder rule.

    The parts add up to ``total`` exactly. Equal remainders are served in order
    of ``tie``. A group without positive total or weight gets zeros. The rows of
    a group share one task: a group is one weekly slot, at most one row a zone.
    """
    group = f"PARTITION BY {', '.join(keys)}"
    units, whole, product, base, rest, left, rank = unused(df, "units", "whole", "product", "base", "rest", "left", "rank")
    return (
        df.withColumn(units, weight_units(df, weight))
        .selectExpr("*", f"sum({units}) OVER ({group}) AS {whole}")
        .selectExpr("*", f"IF({total} > 0 AND {whole} > 0, {WIDE.format(total)} * {WIDE.format(units)}, NULL) AS {product}")
        .selectExpr(
            "*",
            f"coalesce({product} DIV {whole}, 0L) AS {base}",
            f"coalesce(CAST({product} % {whole} AS BIGINT), 0L) AS {rest}",
        )
        .selectExpr(
            "*",
            f"IF({total} > 0 AND {whole} > 0, {total} - sum({base}) OVER ({group}), 0) AS {left}",
            f"row_number() OVER ({group} ORDER BY {rest} DESC, {tie}) AS {rank}",
        )
        .selectExpr(*[f"`{name}`" for name in df.columns], f"{base} + CAST({rank} <= {left} AS BIGINT) AS {into}")
    )


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, behind as many underscores as it takes to clash with no column, in whatever case."""
    taken, mark = {name.lower() for name in df.columns}, "_"
    while any(mark + name in taken for name in names):
        mark += "_"
    return [mark + name for name in names]

"""Forecast errors. Every measure is one aggregate over the predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hailgrid.functions.number import ratio


def mean_absolute(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def root_mean_square(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((actual - predicted) * (actual - predicted)))


def compare_models(df: DataFrame, actual: str, models: dict[str, str]) -> DataFrame:
    """MAE and RMSE of several prediction columns: one scan, then one row per model."""
    measures = [
        measure(F.col(actual), F.col(column).cast("double")).alias(f"{name}_{column}")
        for column in models.values()
        for name, measure in (("mae", mean_absolute), ("rmse", root_mean_square))
    ]
    rows = [
        F.struct(F.lit(model).alias("model"), F.col(f"mae_{column}").alias("mae"), F.col(f"rmse_{column}").alias("rmse"))
        for model, column in models.items()
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def metric_gain(metrics: DataFrame, model: str, baseline: str) -> DataFrame:
    """Relative MAE improvement of a model over a baseline; above zero the model is better."""
    mae = {name: F.max(F.when(F.col("model") == name, F.col("mae"))) for name in (model, baseline)}
    return metrics.agg(
        mae[model].alias("model_mae"),
        mae[baseline].alias("baseline_mae"),
        (1 - ratio(mae[model], mae[baseline])).alias("gain"),
    )


def with_error(df: DataFrame, actual: str = "total_trips") -> DataFrame:
    return df.withColumn("error", F.col("prediction") - F.col(actual))


def error_summary(df: DataFrame, actual: str = "total_trips") -> DataFrame:
    """MAE, MAPE without zero actuals, and R2, which is NaN when the actuals do not vary.

    The total sum of squares comes from the merged central moments, so it needs
    no second pass over the data for the mean.
    """
    df = with_error(df, actual)
    total = F.var_pop(actual) * F.count(actual)
    return df.agg(
        F.avg(F.abs("error")).alias("mae"),
        (F.avg(ratio(F.abs("error"), F.col(actual))) * 100).alias("mape"),
        F.when(total > 0, 1 - F.sum(F.col("error") * F.col("error")) / F.nullif(total, F.lit(0.0)))
        .otherwise(F.lit(float("nan")))
        .alias("r2"),
    )


def value_range(df: DataFrame, actual: str = "total_trips") -> DataFrame:
    """Smallest and largest value over the actual and the predicted column."""
    return df.agg(
        F.least(F.min(actual), F.min("prediction")).alias("lo"),
        F.greatest(F.max(actual), F.max("prediction")).alias("hi"),
    )


def error_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """Rows per equal-width bin of ``error``; the largest value belongs to the last bin."""
    span = df.agg(F.struct(F.min("error").alias("lo"), F.max("error").alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    position = F.floor(ratio(F.col("error") - lo, hi - lo) * bins)
    bin_no = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return df.filter(F.col("error").isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count("*").alias("rows"))


def round_step(lo: Column, hi: Column, bins: int) -> Column:
    """The smallest of 1, 2 and 5 times a power of ten whose multiples part lo..hi into at most ``bins`` bins; 1 without spread."""
    power = F.floor(F.log10((hi - lo) / bins)).cast("double")
    steps = [F.lit(m) * F.pow(F.lit(10.0), power + e) for e in (0, 1) for m in (1.0, 2.0, 5.0)]
    fits = [F.when(F.floor(hi / step) - F.floor(lo / step) < bins, step) for step in steps]
    return F.when(hi > lo, F.coalesce(*fits)).otherwise(F.lit(1.0))


def error_histogram_rounded(df: DataFrame, bins: int = 30) -> DataFrame:
    """Rows per bin of ``error`` with round edges: bin k holds k * step <= error < (k + 1) * step.

    At most ``bins`` bins; empty ones have no row. Returns bin, step, lo (the
    lower edge) and rows. Rows without an error are left out.
    """
    span = df.agg(F.struct(F.min("error").alias("lo"), F.max("error").alias("hi"))).scalar()
    step = round_step(span["lo"], span["hi"], bins)
    cut = df.filter(F.col("error").isNotNull()).withColumn("step", step)
    counted = cut.groupBy(F.floor(F.col("error") / F.col("step")).alias("bin"), "step").agg(F.count("*").alias("rows"))
    return counted.select("bin", "step", (F.col("bin") * F.col("step")).alias("lo"), "rows")


def daily_actual_and_predicted(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.to_date("ts").alias("date"))
        .agg(F.sum("demand").alias("demand"), F.sum("prediction").alias("prediction"))
        .orderBy("date")
    )

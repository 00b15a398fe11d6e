"""Demand forecasts with Spark ML, and the baselines they are measured against."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from hailgrid.functions.clock import is_weekend
from hailgrid.functions.geo import zone_x, zone_y
from hailgrid.functions.number import non_negative
from hailgrid.operators.accuracy import compare_models, metric_gain
from hailgrid.operators.filters import hash_split
from hailgrid.operators.zone_hours import FEATURES
from hailgrid.params import ZONE_STRIDE
from hailgrid.sources.tables import shared_folder

# Names of the rows of the metrics table.
MODEL = "gbt_model"
SLOT_MEAN = "baseline_zone_hour_dow_mean"
LAST_WEEK = "baseline_same_slot_last_week"
BASELINES = {SLOT_MEAN: "hist_mean", LAST_WEEK: "lag_168"}


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 60
    depth: int = 6
    step: float = 0.1
    subsample: float = 0.8
    seed: int = 42
    #: Trees between two reliable checkpoints of the residuals and of each row's node.
    checkpoint_interval: int = 10


def fitted_forest(slots: DataFrame, trees: int = 50, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """A random forest of slot totals by hour and weekday, and the slots held out from it."""
    assembler = VectorAssembler(inputCols=["pickup_hour", "day_of_week"], outputCol="features")
    forest = RandomForestRegressor(featuresCol="features", labelCol="total_trips", numTrees=trees, seed=seed)
    train, test = hash_split(slots, ["pickup_hour", "day_of_week"], 0.8, seed)
    return Pipeline(stages=[assembler, forest]).fit(train), test


def slot_forecast(slots: DataFrame, trees: int = 50, seed: int = 42) -> DataFrame:
    """Random-forest forecast of slot totals from hour and weekday, for the held-out slots.

    Fitting reads its input several times, so pass a stored slot table and not
    a plan over the trips.
    """
    model, test = fitted_forest(slots, trees, seed)
    return model.transform(test).select("pickup_hour", "day_of_week", "total_trips", "prediction")


def train_boosted(train: DataFrame, boost: BoostParams = BoostParams()) -> PipelineModel:
    """Fit the boosted trees. A null feature stops the fit: train on at least one full week.

    Every tree builds on the residuals of those before it. They, and the node
    that each row has reached, are checkpointed to the shared folder, so a lost
    executor costs the trees since the last checkpoint and not the whole fit.
    """
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(train.sparkSession, "fit"))
    trees = GBTRegressor(
        featuresCol="features",
        labelCol="demand",
        maxIter=boost.rounds,
        maxDepth=boost.depth,
        stepSize=boost.step,
        subsamplingRate=boost.subsample,
        seed=boost.seed,
        cacheNodeIds=True,
        checkpointInterval=boost.checkpoint_interval,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), trees]).fit(train)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Score rows; demand cannot be negative, so neither can a prediction."""
    return model.transform(rows).withColumn("prediction", non_negative(F.col("prediction")))


def held_out_predictions(model: PipelineModel, test: DataFrame) -> DataFrame:
    return predict(model, test).select("zone_id", "ts", "demand", "prediction", "hist_mean", "lag_168")


def model_metrics(predictions: DataFrame) -> DataFrame:
    return compare_models(predictions, "demand", {MODEL: "prediction", **BASELINES})


def model_gains(metrics: DataFrame) -> DataFrame:
    """Relative MAE improvement of the model over each baseline."""
    gains = [metric_gain(metrics, MODEL, name).select(F.lit(name).alias("baseline"), "model_mae", "baseline_mae", "gain") for name in BASELINES]
    return reduce(DataFrame.unionByName, gains)


def leaf_bounds(trees) -> tuple[float, float]:
    """Least and largest value a boosted model can predict: the weighted sums of its trees' least and largest leaves."""
    leaves = [[float(x) for x in re.findall(r"Predict: (\S+)", tree.toDebugString)] for tree in trees.trees]
    weights = list(trees.treeWeights)
    ends = [sorted((w * min(own), w * max(own))) for w, own in zip(weights, leaves, strict=True)]
    return sum(lo for lo, _ in ends), sum(hi for _, hi in ends)


def baseline_metrics(test: DataFrame) -> DataFrame:
    return compare_models(test, "demand", BASELINES)


def typical_week(hist: DataFrame, stride: int = ZONE_STRIDE) -> DataFrame:
    """Model input for every zone and weekly slot, with last week taken as typical."""
    return hist.withColumns(
        {
            "is_weekend": is_weekend(F.col("dow")),
            "zone_x": zone_x(F.col("zone_id"), stride),
            "zone_y": zone_y(F.col("zone_id"), stride),
            "lag_168": F.col("hist_mean"),
        }
    )


def predict_grid(model: PipelineModel, hist: DataFrame, stride: int = ZONE_STRIDE) -> DataFrame:
    return predict(model, typical_week(hist, stride)).select(
        "zone_id",
        "dow",
        "hour",
        F.round("hist_mean", 2).alias("hist_mean"),
        F.round("prediction", 2).alias("prediction"),
    )

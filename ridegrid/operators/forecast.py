"""Demand model: gradient-boosted trees on lag and calendar features.

Trained with Spark ML on the hour x location series (a table whose size is
bounded by the calendar and the zone count, not by the trip volume).  The
split is by time: rows before ``split_at`` train, rows from ``split_at`` on
are predicted.  A row's features are the calendar and the last value known for
its hour of the day and of the week: of a predicted hour, the last before
``split_at``; so no prediction depends on what happened from ``split_at`` on.
"""
from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_seconds
from .features import DEFAULT_PERIODS, calendar_features

#: Hours after which a value is expected again: a day, a week.
CYCLES = (24, 168)
FEATURES = ([f"known_{k}" for k in CYCLES] + ["hour_of_day", "day_of_week"]
            + [f"{f}_{p}" for p in DEFAULT_PERIODS for f in ("cos", "sin")])


def feature_table(series: DataFrame, cut) -> DataFrame:
    """The series with its features; values from ``cut`` on are never used as features."""
    at, last = epoch_seconds("pickup_hour"), epoch_seconds(cut)
    known = (series.where(F.col("pickup_hour") < cut)
             .groupBy("pickup_location_id", at.alias("_at")).agg(F.max("rides").alias("_rides")))
    feats = calendar_features(series)
    for k in CYCLES:
        back = F.greatest(F.lit(0), F.floor((at - last) / (3600 * k))) + 1  # cycles to the last known one
        value = known.withColumnsRenamed({"_at": f"_at_{k}", "_rides": f"known_{k}"})
        feats = (feats.withColumn(f"_at_{k}", (at - back * 3600 * k).cast("bigint"))
                 .join(value, ["pickup_location_id", f"_at_{k}"], "left").drop(f"_at_{k}"))
    # Missing values (series start, month gaps) become -1: trees split them off.
    return feats.fillna(-1, subset=[f"known_{k}" for k in CYCLES])


def demand_forecast(series: DataFrame, split_at, max_iter: int = 20, max_depth: int = 5,
                    seed: int = 7) -> DataFrame:
    """Predictions for hours >= ``split_at`` in the served prediction schema."""
    cut = F.lit(split_at).cast("timestamp_ntz")
    feats = feature_table(series, cut)
    train = feats.where(F.col("pickup_hour") < cut)
    test = feats.where(F.col("pickup_hour") >= cut)
    model = Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        GBTRegressor(featuresCol="features", labelCol="rides", maxIter=max_iter,
                     maxDepth=max_depth, seed=seed),
    ]).fit(train.withColumn("rides", F.col("rides").cast("double")))
    scored = model.transform(test)
    return scored.select(
        F.col("pickup_location_id").cast("int").alias("pickup_location_id"),
        F.col("pickup_hour").alias("prediction_datetime"),
        F.greatest(F.lit(0), F.round(F.col("prediction"))).cast("int").alias("predicted_rides"),
    )

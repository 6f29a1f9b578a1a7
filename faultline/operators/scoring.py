"""Scoring new rows at a fixed operating threshold."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.arguments import threshold_value
from faultline.functions.columns import col
from faultline.operators.models import score
from faultline.spec import DatasetSpec


def prediction_columns(probability: Column, threshold: float) -> list[Column]:
    t = threshold_value(threshold)
    return [
        probability.alias("failure_probability"),
        (probability >= F.lit(t)).cast("int").alias("predicted_failure"),
    ]


def predict_scored(df: DataFrame, key: str, threshold: float) -> DataFrame:
    """(key, failure_probability, predicted_failure) from rows that carry a score."""
    return df.select(col(key), *prediction_columns(F.col("probability"), threshold))


def predict(
    model: PipelineModel, df: DataFrame, spec: DatasetSpec, threshold: float
) -> DataFrame:
    """Score feature rows; keeps the key. No refit, no shuffle; batch or streaming.

    Rows without the key column are refused: their predictions would have no identity.
    """
    if spec.key not in df.columns:
        raise ValueError(f"prediction input needs the key column {spec.key}")
    scored = score(model, df)
    return scored.select(
        col(spec.key), *prediction_columns(F.col("probability"), threshold)
    )


def join_predictions(source: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Source rows with their prediction; rows without one keep NULLs."""
    return source.join(predictions, key, "left")

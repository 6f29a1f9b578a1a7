"""The stateless row operators on a stream: score, judge, write."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultline.functions.columns import col, number
from faultline.operators.scoring import predict
from faultline.sources.tables import load_prediction_input
from faultline.spec import DatasetSpec


def read_feature_stream(
    spark: SparkSession, path: str, spec: DatasetSpec, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files with key and features as a stream, under an explicit schema."""
    columns = tuple(dict.fromkeys((spec.key, *spec.features)))
    reader = spark.readStream.schema(spec.schema(columns))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return load_prediction_input(reader.parquet(path), spec)


def score_stream(
    model: PipelineModel, stream: DataFrame, spec: DatasetSpec, threshold: float
) -> DataFrame:
    return predict(model, stream, spec, threshold)


def flag_bad_scores(df: DataFrame, probability: str = "probability") -> DataFrame:
    """Add ``score_fault``: missing, not finite, or outside [0, 1]; row-local."""
    raw = col(probability).cast("double")
    p = number(probability)
    return df.withColumn(
        "score_fault",
        F.when(raw.isNull(), "missing")
        .when(p.isNull() | (F.abs(p) == float("inf")), "not_finite")
        .when((p < 0) | (p > 1), "out_of_range"),
    )


def write_predictions(
    predictions: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append predictions to Parquet exactly once per input row."""
    writer = (
        predictions.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

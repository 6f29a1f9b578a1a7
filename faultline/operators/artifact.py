"""Saving, checking and loading the final model with its metadata."""

from __future__ import annotations

import json
import platform
from datetime import UTC, datetime

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline import __version__
from faultline.operators.checks import (
    ARTIFACT_VERSION,
    FINAL_MODEL,
    FINAL_PROFILE,
    METADATA_FIELDS,
    metadata_audit,
)
from faultline.spec import SEED, DatasetSpec

MODEL_DIR = "model"
METADATA_DIR = "model_metadata"

_TYPES = {
    "operating_threshold": T.DoubleType(),
    "random_seed": T.LongType(),
    "development_row_count": T.LongType(),
    "development_class_distribution": T.MapType(T.StringType(), T.LongType()),
    **{
        f: T.ArrayType(T.StringType())
        for f in (
            "model_features",
            "numerical_features",
            "categorical_features",
            "excluded_identifier_columns",
            "excluded_leakage_columns",
        )
    },
}
METADATA_SCHEMA = T.StructType(
    [T.StructField(f, _TYPES.get(f, T.StringType()), True) for f in METADATA_FIELDS]
)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256) of every data file below a directory, hashed on the executors."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )
    name = F.regexp_extract("path", r"([^/]+/[^/]+/[^/]+)$", 1)
    return files.where(~F.col("path").rlike(r"(\.crc|_SUCCESS)$")).select(
        name.alias("file"), F.sha2("content", 256).alias("sha256")
    )


def artifact_digest(spark: SparkSession, path: str) -> str:
    """One SHA-256 over the sorted file digests of a saved model."""
    lines = F.array_sort(F.collect_list(F.concat_ws(" ", "file", "sha256")))
    row = file_digests(spark, path).agg(
        F.sha2(F.array_join(lines, "\n"), 256).alias("digest"), F.count(F.lit(1)).alias("n")
    ).first()
    if not row["n"]:
        raise ValueError(f"no model files below {path}")
    return row["digest"]


def build_metadata(
    spec: DatasetSpec, threshold: float, class_counts: dict[int, int]
) -> dict:
    """All metadata fields but the checksum."""
    return {
        "artifact_version": ARTIFACT_VERSION,
        "model_name": FINAL_MODEL,
        "operating_profile": FINAL_PROFILE,
        "operating_threshold": float(threshold),
        "target_column": spec.target,
        "model_features": list(spec.features),
        "numerical_features": list(spec.numeric),
        "categorical_features": list(spec.categorical),
        "excluded_identifier_columns": list(spec.identifiers),
        "excluded_leakage_columns": list(spec.leakage),
        "random_seed": SEED,
        "development_row_count": sum(class_counts.values()),
        "development_class_distribution": {str(k): int(n) for k, n in class_counts.items()},
        "training_timestamp_utc": datetime.now(UTC).replace(microsecond=0).isoformat(),
        "python_version": platform.python_version(),
        "spark_version": pyspark.__version__,
        "pyspark_version": pyspark.__version__,
        "project_package_version": __version__,
        "final_evaluation_reference": "see the final evaluation report of the same split",
        "synthetic_dataset_limitation": "fitted on the given table only",
        "intended_use": "batch scoring of failure risk to rank maintenance work",
        "non_intended_use": "autonomous or safety-critical decisions",
        "governance_statement": "fitted on train and validation rows; test rows not used",
        "model_sha256": None,
    }


def metadata_frame(spark: SparkSession, metadata: dict) -> DataFrame:
    unknown = [f for f in METADATA_FIELDS if f not in metadata]
    if unknown:
        raise ValueError(f"metadata is missing the fields {', '.join(unknown)}")
    return spark.createDataFrame(
        [tuple(metadata[f] for f in METADATA_FIELDS)], METADATA_SCHEMA
    )


def require_metadata(spark: SparkSession, metadata: dict, spec: DatasetSpec) -> None:
    broken = [r["violation"] for r in metadata_audit(metadata_frame(spark, metadata), spec).collect()]
    if broken:
        raise ValueError(f"model metadata breaks the rules: {', '.join(broken)}")


def require_pipeline(model, spec: DatasetSpec) -> None:
    """A fitted pipeline of preparation and binary classifier on the contract features."""
    if not isinstance(model, PipelineModel) or len(model.stages) != 2:
        raise ValueError("a pipeline of preparation and classifier is needed")
    prepared, classifier = model.stages
    if not isinstance(prepared, PipelineModel) or not prepared.stages:
        raise ValueError("the first stage must be the preparation")
    if getattr(classifier, "numClasses", 0) != 2:
        raise ValueError("the classifier must be fitted on classes 0 and 1")
    statement = prepared.stages[0].getStatement()
    absent = [f for f in spec.features if f"`{f}`" not in statement]
    if absent:
        raise ValueError(f"the pipeline does not read {', '.join(absent)}")


def save_artifact(
    spark: SparkSession, model: PipelineModel, metadata: dict, path: str, spec: DatasetSpec
) -> dict:
    """Write the model, then its metadata with the checksum; returns the metadata."""
    require_pipeline(model, spec)
    model.write().overwrite().save(f"{path}/{MODEL_DIR}")
    full = {**metadata, "model_sha256": artifact_digest(spark, f"{path}/{MODEL_DIR}")}
    require_metadata(spark, full, spec)
    frame = metadata_frame(spark, full)
    text = frame.select(F.to_json(F.struct("*")).alias("value"))
    text.write.mode("overwrite").text(f"{path}/{METADATA_DIR}")
    return full


def load_artifact(
    spark: SparkSession, path: str, spec: DatasetSpec
) -> tuple[PipelineModel, dict]:
    """Metadata rules first, then the checksum, and only then the model itself."""
    lines = [r["value"] for r in spark.read.text(f"{path}/{METADATA_DIR}").limit(2).collect()]
    if len(lines) != 1:
        raise ValueError(f"one metadata record is expected in {path}/{METADATA_DIR}")
    metadata = json.loads(lines[0])
    require_metadata(spark, metadata, spec)
    if artifact_digest(spark, f"{path}/{MODEL_DIR}") != metadata["model_sha256"]:
        raise ValueError("the saved model does not match its checksum")
    model = PipelineModel.load(f"{path}/{MODEL_DIR}")
    require_pipeline(model, spec)
    return model, metadata

"""Writing reports as strict JSON and CSV, and row-level results as partitioned files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.columns import col, finite


# Column orders of the comparison, threshold, profile, case, importance and
# final evaluation reports.
COMPARISON_COLUMNS = (
    "model", "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision",
    "true_negative", "false_positive", "false_negative", "true_positive", "training_seconds",
)
THRESHOLD_COLUMNS = (
    "threshold", "accuracy", "precision", "recall", "f1", "true_negative", "false_positive",
    "false_negative", "true_positive", "predicted_positive_count", "predicted_positive_rate",
    "total_cost",
)
PROFILE_COLUMNS = (
    "profile", "threshold", "precision", "recall", "f1", "false_positive", "false_negative",
    "predicted_positive_count", "predicted_positive_rate", "illustrative_total_cost",
    "recall_target_met", "precision_target_met",
)
IMPORTANCE_COLUMNS = ("rank", "feature", "importance_mean", "importance_std")
FINAL_COLUMNS = (
    "operating_point", "threshold", "accuracy", "precision", "recall", "f1", "true_negative",
    "false_positive", "false_negative", "true_positive", "predicted_positive_count",
    "predicted_positive_rate", "roc_auc", "average_precision",
)
# Report folder, CSV name, columns, order of rows.
REPORTS = {
    "baseline": ("baseline", "model_comparison", COMPARISON_COLUMNS, ("model",)),
    "model_comparison": ("model_comparison", "model_comparison", COMPARISON_COLUMNS, ("model",)),
    "threshold_metrics": ("threshold_analysis", "threshold_metrics", THRESHOLD_COLUMNS, ("threshold",)),
    "operating_profiles": (
        "recommendations", "business_threshold_recommendation", PROFILE_COLUMNS, ("ord",),
    ),
    "feature_importance": ("explainability", "feature_importance", IMPORTANCE_COLUMNS, ("rank",)),
    "final_evaluation": ("final_evaluation", "final_evaluation", FINAL_COLUMNS, ("operating_point",)),
}


def strict(df: DataFrame) -> DataFrame:
    """Non-finite numbers become NULL, so that neither JSON nor CSV ever shows NaN."""
    return df.select(
        *[
            finite(col(c)).alias(c) if kind in ("double", "float") else col(c)
            for c, kind in df.dtypes
        ]
    )


def _flat(df: DataFrame) -> DataFrame:
    """CSV has no nested values: arrays, maps and structs become JSON text."""
    return df.select(
        *[
            F.to_json(col(c)).alias(c) if kind.startswith(("array", "map", "struct")) else col(c)
            for c, kind in df.dtypes
        ]
    )


def write_report(
    df: DataFrame,
    path: str,
    name: str,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    formats: Sequence[str] = ("json", "csv"),
) -> dict[str, str]:
    """Write one report below ``path``: {format: directory}; column order is kept."""
    out = strict(df)
    if order_by:
        out = out.orderBy(*[col(c) for c in order_by])
    if columns is not None:
        out = out.select(*[col(c) for c in columns])
    paths = {}
    for kind in formats:
        target = f"{path}/{name}_{kind}" if len(formats) > 1 else f"{path}/{name}"
        if kind == "json":
            text = out.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
            text.write.mode("overwrite").text(target)
        elif kind == "csv":
            _flat(out).write.mode("overwrite").option("header", True).csv(target)
        else:
            raise ValueError(f"unknown report format {kind!r}")
        paths[kind] = target
    return paths


def write_reports(
    reports: Mapping[str, DataFrame], path: str, **options
) -> dict[str, dict[str, str]]:
    return {name: write_report(df, path, name, **options) for name, df in reports.items()}


def write_workflow(results: Mapping[str, DataFrame], path: str) -> dict[str, dict[str, str]]:
    """Write all tables of a workflow; known reports get their folder, name and columns.

    Error cases are row-level: they are partitioned by selection and outcome and not
    brought into one order.
    """
    paths = {}
    for name, df in results.items():
        if name == "error_cases":
            target = f"{path}/error_analysis/error_cases"
            paths[name] = {"csv": write_rows(df, target, ("selection", "outcome"), "csv")}
        elif name in REPORTS:
            folder, stem, columns, order = REPORTS[name]
            paths[name] = write_report(df, f"{path}/{folder}", stem, columns, order)
        else:
            paths[name] = write_report(df, path, name)
    return paths


def write_predictions_csv(predictions: DataFrame, key: str, path: str) -> str:
    """Predictions with the key as ``input_index``, in as many files as there are tasks."""
    wanted = [key, "failure_probability", "predicted_failure"]
    if predictions.columns != wanted:
        raise ValueError(f"predictions must have the columns {', '.join(wanted)}")
    return write_rows(predictions.withColumnRenamed(key, "input_index"), path, kind="csv")


def write_rows(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), kind: str = "parquet"
) -> str:
    """Row-level results (error cases, predictions) in as many files as there are tasks."""
    writer = strict(df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)
    return path

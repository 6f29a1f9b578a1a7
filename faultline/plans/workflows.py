"""The analyses from table to report. Validation steps never read test rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faultline.functions.arguments import at_least_one, cost_pair, rate, threshold_list
from faultline.functions.columns import beside, col, number
from faultline.operators import errors, models, thresholds
from faultline.operators.artifact import build_metadata, load_artifact, save_artifact
from faultline.operators.checks import require_scored, require_structure, split_integrity
from faultline.operators.folds import FOLDS, fold_counts, stratified_folds
from faultline.operators.importance import REPEATS, permutation_importance, rank_importance
from faultline.operators.metrics import evaluate_models, fixed_threshold_metrics, ranking_metrics
from faultline.operators.models import BOOSTING, COMPARISON_MODELS
from faultline.operators.scoring import predict
from faultline.operators.splits import (
    development_set,
    split_class_counts,
    split_counts,
    stratified_split,
)
from faultline.functions.settle import settle
from faultline.plans.sinks import COMPARISON_COLUMNS
from faultline.sources.tables import load_prediction_input
from faultline.spec import (
    FALSE_NEGATIVE_COST,
    FALSE_POSITIVE_COST,
    MINIMUM_RECALL,
    PROFILE_MINIMUM_PRECISION,
    PROFILE_MINIMUM_RECALL,
    DatasetSpec,
)

Models = Mapping[str, Callable[[float], Estimator]]


def part(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


def prepare_table(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Checked table with its ``split`` column."""
    require_structure(df, spec)
    return stratified_split(df, spec.key, spec.target)


@dataclass(frozen=True)
class Validation:
    """One model fitted on train rows and its scored validation rows."""

    model: PipelineModel
    table: DataFrame
    scored: DataFrame


def score_validation(
    df: DataFrame, spec: DatasetSpec, model_name: str = BOOSTING, available: Models = COMPARISON_MODELS
) -> Validation:
    """Fit once, score once; threshold, error and profile reports share the result."""
    models.require_model(model_name, available)
    table = prepare_table(df, spec)
    model = models.fit_model(model_name, part(table, "train"), spec, available)
    validation = part(table, "validation")
    keep = list(dict.fromkeys((spec.key, *spec.features)))
    scored = models.score(model, validation).select(
        *[col(c) for c in keep],
        number(spec.target).cast("int").alias("label"),
        "probability",
    )
    scored = settle(scored)
    require_scored(scored)
    return Validation(model, table, scored)


def model_comparison(
    df: DataFrame, spec: DatasetSpec, available: Models = COMPARISON_MODELS
) -> DataFrame:
    """Fit all models on train, judge them on validation; one row per model."""
    return comparison_run(df, spec, available)["model_comparison"]


def comparison_run(
    df: DataFrame, spec: DatasetSpec, available: Models = COMPARISON_MODELS
) -> dict[str, DataFrame]:
    """model_comparison, best_model, split_counts and class_counts of one run."""
    table = prepare_table(df, spec)
    fitted = models.fit_models(part(table, "train"), spec, available)
    scored = settle(models.score_models(fitted, part(table, "validation"), spec))
    seconds = df.sparkSession.createDataFrame(
        [(name, took) for name, (_, took) in fitted.items()],
        "model string, training_seconds double",
    )
    compared = beside([evaluate_models(scored, "model"), seconds], ["model"]).select(
        *COMPARISON_COLUMNS
    )
    return {
        "model_comparison": compared,
        "best_model": models.best_model(compared),
        "split_counts": split_counts(table),
        "class_counts": split_class_counts(table, spec.target),
    }


def out_of_fold_scores(
    df: DataFrame, spec: DatasetSpec, available: Models = COMPARISON_MODELS, folds: int = FOLDS
) -> DataFrame:
    """(model, key, fold, label, probability): every row once per model, by a fit without its fold.

    A fold is a filter on a row-local expression, so no fit shuffles rows to leave others out.
    """
    require_structure(df, spec)
    table = stratified_folds(df, spec.key, spec.target, folds=folds)
    scored = []
    for fold in range(folds):
        fitted = models.fit_models(table.where(F.col("fold") != fold), spec, available)
        held_out = table.where(F.col("fold") == fold)
        scored.append(models.score_models(fitted, held_out, spec).withColumn("fold", F.lit(fold)))
    together = reduce(DataFrame.unionByName, scored)
    return together.select("model", col(spec.key), "fold", "label", "probability")


def cross_validation(
    df: DataFrame, spec: DatasetSpec, available: Models = COMPARISON_MODELS, folds: int = FOLDS
) -> dict[str, DataFrame]:
    """Metrics per model and fold, their mean and spread per model, and the folds' sizes.

    All folds of all models are judged in one grouped job. The standard deviation over folds is
    the population one.
    """
    scored = settle(out_of_fold_scores(df, spec, available, folds))
    each = evaluate_models(scored, ("model", "fold"))
    measured = ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")
    return {
        "cross_validation": each,
        "cross_validation_summary": each.groupBy("model").agg(
            F.count(F.lit(1)).alias("folds"),
            *[f(m).alias(f"{m}_{name}") for m in measured for name, f in (("mean", F.avg), ("std", F.stddev_pop))],
        ),
        "fold_counts": fold_counts(stratified_folds(df, spec.key, spec.target, folds=folds), spec.target),
    }


def baseline_training(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return model_comparison(df, spec, models.BASELINE_MODELS)


def threshold_analysis(
    df: DataFrame,
    spec: DatasetSpec,
    model_name: str = BOOSTING,
    minimum_recall: float = MINIMUM_RECALL,
    false_negative_cost: float = FALSE_NEGATIVE_COST,
    false_positive_cost: float = FALSE_POSITIVE_COST,
    available: Models = COMPARISON_MODELS,
) -> dict[str, DataFrame]:
    """threshold_metrics and selected_thresholds of the validation rows."""
    rate(minimum_recall, "minimum_recall")
    cost_pair(false_negative_cost, false_positive_cost)
    validation = score_validation(df, spec, model_name, available)
    return _threshold_reports(
        validation, minimum_recall, false_negative_cost, false_positive_cost
    )


def _threshold_reports(
    validation: Validation,
    minimum_recall: float,
    false_negative_cost: float,
    false_positive_cost: float,
) -> dict[str, DataFrame]:
    rows = thresholds.costed_sweep(
        validation.scored,
        false_negative_cost=false_negative_cost,
        false_positive_cost=false_positive_cost,
    )
    return {
        "threshold_metrics": rows,
        "selected_thresholds": thresholds.selected_thresholds(rows, minimum_recall),
    }


def recommend_profiles(
    df: DataFrame,
    spec: DatasetSpec,
    model_name: str = BOOSTING,
    minimum_recall: float = PROFILE_MINIMUM_RECALL,
    minimum_precision: float = PROFILE_MINIMUM_PRECISION,
    false_negative_cost: float = FALSE_NEGATIVE_COST,
    false_positive_cost: float = FALSE_POSITIVE_COST,
    available: Models = COMPARISON_MODELS,
) -> dict[str, DataFrame]:
    """operating_profiles and shared_thresholds; arguments are checked before the fit."""
    rate(minimum_recall, "minimum_recall")
    rate(minimum_precision, "minimum_precision")
    cost_pair(false_negative_cost, false_positive_cost)
    validation = score_validation(df, spec, model_name, available)
    return _profile_reports(
        validation, minimum_recall, minimum_precision, false_negative_cost, false_positive_cost
    )


def _profile_reports(
    validation: Validation,
    minimum_recall: float = PROFILE_MINIMUM_RECALL,
    minimum_precision: float = PROFILE_MINIMUM_PRECISION,
    false_negative_cost: float = FALSE_NEGATIVE_COST,
    false_positive_cost: float = FALSE_POSITIVE_COST,
) -> dict[str, DataFrame]:
    analysis = _threshold_reports(validation, 0.0, false_negative_cost, false_positive_cost)
    profiles = thresholds.operating_profiles(
        analysis["threshold_metrics"], minimum_recall, minimum_precision
    )
    return {
        "operating_profiles": profiles,
        "shared_thresholds": thresholds.shared_thresholds(profiles),
        **analysis,
    }


def study_thresholds(
    scored: DataFrame, wanted: Sequence[float] | None = None
) -> dict[str, float]:
    """Named thresholds to study: the given ones, or the four selections."""
    if wanted is not None:
        return {f"threshold_{t!r}".replace(".", "_"): t for t in threshold_list(wanted)}
    picked = thresholds.selected_thresholds(thresholds.costed_sweep(scored))
    found = {r["selection"]: r["threshold"] for r in picked.collect()}  # four rows
    names = ("default_0_5", "best_f1", "minimum_recall", "lowest_cost")
    absent = [n for n in names if n not in found]
    if absent:
        raise ValueError(f"no threshold qualifies for {', '.join(absent)}")
    return {n: found[n] for n in names}


def error_analysis(
    df: DataFrame,
    spec: DatasetSpec,
    model_name: str = BOOSTING,
    wanted: Sequence[float] | None = None,
    top_n: int = 10,
    available: Models = COMPARISON_MODELS,
) -> dict[str, DataFrame]:
    """All error reports of the validation rows, from one scored frame."""
    at_least_one(top_n, "top_n")
    if wanted is not None:
        threshold_list(wanted)
    validation = score_validation(df, spec, model_name, available)
    scored = validation.scored
    reports = error_reports(scored, spec, study_thresholds(scored, wanted), top_n)
    return reports | {"split_counts": split_counts(validation.table)}


def error_reports(
    scored: DataFrame, spec: DatasetSpec, studied: Mapping[str, float], top_n: int = 10
) -> dict[str, DataFrame]:
    """Error reports of scored rows (key, features, label, probability)."""
    spark = scored.sparkSession
    primary = "best_f1" if "best_f1" in studied else next(iter(studied))
    judged = errors.classify_outcomes(scored, studied[primary])
    names = spark.createDataFrame(list(studied.items()), "selection string, threshold double")
    rows = thresholds.costed_sweep(scored, list(studied.values()))
    summary = errors.threshold_error_summary(rows)
    per_threshold = names.join(summary, "threshold")

    # Every studied threshold is one copy of the rows, named by its selection.
    steps = F.array(
        *[
            F.struct(F.lit(n).alias("selection"), F.lit(t).alias("_threshold"))
            for n, t in studied.items()
        ]
    )
    copies = scored.select("*", F.inline(steps))
    predicted = (F.col("probability") >= F.col("_threshold")).cast("int")
    each = copies.withColumn("outcome", errors.outcome_of(F.col("label"), predicted))
    out = {
        "studied_thresholds": names.withColumn("primary", F.col("selection") == primary),
        "threshold_error_summary": per_threshold,
        "outcome_summary": errors.outcome_summary(each, "selection"),
        "numeric_by_outcome": errors.numeric_by_outcome(each, spec.numeric, "selection"),
        "category_by_outcome": errors.category_by_outcome(each, spec.categorical, "selection"),
        "error_cases": errors.error_cases(scored, studied, (spec.key, *spec.features)),
    }
    for error in errors.CORRECT_OUTCOME:
        out[f"{error}_summary"] = errors.error_focus(judged, spec.numeric, spec.categorical, error)
        out[f"{error}_mean_differences"] = errors.mean_differences(judged, spec.numeric, error)
        out[f"top_{error}s"] = errors.top_errors(judged, spec.key, error, top_n)
    return out


def explain(
    df: DataFrame,
    spec: DatasetSpec,
    model_name: str = BOOSTING,
    repeats: int = REPEATS,
    available: Models = COMPARISON_MODELS,
) -> dict[str, DataFrame]:
    """Baseline metrics and ranked permutation importance on the validation rows."""
    at_least_one(repeats, "repeats")
    validation = score_validation(df, spec, model_name, available)
    importance = permutation_importance(
        validation.scored.drop("probability"),
        spec.key,
        spec.features,
        lambda rows: models.score(validation.model, rows),
        repeats,
    )
    return {
        "baseline": ranking_metrics(validation.scored),
        "feature_importance": rank_importance(importance),
    }


def balanced_threshold(profiles: DataFrame) -> float:
    rows = profiles.where(F.col("profile") == "balanced").select("threshold").take(2)
    if len(rows) != 1:
        raise ValueError("one balanced profile is expected")
    return rows[0]["threshold"]


def _development(table: DataFrame, spec: DatasetSpec) -> DataFrame:
    if not split_integrity(table, spec.key).isEmpty():
        raise ValueError(f"{spec.key} does not identify rows; the split is not sound")
    return development_set(table)


def final_evaluation_rows(scored: DataFrame, threshold: float) -> DataFrame:
    """The metrics at 0.5 and at the chosen threshold beside AUC and AP, two rows."""
    ranking = ranking_metrics(scored).select(F.struct("*").alias("r")).scalar()
    rows = [
        fixed_threshold_metrics(scored, t).withColumn("operating_point", F.lit(name))
        for name, t in (("default_0_5", 0.5), ("selected_balanced_threshold", threshold))
    ]
    return rows[0].unionByName(rows[1]).withColumn("_r", ranking).select(
        "operating_point",
        "threshold",
        "accuracy",
        "precision",
        "recall",
        "f1",
        "true_negative",
        "false_positive",
        "false_negative",
        "true_positive",
        "predicted_positive_count",
        "predicted_positive_rate",
        F.col("_r.roc_auc").alias("roc_auc"),
        F.col("_r.average_precision").alias("average_precision"),
    )


def final_evaluation(
    df: DataFrame, spec: DatasetSpec, model_name: str = BOOSTING, available: Models = COMPARISON_MODELS
) -> dict[str, DataFrame]:
    """Freeze the threshold on validation, refit on development, score test once."""
    # One split serves the threshold, the second fit and the test rows.
    validation = score_validation(df, spec, model_name, available)
    table = validation.table
    threshold = balanced_threshold(_profile_reports(validation)["operating_profiles"])
    development = _development(table, spec)
    model = models.fit_model(model_name, development, spec, available)
    scored = settle(
        models.score(model, part(table, "test")).select(
            col(spec.key), number(spec.target).cast("int").alias("label"), "probability"
        )
    )
    require_scored(scored)
    return {
        "final_evaluation": final_evaluation_rows(scored, threshold),
        "class_counts": split_class_counts(table, spec.target),
    }


def build_artifact(
    df: DataFrame, spec: DatasetSpec, path: str, available: Models = COMPARISON_MODELS
) -> dict:
    """Fit the final model on development rows and save it; returns its metadata."""
    validation = score_validation(df, spec, BOOSTING, available)
    threshold = balanced_threshold(_profile_reports(validation)["operating_profiles"])
    development = _development(validation.table, spec)
    counts = {
        int(r["_y"]): r["count"]
        for r in development.groupBy(number(spec.target).alias("_y")).count().collect()
    }
    model = models.fit_model(BOOSTING, development, spec, available)
    return save_artifact(df.sparkSession, model, build_metadata(spec, threshold, counts), path, spec)


def batch_prediction(
    spark: SparkSession,
    data: DataFrame | str,
    artifact_path: str,
    spec: DatasetSpec,
    output: str | None = None,
) -> tuple[DataFrame, dict]:
    """Score new rows with a saved artifact: (predictions, report).

    With ``output`` the rows are written to Parquet and counted on the way, so they are
    read once; without it they are settled, then counted and checked, so they are scored once.
    """
    rows = load_prediction_input(data, spec, spark)
    model, metadata = load_artifact(spark, artifact_path, spec)
    predictions = predict(model, rows, spec, metadata["operating_threshold"])
    report = {
        "model_name": metadata["model_name"],
        "artifact_version": metadata["artifact_version"],
        "operating_threshold": metadata["operating_threshold"],
        "prediction_count": None,
    }
    if output is not None:
        seen = Observation("predictions")
        counted = predictions.observe(
            seen,
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.expr("NOT (failure_probability BETWEEN 0 AND 1)")).alias("bad"),
        )
        counted.write.mode("overwrite").parquet(output)
        if seen.get["bad"]:
            raise ValueError(f"{seen.get['bad']} probabilities lie outside [0, 1]")
        report["prediction_count"] = seen.get["n"]
        predictions = spark.read.parquet(output)
    else:
        predictions = settle(predictions)
        seen = predictions.agg(
            F.count(F.lit(1)),
            F.count_if(F.expr("NOT coalesce(failure_probability BETWEEN 0 AND 1, false)")),
        ).first()
        if seen[1]:
            raise ValueError(f"{seen[1]} probabilities lie outside [0, 1]")
        report["prediction_count"] = seen[0]
    return predictions, report

"""Structure, label, probability, split, threshold-row and metadata checks.

Checks of names look at metadata only. Checks of rows are aggregates or row filters that
return violations as rows; the ``require_*`` functions raise instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline import __version__
from faultline.functions.columns import col, count_where, names_of, number, ratio
from faultline.spec import SEED, DatasetSpec


def repeated_names(names: Sequence[str]) -> list[str]:
    """Names that occur more than once, each reported at its first repeat."""
    seen: set[str] = set()
    out: dict[str, None] = {}
    for name in names:
        if name in seen:
            out[name] = None
        seen.add(name)
    return list(out)


def require_unique_columns(df: DataFrame) -> None:
    repeats = repeated_names(df.columns)
    if repeats:
        raise ValueError(f"duplicate columns: {', '.join(repeats)}")


def require_columns(df: DataFrame, spec: DatasetSpec) -> None:
    present = set(df.columns)
    missing = [c for c in spec.required if c not in present]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def require_rows(df: DataFrame) -> None:
    if not df.columns:
        raise ValueError("the table has no columns")
    if df.isEmpty():
        raise ValueError("the table has no rows")


def require_structure(df: DataFrame, spec: DatasetSpec) -> None:
    """Not empty, then no duplicate names, then no missing names."""
    require_rows(df)
    require_unique_columns(df)
    require_columns(df, spec)


def require_feature_order(columns: Sequence[str], spec: DatasetSpec) -> None:
    """Exactly the feature columns in contract order."""
    missing = [c for c in spec.features if c not in columns]
    if missing:
        raise ValueError(f"missing feature columns: {', '.join(missing)}")
    extra = [c for c in columns if c not in spec.features]
    if extra:
        raise ValueError(f"unexpected columns: {', '.join(extra)}")
    if tuple(columns) != spec.features:
        raise ValueError(f"feature columns must be in the order {', '.join(spec.features)}")


def feature_projection(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Key, features and target; identifiers and leakage columns never pass."""
    return df.select(*[col(c) for c in dict.fromkeys((spec.key, *spec.features, spec.target))])


def target_check(df: DataFrame, target: str, least_rows: int = 3) -> DataFrame:
    """(label, count, violation) for the labels 0, 1, other and <NA>; one pass."""
    y = number(target)
    counts = {
        "0": count_where(y == 0),
        "1": count_where(y == 1),
        "other": count_where(y.isNotNull() & ~y.isin(0.0, 1.0)),
        "<NA>": count_where(y.isNull()),
    }
    one = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts.values())])
    cells = [
        F.struct(F.lit(k).alias("label"), F.col(f"_{i}").alias("count"))
        for i, k in enumerate(counts)
    ]
    n = F.col("count")
    return one.select(F.inline(F.array(*cells))).withColumn(
        "violation",
        F.when((F.col("label") == "other") & (n > 0), "not_binary")
        .when((F.col("label") == "<NA>") & (n > 0), "missing_label")
        .when(F.col("label").isin("0", "1") & (n == 0), "absent_class")
        .when(F.col("label").isin("0", "1") & (n < least_rows), "too_few_rows"),
    )


def require_stratifiable(df: DataFrame, target: str, least_rows: int = 3) -> int:
    """Raise unless both classes are there with enough rows; returns the row count."""
    checked = target_check(df, target, least_rows).collect()
    bad = [r for r in checked if r["violation"]]
    if bad:
        found = "; ".join(f"{r['label']}: {r['violation']} ({r['count']})" for r in bad)
        raise ValueError(f"target cannot be stratified: {found}")
    return sum(r["count"] for r in checked)


def score_check(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    group_by: str | Sequence[str] = (),
) -> DataFrame:
    """Label and probability faults per group, counted in one pass."""
    y = number(label)
    p = col(probability).cast("double")
    unusable = p.isNull() | F.isnan(p) | (F.abs(p) == float("inf"))
    out = df.groupBy(*[col(g) for g in names_of(group_by)]).agg(
        F.count(F.lit(1)).alias("row_count"),
        count_where(y.isNull()).alias("missing_labels"),
        count_where(y.isNotNull() & ~y.isin(0.0, 1.0)).alias("other_labels"),
        count_where(y == 0).alias("negatives"),
        count_where(y == 1).alias("positives"),
        count_where(unusable).alias("unusable_probabilities"),
        count_where(~unusable & ((p < 0) | (p > 1))).alias("probabilities_out_of_range"),
    )
    return out.withColumn(
        "valid",
        F.expr(
            "missing_labels + other_labels + unusable_probabilities"
            " + probabilities_out_of_range = 0 AND negatives > 0 AND positives > 0"
        ),
    )


def require_scored(
    df: DataFrame, label: str = "label", probability: str = "probability"
) -> None:
    row = score_check(df, label, probability).first()
    if not row["valid"]:
        raise ValueError(f"scored rows are not usable: {row.asDict()}")


def split_integrity(df: DataFrame, key: str | Sequence[str], split: str = "split") -> DataFrame:
    """Keys that repeat or lie in more than one part; no rows means a sound split."""
    keys = [col(k) for k in names_of(key)]
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(col(split)).alias("_first"),
            F.max(col(split)).alias("_last"),
        )
        .where("copies > 1")
        .withColumn(
            "violation",
            F.when(F.col("_first") != F.col("_last"), "in_several_parts").otherwise(
                "repeated_key"
            ),
        )
        .drop("_first", "_last")
    )


def alignment_check(features: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """How many keys are matched, on one side only, or repeated; one shuffle, no join."""
    sides = features.select(col(key), F.lit(1).alias("_f"), F.lit(0).alias("_s")).unionAll(
        scores.select(col(key), F.lit(0).alias("_f"), F.lit(1).alias("_s"))
    )
    per_key = sides.groupBy(col(key)).agg(F.sum("_f").alias("_f"), F.sum("_s").alias("_s"))
    return per_key.agg(
        F.count_if(F.expr("_f > 0 AND _s > 0")).alias("matched"),
        F.count_if(F.expr("_s = 0")).alias("features_only"),
        F.count_if(F.expr("_f = 0")).alias("scores_only"),
        F.count_if(F.expr("_f > 1 OR _s > 1")).alias("repeated"),
    )


def _close(a: Column, b: Column) -> Column:
    """Fixed tolerances: 1e-8 absolute plus 1e-5 relative."""
    return F.coalesce(F.abs(a - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b), F.lit(False))


def _violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule; a rule that cannot be evaluated counts as broken."""
    broken = [
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()
    ]
    return df.withColumn("violation", F.explode(F.array_compact(F.array(*broken))))


def threshold_audit(rows: DataFrame, group_by: str | Sequence[str] = ()) -> DataFrame:
    """Threshold rows that contradict themselves or the other rows of their group."""
    groups = names_of(group_by)
    tn, fp, fn, tp = (
        col(c)
        for c in ("true_negative", "false_positive", "false_negative", "true_positive")
    )
    flagged = col("predicted_positive_count")
    counts = (tn, fp, fn, tp, flagged)
    total, positives, negatives = tn + fp + fn + tp, fn + tp, tn + fp
    rates = [
        col(c) for c in ("threshold", "precision", "recall", "f1", "predicted_positive_rate")
    ]

    def all_of(parts):
        out = F.lit(True)
        for part in parts:
            out = out & F.coalesce(part, F.lit(False))
        return out

    rules = {
        "rate_outside_0_1": all_of((r >= 0) & (r <= 1) for r in rates),
        "bad_cost": (col("total_cost") >= 0) & (col("total_cost") < float("inf")),
        "bad_count": all_of((c >= 0) & (c == F.floor(c)) for c in counts),
        "no_rows": total > 0,
        "flagged_mismatch": flagged == fp + tp,
        "flagged_rate_mismatch": _close(col("predicted_positive_rate"), ratio(flagged, total)),
        "precision_mismatch": _close(col("precision"), ratio(tp, fp + tp)),
        "recall_mismatch": _close(col("recall"), ratio(tp, positives)),
        "f1_mismatch": _close(col("f1"), ratio(2 * tp, 2 * tp + fp + fn)),
        "repeated_threshold": F.col("_copies") == 1,
        "totals_differ": (F.col("_p_min") == F.col("_p_max"))
        & (F.col("_n_min") == F.col("_n_max")),
    }
    # Window on a group of threshold rows: as many rows as there are thresholds.
    whole = Window.partitionBy(*[col(g) for g in groups])
    same = Window.partitionBy(*[col(g) for g in groups], col("threshold"))
    checked = rows.select(
        "*",
        F.count(F.lit(1)).over(same).alias("_copies"),
        F.min(positives).over(whole).alias("_p_min"),
        F.max(positives).over(whole).alias("_p_max"),
        F.min(negatives).over(whole).alias("_n_min"),
        F.max(negatives).over(whole).alias("_n_max"),
    )
    return _violations(checked, rules).select(
        *[col(g) for g in groups], "threshold", "violation"
    )


# The fields every artifact's metadata must have.
METADATA_FIELDS = (
    "artifact_version",
    "model_name",
    "operating_profile",
    "operating_threshold",
    "target_column",
    "model_features",
    "numerical_features",
    "categorical_features",
    "excluded_identifier_columns",
    "excluded_leakage_columns",
    "random_seed",
    "development_row_count",
    "development_class_distribution",
    "training_timestamp_utc",
    "python_version",
    "spark_version",
    "pyspark_version",
    "project_package_version",
    "final_evaluation_reference",
    "synthetic_dataset_limitation",
    "intended_use",
    "non_intended_use",
    "governance_statement",
    "model_sha256",
)
ARTIFACT_VERSION = "1.0.0"
FINAL_MODEL = "hist_gradient_boosting_balanced"
FINAL_PROFILE = "balanced"


def metadata_audit(registry: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., violation): broken rules of each artifact's metadata row."""
    absent = [f for f in METADATA_FIELDS if f not in registry.columns]
    if absent:
        raise ValueError(f"metadata is missing the fields {', '.join(absent)}")

    def names(values):
        return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")

    distribution = col("development_class_distribution")
    zero, one = distribution["0"], distribution["1"]
    t = col("operating_threshold").cast("double")
    stamp = col("training_timestamp_utc")
    rules = {
        "version_format": col("artifact_version").rlike(r"^\d+\.\d+\.\d+$"),
        "version_unsupported": col("artifact_version") == ARTIFACT_VERSION,
        "model_name": col("model_name") == FINAL_MODEL,
        "operating_profile": col("operating_profile") == FINAL_PROFILE,
        "target_column": col("target_column") == spec.target,
        "model_features": col("model_features") == names(spec.features),
        "numerical_features": col("numerical_features") == names(spec.numeric),
        "categorical_features": col("categorical_features") == names(spec.categorical),
        "identifiers": col("excluded_identifier_columns") == names(spec.identifiers),
        "leakage_columns": col("excluded_leakage_columns") == names(spec.leakage),
        "threshold": (t > 0) & (t < 1),
        "random_seed": col("random_seed") == SEED,
        "row_count": col("development_row_count") > 0,
        "class_names": F.array_sort(F.map_keys(distribution)) == names(("0", "1")),
        "class_counts": (zero >= 0) & (one >= 0),
        "class_sum": zero + one == col("development_row_count"),
        "timestamp": F.try_to_timestamp(stamp).isNotNull()
        & stamp.rlike(r"(\+00:00|Z)$"),
        "versions": F.least(
            *[
                F.length(F.trim(col(c)))
                for c in ("python_version", "spark_version", "pyspark_version")
            ]
        )
        > 0,
        "package_version": col("project_package_version") == __version__,
        "checksum": col("model_sha256").rlike(r"^[0-9a-f]{64}$"),
    }
    return _violations(registry, rules).select(*[col(k) for k in keep], "violation")


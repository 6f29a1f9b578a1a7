"""Costs, threshold selection and operating profiles on threshold rows.

Every choice is one ``max(struct(...))`` per group: the struct lists the wanted order and
its ties, so no sort and no window is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.arguments import cost_pair, rate, threshold_value
from faultline.functions.columns import col, names_of, ratio
from faultline.operators.metrics import threshold_sweep
from faultline.spec import (
    FALSE_NEGATIVE_COST,
    FALSE_POSITIVE_COST,
    MINIMUM_RECALL,
    PROFILE_MINIMUM_PRECISION,
    PROFILE_MINIMUM_RECALL,
    PROFILES,
)


def threshold_costs(
    rows: DataFrame,
    false_negative_cost: float = FALSE_NEGATIVE_COST,
    false_positive_cost: float = FALSE_POSITIVE_COST,
) -> DataFrame:
    fn, fp = cost_pair(false_negative_cost, false_positive_cost)
    return rows.withColumn(
        "total_cost", F.col("false_negative") * F.lit(fn) + F.col("false_positive") * F.lit(fp)
    )


def _best(
    rows: DataFrame,
    order: Sequence[Column],
    groups: list[str],
    where: Column | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """The row of each group with the largest ``order``; NULLs where none qualifies."""
    extra = extra or {}
    picked = [c for c in rows.columns if c not in groups]
    candidate = F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(order)],
        *[col(c) for c in picked],
        *[v.alias(k) for k, v in extra.items()],
    )
    if where is not None:
        candidate = F.when(where, candidate)
    best = rows.groupBy(*[col(g) for g in groups]).agg(F.max(candidate).alias("_best"))
    return best.select(
        *[col(g) for g in groups],
        *[F.col("_best").getField(c).alias(c) for c in [*picked, *extra]],
    )


def best_f1_threshold(rows: DataFrame, group_by: str | Sequence[str] = ()) -> DataFrame:
    """Largest F1, then recall, precision, threshold."""
    order = [F.col(c) for c in ("f1", "recall", "precision", "threshold")]
    return _best(rows, order, names_of(group_by))


def min_recall_threshold(
    rows: DataFrame, minimum_recall: float = MINIMUM_RECALL, group_by: str | Sequence[str] = ()
) -> DataFrame:
    """Largest precision (then F1, recall, threshold) among rows with enough recall.

    ``eligible`` is false, and the rest NULL, for a group in which no row qualifies.
    """
    least = rate(minimum_recall, "minimum_recall")
    order = [F.col(c) for c in ("precision", "f1", "recall", "threshold")]
    out = _best(rows, order, names_of(group_by), F.col("recall") >= F.lit(least))
    return out.withColumn("eligible", F.col("threshold").isNotNull())


def lowest_cost_threshold(rows: DataFrame, group_by: str | Sequence[str] = ()) -> DataFrame:
    """Smallest cost, then largest recall, precision, F1, threshold."""
    if "total_cost" not in rows.columns:
        raise ValueError("threshold rows need total_cost before choosing by cost")
    order = [-F.col("total_cost")] + [
        F.col(c) for c in ("recall", "precision", "f1", "threshold")
    ]
    return _best(rows, order, names_of(group_by))


def find_threshold(rows: DataFrame, threshold: float) -> DataFrame:
    """The rows of one threshold, up to 1e-8."""
    wanted = threshold_value(threshold)
    return rows.where(F.abs(F.col("threshold") - F.lit(wanted)) < 1e-8)


def selected_thresholds(
    rows: DataFrame,
    minimum_recall: float = MINIMUM_RECALL,
    group_by: str | Sequence[str] = (),
) -> DataFrame:
    """(group..., selection, metrics): default_0_5, best_f1, minimum_recall, lowest_cost.

    All four come from one aggregate over the threshold rows.
    """
    groups = names_of(group_by)
    least = rate(minimum_recall, "minimum_recall")
    picked = [c for c in rows.columns if c not in groups]
    row = F.struct(*[col(c) for c in picked])

    def largest(*order: Column) -> Column:
        keyed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], row.alias("_row"))
        return keyed

    f1, recall, precision, t = (F.col(c) for c in ("f1", "recall", "precision", "threshold"))
    choices = {
        "default_0_5": F.when(F.abs(t - F.lit(0.5)) < 1e-8, largest(t)),
        "best_f1": largest(f1, recall, precision, t),
        "minimum_recall": F.when(recall >= F.lit(least), largest(precision, f1, recall, t)),
        "lowest_cost": largest(-F.col("total_cost"), recall, precision, f1, t),
    }
    one = rows.groupBy(*[col(g) for g in groups]).agg(
        *[F.max(c).getField("_row").alias(name) for name, c in choices.items()]
    )
    cells = [
        F.struct(F.lit(name).alias("selection"), F.col(name).alias("_row")) for name in choices
    ]
    return (
        one.select(*[col(g) for g in groups], F.inline(F.array(*cells)))
        .where("_row IS NOT NULL")
        .select(*[col(g) for g in groups], "selection", "_row.*")
    )


def _met_first(met: Column, if_met: Sequence[str], otherwise: Sequence[str]) -> list[Column]:
    """Rows that meet the target win, ranked one way; without any, ranked the other."""
    return [met] + [
        F.when(met, F.col(a)).otherwise(F.col(b)) for a, b in zip(if_met, otherwise, strict=True)
    ]


def profile_high_recall(
    rows: DataFrame,
    minimum_recall: float = PROFILE_MINIMUM_RECALL,
    group_by: str | Sequence[str] = (),
) -> DataFrame:
    met = F.col("recall") >= F.lit(rate(minimum_recall, "minimum_recall"))
    order = _met_first(
        met,
        ("precision", "f1", "recall", "threshold"),
        ("recall", "precision", "f1", "threshold"),
    )
    return _best(rows, order, names_of(group_by), extra={"recall_target_met": met})


def profile_conservative(
    rows: DataFrame,
    minimum_precision: float = PROFILE_MINIMUM_PRECISION,
    group_by: str | Sequence[str] = (),
) -> DataFrame:
    met = F.col("precision") >= F.lit(rate(minimum_precision, "minimum_precision"))
    order = _met_first(
        met,
        ("recall", "f1", "precision", "threshold"),
        ("precision", "recall", "f1", "threshold"),
    )
    return _best(rows, order, names_of(group_by), extra={"precision_target_met": met})


def profile_rates(rows: DataFrame) -> DataFrame:
    """Add false alarms per row and missed failures per actual failure."""
    tn, fp, fn, tp = (
        F.col(c) for c in ("true_negative", "false_positive", "false_negative", "true_positive")
    )
    return rows.withColumns(
        {
            "false_positive_rate_overall": ratio(fp, tn + fp + fn + tp),
            "false_negative_rate_among_actual_positives": ratio(fn, fn + tp),
        }
    )


def operating_profiles(
    rows: DataFrame,
    minimum_recall: float = PROFILE_MINIMUM_RECALL,
    minimum_precision: float = PROFILE_MINIMUM_PRECISION,
    group_by: str | Sequence[str] = (),
) -> DataFrame:
    """(group..., ord, profile, metrics, rates, cost, targets met), three rows a group."""
    groups = names_of(group_by)
    chosen = [
        profile_high_recall(rows, minimum_recall, groups),
        best_f1_threshold(rows, groups),
        profile_conservative(rows, minimum_precision, groups),
    ]
    named = [
        frame.withColumns({"ord": F.lit(i), "profile": F.lit(name)})
        for i, (name, frame) in enumerate(zip(PROFILES, chosen, strict=True), 1)
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    return profile_rates(stacked).select(
        *[col(g) for g in groups],
        "ord",
        "profile",
        "threshold",
        "precision",
        "recall",
        "f1",
        "true_negative",
        "false_positive",
        "false_negative",
        "true_positive",
        "predicted_positive_count",
        "predicted_positive_rate",
        "false_positive_rate_overall",
        "false_negative_rate_among_actual_positives",
        F.col("total_cost").alias("illustrative_total_cost"),
        "recall_target_met",
        "precision_target_met",
    )


def shared_thresholds(profiles: DataFrame, group_by: str | Sequence[str] = ()) -> DataFrame:
    """(group..., threshold, profiles): thresholds chosen by more than one profile."""
    # A group holds the three profiles at most.
    named = F.transform(
        F.array_sort(F.collect_list(F.struct("ord", "profile"))), lambda s: s["profile"]
    )
    return (
        profiles.groupBy(*[col(g) for g in names_of(group_by)], "threshold")
        .agg(F.array_join(named, ",").alias("profiles"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )


def costed_sweep(
    scored: DataFrame,
    thresholds: Sequence[float] | None = None,
    group_by: str | Sequence[str] = (),
    false_negative_cost: float = FALSE_NEGATIVE_COST,
    false_positive_cost: float = FALSE_POSITIVE_COST,
) -> DataFrame:
    """Threshold sweep with costs."""
    cost_pair(false_negative_cost, false_positive_cost)
    return threshold_costs(
        threshold_sweep(scored, thresholds, group_by), false_negative_cost, false_positive_cost
    )

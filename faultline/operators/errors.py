"""Outcomes of scored rows and what sets wrong ones apart from right ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.arguments import at_least_one, threshold_value
from faultline.functions.columns import (
    beside,
    checked_label,
    checked_score,
    col,
    finite,
    level,
    match,
    match_spread,
    names_of,
    number,
    percent,
)
from faultline.functions.ordering import exact_quantiles
from faultline.operators.metrics import at_threshold
from faultline.operators.profile import numeric_summary
from faultline.spec import OUTCOMES

# Fixed pairs: an error outcome and the right outcome of the same actual class.
CORRECT_OUTCOME = {"false_positive": "true_negative", "false_negative": "true_positive"}


# Largest n for which Spark limits a ranked window before its shuffle.
PARTIAL_LIMIT = 1000


def outcome_of(actual: Column, predicted: Column) -> Column:
    return (
        F.when((actual == 0) & (predicted == 0), "true_negative")
        .when((actual == 0) & (predicted == 1), "false_positive")
        .when((actual == 1) & (predicted == 0), "false_negative")
        .when((actual == 1) & (predicted == 1), "true_positive")
    )


def classify_outcomes(
    df: DataFrame, threshold: float, label: str = "label", probability: str = "probability"
) -> DataFrame:
    """Add actual, predicted and outcome; a row-local projection.

    A missing score, one outside 0..1, and a label other than 0 and 1 are errors.
    """
    predicted = at_threshold(threshold, probability)
    actual = checked_label(label)
    return df.withColumns(
        {
            "actual": actual,
            "predicted": predicted,
            "outcome": outcome_of(actual, predicted),
        }
    )


def error_table(features: DataFrame, scores: DataFrame, key: str, threshold: float) -> DataFrame:
    """Features beside outcome by key; keys that do not line up 1:1 are an error.

    The check belongs to the rows of the join: each side counts its keys in the
    partitions that the join needs anyway, so there is no second pass.
    """
    threshold_value(threshold)
    same_key = Window.partitionBy(col(key))
    judged = classify_outcomes(scores, threshold).select(
        col(key), "actual", "predicted", "probability", "outcome"
    )
    left = features.withColumn("_features", F.count(F.lit(1)).over(same_key))
    right = judged.withColumn("_scores", F.count(F.lit(1)).over(same_key))
    joined = left.join(right, key, "full")
    once = (F.col("_features") == 1) & (F.col("_scores") == 1)
    refused = F.raise_error(F.lit(f"features and scores do not line up by {key}"))
    checked = [
        F.when(once, col(c)).otherwise(refused.cast(joined.schema[c].dataType)).alias(c)
        for c in (key, "outcome")
    ]
    kept = [c for c in joined.columns if c not in (key, "outcome", "_features", "_scores")]
    order = [c for c in joined.columns if c not in ("_features", "_scores")]
    return joined.select(*checked, *[col(c) for c in kept]).select(*[col(c) for c in order])


def _every_outcome(df: DataFrame, groups: list[str]) -> DataFrame:
    """(group..., outcome, _rows) for all four outcomes of every group."""
    names = F.array(*[F.lit(o) for o in OUTCOMES])
    return (
        df.groupBy(*[col(g) for g in groups])
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*[col(g) for g in groups], "_rows", F.explode(names).alias("outcome"))
    )


def outcome_summary(df: DataFrame, group_by: str | Sequence[str] = ()) -> DataFrame:
    """(group..., outcome, count, percent, mean_probability, median_probability).

    Outcomes without rows are present with count 0.
    """
    groups = names_of(group_by)
    keys = [*groups, "outcome"]
    counts = df.groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("count"), finite(F.avg("probability")).alias("mean_probability")
    )
    medians = exact_quantiles(
        df, ["probability"], {"median_probability": 0.5}, keys, few_groups=None if groups else True
    ).drop("feature")
    return beside([_every_outcome(df, groups), counts, medians], keys).select(
        *[col(k) for k in keys],
        F.coalesce("count", F.lit(0)).alias("count"),
        percent(F.coalesce("count", F.lit(0)), F.col("_rows"), None).alias("percent"),
        "mean_probability",
        "median_probability",
    )


def numeric_by_outcome(
    df: DataFrame, features: Sequence[str], group_by: str | Sequence[str] = ()
) -> DataFrame:
    """Seven statistics per outcome and feature; empty outcomes present with NULLs."""
    groups = names_of(group_by)
    keys = [*groups, "outcome", "feature"]
    listed = F.array(*[F.lit(f) for f in features])
    every = _every_outcome(df, groups).select(
        *[col(g) for g in groups], "outcome", F.explode(listed).alias("feature")
    )
    summary = numeric_summary(df, features, [*groups, "outcome"], few_groups=None if groups else True)
    return beside([every, summary.drop("count", "missing")], keys)


def category_by_outcome(
    df: DataFrame, categorical: Sequence[str], group_by: str | Sequence[str] = ()
) -> DataFrame:
    """(group..., outcome, column, value, count, percent within the outcome)."""
    groups = names_of(group_by)
    cells = [F.struct(F.lit(c).alias("column"), level(c).alias("value")) for c in categorical]
    keys = [*groups, "outcome", "column"]
    counts = (
        df.select(*[col(g) for g in groups], "outcome", F.inline(F.array(*cells)))
        .groupBy(*[col(k) for k in keys], "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    totals = counts.groupBy(*[col(k) for k in keys]).agg(F.sum("count").alias("_total"))
    if groups:  # a column of many values is a hot key
        joined = match_spread(counts, totals, keys, "value")
    else:  # one total per outcome and listed column
        joined = match(counts, F.broadcast(totals), keys)
    return joined.select(
        *[col(k) for k in keys],
        "value",
        "count",
        percent(F.col("count"), F.col("_total"), None).alias("percent"),
    )


def mean_differences(
    df: DataFrame, features: Sequence[str], error: str, group_by: str | Sequence[str] = ()
) -> DataFrame:
    """(group..., position, feature, error_mean, correct_mean, difference), one pass."""
    groups = names_of(group_by)
    right = CORRECT_OUTCOME[error]
    parts = []
    for i, f in enumerate(features):
        parts += [
            finite(F.avg(F.when(F.col("outcome") == error, number(f)))).alias(f"_e{i}"),
            finite(F.avg(F.when(F.col("outcome") == right, number(f)))).alias(f"_c{i}"),
        ]
    one = df.groupBy(*[col(g) for g in groups]).agg(*parts)
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f).alias("feature"),
            F.col(f"_e{i}").alias("error_mean"),
            F.col(f"_c{i}").alias("correct_mean"),
            (F.col(f"_e{i}") - F.col(f"_c{i}")).alias("difference"),
        )
        for i, f in enumerate(features)
    ]
    return one.select(*[col(g) for g in groups], F.inline(F.array(*cells)))


def top_errors(
    df: DataFrame, key: str, error: str, n: int = 10, group_by: str | Sequence[str] = ()
) -> DataFrame:
    """The n errors of one kind with the highest probability, ties by key.

    Each task keeps its own n best before anything is shuffled, also per group.
    """
    at_least_one(n, "n")
    if error not in CORRECT_OUTCOME:
        raise ValueError(f"not an error outcome: {error}")
    wrong = df.where(F.col("outcome") == error)
    order = [F.desc("probability"), col(key).asc()]
    groups = names_of(group_by)
    if not groups:
        return wrong.orderBy(*order).limit(n)

    def best(rows: DataFrame, *partition) -> DataFrame:
        place = Window.partitionBy(*partition).orderBy(*order)
        ranked = rows.withColumn("_rank", F.row_number().over(place))
        return ranked.where(F.col("_rank") <= n).drop("_rank")

    held = [col(g) for g in groups]
    if n > PARTIAL_LIMIT:  # beyond it no task keeps its own best: spread a hot group first
        salt = F.pmod(F.xxhash64(col(key)), F.lit(64))
        wrong = best(wrong.withColumn("_salt", salt), *held, F.col("_salt")).drop("_salt")
    return best(wrong, *held)


def error_focus(df: DataFrame, features: Sequence[str], categorical: Sequence[str], error: str) -> DataFrame:
    """Long form (section, name, statistic, value) of one kind of error.

    Sections: rows (count and percent of all rows), probability, numeric, category.
    """
    if error not in CORRECT_OUTCOME:
        raise ValueError(f"not an error outcome: {error}")
    is_error = F.col("outcome") == error
    wrong = df.where(is_error)
    rows = df.agg(
        F.count_if(is_error).cast("double").alias("count"),
        percent(F.count_if(is_error), F.count(F.lit(1)), None).alias("percent_of_rows"),
    )
    shown = numeric_summary(wrong, ["probability", *features]).drop("count", "missing")
    stats = [c for c in shown.columns if c != "feature"]
    numeric = shown.unpivot("feature", stats, "statistic", "value").select(
        F.when(F.col("feature") == "probability", "probability").otherwise("numeric").alias("section"),
        F.col("feature").alias("name"),
        "statistic",
        "value",
    )
    categories = category_by_outcome(wrong, categorical)
    category = categories.select(
        F.concat_ws("=", "column", "value").alias("name"),
        F.col("count").cast("double").alias("count"),
        "percent",
    ).unpivot("name", ["count", "percent"], "statistic", "value")
    return (
        rows.unpivot([], ["count", "percent_of_rows"], "statistic", "value")
        .select(F.lit("rows").alias("section"), F.lit(error).alias("name"), "statistic", "value")
        .unionByName(
            numeric.where("NOT (section = 'probability' AND statistic = 'std')")
        )
        .unionByName(category.select(F.lit("category").alias("section"), "name", "statistic", "value"))
    )


def threshold_error_summary(rows: DataFrame) -> DataFrame:
    """Per threshold row: error percentages and a workload sentence.

    ``false_positive_rate`` is a percentage of all rows.
    """
    tn, fp, fn, tp = (
        F.col(c) for c in ("true_negative", "false_positive", "false_negative", "true_positive")
    )
    return rows.withColumns(
        {
            "false_positive_rate": percent(fp, tn + fp + fn + tp, None),
            "false_negative_rate_actual_positives": percent(fn, fn + tp, None),
            "workload": F.format_string(
                "%d of %d rows would be flagged for review",
                F.col("predicted_positive_count"),
                tn + fp + fn + tp,
            ),
        }
    )


def error_cases(
    df: DataFrame,
    thresholds: Mapping[str, float],
    columns: Sequence[str],
    label: str = "label",
    probability: str = "probability",
) -> DataFrame:
    """(selection, threshold, outcome, probability, columns...) of all errors.

    The few thresholds are an array literal: each row yields only the thresholds at
    which it is wrong, in one pass without a join. Two names may share a threshold.
    """
    p, y = checked_score(probability), checked_label(label)
    steps = F.array(
        *[
            F.struct(F.lit(name).alias("selection"), F.lit(threshold_value(t)).alias("threshold"))
            for name, t in thresholds.items()
        ]
    )
    wrong = F.filter(steps, lambda s: (p >= s["threshold"]).cast("int") != y)
    return df.select(
        F.inline(wrong),
        p.alias("probability"),
        y.alias("_y"),
        *[col(c) for c in columns],
    ).select(
        "selection",
        "threshold",
        F.when(F.col("_y") == 1, "false_negative").otherwise("false_positive").alias("outcome"),
        "probability",
        *[col(c) for c in columns],
    )

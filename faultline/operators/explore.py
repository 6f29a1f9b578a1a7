"""Exploration: distributions, rates by category, correlation, ranges, outliers, leaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.arguments import at_least_one
from faultline.functions.columns import (
    col,
    count_where,
    finite,
    level,
    match,
    match_spread,
    names_of,
    number,
    percent,
    text,
    unpivot_numeric,
)
from faultline.functions.ordering import exact_quantiles, has_few_groups
from faultline.operators.comoments import co_moments
from faultline.operators.profile import numeric_summary
from faultline.spec import DatasetSpec

# Fence width in interquartile ranges, bins of a histogram.
FENCE = 1.5
BINS = 30


def head(df: DataFrame, key: str | Sequence[str], n: int = 5) -> DataFrame:
    """First n rows in key order; each task keeps only its own n best."""
    at_least_one(n, "n")
    return df.orderBy(*[col(k) for k in names_of(key)]).limit(n)


def describe_numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return numeric_summary(df, features)


def numeric_by_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Per target class and feature: mean, median, std, min, max."""
    labelled = df.where(col(target).isNotNull())
    return numeric_summary(labelled, features, target).select(
        col(target), "feature", "mean", "median", "std", "min", "max"
    )


def category_rates(df: DataFrame, category: str, target: str, digits: int = 3) -> DataFrame:
    """(value, count, percent, failure_percent) per category value."""
    counts = df.groupBy(level(category).alias("value")).agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg(number(target)) * 100, digits).alias("failure_percent"),
    )
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        "value", "count", percent(F.col("count"), total, digits).alias("percent"), "failure_percent"
    )


def target_table(df: DataFrame, target: str, digits: int = 3) -> DataFrame:
    """(label, count, percent) over all rows."""
    counts = df.groupBy(level(target).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        "label", "count", percent(F.col("count"), total, digits).alias("percent")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r) for all ordered pairs, each over rows where both are present.

    One scan for any number of columns, without copies of rows. r is NULL where it is not a
    number: with an infinity, or where a side is constant. Pairs that never stand together
    have no row.
    """
    name = F.array(*map(F.lit, columns))
    r = F.col("m_xy") / (F.sqrt("m_xx") * F.sqrt("m_yy"))
    shown = (F.col("endless") == 0) & (F.col("m_xx") > 0) & (F.col("m_yy") > 0)
    return co_moments(df, [number(c) for c in columns]).where("n > 0").select(
        F.element_at(name, F.col("x") + 1).alias("x"),
        F.element_at(name, F.col("y") + 1).alias("y"),
        F.when(shown & (F.abs(r) < float("inf")), r).alias("r"),
    )


def range_review(
    df: DataFrame,
    features: Sequence[str],
    group_by: str | Sequence[str] = (),
    few_groups: bool | None = None,
) -> DataFrame:
    """(group..., feature, min, q1, median, q3, max, iqr, lower_fence, upper_fence)."""
    groups = names_of(group_by)
    summary = numeric_summary(df, features, groups, few_groups)
    return (
        summary.withColumn("iqr", F.expr("q3 - q1"))
        .withColumn("lower_fence", F.col("q1") - FENCE * F.col("iqr"))
        .withColumn("upper_fence", F.col("q3") + FENCE * F.col("iqr"))
        .drop("count", "missing", "mean", "std")
    )


def _with_fences(
    df: DataFrame, features: Sequence[str], groups: list[str], few_groups: bool | None
) -> DataFrame:
    """(group..., feature, value, _n, quartiles, fences): values, each standing for _n rows."""
    keys = [*groups, "feature"]
    if few_groups is None:
        few_groups = has_few_groups(df, groups)
    fences = (
        exact_quantiles(
            df, features, {"q1": 0.25, "median": 0.5, "q3": 0.75}, groups, few_groups
        )
        .withColumn("lower_fence", F.expr(f"q1 - {FENCE} * (q3 - q1)"))
        .withColumn("upper_fence", F.expr(f"q3 + {FENCE} * (q3 - q1)"))
    )
    long = unpivot_numeric(df, features, groups).where("value IS NOT NULL")
    if few_groups:  # one row per feature and group
        return match(long, F.broadcast(fences), keys).withColumn("_n", F.lit(1).cast("bigint"))
    counted = long.groupBy(*[col(k) for k in keys], "value").agg(F.count(F.lit(1)).alias("_n"))
    return match_spread(counted, fences, keys, "value")


def outlier_counts(
    df: DataFrame,
    features: Sequence[str],
    group_by: str | Sequence[str] = (),
    few_groups: bool | None = None,
) -> DataFrame:
    """(group..., feature, outliers): values beyond the fences."""
    groups = names_of(group_by)
    judged = _with_fences(df, features, groups, few_groups)
    outside = F.expr("value < lower_fence OR value > upper_fence")
    return judged.groupBy(*[col(g) for g in groups], "feature").agg(
        F.sum(F.when(outside, F.col("_n")).otherwise(0)).alias("outliers")
    )


def box_stats(
    df: DataFrame,
    features: Sequence[str],
    group_by: str | Sequence[str] = (),
    few_groups: bool | None = None,
) -> DataFrame:
    """Quartiles, whiskers (last values inside the fences) and outlier count."""
    groups = names_of(group_by)
    keys = [*groups, "feature"]
    judged = _with_fences(df, features, groups, few_groups)
    inside = F.expr("value >= lower_fence AND value <= upper_fence")
    whiskers = judged.groupBy(*[col(k) for k in keys]).agg(
        F.min(F.when(inside, F.col("value"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("upper_whisker"),
        F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("outliers"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
    )
    return whiskers.select(
        *[col(k) for k in keys],
        "q1",
        "median",
        "q3",
        "lower_whisker",
        "upper_whisker",
        "outliers",
    )


def histogram(df: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """(feature, bin, lower, upper, count): equal-width bins, the last one closed.

    Empty bins are present. A feature with one value fills its first bin.
    """
    at_least_one(bins, "bins")
    long = unpivot_numeric(df, features).where("value IS NOT NULL")
    edges = long.groupBy("feature").agg(F.min("value").alias("_a"), F.max("value").alias("_b"))
    width = F.expr("_b - _a")
    place = F.when(width > 0, F.floor((F.col("value") - F.col("_a")) / width * bins)).otherwise(0)
    counts = (
        long.join(F.broadcast(edges), "feature")  # one row per feature
        .groupBy("feature", F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    grid = edges.select("feature", "_a", "_b", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = width / bins
    shape = grid.select(
        "feature",
        "bin",
        (F.col("_a") + F.col("bin") * step).alias("lower"),
        (F.col("_a") + (F.col("bin") + 1) * step).alias("upper"),
        F.lit(0).cast("bigint").alias("count"),
    )
    return (
        counts.unionByName(shape, allowMissingColumns=True)
        .groupBy("feature", "bin")
        .agg(
            F.max("lower").alias("lower"),
            F.max("upper").alias("upper"),
            F.sum("count").alias("count"),
        )
    )


def leakage_review(df: DataFrame, spec: DatasetSpec, reasons: dict[str, str] | None = None) -> DataFrame:
    """(column, reason, rows_set, failure_rate_set, failure_rate_unset) of leakage columns."""
    if not spec.leakage:
        return df.sparkSession.createDataFrame(
            [],
            "column string, reason string, rows_set bigint, failure_rate_set double,"
            " failure_rate_unset double",
        )
    y = number(spec.target)
    parts = []
    for i, c in enumerate(spec.leakage):
        on = number(c) == 1
        parts += [
            count_where(on).alias(f"_n{i}"),
            F.avg(F.when(on, y)).alias(f"_p{i}"),
            F.avg(F.when(~on, y)).alias(f"_q{i}"),
        ]
    one = df.agg(*parts)
    told = reasons or {}
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(told.get(c, "known only together with the target")).alias("reason"),
            F.col(f"_n{i}").alias("rows_set"),
            F.col(f"_p{i}").alias("failure_rate_set"),
            F.col(f"_q{i}").alias("failure_rate_unset"),
        )
        for i, c in enumerate(spec.leakage)
    ]
    return one.select(F.inline(F.array(*cells)))

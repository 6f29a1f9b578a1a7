"""Exact ranks, running totals and quantiles without one task seeing a whole group.

A plain ``Window.orderBy(score)`` or an exact ``percentile`` brings a whole group into
one task. Here every value first gets an ordered bucket. The bucket bounds come from an
approximate quantile sketch, so a bucket holds about BUCKET_ROWS rows however the values or the
groups are skewed; equal values are added up before the shuffle, so a value shared by a
third of all rows is one row per task. The number of buckets follows the number of rows, a
small table has one; the way and the results are the same for any number and any bounds.

The rows are counted first, so the input is read more than once: settle it when it is
expensive to compute.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.columns import beside, col, match, number, unpivot_numeric

BUCKET_ROWS = 500_000
# Bounds that the driver holds at most; beyond some 8 * 10^9 rows a bucket grows.
MOST_BUCKETS = 16_384
FEW_GROUPS = 1000


def bucket_count(df: DataFrame, buckets: int | None = None) -> int:
    """About BUCKET_ROWS rows to a bucket, unless the caller wants another number."""
    if buckets is None:
        buckets = -(-df.count() // BUCKET_ROWS)
    return max(1, min(buckets, MOST_BUCKETS))


def has_few_groups(df: DataFrame, group_by: Sequence[str]) -> bool:
    """Whether there are so few groups that one row for each can be broadcast."""
    if not group_by:
        return True
    groups = df.select(*[col(g) for g in group_by]).distinct()
    return groups.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS


def split_points(
    df: DataFrame, columns: Sequence[str], buckets: int
) -> list[list[float]]:
    """At most ``buckets - 1`` rising bounds per column; the one driver-side result."""
    fractions = [k / buckets for k in range(1, buckets)]
    found = df.approxQuantile(list(columns), fractions, 1.0 / (4 * buckets))
    return [sorted({p for p in one if math.isfinite(p)}) or [0.0] for one in found]


def add_buckets(df: DataFrame, columns: Mapping[str, str], buckets: int) -> DataFrame:
    """Add an ordered bucket column (value column -> bucket column); missing values have none."""
    if buckets == 1:
        only = {b: F.when(col(v).isNotNull(), F.lit(0.0)) for v, b in columns.items()}
        return df.withColumns(only)
    points = split_points(df, list(columns), buckets)
    placed = Bucketizer(
        inputCols=list(columns),
        outputCols=list(columns.values()),
        splitsArray=[[-math.inf, *one, math.inf] for one in points],
        handleInvalid="keep",
    ).transform(df)
    return placed.withColumns(
        {b: F.when(col(v).isNotNull(), col(b)) for v, b in columns.items()}
    )


def running_totals(
    df: DataFrame,
    order: str,
    measures: Mapping[str, Column],
    group_by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Per (group, order value): summed measures, ``<measure>_before``, ``<measure>_total``.

    ``_before`` adds up all rows of the group that come strictly earlier, ``_total`` the
    whole group. What earlier buckets add, and the total, enter each bucket with one
    carry-in row that is sorted first, so no join is needed. Each window holds one bucket of one group, or one group's bucket totals.
    """
    size = bucket_count(df, buckets)
    groups = [col(g) for g in group_by]
    plain = df.select(
        *groups,
        number(order).alias("_value"),
        *[m.alias(name) for name, m in measures.items()],
    ).where(F.col("_value").isNotNull())
    sums = [F.sum(col(name)).alias(name) for name in measures]
    value_order = (
        F.desc_nulls_first("_value") if descending else F.asc_nulls_first("_value")
    )

    def finish(rows: DataFrame, partition: list[Column], totals: dict[str, Column]):
        inside = (
            Window.partitionBy(*partition)
            .orderBy(value_order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        running = {
            f"{name}_before": F.coalesce(F.sum(col(name)).over(inside), F.lit(0))
            for name in measures
        }
        kept = rows.withColumns({**running, **totals}).where(F.col("_value").isNotNull())
        return kept.select(
            *groups, F.col("_value").alias(order), *measures, *running, *totals
        )

    whole = Window.partitionBy(*groups)
    placed = add_buckets(plain, {"_value": "_bucket"}, size)
    by_value = placed.groupBy(*groups, "_bucket", "_value").agg(*sums)
    by_bucket = by_value.groupBy(*groups, "_bucket").agg(*sums)
    earlier = whole.orderBy(
        F.desc("_bucket") if descending else F.asc("_bucket")
    ).rowsBetween(Window.unboundedPreceding, -1)
    carry = by_bucket.select(
        *groups,
        "_bucket",
        F.lit(None).cast("double").alias("_value"),
        *[
            F.coalesce(F.sum(col(name)).over(earlier), F.lit(0)).alias(name)
            for name in measures
        ],
        *[F.sum(col(name)).over(whole).alias(f"_{name}_all") for name in measures],
    )
    in_bucket = [*groups, F.col("_bucket")]
    from_first = (
        Window.partitionBy(*in_bucket)
        .orderBy(value_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = {
        f"{name}_total": F.first(col(f"_{name}_all")).over(from_first) for name in measures
    }
    return finish(by_value.unionByName(carry, allowMissingColumns=True), in_bucket, totals)


def exact_quantiles(
    df: DataFrame,
    features: Sequence[str],
    fractions: Mapping[str, float],
    group_by: Sequence[str] = (),
    few_groups: bool | None = None,
    buckets: int | None = None,
    aggregates: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles: (group..., feature, one column per fraction).

    ``aggregates`` of the columns feature and value are added, over all rows, missing
    values included; quantiles leave missing values out.

    Bucket counts, an aggregate of at most ``buckets`` rows per group and feature, show
    which bucket holds each wanted rank. Only the rows of those buckets, a small part of
    the table, are then counted by value and ranked. With few groups the wanted-ranks
    table has at most groups x features x fractions x 2 rows and is broadcast. That is
    checked unless ``few_groups`` says so of a closed set such as the four outcomes.
    """
    size = bucket_count(df, buckets)
    groups = [col(g) for g in group_by]
    keys = [*group_by, "feature"]
    if not features:
        kinds = dict.fromkeys((*(aggregates or {}), *fractions), "double")
        empty = unpivot_numeric(df, features, group_by).drop("value")
        return empty.select(
            "*", *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
        )
    others = [value.alias(name) for name, value in (aggregates or {}).items()]
    values = {f"_v{i}": f"_b{i}" for i in range(len(features))}
    wide = df.select(
        *groups, *[number(f).alias(f"_v{i}") for i, f in enumerate(features)]
    )
    wide = add_buckets(wide, values, size)
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f"_b{i}").alias("_bucket"),
            F.col(f"_v{i}").alias("_value"),
        )
        for i, f in enumerate(features)
    ]
    everything = wide.select(*groups, F.inline(F.array(*cells)))
    long = everything.where(F.col("_value").isNotNull())

    per_feature = Window.partitionBy(*groups, "feature")
    earlier = per_feature.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Missing values are a bucket of their own: a group without a value keeps its row.
    sizes = everything.groupBy(*groups, "feature", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    counted = (
        sizes.where(F.col("_bucket").isNotNull())
        .withColumn("_total", F.sum("_n").over(per_feature))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    )
    wishes = [
        F.struct(F.lit(name).alias("_name"), F.lit(float(p)).alias("_p"))
        for name, p in fractions.items()
    ]
    wanted = (
        counted.select("*", F.inline(F.array(*wishes)))
        .withColumn("_at", F.col("_p") * (F.col("_total") - 1))
        .withColumn("_low", F.floor("_at"))
        .withColumn("_high", F.ceil("_at"))
        .where("_low < _start + _n AND _high >= _start")
        .groupBy(*groups, "feature", "_bucket")
        .agg(
            F.max("_start").alias("_start"),
            F.collect_list(F.struct("_name", "_at", "_low", "_high")).alias("_wanted"),
        )
    )
    place = [*group_by, "feature", "_bucket"]
    inside = (
        Window.partitionBy(*[col(p) for p in place])
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    exact = [*[col(p) for p in place], "_value"]
    if few_groups is None:
        few_groups = has_few_groups(df, group_by)
    if few_groups:
        # Few rows survive the join: join first, then count.
        counts = (
            match(long, F.broadcast(wanted), place)
            .groupBy(*exact)
            .agg(
                F.count(F.lit(1)).alias("_n"),
                F.first("_start").alias("_start"),
                F.first("_wanted").alias("_wanted"),
            )
        )
    else:
        # The join may shuffle: count equal values first, so that none of them is hot.
        counts = match(
            long.groupBy(*exact).agg(F.count(F.lit(1)).alias("_n")), wanted, place
        )
    ranked = (
        counts.withColumn(
            "_from", F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
        )
        .withColumn("_to", F.col("_from") + F.col("_n"))
    )

    def at(rank: str) -> Column:
        return F.max(F.when(F.expr(f"{rank} >= _from AND {rank} < _to"), F.col("_value")))

    found = (
        ranked.select(*groups, "feature", "_value", "_from", "_to", F.inline("_wanted"))
        .groupBy(*groups, "feature", "_name")
        .agg(at("_low").alias("_a"), at("_high").alias("_b"), F.max("_at").alias("_at"))
        .withColumn(
            "_q",
            F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(
                (F.ceil("_at") - F.col("_at")) * F.col("_a")
                + (F.col("_at") - F.floor("_at")) * F.col("_b")
            ),
        )
    )
    quantiles = found.groupBy(*groups, "feature").agg(
        *[
            F.max(F.when(F.col("_name") == name, F.col("_q"))).alias(name)
            for name in fractions
        ]
    )
    if not others:
        every = sizes.groupBy(*groups, "feature").agg(F.sum("_n").alias("_rows"))
        return beside([every, quantiles], keys).drop("_rows")
    rest = unpivot_numeric(df, features, group_by).groupBy(*groups, "feature").agg(*others)
    return beside([rest, quantiles], keys)

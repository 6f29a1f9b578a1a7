"""Confusion counts, classification metrics, exact ROC-AUC and average precision.

All work on scored rows (label 0/1, probability) in long form, per optional group such
as a model, site or segment, so many models are judged in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from faultline.functions.arguments import threshold_list, threshold_value
from faultline.functions.columns import (
    beside,
    checked_label,
    checked_score,
    col,
    count_where,
    match,
    names_of,
    ratio,
)
from faultline.functions.ordering import BUCKET_ROWS, MOST_BUCKETS, running_totals
from faultline.functions.scorelists import listed, pieces, range_sizes, ranked, sampled
from faultline.spec import THRESHOLDS

COUNTS = ("true_negative", "false_positive", "false_negative", "true_positive")


def majority_vote(probability: str = "probability") -> Column:
    """The class a classifier predicts: 1 above one half, 0 at exactly one half."""
    return (checked_score(probability) > 0.5).cast("int")


def at_threshold(threshold: float, probability: str = "probability") -> Column:
    """The class at an operating threshold: 1 from the threshold upwards."""
    return (checked_score(probability) >= F.lit(threshold_value(threshold))).cast("int")


def confusion_matrix(
    df: DataFrame, predicted: Column, label: str = "label", group_by: str | Sequence[str] = ()
) -> DataFrame:
    """(group..., true_negative, false_positive, false_negative, true_positive).

    Labels and predictions other than 0 and 1 are an error.
    """
    keys = [col(g) for g in names_of(group_by)]
    y, predicted_class = F.col("_y"), F.col("_predicted")
    refused = F.raise_error("predictions have to be 0 or 1").cast("int")
    judged = df.select(
        *keys,
        checked_label(label).alias("_y"),
        F.when(predicted.isin(0, 1), predicted.cast("int")).otherwise(refused).alias("_predicted"),
    )
    return judged.groupBy(*keys).agg(
        count_where((y == 0) & (predicted_class == 0)).alias("true_negative"),
        count_where((y == 0) & (predicted_class == 1)).alias("false_positive"),
        count_where((y == 1) & (predicted_class == 0)).alias("false_negative"),
        count_where((y == 1) & (predicted_class == 1)).alias("true_positive"),
    )


def rates_of_counts() -> dict[str, Column]:
    """Accuracy, precision, recall and F1 from the four counts; 0 where undefined."""

    def share(part: str, whole: str) -> Column:
        return F.expr(f"CASE WHEN {whole} = 0 THEN 0D ELSE ({part}) / ({whole}) END")

    tn, fp, fn, tp = COUNTS
    return {
        "accuracy": share(f"{tn} + {tp}", f"{tn} + {fp} + {fn} + {tp}"),
        "precision": share(tp, f"{tp} + {fp}"),
        "recall": share(tp, f"{tp} + {fn}"),
        "f1": share(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
    }


def classification_metrics(
    df: DataFrame,
    predicted: Column | None = None,
    label: str = "label",
    group_by: str | Sequence[str] = (),
) -> DataFrame:
    """(group..., accuracy, precision, recall, f1, four counts), by majority vote."""
    groups = names_of(group_by)
    counts = confusion_matrix(
        df, majority_vote() if predicted is None else predicted, label, groups
    )
    return counts.select(
        *[col(g) for g in groups],
        *[value.alias(name) for name, value in rates_of_counts().items()],
        *COUNTS,
    )


def score_curve(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    group_by: str | Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Per distinct score, from high to low: positives and negatives at and above it."""
    groups = names_of(group_by)
    checked = df.select(
        *[col(g) for g in groups],
        checked_score(probability).alias(probability),
        checked_label(label).cast("bigint").alias("_positive"),
    )
    measures = {"positives": F.col("_positive"), "negatives": F.lit(1) - F.col("_positive")}
    return _curve(checked, measures, probability, groups, buckets)


def counted_scores(
    df: DataFrame, label: str, probability: str, group_by: str | Sequence[str] = ()
) -> DataFrame:
    """(group..., scores, positives, negatives): lists of distinct scores, falling, with their counts.

    A group has several lists, each of some rows of one task; a score may stand in more than one.
    """
    groups = names_of(group_by)
    checked = df.select(
        *[col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        checked_score(probability).cast("double").alias("_p"),
        checked_label(label).cast("bigint").alias("_y"),
    )
    schema = StructType([StructField(f"_g{i}", df.schema[g].dataType) for i, g in enumerate(groups)])
    schema = schema.add("scores", BinaryType()).add("positives", BinaryType()).add("negatives", BinaryType())
    lists = checked.mapInArrow(lambda batches: listed(batches, len(groups)), schema)
    return lists.select(*[F.col(f"_g{i}").alias(g) for i, g in enumerate(groups)], "scores", "positives", "negatives")


def _curve(
    df: DataFrame, measures: dict[str, Column], probability: str, groups: list[str], buckets: int | None
) -> DataFrame:
    return running_totals(
        df,
        probability,
        measures,
        groups,
        descending=True,
        buckets=buckets,
    ).select(
        *[col(g) for g in groups],
        col(probability).alias("score"),
        "positives",
        "negatives",
        "positives_before",
        "negatives_before",
        "positives_total",
        "negatives_total",
        (F.col("positives_before") + F.col("positives")).alias("tp"),
        (F.col("negatives_before") + F.col("negatives")).alias("fp"),
    )


def pr_curve(df: DataFrame, group_by: str | Sequence[str] = (), **options) -> DataFrame:
    """(group..., score, tp, fp, precision, recall) per distinct score."""
    groups = names_of(group_by)
    points = score_curve(df, group_by=groups, **options)
    return points.select(
        *[col(g) for g in groups],
        "score",
        "tp",
        "fp",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("positives_total")).alias("recall"),
    )


def roc_curve(df: DataFrame, group_by: str | Sequence[str] = (), **options) -> DataFrame:
    """(group..., score, tp, fp, tpr, fpr) per distinct score."""
    groups = names_of(group_by)
    points = score_curve(df, group_by=groups, **options)
    return points.select(
        *[col(g) for g in groups],
        "score",
        "tp",
        "fp",
        ratio(F.col("tp"), F.col("positives_total")).alias("tpr"),
        ratio(F.col("fp"), F.col("negatives_total")).alias("fpr"),
    )


def ranking_metrics(df: DataFrame, group_by: str | Sequence[str] = (), **options) -> DataFrame:
    """(group..., roc_auc, average_precision), exact, NULL where a class is absent.

    AUC counts tied pairs half. Average precision is the step sum over distinct scores,
    without interpolation.
    """
    groups = names_of(group_by)
    return _ranked(score_curve(df, group_by=groups, **options), groups)


def ranking_of_counts(
    counts: DataFrame, group_by: str | Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """``ranking_metrics`` from rows of ``counted_scores``, which are read up to four times: settle them.

    Each group gets ranges of scores, about BUCKET_ROWS scores in each, bounded by scores that
    its lists hold at even steps. The counts of all ranges come to the driver, a few numbers each,
    and a range is merged and ranked in one task that knows what the ranges above it hold.
    """
    groups = names_of(group_by)
    if not groups:
        return ranking_of_counts(counts.withColumn("_all", F.lit(0)), "_all", buckets).drop("_all")
    keys = [f"_g{i}" for i in range(len(groups))]
    named = counts.select(
        *[col(g).alias(k) for g, k in zip(groups, keys, strict=True)], "scores", "positives", "negatives"
    )
    fields = [StructField(k, counts.schema[g].dataType) for g, k in zip(groups, keys, strict=True)]
    kinds = {"double": DoubleType(), "long": LongType(), "binary": BinaryType()}

    def schema(**more: str) -> StructType:
        return StructType([*fields, *[StructField(n, kinds[k]) for n, k in more.items()]])

    def by_key(rows) -> dict[tuple, list]:
        found: dict[tuple, list] = {}
        for row in rows:
            found.setdefault(tuple(row)[: len(keys)], []).append(tuple(row)[len(keys) :])
        return found

    whole = named.groupBy(*keys).agg(F.sum(F.length("scores") / 8).cast("bigint")).collect()
    # Powers of 2, so that groups share the jobs that find their bounds.
    wanted = {
        key: min(1 << max(0, -(-sizes[0][0] // BUCKET_ROWS) - 1).bit_length() if buckets is None else buckets, MOST_BUCKETS)
        for key, sizes in by_key(whole).items()
    }
    bounds = {}
    if any(w > 1 for w in wanted.values()):
        steps = {key: max(1, BUCKET_ROWS // 32 if buckets is None else 1) for key in wanted}
        sample = named.mapInArrow(lambda b: sampled(b, len(keys), steps), schema(_score="double", _n="long"))
        shares = {w: [k / w for k in range(1, w)] for w in set(wanted.values()) if w > 1}
        for w, fractions in shares.items():
            of = reduce(or_, [_same(keys, key) for key, one in wanted.items() if one == w])
            quantiles = F.percentile("_score", fractions, F.col("_n")).alias("_bounds")
            for key, found in by_key(sample.where(of).groupBy(*keys).agg(quantiles).collect()).items():
                bounds[key] = sorted(set(found[0][0]))
    counted = named.mapInArrow(
        lambda b: range_sizes(b, len(keys), bounds),
        schema(_range="long", _positives="long", _negatives="long"),
    )
    sizes = counted.groupBy(*keys, "_range").agg(F.sum("_positives"), F.sum("_negatives")).collect()
    before: dict[tuple, tuple[int, int]] = {}
    total: dict[tuple, tuple[int, int]] = {}
    for key, ranges in by_key(sizes).items():
        p = n = 0
        for place, positives, negatives in sorted(ranges, reverse=True):
            before[*key, place] = (p, n)
            p, n = p + positives, n + negatives
        total[key] = (p, n)
    parts = named.mapInArrow(
        lambda b: pieces(b, len(keys), bounds),
        schema(_range="long", scores="binary", positives="binary", negatives="binary"),
    )
    sums = parts.groupBy(*keys, "_range").applyInArrow(
        lambda key, table: ranked(key, table, len(keys), before),
        schema(_pairs="double", _steps="double"),
    )
    rows = [(*key, float(a), float(b)) for key, (a, b) in total.items()]
    known = counts.sparkSession.createDataFrame(rows, schema(_p="double", _n="double"))
    each = match(sums.groupBy(*keys).agg(F.sum("_pairs").alias("_pairs"), F.sum("_steps").alias("_steps")), known, keys)
    p, n = F.col("_p"), F.col("_n")
    return each.select(
        *[col(k).alias(g) for g, k in zip(groups, keys, strict=True)],
        F.when((p > 0) & (n > 0), F.col("_pairs") / (p * n)).alias("roc_auc"),
        F.when(p > 0, F.col("_steps") / p).alias("average_precision"),
    )


def _same(keys: list[str], values: tuple) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, values, strict=True)], F.lit(True))


def _ranked(curve: DataFrame, groups: list[str]) -> DataFrame:
    p, n = F.col("positives").cast("double"), F.col("negatives").cast("double")
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    both = (F.sum(p) > 0) & (F.sum(n) > 0)
    pairs = F.sum(n * (F.col("positives_before") + p / 2))
    return curve.groupBy(*[col(g) for g in groups]).agg(
        F.when(both, pairs / (F.sum(p) * F.sum(n))).alias("roc_auc"),
        F.when(F.sum(p) > 0, F.sum(p * tp / (tp + fp)) / F.sum(p)).alias("average_precision"),
    )


def roc_auc(df: DataFrame, group_by: str | Sequence[str] = (), **options) -> DataFrame:
    return ranking_metrics(df, group_by, **options).drop("average_precision")


def average_precision(df: DataFrame, group_by: str | Sequence[str] = (), **options) -> DataFrame:
    return ranking_metrics(df, group_by, **options).drop("roc_auc")


def evaluate_models(
    df: DataFrame, group_by: str | Sequence[str] = "model", **options
) -> DataFrame:
    """All metrics of many models, one row per group."""
    groups = names_of(group_by)
    hard = classification_metrics(df, group_by=groups)
    soft = ranking_metrics(df, groups, **options)
    return beside([hard, soft], groups).select(
        *[col(g) for g in groups],
        "accuracy",
        "precision",
        "recall",
        "f1",
        "roc_auc",
        "average_precision",
        *COUNTS,
    )


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float] | None = None,
    group_by: str | Sequence[str] = (),
    label: str = "label",
    probability: str = "probability",
) -> DataFrame:
    """All metrics at every threshold, reading the scored rows once.

    A row's bin is the number of thresholds it reaches; rows are counted by bin before
    the shuffle, so thresholds + 1 rows per group and task leave the scan. The grid of
    thresholds is laid over those counts, not over the rows.
    """
    groups = names_of(group_by)
    grid = threshold_list(THRESHOLDS if thresholds is None else thresholds)
    reached = " + ".join(f"int(_p >= {t!r}D)" for t in grid)
    steps = ", ".join(
        f"named_struct('threshold', {t!r}D, '_step', {i})" for i, t in enumerate(grid, 1)
    )
    keys = [col(g) for g in groups]
    binned = (
        df.select(
            *keys,
            checked_score(probability).alias("_p"),
            checked_label(label).cast("bigint").alias("_y"),
        )
        .groupBy(*keys, F.expr(reached).alias("_bin"))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_pos"))
    )
    cells = {
        "true_negative": ("_bin < _step", "_n - _pos"),
        "false_positive": ("_bin >= _step", "_n - _pos"),
        "false_negative": ("_bin < _step", "_pos"),
        "true_positive": ("_bin >= _step", "_pos"),
    }
    counts = (
        binned.select("*", F.expr(f"inline(array({steps}))"))
        .groupBy(*keys, "threshold")
        .agg(
            *[
                F.expr(f"sum(CASE WHEN {where} THEN {value} ELSE 0 END) AS {name}")
                for name, (where, value) in cells.items()
            ]
        )
    )
    flagged = "false_positive + true_positive"
    return counts.select(
        *keys,
        "threshold",
        *[value.alias(name) for name, value in rates_of_counts().items()],
        *COUNTS,
        F.expr(f"{flagged} AS predicted_positive_count"),
        F.expr(f"({flagged}) / ({' + '.join(COUNTS)}) AS predicted_positive_rate"),
    )


def fixed_threshold_metrics(
    df: DataFrame, threshold: float, group_by: str | Sequence[str] = (), **options
) -> DataFrame:
    """The metrics at one threshold."""
    return threshold_sweep(df, [threshold], group_by, **options)


def classification_report(df: DataFrame, predicted: Column | None = None) -> DataFrame:
    """(class, precision, recall, f1, support) per class, with macro and weighted means."""
    one = confusion_matrix(df, majority_vote() if predicted is None else predicted)
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)

    def scores(hit, wrongly_in, wrongly_out):
        return {
            "precision": ratio(hit, hit + wrongly_in),
            "recall": ratio(hit, hit + wrongly_out),
            "f1": ratio(2 * hit, 2 * hit + wrongly_in + wrongly_out),
        }

    zero, positive = scores(tn, fn, fp), scores(tp, fp, fn)
    n0, n1 = tn + fp, fn + tp
    rows = {
        "0": (zero, n0),
        "1": (positive, n1),
        "macro": ({k: (zero[k] + positive[k]) / 2 for k in zero}, n0 + n1),
        "weighted": (
            {k: ratio(zero[k] * n0 + positive[k] * n1, n0 + n1) for k in zero},
            n0 + n1,
        ),
    }
    cells = [
        F.struct(
            F.lit(name).alias("class"),
            *[v.alias(k) for k, v in values.items()],
            support.alias("support"),
        )
        for name, (values, support) in rows.items()
    ]
    return one.select(F.inline(F.array(*cells)))

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tables import one, rows_of, scored

from faultline.functions.arguments import cost_pair, rate, threshold_list
from faultline.functions import scorelists
from faultline.operators import metrics
from faultline.operators.checks import score_check
from faultline.spec import THRESHOLDS


def test_metrics_at_one_threshold(spark):
    df = scored(spark, [0, 0, 1, 1], [0.1, 0.6, 0.7, 0.4])
    row = one(metrics.fixed_threshold_metrics(df, 0.5))
    assert [row[c] for c in metrics.COUNTS] == [1, 1, 1, 1]
    assert row["accuracy"] == row["precision"] == row["recall"] == row["f1"] == 0.5
    assert (row["predicted_positive_count"], row["predicted_positive_rate"]) == (2, 0.5)


def test_thresholds_are_sorted_and_distinct(spark):
    df = scored(spark, [0, 0, 1, 1], [0.1, 0.6, 0.7, 0.4])
    out = metrics.threshold_sweep(df, [0.75, 0.25, 0.5, 0.25]).orderBy("threshold")
    assert [t for (t,) in rows_of(out, "threshold")] == [0.25, 0.5, 0.75]
    assert THRESHOLDS[0] == 0.05 and THRESHOLDS[-1] == 0.95 and len(THRESHOLDS) == 19


@pytest.mark.parametrize(
    "bad", [[0.0], [1.0], [-0.1], [1.1], [float("nan")], [float("inf")], ["x"], [], "0.5", [True]]
)
def test_bad_thresholds(bad):
    with pytest.raises(ValueError):
        threshold_list(bad)


@pytest.mark.parametrize("pair", [(1, 1), (1, 2), (0, 1), (10, 0), (-1, -2), (float("nan"), 1), (float("inf"), 1), ("a", 1)])
def test_bad_costs(pair):
    with pytest.raises(ValueError):
        cost_pair(*pair)


@pytest.mark.parametrize("bad", [-0.1, 1.1, float("nan"), "a", None])
def test_bad_rates(bad):
    with pytest.raises(ValueError):
        rate(bad, "rate")


def test_ranking_of_the_toy_case(spark):
    df = scored(spark, [0, 0, 1, 1], [0.1, 0.7, 0.8, 0.4])
    row = one(metrics.ranking_metrics(df))
    assert row["roc_auc"] == 0.75
    assert row["average_precision"] == pytest.approx(5 / 6)
    counts = one(metrics.confusion_matrix(df, metrics.majority_vote()))
    assert list(counts.values()) == [1, 1, 1, 1]


def test_zero_division_is_zero(spark):
    row = one(metrics.classification_metrics(scored(spark, [0, 0, 1, 1], [0.1] * 4)))
    assert row["precision"] == row["recall"] == row["f1"] == 0.0


def test_ties_at_one_half(spark):
    df = scored(spark, [0, 1], [0.5, 0.5])
    vote = one(metrics.confusion_matrix(df, metrics.majority_vote()))
    cut = one(metrics.confusion_matrix(df, metrics.at_threshold(0.5)))
    assert (vote["true_negative"], vote["false_negative"]) == (1, 1)
    assert (cut["false_positive"], cut["true_positive"]) == (1, 1)


def test_published_counts_give_published_metrics(spark):
    rows = [(0, 0.0)] * 1924 + [(0, 0.9)] * 8 + [(1, 0.0)] * 17 + [(1, 0.9)] * 51
    df = scored(spark, *zip(*rows, strict=True))
    row = one(metrics.fixed_threshold_metrics(df, 0.8))
    assert [round(row[c], 4) for c in ("accuracy", "precision", "recall", "f1")] == [0.9875, 0.8644, 0.75, 0.8031]
    assert row["predicted_positive_count"] == 59 and row["predicted_positive_rate"] == 0.0295


def test_single_class_has_no_auc(spark):
    row = one(metrics.ranking_metrics(scored(spark, [0, 0], [0.1, 0.2])))
    assert row == {"roc_auc": None, "average_precision": None}
    only = one(metrics.ranking_metrics(scored(spark, [1, 1], [0.1, 0.2])))
    assert only == {"roc_auc": None, "average_precision": 1.0}


def test_score_check_finds_faults(spark):
    df = spark.createDataFrame(
        [(0, 0.1), (1, float("nan")), (1, None), (None, 0.2), (2, 0.3), (1, 1.5), (0, -0.5), (1, float("inf"))],
        "label int, probability double",
    )
    row = one(score_check(df))
    assert row["missing_labels"] == 1 and row["other_labels"] == 1
    assert row["unusable_probabilities"] == 3 and row["probabilities_out_of_range"] == 2
    assert not row["valid"]
    assert one(score_check(scored(spark, [0, 1], [0.0, 1.0])))["valid"]
    assert not one(score_check(scored(spark, [0, 0], [0.0, 1.0])))["valid"]


def _brute(rows):
    """AUC by pairs and AP by steps, in plain Python."""
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap = 0.0
    for cut in sorted({p for _, p in rows}, reverse=True):
        above = [(y, p) for y, p in rows if p >= cut]
        here = sum(1 for y, p in rows if p == cut and y == 1)
        ap += here / len(pos) * sum(y for y, _ in above) / len(above)
    return auc, ap


@pytest.mark.parametrize("buckets", [None, 2, 7, 50])
def test_ranking_against_brute_force_with_hot_ties_and_groups(spark, buckets):
    """One score and one group hold far more than a third of all rows."""
    rng = random.Random(7)
    rows = []
    for i in range(1200):
        group = "hot" if i % 3 else rng.choice(["a", "b", None])
        p = 0.25 if rng.random() < 0.4 else round(rng.random(), 3)
        rows.append((group, int(rng.random() < p), p))
    df = spark.createDataFrame(rows, "g string, label int, probability double").repartition(5)
    got = {r["g"]: r for r in metrics.ranking_metrics(df, "g", buckets=buckets).collect()}
    assert set(got) == {"hot", "a", "b", None}
    for g, r in got.items():
        auc, ap = _brute([(y, p) for k, y, p in rows if k == g])
        assert r["roc_auc"] == pytest.approx(auc, abs=1e-12)
        assert r["average_precision"] == pytest.approx(ap, abs=1e-12)
    flipped = df.withColumn("probability", 1 - F.col("probability"))
    back = one(metrics.roc_auc(flipped, buckets=buckets))["roc_auc"]
    assert back == pytest.approx(1 - one(metrics.roc_auc(df, buckets=buckets))["roc_auc"], abs=1e-12)


def test_sweep_invariants(spark):
    rng = random.Random(3)
    df = scored(spark, [int(rng.random() < 0.2) for _ in range(500)], [rng.random() for _ in range(500)])
    rows = metrics.threshold_sweep(df).orderBy("threshold").collect()
    assert len(rows) == 19
    for r in rows:
        assert sum(r[c] for c in metrics.COUNTS) == 500
    recalls = [r["recall"] for r in rows]
    assert recalls == sorted(recalls, reverse=True)
    for n in (1, 7, 64):
        again = metrics.threshold_sweep(df.repartition(n)).orderBy("threshold").collect()
        assert again == rows


def test_sweep_keeps_every_threshold_of_every_group(spark):
    df = spark.createDataFrame(
        [("a", 0, 0.01), ("a", 1, 0.02), (None, 1, 0.99)], "g string, label int, probability double"
    )
    out = metrics.threshold_sweep(df, group_by="g")
    assert out.groupBy("g").count().where("count <> 19").count() == 0
    assert out.select("g").distinct().count() == 2


def test_evaluate_models_and_report(spark):
    df = scored(spark, [0, 0, 1, 1], [0.1, 0.7, 0.8, 0.4])
    both = df.withColumn("model", F.lit("x")).unionByName(df.withColumn("model", F.lit("y")))
    rows = metrics.evaluate_models(both).orderBy("model").collect()
    assert [r["model"] for r in rows] == ["x", "y"]
    assert rows[0]["roc_auc"] == 0.75 and rows[0]["f1"] == 0.5
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert set(report) == {"0", "1", "macro", "weighted"} and report["weighted"]["support"] == 4


@pytest.mark.parametrize("buckets", [None, 1, 7])
@pytest.mark.parametrize("group_by", [(), ("a group",), ("a group", "r")])
def test_ranking_of_packed_lists(spark, monkeypatch, group_by, buckets):
    monkeypatch.setattr(scorelists, "LISTED_ROWS", 700)
    score = F.pmod(F.xxhash64("id"), F.lit(500)) / F.lit(500.0)
    df = spark.range(3000).repartition(3).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("a group"),
        (F.col("id") % 2).alias("r"),
        F.when(F.col("id") % 5 == 0, 0.5).otherwise(score).alias("probability"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7)) == 0).cast("int").alias("label"),
    )
    df = df.unionAll(spark.createDataFrame([("z", 0, -0.0, 1), ("y", 0, 0.0, 0)], df.schema))
    counts = metrics.counted_scores(df, "label", "probability", group_by)
    groups = df.select(*[F.col(g) for g in group_by]).distinct().count()
    # Lists, a few for each group and task, not a row for each score.
    assert counts.count() <= 15 * groups + 2
    wanted = {tuple(r)[:-2]: tuple(r)[-2:] for r in metrics.ranking_metrics(df, group_by).collect()}
    found = {tuple(r)[:-2]: tuple(r)[-2:] for r in metrics.ranking_of_counts(counts, group_by, buckets).collect()}
    assert found.keys() == wanted.keys()
    for key, values in wanted.items():
        for a, b in zip(found[key], values, strict=True):
            assert a == b if b is None else a == pytest.approx(b)

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from tables import one, rows_of, threshold_rows

from faultline.operators import thresholds as th
from faultline.operators.checks import threshold_audit
from faultline.operators.models import best_model

A = ((0.1, 10, 7, 1, 9), (0.5, 15, 2, 5, 5), (0.8, 16, 1, 4, 6))


def chosen(profiles):
    return {r["profile"]: r for r in profiles.collect()}


def test_profiles_of_the_standard_rows(spark):
    rows = threshold_rows(spark, *A)
    profiles = th.operating_profiles(rows)
    got = chosen(profiles)
    assert {k: r["threshold"] for k, r in got.items()} == {"high_recall": 0.1, "balanced": 0.8, "conservative": 0.8}
    high = got["high_recall"]
    assert high["false_positive_rate_overall"] == pytest.approx(7 / 27)
    assert high["false_negative_rate_among_actual_positives"] == pytest.approx(0.1)
    assert high["illustrative_total_cost"] == 17.0
    assert high["recall_target_met"] is True and high["precision_target_met"] is None
    assert got["balanced"]["recall_target_met"] is None
    assert rows_of(th.shared_thresholds(profiles), "threshold", "profiles") == [(0.8, "balanced,conservative")]


def test_high_recall_prefers_precision_among_eligible(spark):
    rows = threshold_rows(spark, (0.1, 12, 5, 1, 9), (0.2, 14, 3, 1, 9), (0.3, 15, 2, 1, 9))
    row = one(th.profile_high_recall(rows))
    assert (row["threshold"], row["recall_target_met"]) == (0.3, True)


def test_high_recall_falls_back_to_best_recall(spark):
    rows = threshold_rows(spark, (0.1, 12, 5, 4, 6), (0.2, 13, 4, 2, 8))
    row = one(th.profile_high_recall(rows, 0.95))
    assert (row["threshold"], row["recall_target_met"]) == (0.2, False)


def test_balanced_tie_takes_the_higher_threshold(spark):
    rows = threshold_rows(spark, (0.3, 14, 2, 2, 8), (0.6, 14, 2, 2, 8))
    assert one(th.best_f1_threshold(rows))["threshold"] == 0.6


def test_conservative_profile(spark):
    met = one(th.profile_conservative(threshold_rows(spark, (0.4, 15, 2, 4, 6), (0.6, 16, 1, 5, 5))))
    assert (met["threshold"], met["precision_target_met"]) == (0.4, True)
    unmet = one(th.profile_conservative(threshold_rows(spark, (0.4, 11, 6, 1, 9), (0.6, 14, 3, 5, 5)), 0.9))
    assert (unmet["threshold"], unmet["precision_target_met"]) == (0.6, False)


def test_shared_groups(spark):
    three = th.operating_profiles(threshold_rows(spark, (0.5, 17, 0, 0, 10)))
    assert one(th.shared_thresholds(three))["profiles"] == "high_recall,balanced,conservative"
    none = th.operating_profiles(
        threshold_rows(spark, (0.1, 7, 10, 0, 10), (0.5, 15, 2, 3, 7), (0.9, 17, 0, 6, 4)), 0.95, 0.99
    )
    assert th.shared_thresholds(none).count() == 0


def _plain(spark, *rows):
    return spark.createDataFrame(
        [tuple(map(float, r)) for r in rows], "threshold double, f1 double, recall double, precision double"
    )


def test_selection_ties(spark):
    rows = _plain(spark, (0.2, 0.8, 0.7, 0.9), (0.4, 0.8, 0.8, 0.6), (0.6, 0.8, 0.8, 0.6))
    assert one(th.best_f1_threshold(rows))["threshold"] == 0.6


def test_minimum_recall(spark):
    rows = _plain(spark, (0.2, 0.3, 1, 0.2), (0.4, 0.7, 0.8, 0.7), (0.6, 0.8, 0.7, 0.9))
    row = one(th.min_recall_threshold(rows, 0.8))
    assert row["threshold"] == 0.4 and row["eligible"]
    nothing = one(th.min_recall_threshold(rows.where("recall < 0.8"), 0.8))
    assert nothing["threshold"] is None and not nothing["eligible"]


def test_costs(spark):
    row = one(th.threshold_costs(threshold_rows(spark, (0.5, 5, 3, 2, 4)).drop("total_cost"), 10, 1))
    assert row["total_cost"] == 23.0
    tie = _plain(spark, (0.2, 0.5, 0.8, 0.5), (0.4, 0.5, 0.8, 0.6)).withColumn("total_cost", F.lit(10.0))
    assert one(th.lowest_cost_threshold(tie))["threshold"] == 0.4
    with pytest.raises(ValueError):
        th.lowest_cost_threshold(tie.drop("total_cost"))


def test_selected_thresholds_per_group(spark):
    rows = threshold_rows(spark, *A)
    two = rows.withColumn("g", F.lit("x")).unionByName(rows.withColumn("g", F.lit(None).cast("string")))
    out = th.selected_thresholds(two, 0.8, "g")
    picked = {(r["g"], r["selection"]): r["threshold"] for r in out.collect()}
    assert picked["x", "best_f1"] == 0.8 and picked[None, "minimum_recall"] == 0.1
    assert picked["x", "default_0_5"] == 0.5 and picked["x", "lowest_cost"] == 0.1
    assert len(picked) == 8
    assert rows_of(th.find_threshold(rows, 0.5 + 1e-12), "threshold") == [(0.5,)]


def _violations(df):
    return {r["violation"] for r in threshold_audit(df).collect()}


def test_audit_passes_sound_rows(spark):
    assert _violations(threshold_rows(spark, *A)) == set()


@pytest.mark.parametrize(
    "column, value, code",
    [
        ("predicted_positive_count", "999", "flagged_mismatch"),
        ("predicted_positive_rate", "0.99", "flagged_rate_mismatch"),
        ("precision", "0.99", "precision_mismatch"),
        ("recall", "0.99", "recall_mismatch"),
        ("f1", "0.99", "f1_mismatch"),
        ("true_negative", "-1", "bad_count"),
        ("false_positive", "1.5", "bad_count"),
        ("precision", "double('nan')", "rate_outside_0_1"),
        ("precision", "NULL", "rate_outside_0_1"),
        ("total_cost", "-1", "bad_cost"),
        ("total_cost", "double('inf')", "bad_cost"),
        ("true_negative", "11", "totals_differ"),
        ("threshold", "0.5", "repeated_threshold"),
    ],
)
def test_audit_finds_each_fault(spark, column, value, code):
    rows = threshold_rows(spark, *A)
    bad = rows.withColumn(column, F.expr(f"CASE WHEN threshold = 0.1 THEN {value} ELSE {column} END"))
    assert code in _violations(bad)


def test_best_model_tie_goes_to_first_name(spark):
    df = spark.createDataFrame([("z_model", 0.5), ("a_model", 0.5)], "model string, average_precision double")
    assert one(best_model(df))["model"] == "a_model"

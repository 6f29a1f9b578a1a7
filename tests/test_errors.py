from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tables import SPEC, one, rows_of, scored

from faultline.operators import errors

LABELS = [0, 0, 1, 1]
NUMERIC = SPEC.numeric


def four(spark):
    """Features of keys 10..13."""
    rows = [
        (10 + i, "LMHL"[i], 300.0 + i, 310.0 + i, 1400.0 + 100 * i, 40.0 + i, 10.0 * (i + 1))
        for i in range(4)
    ]
    columns = ("UDI", *SPEC.features)
    return spark.createDataFrame(rows, SPEC.schema(columns))


def table(spark, probabilities, threshold=0.5):
    scores = scored(spark, LABELS, probabilities).select((F.col("key") + 10).alias("UDI"), "label", "probability")
    return errors.error_table(four(spark), scores, "UDI", threshold)


def test_outcomes(spark):
    out = errors.classify_outcomes(scored(spark, LABELS, [0.1, 0.6, 0.4, 0.8]), 0.5).orderBy("key")
    assert [r["outcome"] for r in out.collect()] == [
        "true_negative", "false_positive", "false_negative", "true_positive",
    ]
    tie = errors.classify_outcomes(scored(spark, [0, 1], [0.5, 0.5]), 0.5).orderBy("key")
    assert [r["outcome"] for r in tie.collect()] == ["false_positive", "true_positive"]


def test_summaries(spark):
    df = table(spark, [0.1, 0.6, 0.4, 0.8])
    rows = {r["outcome"]: r for r in errors.outcome_summary(df).collect()}
    assert {k: (r["count"], r["percent"]) for k, r in rows.items()} == dict.fromkeys(
        ("true_negative", "false_positive", "false_negative", "true_positive"), (1, 25.0)
    )
    assert rows["false_positive"]["mean_probability"] == rows["false_positive"]["median_probability"] == 0.6
    numeric = {(r["outcome"], r["feature"]): r for r in errors.numeric_by_outcome(df, NUMERIC).collect()}
    assert len(numeric) == 4 * len(NUMERIC)
    assert numeric["false_positive", "Torque [Nm]"]["mean"] == 41.0
    assert numeric["false_positive", "Torque [Nm]"]["std"] is None
    kinds = {(r["outcome"], r["value"]): (r["count"], r["percent"]) for r in errors.category_by_outcome(df, ("Type",)).collect()}
    assert kinds["true_negative", "L"] == (1, 100.0) and kinds["false_positive", "M"] == (1, 100.0)


@pytest.mark.parametrize("group", [(), ("g",)])
def test_empty_outcomes_are_present(spark, group):
    df = table(spark, [0.1, 0.2, 0.7, 0.8]).withColumn("g", F.lit(None).cast("string"))
    rows = {r["outcome"]: r for r in errors.outcome_summary(df, group).collect()}
    for empty in ("false_positive", "false_negative"):
        assert (rows[empty]["count"], rows[empty]["percent"]) == (0, 0.0)
        assert rows[empty]["mean_probability"] is None
    numeric = errors.numeric_by_outcome(df, NUMERIC, group)
    assert numeric.count() == 4 * len(NUMERIC)
    assert numeric.where("outcome = 'false_positive' AND mean IS NULL").count() == len(NUMERIC)
    assert errors.top_errors(df, "UDI", "false_positive").count() == 0


def test_top_errors_are_descending_for_both_kinds(spark):
    df = table(spark, [0.9, 0.7, 0.2, 0.1])
    assert one(errors.top_errors(df, "UDI", "false_positive", 1))["probability"] == 0.9
    assert one(errors.top_errors(df, "UDI", "false_negative", 1))["probability"] == 0.2
    with pytest.raises(ValueError):
        errors.top_errors(df, "UDI", "false_positive", 0)


def test_top_errors_per_group_with_a_hot_group_and_large_n(spark):
    df = spark.range(5000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("g"),
        (F.col("id") % 977 / 977.0).alias("probability"),
        F.lit("false_positive").alias("outcome"),
    )
    rows = df.collect()
    for n in (3, 1500):
        got = errors.top_errors(df, "key", "false_positive", n, "g").collect()
        wanted = []
        for g in {r["g"] for r in rows}:
            held = sorted((r for r in rows if r["g"] == g), key=lambda r: (-r["probability"], r["key"]))
            wanted += held[:n]
        assert sorted(r["key"] for r in got) == sorted(r["key"] for r in wanted)


def test_mean_differences(spark):
    rows = errors.mean_differences(table(spark, [0.1, 0.6, 0.4, 0.8]), NUMERIC, "false_positive").orderBy("position").collect()
    assert [r["feature"] for r in rows] == list(NUMERIC)
    assert [r["difference"] for r in rows] == [1.0, 1.0, 100.0, 1.0, 10.0]
    empty = errors.mean_differences(table(spark, [0.1, 0.2, 0.7, 0.8]), NUMERIC, "false_positive").first()
    assert empty["error_mean"] is None and empty["difference"] is None


def test_threshold_error_summary(spark):
    from faultline.operators.metrics import threshold_sweep

    row = one(errors.threshold_error_summary(threshold_sweep(scored(spark, LABELS, [0.1, 0.6, 0.4, 0.8]), [0.5])))
    assert row["false_positive_rate"] == 25.0 and row["false_negative_rate_actual_positives"] == 50.0
    assert row["workload"] == "2 of 4 rows would be flagged for review"


def test_error_cases_for_shared_thresholds(spark):
    df = scored(spark, LABELS, [0.1, 0.6, 0.4, 0.8])
    out = errors.error_cases(df, {"a": 0.5, "b": 0.5, "c": 0.7}, ("key",))
    got = sorted(rows_of(out, "selection", "outcome", "key"))
    assert got == [
        ("a", "false_negative", 2), ("a", "false_positive", 1),
        ("b", "false_negative", 2), ("b", "false_positive", 1),
        ("c", "false_negative", 2),
    ]


def test_error_focus(spark):
    df = table(spark, [0.1, 0.6, 0.4, 0.8])
    rows = {(r["section"], r["name"], r["statistic"]): r["value"] for r in errors.error_focus(df, NUMERIC, ("Type",), "false_negative").collect()}
    assert rows["rows", "false_negative", "count"] == 1.0
    assert rows["rows", "false_negative", "percent_of_rows"] == 25.0
    assert rows["probability", "probability", "median"] == 0.4
    assert rows["numeric", "Torque [Nm]", "mean"] == 42.0
    assert rows["category", "Type=H", "percent"] == 100.0


def test_misaligned_or_repeated_keys_are_errors(spark):
    features = four(spark)
    scores = scored(spark, LABELS, [0.1] * 4).select((F.col("key") + 11).alias("UDI"), "label", "probability")
    with pytest.raises(PySparkException, match="line up"):
        errors.error_table(features, scores, "UDI", 0.5).collect()
    same = scores.withColumn("UDI", F.col("UDI") - 1)
    with pytest.raises(PySparkException, match="line up"):
        errors.error_table(features, same.unionByName(same), "UDI", 0.5).collect()

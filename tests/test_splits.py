from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from tables import SPEC, machine_rows, machine_table, one, rows_of

from faultline.operators import checks, features, models, splits


def counts(df):
    return {(r["split"], r["label"]): r["count"] for r in splits.split_class_counts(df, SPEC.target).collect()}


def test_exact_sizes_and_classes(spark):
    df = splits.stratified_split(machine_table(spark, machine_rows()), "UDI", SPEC.target)
    assert dict(rows_of(splits.split_counts(df), "split", "count")) == {"train": 60, "validation": 20, "test": 20}
    assert counts(df)["validation", 0] == 16 and counts(df)["validation", 1] == 4
    assert splits.development_set(df).count() == 80
    assert checks.split_integrity(df, "UDI").count() == 0


def test_published_class_counts():
    test = splits.class_shares({0: 9661, 1: 339}, math.ceil(0.2 * 10000))
    assert test == {0: 1932, 1: 68}
    rest = {0: 9661 - 1932, 1: 339 - 68}
    assert splits.class_shares(rest, math.ceil(0.25 * 8000)) == {0: 1932, 1: 68}


def test_same_rows_under_any_partitioning(spark):
    df = machine_table(spark, machine_rows())
    parts = [
        sorted(rows_of(splits.stratified_split(df.repartition(n), "UDI", SPEC.target), "UDI", "split"))
        for n in (1, 7, 64)
    ]
    assert parts[0] == parts[1] == parts[2]
    other = sorted(rows_of(splits.stratified_split(df, "UDI", SPEC.target, seed=7), "UDI", "split"))
    assert other != parts[0]


def test_split_is_a_row_local_expression(spark):
    df = splits.stratified_split(machine_table(spark, machine_rows()), "UDI", SPEC.target)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize(
    "labels", [[0, 0, 0, 1, 1], [0] * 6, [0, 0, 0, 1, 1, None], [0, 0, 0, 1, 1, 2], [1, 2] * 3]
)
def test_unusable_targets(spark, labels):
    df = spark.createDataFrame(list(enumerate(labels)), "k bigint, y int")
    with pytest.raises(ValueError):
        splits.stratified_split(df, "k", "y")


def test_target_check_reports_each_label(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,), (5,)], "y int")
    got = {r["label"]: (r["count"], r["violation"]) for r in checks.target_check(df, "y").collect()}
    assert got == {
        "0": (3, None), "1": (1, "too_few_rows"), "other": (1, "not_binary"), "<NA>": (1, "missing_label"),
    }


def test_split_integrity_reports_overlap(spark):
    df = spark.createDataFrame([(1, "train"), (1, "test"), (2, "train"), (2, "train"), (3, "test")], "k int, split string")
    got = {r["k"]: (r["copies"], r["violation"]) for r in checks.split_integrity(df, "k").collect()}
    assert got == {1: (2, "in_several_parts"), 2: (2, "repeated_key")}


def test_balanced_weights(spark):
    df = spark.createDataFrame([(i, y) for i, y in enumerate([0, 1, 0, 0, 1, 0])], "k int, y int")
    out = features.balanced_weights(df, "y").orderBy("k")
    assert [w for (w,) in rows_of(out, "weight")] == [0.75, 1.5, 0.75, 0.75, 1.5, 0.75]


F4 = [("L", 298.1, 40.0), ("M", 299.2, 42.0), ("H", 300.3, 44.0), ("L", 301.4, 46.0)]


def test_scaling_uses_training_rows_and_population_std(spark):
    train = spark.createDataFrame(F4, "Type string, air double, torque double").withColumn("flat", F.lit(2.0))
    new = spark.createDataFrame([("Z", 300.3, 43.0, 5.0)], "Type string, air double, torque double, flat double")
    row = one(features.standard_scale(train, new, ("air", "torque", "flat")))
    std = math.sqrt(sum((x - 43) ** 2 for x in (40, 42, 44, 46)) / 4)
    assert row["torque"] == 0.0 and row["flat"] == 3.0
    back = features.standard_scale(train, train, ("torque",)).orderBy("torque").first()
    assert back["torque"] == pytest.approx(-3 / std)


def test_one_hot_knows_training_levels_only(spark):
    train = spark.createDataFrame([(r[0],) for r in F4], "Type string")
    new = spark.createDataFrame([("H",), ("Z",), (None,)], "Type string")
    rows = features.one_hot(train, new, ("Type",)).collect()
    assert [tuple(r)[1:] for r in rows] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]
    assert rows[0].__fields__[1:] == ["Type=H", "Type=L", "Type=M"]


def test_preparation_handles_missing_and_unknown(spark):
    table = machine_table(spark, machine_rows(40, 31))
    prepared = features.preparation(SPEC).fit(table)
    new = table.limit(2).withColumns({"Type": F.lit("Z"), "Torque [Nm]": F.lit(None).cast("double")})
    vectors = [r["features"].toArray() for r in prepared.transform(new).collect()]
    assert all(len(v) == 5 + 5 + 3 for v in vectors)
    assert all(v[5:10].sum() == 1.0 and v[10:].sum() == 0.0 for v in vectors)


def test_prior_scores(spark):
    df = machine_table(spark, machine_rows())
    out = models.prior_scores(df, df, SPEC.target).select("probability", "prediction").distinct()
    assert one(out) == {"probability": 0.2, "prediction": 0}

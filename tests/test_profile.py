from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F
from tables import SPEC, TARGET, THREE, TORQUE, TYPE, changed, machine_table, one, rows_of

from faultline.functions.ordering import exact_quantiles
from faultline.operators import checks, explore, profile


def metrics_of(df):
    return dict(rows_of(profile.dataset_summary(df), "metric", "value"))


def test_summary_and_duplicates(spark):
    assert metrics_of(machine_table(spark, THREE)) == {"row_count": 3, "column_count": 14, "duplicate_row_count": 0}
    repeated = machine_table(spark, [*THREE, THREE[0], THREE[0]])
    assert metrics_of(repeated)["duplicate_row_count"] == 2
    gaps = machine_table(spark, changed([*THREE, THREE[0]], r0c6=None, r3c6=None))
    assert one(profile.duplicate_rows(gaps))["duplicate_row_count"] == 1


def test_missing_values(spark):
    for gap in (None, float("nan")):
        df = machine_table(spark, changed(THREE, **{f"r0c{TORQUE}": gap}))
        rows = profile.missing_values(df, SPEC).orderBy("position").collect()
        assert [r["column"] for r in rows] == list(SPEC.required)
        found = {r["column"]: (r["missing_count"], r["missing_percent"], r["role"]) for r in rows}
        assert found["Torque [Nm]"] == (1, 33.33, "numeric")
        assert sum(v[0] for v in found.values()) == 1


def test_target_summary(spark):
    rows = {r["label"]: r for r in profile.target_summary(machine_table(spark, THREE), SPEC.target).collect()}
    assert (rows["0"]["count"], rows["0"]["percent"], rows["1"]["percent"]) == (2, 66.67, 33.33)
    assert rows["0"]["imbalance_ratio"] == 2.0
    zeros = one(profile.target_summary(machine_table(spark, changed(THREE, r2c8=0)), SPEC.target))
    assert (zeros["label"], zeros["count"], zeros["imbalance_ratio"]) == ("0", 3, None)
    gap = profile.target_summary(machine_table(spark, changed(THREE, r0c8=None)), SPEC.target)
    assert sorted(rows_of(gap, "label", "count", "percent")) == [("0", 1, 50.0), ("1", 1, 50.0)]


def test_numeric_summary(spark):
    row = profile.numeric_summary(machine_table(spark, THREE), SPEC.numeric).where("feature = 'Torque [Nm]'").first()
    values = [42.8, 46.3, 50.0]
    assert row["mean"] == pytest.approx(statistics.mean(values))
    assert row["std"] == pytest.approx(statistics.stdev(values))
    assert (row["min"], row["median"], row["max"]) == (42.8, 46.3, 50.0)
    assert row["q1"] == pytest.approx(44.55) and row["q3"] == pytest.approx(48.15)


def test_non_finite_statistics_are_missing(spark):
    inf = float("inf")
    df = machine_table(spark, changed(THREE, r0c6=inf, r1c6=-inf, r2c6=float("nan")))
    row = profile.numeric_summary(df, ("Torque [Nm]",)).first().asDict()
    assert all(row[c] is None for c in ("mean", "std", "min", "q1", "median", "q3", "max"))
    gone = machine_table(spark, changed(THREE, r0c6=None, r1c6=None, r2c6=None))
    row = one(profile.numeric_summary(gone, ("Torque [Nm]",)))
    assert (row["count"], row["missing"], row["median"]) == (0, 3, None)


def test_categorical_summary(spark):
    df = machine_table(spark, changed(THREE, r0c2=None, r1c2=None, r2c2=None))
    assert rows_of(profile.categorical_summary(df, ("Type",)), "value", "count", "percent") == [("<NA>", 3, 100.0)]


def test_constant_and_unexpected(spark):
    rows = profile.constant_columns(machine_table(spark, THREE)).orderBy("position")
    assert [c for (c,) in rows_of(rows, "column")] == ["HDF", "PWF", "OSF", "RNF"]
    gone = machine_table(spark, changed(THREE, r0c6=None, r1c6=None, r2c6=None))
    assert "Torque [Nm]" in [c for (c,) in rows_of(profile.constant_columns(gone), "column")]
    half = machine_table(spark, changed(THREE, r0c9=None, r1c9=1))
    assert "TWF" not in [c for (c,) in rows_of(profile.constant_columns(half), "column")]
    odd = profile.unexpected_categories(machine_table(spark, changed(THREE, r0c2="X", r1c2=None)), SPEC)
    assert rows_of(odd, "column", "value", "count") == [("Type", "X", 1)]


def codes(df):
    return [c for (c,) in rows_of(profile.data_warnings(df, SPEC).orderBy("ord"), "code")]


def test_warnings(spark):
    assert codes(machine_table(spark, THREE)) == ["constant_columns"]
    many = machine_table(spark, [THREE[0]] * 20 + [THREE[2]])
    assert codes(many) == ["imbalanced_target", "duplicate_rows", "constant_columns"]
    message = profile.data_warnings(many, SPEC).where("code = 'imbalanced_target'").first()["message"]
    assert message.endswith("20.00")
    assert "one_target_class" in codes(machine_table(spark, changed(THREE, r2c8=0)))
    gaps = codes(machine_table(spark, changed(THREE, r0c8=None, r1c8=None, r2c8=None, r0c2="X")))
    assert gaps == ["missing_target", "no_target_class", "missing_cells", "constant_columns", "unexpected_categories"]


def test_profile_has_every_table(spark):
    tables = profile.profile_dataset(machine_table(spark, THREE), SPEC)
    assert all(df.count() >= 0 for df in tables.values()) and len(tables) == 9
    assert tables["schema_summary"].count() == 14


def interpolate(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.mark.parametrize("buckets", [None, 2, 5, 64])
@pytest.mark.parametrize("few", [None, True, False])
def test_exact_quantiles_with_hot_values_and_groups(spark, buckets, few):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        g = "hot" if i % 2 else rng.choice(["a", None])
        x = 5.0 if rng.random() < 0.4 else rng.gauss(0, 10)
        y = None if rng.random() < 0.1 else float(rng.randint(0, 3))
        rows.append((g, x, y))
    rows += [("one", 1.5, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(6)
    wanted = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q99": 0.99}
    out = exact_quantiles(df, ["x", "y"], wanted, ["g"], few, buckets)
    got = {(r["g"], r["feature"]): r for r in out.collect()}
    for g in ("hot", "a", None, "one"):
        for at, feature in ((1, "x"), (2, "y")):
            values = [r[at] for r in rows if r[0] == g and r[at] is not None]
            row = got.get((g, feature))
            if not values:
                assert row is None or row["q50"] is None
                continue
            for name, p in wanted.items():
                assert row[name] == pytest.approx(interpolate(values, p), abs=1e-12)


def test_bucketed_numeric_summary_equals_plain(spark):
    df = spark.range(3000).select(
        (F.col("id") % 7).alias("g"),
        (F.sin("id") * 100).alias("x"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 11).cast("double").alias("y"),
    )
    def shown(out):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in out.collect())

    assert shown(profile.numeric_summary(df, ("x", "y"), "g")) == shown(
        profile.numeric_summary(df, ("x", "y"), "g", buckets=9)
    )


def test_exploration(spark):
    df = spark.createDataFrame(
        [(0, "L", 1.0, 2.0), (0, "L", 2.0, 4.0), (1, "M", 3.0, None), (1, None, 100.0, 8.0), (0, "L", 4.0, 8.0)],
        "y int, kind string, a double, b double",
    )
    rates = {r["value"]: (r["count"], r["percent"], r["failure_percent"]) for r in explore.category_rates(df, "kind", "y").collect()}
    assert rates == {"L": (3, 60.0, 0.0), "M": (1, 20.0, 100.0), "<NA>": (1, 20.0, 100.0)}
    assert sorted(rows_of(explore.target_table(df, "y"), "label", "count", "percent")) == [("0", 3, 60.0), ("1", 2, 40.0)]
    r = {(x, y): v for x, y, v in rows_of(explore.correlation_matrix(df, ("a", "b", "y")), "x", "y", "r")}
    assert len(r) == 9 and r["a", "a"] == pytest.approx(1.0) and r["a", "b"] == r["b", "a"]
    box = {f["feature"]: f for f in explore.box_stats(df, ("a", "b")).collect()}
    assert (box["a"]["outliers"], box["a"]["upper_whisker"]) == (1, 4.0)
    counts = dict(rows_of(explore.outlier_counts(df, ("a", "b")), "feature", "outliers"))
    assert counts == {"a": 1, "b": 0}
    by_group = explore.outlier_counts(df.withColumn("g", F.lit(None).cast("string")), ("a", "b"), "g")
    assert dict(rows_of(by_group, "feature", "outliers")) == counts
    bars = explore.histogram(df.withColumn("c", F.lit(3.0)), ("a", "c"), 4)
    got = {(f, b): n for f, b, n in rows_of(bars, "feature", "bin", "count")}
    assert [got["a", i] for i in range(4)] == [4, 0, 0, 1]
    assert [got["c", i] for i in range(4)] == [5, 0, 0, 0]
    assert explore.head(df, "a", 2).count() == 2


def test_leakage_review_measures_the_leak(spark):
    rows = {r["column"]: r for r in explore.leakage_review(machine_table(spark, THREE), SPEC).collect()}
    assert (rows["TWF"]["rows_set"], rows["TWF"]["failure_rate_set"]) == (1, 1.0)
    assert rows["RNF"]["rows_set"] == 0 and rows["RNF"]["failure_rate_set"] is None


def test_structure_checks(spark):
    df = machine_table(spark, THREE[:1])
    checks.require_structure(df, SPEC)
    with pytest.raises(ValueError, match="Type, TWF"):
        checks.require_structure(df.drop("Type", "TWF"), SPEC)
    with pytest.raises(ValueError, match="duplicate columns: Type"):
        checks.require_structure(df.select("*", "Type"), SPEC)
    with pytest.raises(ValueError, match="no rows"):
        checks.require_structure(df.limit(0), SPEC)
    with pytest.raises(ValueError, match="no columns"):
        checks.require_rows(df.select())
    assert checks.repeated_names(["a", "b", "a", "c", "b", "a"]) == ["a", "b"]


def test_feature_projection_has_no_leaks(spark):
    out = checks.feature_projection(machine_table(spark, THREE), SPEC)
    assert out.columns == ["UDI", *SPEC.features, SPEC.target]
    assert TYPE == 2 and TARGET == 8


@pytest.mark.parametrize("known_prints", [1_000_000, 0])
def test_duplicates_are_compared_in_full(spark, known_prints):
    rows = [(1, None, 0.0), (None, 1, -0.0), (1, None, -0.0), (2, 2, float("nan")), (2, 2, float("nan")), (3, 3, None)]
    df = spark.createDataFrame(rows, "`a.b` int, `_n` int, c double")
    assert one(profile.duplicate_rows(df, known_prints))["duplicate_row_count"] == 2
    assert one(profile.duplicate_rows(df.limit(0), known_prints))["duplicate_row_count"] == 0
    held = {r["metric"]: r["value"] for r in profile.dataset_summary(df).collect()}
    assert held == {"row_count": 6, "column_count": 3, "duplicate_row_count": 2}


def test_equal_prints_of_unlike_rows_are_no_duplicates(spark, monkeypatch):
    same = lambda df: [F.lit(7).alias("_print1"), F.lit(7).alias("_print2")]
    monkeypatch.setattr(profile, "row_print", same)
    df = spark.createDataFrame([(1, "x"), (1, "y"), (1, "x")], "a int, b string")
    assert one(profile.duplicate_rows(df))["duplicate_row_count"] == 1


def test_maps_count_as_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (map('a', 1)), (map('a', 1)), (map('b', 1)) t(m)")
    assert one(profile.duplicate_rows(df))["duplicate_row_count"] == 1

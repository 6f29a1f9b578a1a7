"""Refused rows, ordinary but awkward tables, equal results for any number of buckets."""

from __future__ import annotations

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tables import SPEC

from faultline.functions.ordering import exact_quantiles
from faultline.functions.settle import checkpoint_dir
from faultline.operators import errors, explore, features, metrics, models, profile, scoring, splits
from faultline.plans import workflows
from faultline.sources.tables import conform, load_table
from faultline.spec import DatasetSpec

BAD_SCORES = (None, float("nan"), float("inf"), -0.1, 1.1)


def scored(spark, label, probability):
    rows = [(1, 0.0, 0.2), (2, 1.0, 0.9), (3, label, probability)]
    return spark.createDataFrame(rows, "k long, label double, probability double").coalesce(1)


JUDGES = {
    "sweep": lambda df: metrics.threshold_sweep(df),
    "metrics": lambda df: metrics.classification_metrics(df),
    "report": lambda df: metrics.classification_report(df),
    "evaluate": lambda df: metrics.evaluate_models(df, ()),
    "curve": lambda df: metrics.pr_curve(df),
    "ranking": lambda df: metrics.ranking_metrics(df),
    "ranking_by_bucket": lambda df: metrics.ranking_metrics(df, buckets=3),
    "outcomes": lambda df: errors.classify_outcomes(df, 0.5),
    "cases": lambda df: errors.error_cases(df, {"a": 0.5}, ("k",)),
}


@pytest.mark.parametrize("judge", JUDGES)
def test_scored_rows_are_checked_where_they_are_used(spark, judge):
    JUDGES[judge](scored(spark, 1.0, 0.5)).collect()
    for label, probability in [(1.0, p) for p in BAD_SCORES] + [(None, 0.5), (2.0, 0.5), (float("nan"), 0.5)]:
        with pytest.raises(PySparkException, match="has to be"):
            JUDGES[judge](scored(spark, label, probability)).collect()


def test_predictions_other_than_0_and_1_are_refused(spark):
    with pytest.raises(PySparkException, match="predictions"):
        metrics.confusion_matrix(scored(spark, 1.0, 0.5), F.lit(2)).collect()


def test_error_table_refuses_keys_that_do_not_line_up(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 6.0)], "k long, x double")
    good = spark.createDataFrame([(1, 0, 0.2), (2, 1, 0.9)], "k long, label int, probability double")
    assert errors.error_table(rows, good, "k", 0.5).columns[:2] == ["k", "x"]
    assert {r["outcome"] for r in errors.error_table(rows, good, "k", 0.5).collect()} == {
        "true_negative",
        "true_positive",
    }
    for left, right in ((rows.where("k = 1"), good), (rows, good.where("k = 1")), (rows, good.union(good)), (rows.union(rows), good)):
        with pytest.raises(PySparkException, match="line up"):
            errors.error_table(left, right, "k", 0.5).collect()


def awkward(spark):
    rows = [("all_missing", None), ("all_missing", None), ("fence", None)]
    rows += [("fence", x) for x in (0.04, 0.28, 0.39, 0.44, 0.56, 0.57, 0.6, 0.62)]
    rows += [("hot", 7.5)] * 300 + [("hot", float(i) / 7) for i in range(60)]
    rows += [("ends", x) for x in (-math.inf, math.inf, 1.0, 2.0, 3.0, float("nan"))]
    rows += [("one", 3.25)]
    return spark.createDataFrame(rows, "g string, x double").repartition(5)


RANKED = {
    "quantiles": lambda df, n: exact_quantiles(df, ["x"], {"a": 0.1, "b": 0.25, "c": 0.5, "d": 0.9}, ["g"], buckets=n),
    "summary": lambda df, n: profile.numeric_summary(df, ["x"], "g", buckets=n).drop("mean", "std"),
    # The metrics are sums of doubles, the counts below them are exact.
    "curve": lambda df, n: metrics.score_curve(
        df.where("x BETWEEN 0 AND 8").selectExpr("g", "x / 8 AS probability", "int(hash(x) % 2 = 0) AS label"),
        group_by="g",
        buckets=n,
    ),
}


@pytest.mark.parametrize("name", RANKED)
def test_any_number_of_buckets_gives_the_same_bits(spark, name):
    df = awkward(spark)
    found = [sorted(map(repr, RANKED[name](df, n).collect())) for n in (None, 1, 2, 64)]
    assert found[0] == found[1] == found[2] == found[3]


def test_groups_without_a_value_keep_their_row(spark):
    for few in (None, True, False):
        got = {r["g"]: r["m"] for r in exact_quantiles(awkward(spark), ["x"], {"m": 0.5}, ["g"], few).collect()}
        assert got.keys() == {"all_missing", "fence", "hot", "ends", "one"} and got["all_missing"] is None


@pytest.mark.parametrize("buckets", [1, 2, 64])
def test_a_value_on_the_fence_is_judged_alike(spark, monkeypatch, buckets):
    from faultline.functions import ordering

    monkeypatch.setattr(ordering, "bucket_count", lambda df, n=None: buckets)
    got = {r["g"]: r["outliers"] for r in explore.outlier_counts(awkward(spark), ["x"], "g").collect()}
    assert got["fence"] == 0


@pytest.mark.parametrize("sorted_rows, digits", [(100_000, 2), (3, 1), (1, 2)])
def test_split_is_the_same_however_the_cut_is_found(spark, monkeypatch, sorted_rows, digits):
    df = spark.range(500).selectExpr("id", "int(id % 5 = 0) AS y")
    wanted = {r["id"]: r["split"] for r in splits.stratified_split(df, "id", "y").collect()}
    monkeypatch.setattr(splits, "SORTED_ROWS", sorted_rows)
    monkeypatch.setattr(splits, "DIGITS", digits)
    assert {r["id"]: r["split"] for r in splits.stratified_split(df, "id", "y").collect()} == wanted


PLAIN = DatasetSpec(key="k", target="y", identifiers=("k",), categorical=(), numeric=("x",))


def test_a_table_without_categories_or_leaks_is_profiled(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 1, 2.0)], "k long, y int, x double")
    for report in profile.profile_dataset(df, PLAIN).values():
        report.collect()
    assert profile.unexpected_categories(df, PLAIN).count() == 0
    assert profile.categorical_summary(df, ()).count() == 0
    assert explore.leakage_review(df, PLAIN).count() == 0
    assert profile.numeric_summary(df, ()).count() == 0


def test_nan_in_a_whole_number_column_is_missing(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 0.0, 1.0), (2.0, float("nan"), 2.0)], "k double, y double, x double")
    assert [r["y"] for r in conform(df, PLAIN).orderBy("k").collect()] == [0, None]


def test_csv_is_known_by_name_or_by_word(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 1.0), (2, 1, 2.0)], "k long, y int, x double")
    rows.coalesce(1).write.option("header", True).csv(str(tmp_path / "folder"))
    rows.coalesce(1).write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "g"))
    packed = next((tmp_path / "g").glob("*.csv.gz"))
    assert load_table(spark, str(tmp_path / "folder"), PLAIN, "csv").count() == 2
    assert load_table(spark, str(packed), PLAIN).count() == 2
    with pytest.raises(ValueError, match="format"):
        load_table(spark, str(packed), PLAIN, "xml")


def test_a_feature_without_any_value_can_be_fitted(spark):
    rows = [(i, i % 2, None, float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, y int, x double, z double")
    spec = DatasetSpec(key="k", target="y", identifiers=("k",), categorical=(), numeric=("x", "z"))
    assert features.training_medians(df, spec) == {"x": 0.0, "z": 9.5}
    model = models.fit_model(models.LOGISTIC, df, spec)
    assert models.score(model, df).where("probability BETWEEN 0 AND 1").count() == 20


def test_predictions_need_the_key(spark):
    rows = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError, match="key"):
        scoring.predict(None, rows, PLAIN, 0.5)


def test_studied_thresholds_keep_their_names_apart(spark):
    assert list(workflows.study_thresholds(None, [0.501, 0.504, 0.7]).values()) == [0.501, 0.504, 0.7]


def test_category_of_many_values(spark):
    df = spark.range(100_000).selectExpr("'true_negative' AS outcome", "string(id) AS c", "id % 2 AS g")
    assert errors.category_by_outcome(df, ["c"]).agg(F.sum("percent")).first()[0] == pytest.approx(100)
    plan = errors.category_by_outcome(df, ["c"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    grouped = errors.category_by_outcome(df, ["c"], "g")
    assert "_salt" in grouped._jdf.queryExecution().executedPlan().toString()
    assert grouped.agg(F.sum("percent")).first()[0] == pytest.approx(200)


def test_correlation_does_not_copy_rows(spark):
    df = spark.range(50).selectExpr("double(id) AS a", "id * 2D AS b", "double(id % 3) AS c")
    found = explore.correlation_matrix(df, ("a", "b", "c"))
    below = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in below and "Expand" not in below
    assert below.count("Range (") == 1
    assert {(r["x"], r["y"]): round(r["r"], 9) for r in found.collect()}["a", "b"] == 1


def test_warnings_read_the_table_once(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 1.0)] * 3 + [(2, 1, None)], "k long, y int, x double")
    df.write.parquet(str(tmp_path / "t"))
    found = profile.data_warnings(spark.read.parquet(str(tmp_path / "t")), PLAIN)
    codes = [r["code"] for r in found.orderBy("ord").collect()]
    assert codes == ["duplicate_rows", "missing_cells"]
    final = found._jdf.queryExecution()
    found.collect()
    plan = final.executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") <= 2


def test_checkpoints_go_to_a_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_dir(spark) == named or checkpoint_dir(spark).startswith(
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    )


def test_run_results_hold_counts_and_best_model(spark):
    df = spark.range(200).selectExpr(
        "id AS k", "int(id % 4 = 0) AS y", "double(id % 4) + (id % 7) / 10D AS x"
    )
    run = workflows.comparison_run(df, PLAIN, models.BASELINE_MODELS)
    assert {r["split"]: r["count"] for r in run["split_counts"].collect()} == {"train": 120, "validation": 40, "test": 40}
    assert run["class_counts"].count() == 6
    assert run["best_model"].first()["model"] == models.LOGISTIC
    assert run["model_comparison"].where("training_seconds > 0").count() == 2


def test_spec_of_the_readings_is_unchanged():
    assert SPEC.key in SPEC.identifiers

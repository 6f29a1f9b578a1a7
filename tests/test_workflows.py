from __future__ import annotations

import hashlib
import os

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.sql import functions as F
from tables import SPEC, machine_rows, machine_table, one, rows_of, scored

from faultline.functions.columns import col
from faultline.operators import artifact, importance, models
from faultline.operators.boosting import LeafwiseBoosting
from faultline.operators.checks import metadata_audit
from faultline.operators.metrics import average_precision
from faultline.operators.scoring import predict_scored
from faultline.plans import workflows
from faultline.sources.tables import load_prediction_input
from faultline.spec import DatasetSpec
from faultline.streaming.scoring import (
    flag_bad_scores,
    read_feature_stream,
    score_stream,
    write_predictions,
)


def _tree(weight_sum):
    return DecisionTreeClassifier(labelCol="_label", weightCol="weight", maxDepth=3, seed=42)


def _boosting(weight_sum):
    return GBTClassifier(labelCol="_label", weightCol="weight", maxIter=3, maxDepth=3, seed=42)


QUICK = {**models.BASELINE_MODELS, models.FOREST: _tree, models.BOOSTING: _boosting}


@pytest.fixture(scope="module")
def table(spark):
    return machine_table(spark, machine_rows()).cache()


@pytest.fixture(scope="module")
def saved(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("artifact"))
    metadata = workflows.build_artifact(table, SPEC, path, QUICK)
    return path, metadata


def test_registries():
    assert list(models.BASELINE_MODELS) == [models.PRIOR, models.LOGISTIC]
    assert list(models.COMPARISON_MODELS) == [models.PRIOR, models.LOGISTIC, models.FOREST, models.BOOSTING]
    with pytest.raises(ValueError, match="unknown model"):
        models.build_pipeline("other", SPEC)


def test_fresh_pipelines(spark):
    a, b = (models.build_pipeline(models.LOGISTIC, SPEC) for _ in range(2))
    assert a is not b and a.getStages()[1] is not b.getStages()[1]


def test_prior_model_answers_class_frequencies(table):
    model = models.fit_model(models.PRIOR, table, SPEC)
    got = models.score(model, table).select("probability").distinct()
    assert one(got)["probability"] == pytest.approx(0.2)


def test_model_comparison_orders_models(table):
    rows = {r["model"]: r for r in workflows.model_comparison(table, SPEC, QUICK).collect()}
    assert set(rows) == set(QUICK)
    assert rows[models.PRIOR]["average_precision"] == pytest.approx(0.2)
    assert rows[models.PRIOR]["roc_auc"] == 0.5
    for name in (models.LOGISTIC, models.FOREST, models.BOOSTING):
        assert rows[name]["average_precision"] > 0.9
        assert rows[name]["training_seconds"] > 0
        assert sum(rows[name][c] for c in ("true_negative", "false_positive", "false_negative", "true_positive")) == 20


def test_baselines(table):
    assert workflows.baseline_training(table, SPEC).count() == 2


def test_threshold_analysis_ignores_test_rows(spark, table):
    """Spoiling the features of test rows changes no validation result."""
    first = workflows.threshold_analysis(table, SPEC, models.FOREST, available=QUICK)
    marked = workflows.prepare_table(table, SPEC)
    spoilt = marked.withColumn(
        "Torque [Nm]", F.when(F.col("split") == "test", F.lit(-1e6)).otherwise(col("Torque [Nm]"))
    ).drop("split")
    second = workflows.threshold_analysis(spoilt, SPEC, models.FOREST, available=QUICK)
    for name in first:
        assert first[name].orderBy("threshold").collect() == second[name].orderBy("threshold").collect()
    assert first["threshold_metrics"].count() == 19
    assert first["selected_thresholds"].count() == 4


def test_arguments_are_checked_before_any_fit(table):
    def explode(weight_sum):
        raise AssertionError("fitted")

    never = dict.fromkeys(QUICK, explode)
    for call in (
        lambda: workflows.threshold_analysis(table, SPEC, minimum_recall=2, available=never),
        lambda: workflows.recommend_profiles(table, SPEC, minimum_precision=-1, available=never),
        lambda: workflows.recommend_profiles(table, SPEC, false_negative_cost=1, available=never),
        lambda: workflows.error_analysis(table, SPEC, top_n=0, available=never),
        lambda: workflows.explain(table, SPEC, repeats=0, available=never),
        lambda: workflows.threshold_analysis(table, SPEC, "other", available=never),
    ):
        with pytest.raises(ValueError):
            call()


def test_error_analysis(table):
    reports = workflows.error_analysis(table, SPEC, models.LOGISTIC, [0.5, 0.05], 3, QUICK)
    names = {r["selection"] for r in reports["threshold_error_summary"].collect()}
    assert names == {"threshold_0_5", "threshold_0_05"}
    assert reports["outcome_summary"].count() == 8
    assert reports["numeric_by_outcome"].count() == 2 * 4 * 5
    assert {"false_positive_summary", "top_false_negatives", "false_negative_mean_differences"} <= set(reports)
    for df in reports.values():
        df.collect()
    four = workflows.study_thresholds(scored_frame(table))
    assert list(four) == ["default_0_5", "best_f1", "minimum_recall", "lowest_cost"]


def scored_frame(table):
    return table.select(
        col(SPEC.target).alias("label"), (col("Torque [Nm]") / 60).alias("probability")
    )


def test_explain_ranks_the_telling_feature_first(table):
    reports = workflows.explain(table, SPEC, models.FOREST, 2, QUICK)
    rows = reports["feature_importance"].orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 7))
    assert rows[0]["feature"] in ("Torque [Nm]", "Air temperature [K]", "Process temperature [K]", "Rotational speed [rpm]", "Tool wear [min]")
    assert {r["feature"] for r in rows} == set(SPEC.features)
    assert one(reports["baseline"])["average_precision"] > 0.9


def test_ranking_of_importance(spark):
    df = spark.createDataFrame([("b", 0.2, 0.0), ("a", 0.2, 0.0), ("c", 0.4, 0.0)], "feature string, importance_mean double, importance_std double")
    out = importance.rank_importance(df).orderBy("rank")
    assert rows_of(out, "rank", "feature") == [(1, "c"), (2, "a"), (3, "b")]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 100, 101, 4096, 5000, 65537])
def test_receivers_are_a_bijection(n):
    ranks = np.arange(n)
    for repeat in (1, 2):
        to = importance.receivers(ranks, importance.round_keys("f", repeat, 42), n)
        assert np.array_equal(np.sort(to), ranks)
    a, b = importance.sides(n)
    assert n <= a * b < n + a
    if n > 4000:
        # Givers and receivers are as far apart as in a random order: a third of the table.
        assert abs(np.abs(to - ranks).mean() / n - 1 / 3) < 0.02
        assert abs(np.corrcoef(to, ranks)[0, 1]) < 0.05
        half = importance.receivers(ranks[: n // 3], importance.round_keys("f", 2, 42), n)
        assert np.array_equal(half, to[: n // 3])


@pytest.mark.parametrize("range_rows", [50_000, 10])
def test_numbers_are_ranks_of_hashes(spark, monkeypatch, range_rows):
    monkeypatch.setattr(importance, "RANGE_ROWS", range_rows)
    keys = spark.range(500).repartition(7).select(F.col("id").alias("a key"))
    found = {r["a key"]: r["_rank"] for r in importance.numbered(keys, "a key", 500).collect()}
    order = sorted(range(500), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    assert found == {k: rank for rank, k in enumerate(order)}


def test_permuted_copies_are_permutations(table):
    base = table.select("UDI", col(SPEC.target).alias("label"), *[col(f) for f in SPEC.features])
    copies = importance.permuted_copies(base, "UDI", ("Type", "Torque [Nm]"), 2).collect()
    assert len(copies) == 100 * (1 + 2 * 2)
    original = {r["UDI"]: r for r in copies if r["feature"] is None}
    for feature, other in (("Type", "Torque [Nm]"), ("Torque [Nm]", "Type")):
        for repeat in (1, 2):
            rows = [r for r in copies if r["feature"] == feature and r["repeat"] == repeat]
            assert sorted(str(r[feature]) for r in rows) == sorted(str(r[feature]) for r in original.values())
            assert all(r[other] == original[r["UDI"]][other] and r["label"] == original[r["UDI"]]["label"] for r in rows)
            assert any(r[feature] != original[r["UDI"]][feature] for r in rows)


def test_importance_of_a_constant_score_is_zero(spark, table):
    base = table.select("UDI", col(SPEC.target).alias("label"), *[col(f) for f in SPEC.features])
    out = importance.permutation_importance(
        base, "UDI", SPEC.features, lambda df: df.withColumn("probability", F.lit(0.3)), 2
    )
    assert all(r["importance_mean"] == 0.0 and r["importance_std"] == 0.0 for r in out.collect())
    assert one(average_precision(base.withColumn("probability", F.lit(0.3))))["average_precision"] == pytest.approx(0.2)


def test_final_evaluation(table):
    reports = workflows.final_evaluation(table, SPEC, models.BOOSTING, QUICK)
    rows = {r["operating_point"]: r for r in reports["final_evaluation"].collect()}
    assert set(rows) == {"default_0_5", "selected_balanced_threshold"}
    assert rows["default_0_5"]["true_negative"] + rows["default_0_5"]["false_positive"] == 16
    assert rows["default_0_5"]["roc_auc"] == rows["selected_balanced_threshold"]["roc_auc"]
    assert len(reports["final_evaluation"].columns) == 14
    assert reports["class_counts"].count() == 6


def test_final_rows_of_the_fixed_case(spark):
    rows = {r["operating_point"]: r for r in workflows.final_evaluation_rows(scored(spark, [0, 1], [0.4, 0.7]), 0.8).collect()}
    low, high = rows["default_0_5"], rows["selected_balanced_threshold"]
    assert low["roc_auc"] == low["average_precision"] == low["accuracy"] == low["f1"] == 1.0
    assert (high["true_negative"], high["false_negative"], high["precision"], high["recall"], high["f1"], high["accuracy"]) == (1, 1, 0.0, 0.0, 0.0, 0.5)


def test_repeated_keys_are_refused(table):
    twice = table.unionByName(table)
    with pytest.raises(ValueError):
        workflows._development(workflows.prepare_table(twice, SPEC), SPEC)


def test_artifact_round_trip(spark, table, saved):
    path, metadata = saved
    assert metadata["development_row_count"] == 80
    assert metadata["development_class_distribution"] == {"0": 64, "1": 16}
    model, read = artifact.load_artifact(spark, path, SPEC)
    assert read == metadata and 0 < read["operating_threshold"] < 1
    rows = table.select("UDI", *[col(f) for f in SPEC.features])
    predictions, report = workflows.batch_prediction(spark, rows, path, SPEC, path + "/predictions")
    assert report["prediction_count"] == 100 and predictions.count() == 100
    assert predictions.columns == ["UDI", "failure_probability", "predicted_failure"]
    t = read["operating_threshold"]
    assert predictions.where(f"predicted_failure <> int(failure_probability >= {t!r}D)").count() == 0
    gaps = rows.withColumn("Torque [Nm]", F.lit(None).cast("double"))
    assert workflows.batch_prediction(spark, gaps, path, SPEC)[0].where("failure_probability IS NULL").count() == 0


def test_changed_model_is_refused(spark, table, saved, tmp_path):
    path, metadata = saved
    model, _ = artifact.load_artifact(spark, path, SPEC)
    copy = str(tmp_path / "copy")
    artifact.save_artifact(spark, model, metadata, copy, SPEC)
    for folder, _, files in os.walk(copy + "/model"):
        for name in files:
            if name.startswith("part-") and "metadata" in folder:
                with open(os.path.join(folder, name), "a") as file:
                    file.write(" ")
                crc = os.path.join(folder, f".{name}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
    with pytest.raises(ValueError, match="checksum"):
        artifact.load_artifact(spark, copy, SPEC)


@pytest.mark.parametrize(
    "field, value, violation",
    [
        ("artifact_version", "1.0", "version_format"),
        ("artifact_version", "2.0.0", "version_unsupported"),
        ("model_name", "other", "model_name"),
        ("operating_profile", "high_recall", "operating_profile"),
        ("target_column", "other", "target_column"),
        ("model_features", ["Type"], "model_features"),
        ("numerical_features", [], "numerical_features"),
        ("categorical_features", None, "categorical_features"),
        ("excluded_identifier_columns", ["UDI"], "identifiers"),
        ("excluded_leakage_columns", ["TWF"], "leakage_columns"),
        ("operating_threshold", 1.0, "threshold"),
        ("operating_threshold", float("nan"), "threshold"),
        ("random_seed", 7, "random_seed"),
        ("development_row_count", 0, "row_count"),
        ("development_class_distribution", {"0": 80}, "class_names"),
        ("development_class_distribution", {"0": 81, "1": -1}, "class_counts"),
        ("development_class_distribution", {"0": 64, "1": 15}, "class_sum"),
        ("training_timestamp_utc", "yesterday", "timestamp"),
        ("training_timestamp_utc", "2024-05-01T10:00:00", "timestamp"),
        ("training_timestamp_utc", "2024-05-01T10:00:00+02:00", "timestamp"),
        ("python_version", " ", "versions"),
        ("project_package_version", "0.0.1", "package_version"),
        ("model_sha256", "abc", "checksum"),
    ],
)
def test_each_metadata_rule(spark, field, value, violation):
    good = {**artifact.build_metadata(SPEC, 0.8, {0: 64, 1: 16}), "model_sha256": "0" * 64}
    assert metadata_audit(artifact.metadata_frame(spark, good), SPEC).count() == 0
    bad = artifact.metadata_frame(spark, {**good, field: value})
    assert violation in {v for (v,) in rows_of(metadata_audit(bad, SPEC), "violation")}
    with pytest.raises(ValueError):
        artifact.require_metadata(spark, {**good, field: value}, SPEC)


def test_fixed_scores_keep_their_keys(spark):
    df = spark.createDataFrame([(101, 0.05), (105, 0.81), (109, 0.8)], "UDI bigint, probability double")
    assert rows_of(predict_scored(df, "UDI", 0.8), "UDI", "predicted_failure") == [(101, 0), (105, 1), (109, 1)]


def test_stream_gives_the_batch_predictions(spark, table, saved, tmp_path):
    path, metadata = saved
    model, _ = artifact.load_artifact(spark, path, SPEC)
    rows = table.select("UDI", *[col(f) for f in SPEC.features])
    source = str(tmp_path / "in")
    rows.repartition(3).write.parquet(source)
    stream = read_feature_stream(spark, source, SPEC, 1)
    scored_stream = score_stream(model, stream, SPEC, metadata["operating_threshold"])
    query = write_predictions(scored_stream, str(tmp_path / "out"), str(tmp_path / "state"))
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("UDI").collect()
    wanted, _ = workflows.batch_prediction(spark, load_prediction_input(rows, SPEC), path, SPEC)
    assert got == wanted.orderBy("UDI").collect()


def test_bad_scores_are_flagged_row_by_row(spark):
    df = spark.createDataFrame([(0.5,), (None,), (float("nan"),), (1.5,), (float("inf"),)], "probability double")
    faults = [f for (f,) in rows_of(flag_bad_scores(df), "score_fault")]
    assert faults == [None, "missing", "not_finite", "out_of_range", "not_finite"]


def test_rows_are_scored_without_vectors(spark):
    rows = [(i, f"{'ab'[i % 2]}" if i % 7 else None, float(i % 13) if i % 5 else None, int(i % 13 > 6 and i % 2)) for i in range(400)]
    train = spark.createDataFrame(rows, "id int, `a kind` string, `x 1` double, y int").repartition(2)
    spec = DatasetSpec(key="id", target="y", identifiers=("id",), categorical=("a kind",), numeric=("x 1",))
    model = models.fit_model(models.BOOSTING, train, spec, {models.BOOSTING: lambda weight: LeafwiseBoosting(maxIter=5)})
    new = train.unionByName(spark.createDataFrame([(400, "new", float("nan"), 1), (401, "", float("inf"), 0)], train.schema))
    direct = models.score(model, new)
    assert "vector" not in direct._jdf.queryExecution().optimizedPlan().toString().lower()
    through = model.transform(new).select("id", models.positive_probability(model).alias("p"))
    both = direct.join(through, "id").collect()
    assert len(both) == 402 and all(r["probability"] == r["p"] for r in both)
    assert len({r["p"] for r in both}) > 3


def test_predictions_are_scored_once(spark, table, saved):
    rows = table.select("UDI", *[col(f) for f in SPEC.features])
    predictions, report = workflows.batch_prediction(spark, rows, saved[0], SPEC)
    # What was counted is what is read: settled rows, no scoring above them.
    assert predictions._jdf.queryExecution().optimizedPlan().toString().count("\n") == 1
    assert predictions.count() == report["prediction_count"] == 100

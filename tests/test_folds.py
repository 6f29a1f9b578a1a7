"""Stratified folds and out-of-fold scores."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import SPEC, machine_rows, machine_table

from faultline.operators import folds, models
from faultline.plans import workflows


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(103).select(F.col("id").alias("k"), (F.col("id") % 9 == 0).cast("int").alias("y"))


@given(st.integers(0, 500), st.integers(0, 500), st.integers(2, 20))
def test_sizes_differ_by_at_most_one(zeros, ones, k):
    sizes = folds.fold_sizes({0: zeros, 1: ones}, k)
    assert (sum(sizes[0]), sum(sizes[1])) == (zeros, ones)
    both = [a + b for a, b in zip(sizes[0], sizes[1], strict=True)]
    assert all(max(s) - min(s) <= 1 for s in (sizes[0], sizes[1], both))


@pytest.mark.parametrize("k", [2, 5, 11])
def test_every_row_has_one_fold_whatever_the_partitioning(rows, k):
    plan = folds.fit_folds(rows, "k", "y", folds=k)
    found = {r["k"]: r["fold"] for r in plan.apply(rows).collect()}
    again = folds.stratified_folds(rows.repartition(7), "k", "y", folds=k)
    assert {r["k"]: r["fold"] for r in again.collect()} == found
    counted = Counter((r["y"], found[r["k"]]) for r in rows.collect())
    for y in (0, 1):
        sizes = [counted[y, fold] for fold in range(k)]
        assert min(sizes) > 0 and max(sizes) - min(sizes) <= 1
    assert all(isinstance(cut, tuple) for cuts in plan.cuts.values() for cut in cuts)


def test_applying_folds_neither_joins_nor_shuffles(rows):
    folded = folds.stratified_folds(rows, "k", "y")
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_refusals(rows):
    with pytest.raises(ValueError, match="at least 2"):
        folds.fit_folds(rows, "k", "y", folds=1)
    with pytest.raises(ValueError, match="one has 12"):
        folds.fit_folds(rows, "k", "y", folds=13)


def test_scores_come_from_the_other_folds(spark):
    table = machine_table(spark, machine_rows())
    prior = {models.PRIOR: models.COMPARISON_MODELS[models.PRIOR]}
    scored = workflows.out_of_fold_scores(table, SPEC, prior, folds=3).collect()
    assert len({r[SPEC.key] for r in scored}) == len(scored) == table.count()
    for fold in range(3):
        others = [r["label"] for r in scored if r["fold"] != fold]
        wanted = sum(others) / len(others)
        held = {r["probability"] for r in scored if r["fold"] == fold}
        assert list(held) == [pytest.approx(wanted, abs=1e-12)]


def test_summary_has_the_mean_of_the_folds(spark):
    prior = {models.PRIOR: models.COMPARISON_MODELS[models.PRIOR]}
    reports = workflows.cross_validation(machine_table(spark, machine_rows()), SPEC, prior, folds=2)
    each = reports["cross_validation"].collect()
    one = reports["cross_validation_summary"].first()
    assert one["folds"] == len(each) == 2 and one["roc_auc_mean"] == 0.5
    assert one["average_precision_mean"] == pytest.approx(sum(r["average_precision"] for r in each) / 2)

"""Co-moments and correlations beside pandas, over any partitioning."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.operators import explore
from faultline.operators.comoments import co_moments


def matrix(df, columns):
    rows = explore.correlation_matrix(df, columns).collect()
    assert len({(r["x"], r["y"]) for r in rows}) == len(rows)
    return {(r["x"], r["y"]): r["r"] for r in rows}


@pytest.fixture(scope="module")
def table():
    draw = np.random.default_rng(8)
    base = draw.normal(size=(3000, 3))
    held = pd.DataFrame(
        {
            "far": 1e9 + base[:, 0],
            "near": base[:, 0] + base[:, 1],
            "gaps": np.where(draw.random(3000) < 0.4, np.nan, base[:, 1] - base[:, 2]),
            "rare": np.where(draw.random(3000) < 0.995, np.nan, base[:, 2]),
            # Wide apart where `gaps` is missing, close together where it is there.
            "steps": 0.0,
            "constant": 0.1,
        }
    )
    held["steps"] = np.where(held["gaps"].isna(), 0.0, 1e8 + base[:, 1])
    return held


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_correlations_equal_pandas(spark, table, parts):
    got = matrix(spark.createDataFrame(table).repartition(parts), list(table))
    assert len(got) == 36
    for x in table:
        for y in table:
            own = table[[x, y]].dropna().to_numpy()
            if "constant" in (x, y):
                assert got[x, y] is None
            else:
                assert got[x, y] == pytest.approx(np.corrcoef(own.T)[0, 1], abs=1e-7)
                assert got[x, y] == pytest.approx(got[y, x], abs=1e-15)


def test_moments_of_missing_endless_and_lonely_values(spark):
    rows = [(1.0, math.inf, None, 5.0), (2.0, 1.0, None, None), (4.0, None, 3.0, None), (math.nan, 2.0, None, None)]
    df = spark.createDataFrame(rows * 3, "a double, b double, c double, d double")
    found = {(r["x"], r["y"]): r for r in co_moments(df, [F.col(c) for c in "abcd"]).collect()}
    assert [found[0, i]["n"] for i in range(4)] == [9, 6, 3, 3]
    assert [found[1, i]["endless"] for i in range(4)] == [3, 3, 0, 3]
    assert [found[i, 1]["endless"] for i in range(4)] == [3, 3, 0, 3] and found[0, 2]["endless"] == 0
    assert found[0, 0]["m_xx"] == pytest.approx(14.0) and found[0, 2]["m_xx"] == 0.0
    got = matrix(df, list("abcd"))
    assert ("b", "c") not in got and ("c", "d") not in got
    assert got["a", "b"] is None and got["a", "c"] is None and got["d", "d"] is None
    assert got["a", "a"] == pytest.approx(1.0)


def test_many_columns_are_one_scan(spark, tmp_path):
    wide = spark.range(2000).select(*[((F.col("id") * (i + 3)) % 101).alias(f"c{i}") for i in range(100)])
    wide.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    found = explore.correlation_matrix(read, read.columns)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {(r["x"], r["y"]): r["r"] for r in found.where("x = 'c7'").collect()}
    want = wide.toPandas().corr()["c7"]
    assert len(got) == 100
    assert got["c7", "c98"] is None and math.isnan(want["c98"])  # id * 101 % 101
    assert all(got["c7", y] == pytest.approx(want[y], abs=1e-9) for y in want.index if y != "c98")


def test_empty_table_has_no_pairs(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert explore.correlation_matrix(df, ["a", "b"]).count() == 0

from __future__ import annotations

import pytest
from tables import SPEC, THREE, machine_table, rows_of

from faultline.functions.columns import col
from faultline.plans.sinks import write_predictions_csv, write_report, write_rows, write_workflow
from faultline.sources.tables import load_prediction_input, load_table, read_csv

HEADER = ",".join(SPEC.required)
LINES = ["1,M14860,M,298.1,308.6,1551,42.8,0,0,0,0,0,0,0", "2,L47181,L,298.2,308.7,1408,46.3,3,0,0,0,0,0,0"]


def csv(tmp_path, *lines, name="t.csv"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + ("\n" if lines else ""))
    return str(path)


def test_reads_contract_columns_in_order(spark, tmp_path):
    df = load_table(spark, csv(tmp_path, "extra," + HEADER, *["x," + r for r in LINES]), SPEC)
    assert df.columns == list(SPEC.required)
    assert df.count() == 2 and dict(df.dtypes)["Torque [Nm]"] == "double"


def test_missing_marks(spark, tmp_path):
    df = load_table(spark, csv(tmp_path, HEADER, LINES[0].replace("42.8", "NA"), LINES[1].replace("46.3", "")), SPEC)
    assert rows_of(df.select(col("Torque [Nm]").alias("t")), "t") == [(None,), (None,)]


def test_bad_number_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed|cannot parse|NumberFormat"):
        load_table(spark, csv(tmp_path, HEADER, LINES[0].replace("42.8", "abc")), SPEC).collect()


@pytest.mark.parametrize(
    "lines, message",
    [
        ((), "empty"),
        ((HEADER,), "no rows"),
        ((HEADER + ",Type,UDI,Type", LINES[0] + ",M,1,M"), "duplicate source columns: Type, UDI"),
        ((HEADER + ',"Type"', LINES[0] + ",M"), "duplicate source columns: Type"),
        ((HEADER.replace("Type", "Kind"), LINES[0]), "missing columns: Type"),
    ],
)
def test_bad_sources(spark, tmp_path, lines, message):
    with pytest.raises(ValueError, match=message):
        load_table(spark, csv(tmp_path, *lines), SPEC)


def test_absent_path(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)does not exist|PATH_NOT_FOUND"):
        load_table(spark, str(tmp_path / "none.csv"), SPEC)


def test_parquet_source(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    machine_table(spark, THREE).selectExpr("'x' AS extra", "*").write.parquet(path)
    assert load_table(spark, path, SPEC).columns == list(SPEC.required)


def test_prediction_input(spark, tmp_path):
    df = machine_table(spark, THREE).select("UDI", *[col(f) for f in SPEC.features])
    assert load_prediction_input(df, SPEC).count() == 3
    assert load_prediction_input(df.drop("UDI"), SPEC).columns == list(SPEC.features)
    path = csv(tmp_path, ",".join(("UDI", *SPEC.features)), "1,L,298.1,308.6,1551,,0", "2,M,298,308,1400,40,NA")
    assert load_prediction_input(path, SPEC, spark).count() == 2


def test_prediction_input_must_match_exactly(spark):
    df = machine_table(spark, THREE).select(*[col(f) for f in SPEC.features])
    for bad, message in (
        (df.drop("Type").withColumn("x", col("Torque [Nm]")), "missing feature columns: Type"),
        (df.withColumn("x", col("Torque [Nm]")), "unexpected columns: x"),
        (df.select(*[col(f) for f in reversed(SPEC.features)]), "in the order"),
        (df.select("*", "Type"), "duplicate columns"),
    ):
        with pytest.raises(ValueError, match=message):
            load_prediction_input(bad, SPEC)


def test_reports_are_strict_and_ordered(spark, tmp_path):
    df = spark.createDataFrame(
        [(2, float("nan"), [1]), (1, float("inf"), None), (3, 1.5, [2, 3])], "k int, v double, a array<int>"
    )
    paths = write_report(df, str(tmp_path), "report", columns=("v", "k", "a"), order_by=("k",))
    lines = [r["value"] for r in spark.read.text(paths["json"]).collect()]
    assert sorted(lines) == ['{"v":1.5,"k":3,"a":[2,3]}', '{"v":null,"k":1,"a":null}', '{"v":null,"k":2,"a":[1]}']
    back = spark.read.option("header", True).csv(paths["csv"])
    assert back.columns == ["v", "k", "a"] and back.count() == 3
    with pytest.raises(ValueError):
        write_report(df, str(tmp_path), "bad", formats=("xml",))
    rows = write_rows(df.drop("a"), str(tmp_path / "rows"), ("k",))
    assert spark.read.parquet(rows).count() == 3


def test_csv_and_spec_agree(spark, tmp_path):
    df = read_csv(spark, csv(tmp_path, HEADER, *LINES), SPEC, ("Type", "UDI"))
    assert df.columns == ["Type", "UDI"]


def test_workflow_reports_keep_names_and_columns(spark, tmp_path):
    cases = spark.createDataFrame(
        [("a", 0.5, "false_positive", 0.7, 1)], "selection string, threshold double, outcome string, probability double, k int"
    )
    ranks = spark.createDataFrame([(1, "x", 0.5, 0.1)], "rank int, feature string, importance_mean double, importance_std double")
    paths = write_workflow({"error_cases": cases, "feature_importance": ranks.select(*reversed(ranks.columns))}, str(tmp_path))
    back = spark.read.option("header", True).csv(paths["feature_importance"]["csv"])
    assert back.columns == ["rank", "feature", "importance_mean", "importance_std"]
    assert (tmp_path / "error_analysis/error_cases/selection=a/outcome=false_positive").is_dir()
    predictions = spark.createDataFrame([(7, 0.5, 1)], "UDI bigint, failure_probability double, predicted_failure int")
    out = write_predictions_csv(predictions, "UDI", str(tmp_path / "p"))
    assert spark.read.option("header", True).csv(out).columns[0] == "input_index"
    with pytest.raises(ValueError):
        write_predictions_csv(predictions.drop("UDI"), "UDI", str(tmp_path / "q"))

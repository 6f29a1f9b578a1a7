"""Reading tables under a column contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from faultline.functions.columns import quoted
from faultline.operators.checks import (
    repeated_names,
    require_columns,
    require_feature_order,
    require_rows,
    require_unique_columns,
)
from faultline.spec import DatasetSpec


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names as written in the source, before Spark renames repeats."""
    first = spark.read.option("header", False).csv(path).limit(1).collect()
    return [] if not first else ["" if n is None else n for n in first[0]]


def read_csv(
    spark: SparkSession, path: str, spec: DatasetSpec, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """CSV scan: header checked first, explicit types, bad numbers are an error.

    Columns outside the contract are read over and dropped; ``NA`` and empty fields are
    missing.
    """
    wanted = spec.required if columns is None else columns
    header = csv_header(spark, path)
    if not header:
        raise ValueError(f"{path} is empty")
    repeats = repeated_names(header)
    if repeats:
        raise ValueError(f"duplicate source columns: {', '.join(repeats)}")
    missing = [c for c in wanted if c not in header]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    schema = T.StructType(
        [
            T.StructField(n, spec.type_of(n) if n in wanted else T.StringType(), True)
            for n in header
        ]
    )
    table = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "NA")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return conform(table, spec, wanted)


def conform(
    df: DataFrame, spec: DatasetSpec, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Project the contract columns in order; NaN becomes missing once, here."""
    wanted = spec.required if columns is None else columns
    kinds = dict(df.dtypes)

    def cell(c: str) -> str:
        name = quoted(c)
        if c in spec.numeric:
            return f"nanvl(CAST({name} AS DOUBLE), NULL) AS {name}"
        if kinds[c] in ("double", "float"):
            value = f"nanvl({name}, CAST(NULL AS {kinds[c]}))"
            return f"CAST({value} AS {spec.type_of(c).simpleString()}) AS {name}"
        return f"CAST({name} AS {spec.type_of(c).simpleString()}) AS {name}"

    return df.selectExpr(*[cell(c) for c in wanted])


def is_csv(path: str, kind: str | None = None) -> bool:
    """Whether a path holds CSV: as `kind` ("csv" or "parquet") says, else by its ending."""
    if kind is not None:
        if kind not in ("csv", "parquet"):
            raise ValueError(f"unknown format: {kind}")
        return kind == "csv"
    name = path.rstrip("/").lower()
    return name.endswith((".csv", ".csv.gz", ".csv.bz2", ".csv.zst", ".csv.lz4"))


def load_table(
    spark: SparkSession, path: str, spec: DatasetSpec, kind: str | None = None
) -> DataFrame:
    """Read CSV or Parquet, check the structure, project the contract columns.

    A folder of CSV files without a telling name needs kind="csv".
    """
    if is_csv(path, kind):
        table = read_csv(spark, path, spec)
    else:
        source = spark.read.parquet(path)
        require_unique_columns(source)
        require_columns(source, spec)
        table = conform(source, spec)
    require_rows(table)
    return table


def load_prediction_input(
    source: DataFrame | str,
    spec: DatasetSpec,
    spark: SparkSession | None = None,
    kind: str | None = None,
) -> DataFrame:
    """Feature columns only, exactly in contract order; missing values are allowed.

    A source may also carry the key column, which stands in for a row index; without it
    predictions cannot be matched to rows, which `predict` refuses. Works on
    streaming frames, as only column names are looked at.
    """
    if isinstance(source, str):
        if spark is None:
            raise ValueError("a session is needed to read a path")
        if is_csv(source, kind):
            header = csv_header(spark, source)
            repeats = repeated_names(header)
            if repeats:
                raise ValueError(f"duplicate source columns: {', '.join(repeats)}")
            require_feature_order([c for c in header if c != spec.key], spec)
            table = read_csv(spark, source, spec, tuple(header))
            require_rows(table)
            return table
        source = spark.read.parquet(source)
    require_unique_columns(source)
    require_feature_order([c for c in source.columns if c != spec.key], spec)
    return conform(source, spec, tuple(source.columns))

"""Profiling: shape, missing values, target, numeric and categorical summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.columns import (
    beside,
    col,
    count_where,
    finite,
    level,
    names_of,
    number,
    percent,
    quoted,
    text,
)
from faultline.functions.ordering import exact_quantiles
from faultline.functions.settle import settle
from faultline.spec import HIGH_IMBALANCE_RATIO, DatasetSpec

# Fingerprints of repeated rows that are broadcast at most, 16 bytes each.
BROADCAST_PRINTS = 1_000_000
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _gap(kind: str, name: str) -> str:
    """SQL condition: NULL, or NaN in a floating column."""
    null = f"{quoted(name)} IS NULL"
    return f"{null} OR isnan({quoted(name)})" if kind in ("double", "float") else null


def _missing(df: DataFrame, name: str):
    return F.expr(_gap(dict(df.dtypes)[name], name))


def _text(df: DataFrame, name: str):
    """Value as a text key: integral numbers without a fraction, missing as <NA>."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("double", "float"):
        value = number(name)
        whole = (value == F.floor(value)) & (F.abs(value) < 1e18)
        shown = F.when(whole, value.cast("bigint").cast("string")).otherwise(
            value.cast("string")
        )
        return F.coalesce(shown, F.lit("<NA>"))
    return level(name)


def row_print(df: DataFrame) -> list[Column]:
    """A 128-bit fingerprint of whole rows as two longs; equal rows have equal ones.

    Maps and collated texts have no hash that agrees with their equality and are left out.
    """
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "collate" not in kind.lower()]
    # A missing value does not change a hash, so where it stands is hashed beside it.
    cells = [x for c in hashed for x in (col(c).isNull(), col(c))]
    return [F.xxhash64(F.lit(i), *cells).alias(f"_print{i}") for i in (1, 2)]


def duplicate_rows(df: DataFrame, known_prints: int = BROADCAST_PRINTS) -> DataFrame:
    """Rows that repeat an earlier whole row; missing equals missing.

    Fingerprints are counted first, 24 bytes a row at most. Only rows whose fingerprint stands
    more than once move whole, and these are compared in full. With more such fingerprints
    than ``known_prints`` every row moves whole, as it would in a join with them. Equal rows are
    counted before either shuffle, so a row copied a billion times costs one row per task.
    """
    # Columns by position, so that no name of the table meets one of ours.
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    names, prints = plain.columns, ["_print1", "_print2"]
    marked = plain.select(*names, *row_print(plain))
    counted = marked.groupBy(*prints).agg(F.count(F.lit(1)).alias("_n"))
    repeated = settle(counted.where("_n > 1").select(*prints))
    rows = plain
    if repeated.count() <= known_prints:
        rows = marked.join(F.broadcast(repeated), prints, "left_semi")
    return (
        rows.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_row_count"))
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """(metric, value): rows, columns, duplicate rows; no unrepeated row is shuffled whole."""
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count")
    )
    one = beside([counted, duplicate_rows(df)], ())
    return one.unpivot([], one.columns, "metric", "value")


def missing_values(df: DataFrame, spec: DatasetSpec | None = None) -> DataFrame:
    """(position, column, [role,] missing_count, missing_percent), one pass."""
    roles = dict(spec.roles()) if spec else {}
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"count_if({_gap(kind, c)}) AS _m{i}") for i, (c, kind) in enumerate(df.dtypes)],
    )
    cells = ", ".join(
        f"named_struct('position', {i}, 'column', {text(c)}, "
        + (f"'role', {text(roles.get(c, 'other'))}, " if spec else "")
        + f"'missing_count', _m{i}, 'missing_percent', "
        f"CASE WHEN _rows = 0 THEN 0D ELSE round(100D * _m{i} / _rows, 2) END)"
        for i, c in enumerate(df.columns)
    )
    return counts.select(F.expr(f"inline(array({cells}))"))


def schema_summary(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Role and type of each contract column, with how many rows fill it."""
    types = dict(df.dtypes)
    counts = df.agg(
        *[
            F.expr(f"count_if(NOT ({_gap(types[c], c)})) AS _f{i}")
            for i, (c, _) in enumerate(spec.roles())
        ]
    )
    cells = ", ".join(
        f"named_struct('position', {i}, 'column', {text(c)}, 'role', {text(role)}, "
        f"'type', {text(types[c])}, 'filled', _f{i})"
        for i, (c, role) in enumerate(spec.roles())
    )
    return counts.select(F.expr(f"inline(array({cells}))"))


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """(label, count, percent, imbalance_ratio) over rows with a label.

    The ratio is largest over smallest class, NULL with fewer than two classes.
    """
    counts = (
        df.where(~_missing(df, target))
        .groupBy(_text(df, target).alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    totals = counts.agg(
        F.struct(
            F.sum("count").alias("n"),
            F.max("count").alias("high"),
            F.min("count").alias("low"),
            F.count(F.lit(1)).alias("classes"),
        ).alias("t")
    ).scalar()
    return counts.withColumn("_t", totals).select(
        "label",
        "count",
        percent(F.col("count"), F.col("_t.n")).alias("percent"),
        F.when(
            F.col("_t.classes") > 1, F.col("_t.high").cast("double") / F.col("_t.low")
        ).alias("imbalance_ratio"),
    )


def numeric_summary(
    df: DataFrame,
    features: Sequence[str],
    group_by: str | Sequence[str] = (),
    few_groups: bool | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """(group..., feature, count, missing, mean, std, min, q1, median, q3, max).

    Missing values are left out, std is the sample one, quartiles are exact and linearly
    interpolated, non-finite results are NULL.
    """
    groups = names_of(group_by)
    value = F.col("value")
    moments = {
        "count": F.count(value),
        "missing": count_where(value.isNull()),
        "mean": finite(F.avg(value)),
        "std": finite(F.stddev_samp(value)),
        "min": finite(F.min(value)),
        "max": finite(F.max(value)),
    }
    summary = exact_quantiles(df, features, QUARTILES, groups, few_groups, buckets, moments)
    return summary.select(
        *[col(k) for k in (*groups, "feature")],
        "count",
        "missing",
        "mean",
        "std",
        "min",
        *[finite(F.col(q)).alias(q) for q in QUARTILES],
        "max",
    )


def categorical_summary(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """(column, value, count, percent) over all rows; missing shown as <NA>."""
    if not categorical:
        return df.sparkSession.createDataFrame(
            [], "column string, value string, count bigint, percent double"
        )
    cells = [F.struct(F.lit(c).alias("column"), _text(df, c).alias("value")) for c in categorical]
    counts = (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    totals = (
        counts.groupBy("column")
        .agg(F.sum("count").alias("_total"))
    )
    # One total per listed column: as many rows as there are categorical columns.
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "count", percent(F.col("count"), F.col("_total")).alias("percent")
    )


def constant_columns(df: DataFrame) -> DataFrame:
    """(position, column): columns with one value, a missing one counting as a value.

    Smallest equals largest with nothing missing, or everything missing: one pass, no
    distinct.
    """
    parts = []
    for i, (c, kind) in enumerate(df.dtypes):
        gap = _gap(kind, c)
        shown = f"CASE WHEN NOT ({gap}) THEN {quoted(c)} END"
        parts += [f"min({shown}) AS _a{i}", f"max({shown}) AS _b{i}", f"count_if({gap}) AS _m{i}"]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.expr(p) for p in parts])
    cells = ", ".join(
        f"named_struct('position', {i}, 'column', {text(c)}, '_constant', "
        f"_rows > 0 AND (_m{i} = _rows OR (_m{i} = 0 AND _a{i} = _b{i})))"
        for i, c in enumerate(df.columns)
    )
    return one.select(F.expr(f"inline(array({cells}))")).where("_constant").drop("_constant")


def unexpected_categories(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(column, value, count): values outside the allowed list; missing is ignored."""
    return _unexpected(df, spec, F.count(F.lit(1)))


def _unexpected(df: DataFrame, spec: DatasetSpec, count: Column) -> DataFrame:
    cells = [
        F.struct(F.lit(c).alias("_column"), col(c).cast("string").alias("_value"))
        for c in spec.allowed
        if c in df.columns
    ]
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, value string, count bigint")
    allowed = F.lit(False)
    for c, values in spec.allowed.items():
        allowed = allowed | ((F.col("_column") == c) & F.col("_value").isin(*values))
    return (
        df.select("*", F.inline(F.array(*cells)))
        .where(F.col("_value").isNotNull() & ~allowed)
        .groupBy(F.col("_column").alias("column"), F.col("_value").alias("value"))
        .agg(count.alias("count"))
    )


def data_warnings(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(ord, code, message) of data risks in a fixed order; no rows when there are none.

    Equal rows are counted once; all facts come from these counts, so the table is read
    in one pass and its exchange is reused.
    """
    counted = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    gaps = [f"sum(IF({_gap(kind, c)}, _n, 0))" for c, kind in df.dtypes]
    ends = []
    for i, (c, kind) in enumerate(df.dtypes):
        shown = f"CASE WHEN NOT ({_gap(kind, c)}) THEN {quoted(c)} END"
        ends += [f"min({shown}) AS _a{i}", f"max({shown}) AS _b{i}", f"{gaps[i]} AS _m{i}"]
    one = counted.agg(
        F.sum("_n").alias("_rows"), F.sum(F.col("_n") - 1).alias("_copies"), *[F.expr(e) for e in ends]
    )
    # At most one entry per column of the table.
    constant = ", ".join(
        f"IF(_m{i} = _rows OR (_m{i} = 0 AND _a{i} = _b{i}), {text(c)}, NULL)"
        for i, c in enumerate(df.columns)
    )
    whole = one.select(
        "_copies",
        F.expr(" + ".join(f"_m{i}" for i in range(len(df.columns)))).alias("_gaps"),
        F.col(f"_m{df.columns.index(spec.target)}").alias("_target_gaps"),
        F.expr(f"array_join(array({constant}), ', ')").alias("_constant"),
    )
    classes = (
        counted.where(~_missing(df, spec.target))
        .groupBy(_text(df, spec.target).alias("label"))
        .agg(F.sum("_n").alias("count"))
        .agg(
            F.count(F.lit(1)).alias("_classes"),
            F.when(F.count(F.lit(1)) > 1, F.max("count").cast("double") / F.min("count")).alias("_ratio"),
        )
    )
    odd = _unexpected(counted, spec, F.sum("_n")).agg(
        F.count(F.lit(1)).alias("_odd_values"), F.sum("count").alias("_odd_rows")
    )
    facts = beside([whole, classes, odd], ())

    rules = [
        (
            "missing_target",
            F.col("_target_gaps") > 0,
            F.format_string("target has %d missing values", F.col("_target_gaps")),
        ),
        (
            "no_target_class",
            F.col("_classes") == 0,
            F.lit("target has no observed class"),
        ),
        (
            "one_target_class",
            F.col("_classes") == 1,
            F.lit("target has one observed class"),
        ),
        (
            "imbalanced_target",
            F.col("_ratio") >= HIGH_IMBALANCE_RATIO,
            F.concat(
                F.lit("largest class outnumbers the smallest by "),
                F.round("_ratio", 2).cast("decimal(20,2)").cast("string"),
            ),
        ),
        (
            "duplicate_rows",
            F.col("_copies") > 0,
            F.format_string("%d duplicate rows", F.col("_copies")),
        ),
        (
            "missing_cells",
            F.col("_gaps") > 0,
            F.format_string("%d missing cells", F.col("_gaps")),
        ),
        (
            "constant_columns",
            F.length("_constant") > 0,
            F.concat(F.lit("constant columns: "), F.col("_constant")),
        ),
        (
            "unexpected_categories",
            F.col("_odd_values") > 0,
            F.format_string(
                "%d unexpected category values in %d rows",
                F.col("_odd_values"),
                F.col("_odd_rows"),
            ),
        ),
    ]
    cells = [
        F.struct(
            F.lit(i).alias("ord"),
            F.lit(code).alias("code"),
            F.when(F.coalesce(condition, F.lit(False)), message).alias("message"),
        )
        for i, (code, condition, message) in enumerate(rules, 1)
    ]
    return facts.select(F.inline(F.array(*cells))).where("message IS NOT NULL")


def profile_dataset(df: DataFrame, spec: DatasetSpec) -> dict[str, DataFrame]:
    """Every profile table by name; each runs when it is used."""
    return {
        "dataset_summary": dataset_summary(df),
        "schema_summary": schema_summary(df, spec),
        "missing_values": missing_values(df, spec),
        "target_summary": target_summary(df, spec.target),
        "numeric_summary": numeric_summary(df, spec.numeric),
        "categorical_summary": categorical_summary(df, spec.categorical),
        "constant_columns": constant_columns(df),
        "unexpected_categories": unexpected_categories(df, spec),
        "data_warnings": data_warnings(df, spec),
    }

"""Column expressions and small frame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "<NA>"


def col(name: str) -> Column:
    """Column by its exact name; dots, blanks and brackets are part of the name."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    """The name as it is written in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal in SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(name: str) -> Column:
    """Double in which NaN counts as missing."""
    return F.nanvl(col(name).cast("double"), F.lit(None).cast("double"))


def checked_score(name: str) -> Column:
    """The probability as a double; a row whose score is missing or outside 0..1 is an error.

    The check is part of the expression, so it costs no pass over the rows.
    """
    p = f"CAST({quoted(name)} AS DOUBLE)"
    refused = text(f"{name} has to be a probability between 0 and 1")
    return F.expr(f"CASE WHEN {p} >= 0 AND {p} <= 1 THEN {p} ELSE CAST(raise_error({refused}) AS DOUBLE) END")


def checked_label(name: str) -> Column:
    """The label as an int; a row whose label is neither 0 nor 1 is an error."""
    y = f"CAST({quoted(name)} AS DOUBLE)"
    refused = text(f"{name} has to be 0 or 1")
    return F.expr(f"CASE WHEN {y} IN (0, 1) THEN CAST({y} AS INT) ELSE CAST(raise_error({refused}) AS INT) END")


def finite(value: Column) -> Column:
    """The value, or NULL where it is infinite or not a number."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """part of whole on a 0-100 scale, 0 where whole is 0."""
    value = ratio(part * F.lit(100.0), whole)
    return value if digits is None else F.round(value, digits)


def level(name: str) -> Column:
    """Category as text, missing shown as <NA>."""
    return F.coalesce(col(name).cast("string"), F.lit(MISSING))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def names_of(group_by: str | Iterable[str]) -> list[str]:
    return [group_by] if isinstance(group_by, str) else list(group_by)


def match(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Equi-join on keys where a missing key matches a missing key."""
    renamed = right.select(
        *[
            col(c).alias(f"_right_{c}") if c in keys else col(c)
            for c in right.columns
        ]
    )
    condition = reduce(
        lambda a, b: a & b, [col(k).eqNullSafe(col(f"_right_{k}")) for k in keys]
    )
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def match_spread(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_on: str,
    salts: int = 64,
) -> DataFrame:
    """``match`` for a right side with one row per key and a left side with hot keys.

    Each left row goes to one of ``salts`` copies of its right row, chosen by a hash of
    ``spread_on``, so a key that holds a third of all rows is joined by many tasks.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(col(spread_on)), F.lit(salts)))
    copies = right.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    return match(salted, copies, [*keys, "_salt"]).drop("_salt")


def beside(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Put the columns of frames with one row per key side by side.

    A union followed by one aggregate: needs no join, keeps missing keys, and works
    without any key, where a join of one-row frames would be a cross join.
    """
    values = [c for f in frames for c in f.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    picked = [F.max(col(c)).alias(c) for c in values]
    return stacked.groupBy(*[col(k) for k in keys]).agg(*picked)


def unpivot_numeric(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()):
    """Long form (keep..., feature, value), missing values included."""
    if not features:
        empty = df.select(
            *[col(k) for k in keep], F.lit("").alias("feature"), F.lit(0.0).alias("value")
        )
        return empty.where("false")
    cells = ", ".join(
        f"named_struct('feature', {text(f)}, 'value', nanvl(double({quoted(f)}), NULL))"
        for f in features
    )
    return df.select(*[col(k) for k in keep], F.expr(f"inline(array({cells}))"))

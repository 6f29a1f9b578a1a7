"""Feature preparation fitted on training rows, and class weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.columns import col, count_where, number
from faultline.functions.ordering import exact_quantiles
from faultline.spec import DatasetSpec


def standard_scale(train: DataFrame, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(x - mean) / population std of the training rows; a constant feature becomes 0.

    The fitted values are one row and enter as scalars, so scaling is a row-local
    projection.
    """
    fitted = train.agg(
        *[F.avg(number(f)).alias(f"_m{i}") for i, f in enumerate(features)],
        *[F.stddev_pop(number(f)).alias(f"_s{i}") for i, f in enumerate(features)],
    ).first()
    out = df
    for i, f in enumerate(features):
        mean, std = fitted[f"_m{i}"], fitted[f"_s{i}"]
        value = F.lit(None).cast("double") if mean is None else (number(f) - mean) / (std or 1.0)
        out = out.withColumn(f, value)
    return out


def one_hot(train: DataFrame, df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """0/1 columns ``<column>=<level>`` for the training levels; unknown gives all 0.

    Levels become columns, so this is for categories with few levels; the model pipelines
    use sparse vectors instead.
    """
    cells = [F.struct(F.lit(c).alias("c"), col(c).cast("string").alias("v")) for c in categorical]
    levels = (
        train.select(F.inline(F.array(*cells)))
        .where("v IS NOT NULL")
        .distinct()
        .orderBy("c", "v")
        .limit(10_001)
        .collect()
    )
    if len(levels) > 10_000:
        raise ValueError("too many category levels for columns; use the model pipelines")
    return df.select(
        "*",
        *[
            F.coalesce((col(r["c"]).cast("string") == r["v"]).cast("int"), F.lit(0)).alias(
                f"{r['c']}={r['v']}"
            )
            for c in categorical
            for r in levels
            if r["c"] == c
        ],
    )


def class_weights(train: DataFrame, target: str) -> dict[int, float]:
    """n / (classes * n_class) from the training rows; one pass, two numbers."""
    y = number(target)
    zero, one = train.agg(count_where(y == 0), count_where(y == 1)).first()
    present = {label: n for label, n in ((0, zero), (1, one)) if n}
    return {label: (zero + one) / (len(present) * n) for label, n in present.items()}


def balanced_weights(train: DataFrame, target: str) -> DataFrame:
    """The training rows with a ``weight`` column."""
    out = F.lit(None).cast("double")
    for label, weight in class_weights(train, target).items():
        out = F.when(number(target) == label, F.lit(weight)).otherwise(out)
    return train.withColumn("weight", out)


def training_medians(train: DataFrame, spec: DatasetSpec) -> dict[str, float]:
    """The exact median of each numeric feature, 0 where every value is missing."""
    found = exact_quantiles(train, spec.numeric, {"median": 0.5})
    medians = {r["feature"]: r["median"] for r in found.collect()}  # one row per feature
    return {f: medians.get(f) or 0.0 for f in spec.numeric}


def preparation(spec: DatasetSpec, fills: Mapping[str, float] | None = None) -> Pipeline:
    """Impute with missing flags, scale, one-hot and assemble into ``features``.

    ``fills``, as from ``training_medians``, replace missing numbers, with a 0/1 flag beside
    each; without them 0 does. The slot for unknown categories is the dropped one, so
    unknown and missing become all zeros and every real level keeps its own slot.
    """
    n, c = len(spec.numeric), len(spec.categorical)
    known = fills or {}
    plain = ", ".join(
        f"coalesce(nanvl(CAST(`{f}` AS DOUBLE), NULL), {float(known.get(f, 0.0))!r}D) AS _f{i}, "
        f"CASE WHEN `{f}` IS NULL OR isnan(CAST(`{f}` AS DOUBLE)) THEN 1D ELSE 0D END AS _g{i}"
        for i, f in enumerate(spec.numeric)
    )
    levels = ", ".join(f"CAST(`{f}` AS STRING) AS _c{i}" for i, f in enumerate(spec.categorical))
    stages = [
        SQLTransformer(
            statement="SELECT *, " + ", ".join(p for p in (plain, levels) if p) + " FROM __THIS__"
        )
    ]
    parts = []
    if n:
        stages += [
            VectorAssembler(inputCols=[f"_f{i}" for i in range(n)], outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        ]
        parts += ["_scaled", *[f"_g{i}" for i in range(n)]]
    if c:
        stages += [
            StringIndexer(
                inputCols=[f"_c{i}" for i in range(c)],
                outputCols=[f"_i{i}" for i in range(c)],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"_i{i}" for i in range(c)],
                outputCols=[f"_o{i}" for i in range(c)],
                dropLast=True,
            ),
        ]
        parts += [f"_o{i}" for i in range(c)]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages)


def native_preparation(spec: DatasetSpec) -> Pipeline:
    """Assemble for trees that take missing values: NaN numbers, no scaling, one-hot levels.

    Unknown and missing categories become all zeros, as in ``preparation``.
    """
    n, c = len(spec.numeric), len(spec.categorical)
    numbers = [
        f"coalesce(CAST(`{f}` AS DOUBLE), double('NaN')) AS _f{i}" for i, f in enumerate(spec.numeric)
    ]
    levels = [f"CAST(`{f}` AS STRING) AS _c{i}" for i, f in enumerate(spec.categorical)]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join([*numbers, *levels])} FROM __THIS__")]
    if c:
        stages += [
            StringIndexer(
                inputCols=[f"_c{i}" for i in range(c)],
                outputCols=[f"_i{i}" for i in range(c)],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"_i{i}" for i in range(c)],
                outputCols=[f"_o{i}" for i in range(c)],
                dropLast=True,
            ),
        ]
    parts = [*[f"_f{i}" for i in range(n)], *[f"_o{i}" for i in range(c)]]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)


def derived_features(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Add features computed from others, given as SQL expressions."""
    return df.withColumns({name: F.expr(e) for name, e in expressions.items()})

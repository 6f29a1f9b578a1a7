"""Class-balanced classifiers as Spark ML jobs, and their comparison."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoderModel, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.columns import col, names_of, number
from faultline.operators.boosting import LeafwiseBoosting, LeafwiseModel, level_scorer
from faultline.operators.checks import FINAL_MODEL
from faultline.operators.features import (
    balanced_weights,
    native_preparation,
    preparation,
    training_medians,
)
from faultline.spec import SEED, DatasetSpec

PRIOR = "dummy_prior"
LOGISTIC = "logistic_regression_balanced"
FOREST = "random_forest_balanced"
BOOSTING = FINAL_MODEL
# Training rows per task of the solvers, at least.
ROWS_PER_TASK = 20_000


def _prior(weight_sum: float) -> Estimator:
    # A tree without a split answers the class frequencies of its training rows.
    return DecisionTreeClassifier(maxDepth=0, labelCol="_label")


def _logistic(weight_sum: float) -> Estimator:
    # L2 with C = 1 on the sum of losses is 1 / (sum of weights) on their mean.
    return LogisticRegression(
        labelCol="_label",
        weightCol="weight",
        maxIter=1000,
        tol=1e-4,
        regParam=1.0 / weight_sum,
        elasticNetParam=0.0,
        standardization=False,
    )


def _forest(weight_sum: float) -> Estimator:
    return RandomForestClassifier(
        labelCol="_label", weightCol="weight", numTrees=200, maxDepth=15, seed=SEED
    )


def _boosting(weight_sum: float) -> Estimator:
    return LeafwiseBoosting()


# name -> function of the weight sum that gives a fresh, unfitted classifier
BASELINE_MODELS: Mapping[str, Callable[[float], Estimator]] = {
    PRIOR: _prior,
    LOGISTIC: _logistic,
}
COMPARISON_MODELS: Mapping[str, Callable[[float], Estimator]] = {
    **BASELINE_MODELS,
    FOREST: _forest,
    BOOSTING: _boosting,
}


def require_model(name: str, models: Mapping[str, Callable]) -> None:
    if name not in models:
        raise ValueError(f"unknown model {name!r}; known: {', '.join(models)}")


def build_pipeline(
    name: str,
    spec: DatasetSpec,
    weight_sum: float = 1.0,
    models: Mapping[str, Callable[[float], Estimator]] = COMPARISON_MODELS,
) -> Pipeline:
    """A fresh, unfitted pipeline with its own preparation."""
    require_model(name, models)
    estimator = models[name](weight_sum)
    prepare = native_preparation if takes_missing(estimator) else preparation
    return Pipeline(stages=[prepare(spec), estimator])


def takes_missing(estimator: Estimator) -> bool:
    """Whether missing values reach the estimator as they are."""
    return isinstance(estimator, LeafwiseBoosting)


def fit_models(
    train: DataFrame,
    spec: DatasetSpec,
    models: Mapping[str, Callable[[float], Estimator]] = COMPARISON_MODELS,
) -> dict[str, tuple[PipelineModel, float]]:
    """Fit every model on the training rows: {name: (pipeline model, seconds)}.

    The seconds of each model hold its preparation, as if it were fitted alone.
    The preparation depends on the rows only, so each of the two kinds (imputed and scaled,
    or with missing values as they are) is fitted once. Its steps read the training rows several
    times and the solvers read the vectors many times: both are cached with spill to disk.
    """
    columns = [col(c) for c in (*spec.features, spec.target)]
    rows = train.select(*columns).persist()
    weighted = balanced_weights(rows, spec.target).withColumn("_label", number(spec.target))
    # The solvers run many short jobs: no more tasks than the rows are worth.
    tasks = max(1, -(-rows.count() // ROWS_PER_TASK))
    weight_sum = weighted.agg(F.sum("weight")).first()[0]
    estimators = {name: make(weight_sum) for name, make in models.items()}
    fitted = {}
    try:
        for native in (False, True):
            names = [n for n, e in estimators.items() if takes_missing(e) == native]
            if not names:
                continue
            started = time.perf_counter()
            prepare = native_preparation(spec) if native else preparation(spec, training_medians(rows, spec))
            prepared = prepare.fit(weighted)
            vectors = prepared.transform(weighted).select("_label", "weight", "features")
            vectors = vectors.coalesce(tasks).persist()
            try:
                vectors.count()
                preparing = time.perf_counter() - started
                for name in names:
                    started = time.perf_counter()
                    model = estimators[name].fit(vectors)
                    seconds = preparing + time.perf_counter() - started
                    fitted[name] = (PipelineModel(stages=[prepared, model]), seconds)
            finally:
                vectors.unpersist()
        return {name: fitted[name] for name in models}
    finally:
        rows.unpersist()


def fit_model(
    name: str,
    train: DataFrame,
    spec: DatasetSpec,
    models: Mapping[str, Callable[[float], Estimator]] = COMPARISON_MODELS,
) -> PipelineModel:
    require_model(name, models)
    return fit_models(train, spec, {name: models[name]})[name][0]


def positive_probability(model: PipelineModel, vector: str = "probability") -> Column:
    """Probability of class 1; labels are 0/1 doubles, so its place is 1."""
    classes = model.stages[-1].numClasses
    if classes != 2:
        raise ValueError(f"a binary classifier is needed, this one has {classes} classes")
    return vector_to_array(col(vector))[1]


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The input columns plus ``probability`` (double); a row-local transformation."""
    names = [col(c) for c in df.columns]
    prepared = _prepared_columns(model)
    if prepared is not None:
        projection, numbers, categories, levels = prepared
        probability = F.arrow_udf(level_scorer(model.stages[-1].getOrDefault("content"), len(numbers), levels), "double")
        inputs = [*([F.array(*numbers)] if numbers else []), *categories]
        return projection.transform(df).select(*names, probability(*inputs).alias("probability"))
    scored = model.transform(df)
    return scored.select(*names, positive_probability(model).alias("probability"))


def _prepared_columns(model: PipelineModel) -> tuple | None:
    """(projection, number columns, category columns, levels) of a ``native_preparation`` and its trees.

    Trees read these as they are, so no vector is made of every row. None for other pipelines.
    """
    first, last = model.stages[0], model.stages[-1]
    if len(model.stages) != 2 or not isinstance(last, LeafwiseModel) or not isinstance(first, PipelineModel):
        return None
    kinds = [type(stage) for stage in first.stages]
    if kinds == [SQLTransformer, VectorAssembler]:
        inputs, outputs, levels = [], [], []
    elif kinds == [SQLTransformer, StringIndexerModel, OneHotEncoderModel, VectorAssembler]:
        _, indexer, encoder, _ = first.stages
        inputs, outputs, levels = indexer.getInputCols(), encoder.getOutputCols(), [list(one) for one in indexer.labelsArray]
        plain = indexer.getHandleInvalid() == "keep" and encoder.getDropLast() and encoder.getInputCols() == indexer.getOutputCols()
        if not plain:
            return None
    else:
        return None
    assembled = first.stages[-1].getInputCols()
    numbers = [c for c in assembled if c not in outputs]
    if assembled != [*numbers, *outputs]:
        return None
    return first.stages[0], numbers, inputs, levels


def score_models(
    fitted: Mapping[str, tuple[PipelineModel, float]], df: DataFrame, spec: DatasetSpec
) -> DataFrame:
    """Long form (model, key, label, probability) of all models."""
    parts = [
        score(model, df).select(
            F.lit(name).alias("model"),
            col(spec.key),
            number(spec.target).cast("int").alias("label"),
            "probability",
        )
        for name, (model, _) in fitted.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def prior_scores(train: DataFrame, df: DataFrame, target: str) -> DataFrame:
    """Class frequency of the training rows as everyone's probability."""
    share = train.agg(F.avg(number(target))).scalar()
    return df.withColumns(
        {"probability": share, "prediction": (share > 0.5).cast("int")}
    )


def best_model(comparison: DataFrame, group_by=()) -> DataFrame:
    """The row with the largest average precision, ties to the first name."""
    groups = names_of(group_by)
    # One row per model.
    order = Window.partitionBy(*[col(g) for g in groups]).orderBy(
        F.desc("average_precision"), F.asc("model")
    )
    return (
        comparison.withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == 1)
        .drop("_place")
    )

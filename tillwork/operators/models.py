"""Model families on assembled feature vectors, grid search, and their prediction frames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_vector(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output).transform(df)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a training frame for the passes of an iterative fit, spilling to disk."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def predictions(
    model, vectors: DataFrame, label: str = "label", key: str = "row_key", keep: Sequence[str] = ()
) -> DataFrame:
    """(key, label, score, prediction) of a fitted classifier with probabilities."""
    scored = model.transform(vectors)
    return scored.select(
        key,
        label,
        *keep,
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def grid_search(
    estimator,
    grid: Sequence[dict],
    vectors: DataFrame,
    folds: int,
    label: str = "label",
    fold: str = "fold",
    parallelism: int = 4,
):
    """(best model, table of mean accuracy per candidate); folds come from the fold column."""
    evaluator = MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="accuracy"
    )
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=list(grid),
        evaluator=evaluator,
        numFolds=folds,
        foldCol=fold,
        parallelism=parallelism,
    )
    with persisted(vectors) as kept:
        fitted = search.fit(kept)
    best = max(range(len(grid)), key=lambda i: fitted.avgMetrics[i])
    rows = [
        (_describe(point), float(score), i == best)
        for i, (point, score) in enumerate(zip(grid, fitted.avgMetrics))
    ]
    schema = "params string, accuracy double, best boolean"
    return fitted.bestModel, vectors.sparkSession.createDataFrame(rows, schema)


def _describe(point: dict) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda x: x[0].name))


def param_points(estimator, **values: Sequence) -> list[dict]:
    """Cartesian product of parameter values, as parameter maps of the estimator."""
    points: list[dict] = [{}]
    for name, options in values.items():
        points = [{**p, estimator.getParam(name): v} for p in points for v in options]
    return points


def importance_table(model, features: Sequence[str], spark) -> DataFrame:
    """Feature importances, largest first."""
    values = model.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def top_features(importances: DataFrame, n: int) -> list[str]:
    return [r["feature"] for r in importances.limit(n).collect()]


def svm_search(
    estimator: LinearSVC, cs: Sequence[float], train: DataFrame, folds: int, label: str = "label"
):
    """(best model, table): strengths 1/C over the rows that a fit sees, in the folds and in the end."""
    n = train.count()
    in_folds = n * (folds - 1) / folds
    points = [{estimator.getParam("regParam"): 1.0 / (c * in_folds)} for c in cs]
    _, table = grid_search(estimator, points, train, folds, label)
    best = cs[next(i for i, r in enumerate(table.collect()) if r["best"])]
    with persisted(train) as kept:
        return estimator.copy({estimator.getParam("regParam"): 1.0 / (best * n)}).fit(kept), table


def calibrated_svm(model, train: DataFrame, test: DataFrame, label: str = "label", key: str = "row_key") -> DataFrame:
    """Predictions of a margin classifier, with a probability from a logistic fit on the margin."""

    def margins(df: DataFrame) -> DataFrame:
        scored = model.transform(df).select(
            key,
            label,
            F.col("prediction").cast("int").alias("prediction"),
            vector_to_array("rawPrediction")[1].alias("margin"),
        )
        return with_vector(scored, ["margin"], "margin_vector")

    logistic = LogisticRegression(
        featuresCol="margin_vector", labelCol=label, predictionCol="calibrated", maxIter=50
    ).fit(margins(train))
    return logistic.transform(margins(test)).select(
        key, label, vector_to_array("probability")[1].alias("score"), "prediction"
    )


def polynomial_svm(degree: int, **options) -> Pipeline:
    """Polynomial kernel replaced by its explicit features."""
    expand = PolynomialExpansion(degree=degree, inputCol="features", outputCol="expanded")
    return Pipeline(stages=[expand, LinearSVC(featuresCol="expanded", **options)])

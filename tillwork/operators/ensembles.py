"""Bagging, stacking and boosting over the library's own estimators."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import hash_fraction
from tillwork.operators.models import persisted, with_vector
from tillwork.session import cut

CLIP = 1e-12


def poisson_steps(rate: float) -> list[float]:
    """Probabilities of at most 0, 1, 2, ... draws, until a 32-bit fraction cannot lie beyond."""
    steps: list[float] = []
    total = 0.0
    while total <= 1.0 - 2.0**-32:
        k = len(steps)
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        steps.append(total)
    return steps


def poisson_weight(key: str, rate: float, seed: int) -> Column:
    """How often a row is drawn in a bootstrap sample: Poisson counts from the key's hash.

    Unlike sampling by partition this draws the same rows under any partitioning.
    """
    u = hash_fraction(key, seed)
    steps = F.array(*[F.lit(step) for step in poisson_steps(rate)])
    return F.size(F.filter(steps, lambda step: u >= step)).cast("double")


def _named(estimator, name: str):
    """Copy of an estimator whose output columns carry a name of their own."""
    own = estimator.copy()
    own.setPredictionCol(f"{name}_prediction")
    own.setProbabilityCol(f"{name}_probability")
    own.setRawPredictionCol(f"{name}_raw")
    return own


def bagging(
    estimator,
    train: DataFrame,
    test: DataFrame,
    learners: int = 10,
    rate: float = 0.8,
    label: str = "label",
    key: str = "row_key",
    seed: int = 5805,
) -> DataFrame:
    """Mean probability of learners fitted on bootstrap samples: (key, label, members, score, ...)."""
    models = []
    with persisted(train) as kept:
        for i in range(learners):
            weighted = kept.withColumn("__weight", poisson_weight(key, rate, seed + i))
            own = _named(estimator, f"m{i}").setWeightCol("__weight")
            models.append(own.fit(weighted.where("__weight > 0")))
    scored = test
    for model in models:
        scored = model.transform(scored)
    members = F.array(*[vector_to_array(f"m{i}_probability")[1] for i in range(learners)])
    out = scored.select(key, label, members.alias("members"))
    mean = F.aggregate("members", F.lit(0.0), lambda a, x: a + x) / F.lit(float(learners))
    return out.withColumn("score", mean).withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def stacking(
    estimators: dict,
    train: DataFrame,
    test: DataFrame,
    folds: int = 3,
    label: str = "label",
    key: str = "row_key",
    fold: str = "fold",
) -> DataFrame:
    """Logistic model over out-of-fold base probabilities; bases are refitted on all rows."""
    names = list(estimators)

    def probabilities(models: Sequence, df: DataFrame) -> DataFrame:
        for model in models:
            df = model.transform(df)
        columns = [vector_to_array(f"{n}_probability")[1].alias(f"{n}_p") for n in names]
        return with_vector(df.select(key, label, *columns), [f"{n}_p" for n in names], "stacked")

    with persisted(train) as kept:
        held_out = None
        for f in range(folds):
            rest = kept.where(F.col(fold) != f)
            models = [_named(estimators[n], n).fit(rest) for n in names]
            part = probabilities(models, kept.where(F.col(fold) == f))
            held_out = part if held_out is None else held_out.unionByName(part)
        final = LogisticRegression(featuresCol="stacked", labelCol=label).fit(held_out)
        models = [_named(estimators[n], n).fit(kept) for n in names]
    scored = final.transform(probabilities(models, test))
    return scored.select(
        key,
        label,
        *[f"{n}_p" for n in names],
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def adaboost(
    estimator,
    train: DataFrame,
    test: DataFrame,
    rounds: int = 50,
    rate: float = 1.0,
    label: str = "label",
    key: str = "row_key",
    algorithm: str = "SAMME.R",
) -> tuple[DataFrame, list[tuple[float, float]]]:
    """Boosting of a probabilistic classifier for two classes.

    SAMME reweights rows by hits and misses, SAMME.R by class probabilities. Weights are cut off
    from their lineage every round. Returns the scored test rows and (error, stage weight) pairs.
    """
    weighted = cut(train.withColumn("__w", F.lit(1.0)))
    stages: list[tuple] = []
    history: list[tuple[float, float]] = []
    y = F.col(label)
    for i in range(rounds):
        own = _named(estimator, f"b{i}").setWeightCol("__w")
        model = own.fit(weighted)
        miss = (F.col(f"b{i}_prediction") != y).cast("double")
        scored = model.transform(weighted)
        row = scored.agg(F.sum(miss * F.col("__w")), F.sum("__w")).first()
        error = row[0] / row[1]
        if error >= 0.5 and algorithm == "SAMME":
            if not stages:
                raise ValueError("the base classifier is no better than chance")
            break
        stage = 1.0
        if algorithm == "SAMME" and error > 0:
            stage = rate * math.log((1 - error) / error)
        stages.append((model, stage))
        history.append((error, stage))
        if error <= 0 or i == rounds - 1:
            break
        if algorithm == "SAMME":
            factor = F.exp(F.lit(stage) * miss)
        else:
            factor = F.exp(-F.lit(rate * 0.5) * (2 * y - 1) * _log_odds(f"b{i}_probability"))
        mean = row[1] / max(1, weighted.count())
        weighted = cut(
            scored.select(*train.columns, (F.col("__w") * factor / F.lit(mean)).alias("__w"))
        )
    scored = test
    votes = F.lit(0.0)
    for i, (model, stage) in enumerate(stages):
        scored = model.transform(scored)
        if algorithm == "SAMME":
            votes = votes + F.lit(stage) * (2 * F.col(f"b{i}_prediction") - 1)
        else:
            votes = votes + 0.5 * _log_odds(f"b{i}_probability")
    scale = sum(s for _, s in stages) if algorithm == "SAMME" else float(len(stages))
    out = scored.select(key, label, (votes / F.lit(scale)).alias("decision"))
    out = out.withColumn("score", 1.0 / (1.0 + F.exp(-2.0 * F.col("decision"))))
    return out.withColumn("prediction", (F.col("decision") > 0).cast("int")), history


def _log_odds(probability: str) -> Column:
    p = vector_to_array(probability)[1]
    return F.log(F.greatest(p, F.lit(CLIP))) - F.log(F.greatest(1.0 - p, F.lit(CLIP)))


def fold_scores(
    fit: Callable[[DataFrame], object],
    vectors: DataFrame,
    folds: int,
    model: str,
    label: str = "label",
    fold: str = "fold",
) -> DataFrame:
    """(model, fold, accuracy): fit on all other folds, score the fold, for any fit function."""
    scored = None
    with persisted(vectors) as kept:
        fitted = [fit(kept.where(F.col(fold) != f)) for f in range(folds)]
    for f, m in enumerate(fitted):
        part = m.transform(vectors.where(F.col(fold) == f)).select(fold, label, "prediction")
        scored = part if scored is None else scored.unionByName(part)
    hit = (F.col("prediction") == F.col(label)).cast("double")
    return scored.groupBy(F.lit(model).alias("model"), fold).agg(F.avg(hit).alias("accuracy"))

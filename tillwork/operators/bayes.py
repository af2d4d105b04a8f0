"""Gaussian naive Bayes with variance smoothing, from per-class aggregates and column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.session import cut


@dataclass
class Moments:
    n: float
    mean: list[float]
    var: list[float]

    def merged(self, other: "Moments") -> "Moments":
        """Moments of two disjoint sets of rows."""
        n = self.n + other.n
        mean, var = [], []
        for m1, v1, m2, v2 in zip(self.mean, self.var, other.mean, other.var):
            delta = m2 - m1
            mean.append(m1 + delta * other.n / n)
            var.append((self.n * v1 + other.n * v2 + delta * delta * self.n * other.n / n) / n)
        return Moments(n, mean, var)


def class_moments(df: DataFrame, features: Sequence[str], keys: Sequence[str]) -> dict[tuple, Moments]:
    """Count, mean and population variance per group; a few rows, one per class (and fold)."""
    aggs = [F.count("*").alias("n")]
    for i, c in enumerate(features):
        aggs += [F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}")]
    out = {}
    for r in df.select(*keys, *features).na.drop().groupBy(*keys).agg(*aggs).collect():
        p = range(len(features))
        out[tuple(r[k] for k in keys)] = Moments(
            float(r["n"]), [r[f"m{i}"] for i in p], [r[f"v{i}"] for i in p]
        )
    return out


@dataclass
class GaussianNB:
    features: list[str]
    classes: dict
    var_smoothing: float

    def _smoothing(self) -> float:
        total = None
        for m in self.classes.values():
            total = m if total is None else total.merged(m)
        return self.var_smoothing * max(total.var)

    def log_joint(self) -> dict:
        """Log of prior times density, one column per class."""
        extra = self._smoothing()
        n = sum(m.n for m in self.classes.values())
        out = {}
        for label, m in sorted(self.classes.items()):
            constant = math.log(m.n / n)
            terms = F.lit(0.0)
            for c, mean, var in zip(self.features, m.mean, m.var):
                v = var + extra
                constant -= 0.5 * math.log(2 * math.pi * v)
                gap = F.col(c) - F.lit(mean)
                terms = terms - gap * gap / F.lit(2 * v)
            out[label] = terms + F.lit(constant)
        return out

    def parameters(self) -> dict:
        """Per class [constant, mean, factor, mean, factor, ...] of its log density."""
        extra = self._smoothing()
        n = sum(m.n for m in self.classes.values())
        out = {}
        for label, m in self.classes.items():
            variances = [v + extra for v in m.var]
            constant = math.log(m.n / n) - 0.5 * sum(math.log(2 * math.pi * v) for v in variances)
            out[label] = [constant, *[x for mean, v in zip(m.mean, variances) for x in (mean, 1 / (2 * v))]]
        return out

    def prediction(self) -> Column:
        """The most likely class; the smaller label wins ties."""
        joint = self.log_joint()
        best = F.greatest(*joint.values()) if len(joint) > 1 else next(iter(joint.values()))
        column = F.lit(None)
        for label in reversed(list(joint)):
            column = F.when(joint[label] == best, F.lit(label)).otherwise(column)
        return column

    def probability(self, label) -> Column:
        joint = self.log_joint()
        total = F.lit(0.0)
        for other in joint:
            total = total + F.exp(F.least(joint[other] - joint[label], F.lit(700.0)))
        return 1.0 / total

    def transform(self, df: DataFrame, positive=1) -> DataFrame:
        return df.withColumns(
            {"score": self.probability(positive), "prediction": self.prediction()}
        )


def fit_gaussian_nb(
    df: DataFrame, features: Sequence[str], label: str = "label", var_smoothing: float = 1e-9
) -> GaussianNB:
    found = class_moments(df, features, [label])
    return GaussianNB(list(features), {k[0]: m for k, m in found.items()}, var_smoothing)


def gaussian_nb_grid(
    df: DataFrame,
    features: Sequence[str],
    smoothings: Sequence[float],
    label: str = "label",
    fold: str = "fold",
) -> DataFrame:
    """Cross-validated accuracy per smoothing value: one pass to fit, one to score all of them.

    The model for a fold is put together from the moments of the other folds.
    """
    # Read twice: for the moments and for the scores.
    df = cut(df.select(*features, label, fold).na.drop(subset=[*features, label]))
    found = class_moments(df, features, [fold, label])
    folds = sorted({f for f, _ in found})
    labels = sorted({y for _, y in found})
    # Per fold, smoothing and class: a constant, and the mean and the factor of each feature. A row
    # looks up those of its fold, so the densities of one fold only are worked out.
    table: dict = {}
    for f in folds:
        classes: dict = {}
        for (other, y), m in found.items():
            if other != f:
                classes[y] = classes[y].merged(m) if y in classes else m
        for i, smoothing in enumerate(smoothings):
            table[f, i] = GaussianNB(list(features), classes, smoothing).parameters() if classes else {}
    at = F.array_position(F.array(*[F.lit(f) for f in folds]), F.col(fold)).cast("int") - 1
    never = [float("-inf")] + [0.0] * (2 * len(features))

    def looked_up(values: Sequence[float]) -> Column:
        return F.array(*[F.lit(float(v)) for v in values])[at]

    hits = []
    for i in range(len(smoothings)):
        joint = {}
        for y in labels:
            rows = [table[f, i].get(y, never) for f in folds]
            total = looked_up([r[0] for r in rows])
            for j, c in enumerate(features):
                gap = F.col(c) - looked_up([r[1 + 2 * j] for r in rows])
                total = total - gap * gap * looked_up([r[2 + 2 * j] for r in rows])
            joint[y] = total
        best = F.greatest(*joint.values()) if len(joint) > 1 else next(iter(joint.values()))
        predicted = F.lit(None)
        for y in reversed(labels):
            predicted = F.when(joint[y] == best, F.lit(y)).otherwise(predicted)
        hits.append(F.avg((predicted == F.col(label)).cast("double")).alias(f"a{i}"))
    per_fold = df.groupBy(fold).agg(*hits)
    averaged = per_fold.agg(*[F.avg(f"a{i}").alias(f"a{i}") for i in range(len(smoothings))])
    rows = [
        F.struct(F.lit(float(s)).alias("var_smoothing"), F.col(f"a{i}").alias("accuracy"))
        for i, s in enumerate(smoothings)
    ]
    return averaged.select(F.inline(F.array(*rows)))

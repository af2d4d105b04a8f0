"""Logistic regression with an L1 or L2 penalty on all weights, the intercept's among them.

The objective is the penalty plus C times the summed log loss, so C keeps its meaning whatever the
number of rows of a fold. A pass over the rows gives loss, gradient and curvature of all fits of a
grid at once; the driver solves each fit's quadratic model, for L1 by coordinate descent on the active
weights, and halves a step that did not lower the objective. Fits that meet their optimality
condition leave. Nothing but sums over features goes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.forest import TEST

SLICE = 16_384


@dataclass
class Fit:
    """One fit: its strength, its penalty, the fold it does not learn from, and where it is."""

    c: float
    penalty: str = "l2"
    held_out: int = TEST
    weights: np.ndarray | None = None
    before: np.ndarray | None = None
    objective: float = np.inf
    passes: int = 0
    running: bool = True
    scale: float = 1.0
    violation: float = field(default=np.inf)

    def price(self, w: np.ndarray) -> float:
        return float(np.abs(w).sum() if self.penalty == "l1" else 0.5 * (w @ w))


def _design(batches: Iterator[pa.RecordBatch], names: Sequence[str]):
    """(x with a column of ones, y, fold) in slices."""
    for batch in batches:
        x = np.column_stack([np.asarray(batch.column(c), dtype=np.float64) for c in names])
        x = np.column_stack([x, np.ones(len(x))])
        y, fold = np.asarray(batch.column("y"), dtype=np.float64), np.asarray(batch.column("fold"))
        for low in range(0, len(x), SLICE):
            part = slice(low, low + SLICE)
            yield x[part], y[part], fold[part]


def prepared(df: DataFrame, features: Sequence[str], label: str, fold: str | None) -> DataFrame:
    """(x0, x1, ..., y, fold) without rows that lack a value; callers keep it cached."""
    return df.select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
        F.col(label).cast("double").alias("y"),
        (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"),
    ).dropna()


def _pass(rows: DataFrame, names: Sequence[str], fits: Sequence[Fit]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(loss, gradient, curvature) of the summed log loss of each fit at its weights."""
    size = len(names) + 1
    sent = [(f.weights, f.held_out) for f in fits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(sent), 1 + size + size * size))
        for x, y, fold in _design(batches, names):
            for i, (w, held) in enumerate(sent):
                mine = (fold != TEST) & (fold != held)
                a, b = (x, y) if mine.all() else (x[mine], y[mine])
                z = a @ w
                p = 0.5 * (1.0 + np.tanh(0.5 * z))
                sums[i, 0] += (np.logaddexp(0.0, z) - b * z).sum()
                sums[i, 1 : 1 + size] += a.T @ (p - b)
                sums[i, 1 + size :] += (a.T @ (a * (p * (1 - p))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sent), dtype=np.int32)), pa.array(list(sums), pa.list_(pa.float64()))],
            names=["fit", "sums"],
        )

    told = rows.mapInArrow(run, "fit int, sums array<double>")
    added = told.select("fit", F.posexplode("sums").alias("i", "v")).groupBy("fit", "i").agg(F.sum("v").alias("v"))
    out = np.zeros((len(sent), 1 + size + size * size))
    for r in added.collect():
        out[r["fit"], r["i"]] = r["v"]
    return [(float(s[0]), s[1 : 1 + size], s[1 + size :].reshape(size, size)) for s in out]


def violation(w: np.ndarray, g: np.ndarray, penalty: str) -> float:
    """Largest breach of the optimality conditions, for the gradient of C times the loss."""
    if penalty == "l2":
        return float(np.abs(w + g).max())
    return float(np.where(w != 0, np.abs(g + np.sign(w)), np.maximum(np.abs(g) - 1.0, 0.0)).max())


def _step(w: np.ndarray, g: np.ndarray, h: np.ndarray, penalty: str) -> np.ndarray:
    """Minimizer of the penalty plus the quadratic model around ``w``, less ``w``."""
    if penalty == "l2":
        return -np.linalg.solve(h + np.eye(len(w)), g + w)
    d = np.zeros_like(w)
    h = h + 1e-12 * np.trace(h) / len(w) * np.eye(len(w))
    active = np.arange(len(w))
    for sweep in range(1000):
        largest = 0.0
        for j in active:
            slope, curve = g[j] + h[j] @ d, max(h[j, j], 1e-300)
            u = w[j] + d[j] - slope / curve
            new = np.sign(u) * max(abs(u) - 1.0 / curve, 0.0) - w[j]
            largest = max(largest, abs(new - d[j]) * np.sqrt(curve))
            d[j] = new
        if largest < 1e-10:
            if len(active) == len(w):
                break
            active = np.arange(len(w))  # all weights once more before the end
        else:
            active = np.flatnonzero(w + d != 0) if sweep % 5 else np.arange(len(w))
            if not len(active):
                active = np.arange(len(w))
    return d


def train(rows: DataFrame, inputs: int, fits: Sequence[Fit], max_iter: int = 100, tol: float = 1e-6) -> Sequence[Fit]:
    """Bring all fits to their optimum; ``tol`` is relative to the gradient at the start."""
    names = [f"x{i}" for i in range(inputs)]
    steps: dict[int, np.ndarray] = {}
    for f in fits:
        f.weights = np.zeros(inputs + 1)
    while running := [i for i, f in enumerate(fits) if f.running]:
        for i, (loss, g, h) in zip(running, _pass(rows, names, [fits[i] for i in running])):
            f = fits[i]
            objective = f.price(f.weights) + f.c * loss
            f.passes += 1
            g = f.c * g
            if f.passes == 1:
                f.scale = max(float(np.abs(g).max()), 1e-300)
            if objective > f.objective + 1e-12 * abs(f.objective) and np.abs(steps[i]).max() > 1e-14:
                steps[i] = steps[i] / 2
                f.weights = f.before + steps[i]
                f.running = f.passes < max_iter
                continue
            f.objective, f.violation = objective, violation(f.weights, g, f.penalty)
            if f.violation <= tol * max(f.scale, 1.0) or f.passes >= max_iter:
                f.running = False
                continue
            steps[i] = _step(f.weights, g, f.c * h, f.penalty)
            f.before, f.weights = f.weights, f.weights + steps[i]
    return fits


def held_out_accuracy(rows: DataFrame, inputs: int, fits: Sequence[Fit]) -> list[float]:
    names = [f"x{i}" for i in range(inputs)]
    sent = [(f.weights, f.held_out) for f in fits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, n = np.zeros(len(sent)), np.zeros(len(sent))
        for x, y, fold in _design(batches, names):
            for i, (w, held) in enumerate(sent):
                mine = fold == held
                hits[i] += ((x[mine] @ w > 0) == (y[mine] > 0.5)).sum()
                n[i] += mine.sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sent), dtype=np.int32)), pa.array(hits), pa.array(n)], names=["fit", "hits", "n"]
        )

    added = rows.mapInArrow(run, "fit int, hits double, n double").groupBy("fit").agg(
        F.sum("hits").alias("hits"), F.sum("n").alias("n")
    )
    found = {r["fit"]: r["hits"] / max(r["n"], 1.0) for r in added.collect()}
    return [found.get(i, 0.0) for i in range(len(fits))]


def grid(
    rows: DataFrame, inputs: int, folds: int, cs: Sequence[float] = (0.01, 0.1, 1.0, 10.0, 100.0),
    penalties: Sequence[str] = ("l1", "l2"),
) -> tuple[Fit, list[tuple[float, str, float]]]:
    """The fit on all rows of the best mean accuracy over folds, and (C, penalty, accuracy) of all points.

    All points train on all folds and on all rows in the same passes; the first point wins ties.
    """
    points = [(c, p) for c in cs for p in penalties]
    fits = [Fit(c, p, fold) for c, p in points for fold in (*range(folds), TEST)]
    train(rows, inputs, fits)
    scores = held_out_accuracy(rows, inputs, fits)
    step = folds + 1
    table = [(c, p, float(np.mean(scores[i * step : i * step + folds]))) for i, (c, p) in enumerate(points)]
    best = max(range(len(points)), key=lambda i: table[i][2])
    return fits[best * step + folds], table


def predict(df: DataFrame, fit: Fit, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` with score and prediction, as column expressions."""
    z = F.lit(float(fit.weights[-1]))
    for c, w in zip(features, fit.weights):
        z = z + F.col(c).cast("double") * F.lit(float(w))
    out = df.select(*keep, (1.0 / (1.0 + F.exp(-z))).alias("score"))
    return out.withColumn("prediction", (F.col("score") > 0.5).cast("int"))

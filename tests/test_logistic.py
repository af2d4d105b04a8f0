"""Optimality of the penalized logistic fits."""

import numpy as np
import pytest

from tillwork.operators import logistic
from tillwork.operators.logistic import Fit


def rows(n=800):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 5)) * [1, 2, 0.5, 1, 1]
    y = (x[:, 0] - 0.7 * x[:, 1] + 0.4 + rng.logistic(size=n) > 0).astype(float)
    return x, y, np.arange(n) % 4 - 1


@pytest.fixture(scope="module")
def frame(spark):
    x, y, fold = rows()
    data = [(*map(float, r), float(c), int(f)) for r, c, f in zip(x, y, fold)]
    return spark.createDataFrame(data, "a double, b double, c double, d double, e double, label double, fold int").repartition(3)


def test_fits_meet_the_optimality_conditions(frame):
    x, y, fold = rows()
    data = logistic.prepared(frame, list("abcde"), "label", "fold").cache()
    fits = [Fit(c, p, held) for c in (0.01, 1.0, 100.0) for p in ("l1", "l2") for held in (-1, 1)]
    logistic.train(data, 5, fits)
    full = np.column_stack([x, np.ones(len(x))])
    for f in fits:
        mine = (fold != -1) & (fold != f.held_out)
        z = full[mine] @ f.weights
        g = f.c * full[mine].T @ (1 / (1 + np.exp(-z)) - y[mine])
        if f.penalty == "l2":
            assert np.abs(g + f.weights).max() < 1e-3
        else:
            assert np.abs(g[f.weights != 0] + np.sign(f.weights[f.weights != 0])).max(initial=0) < 1e-3
            assert np.abs(g[f.weights == 0]).max(initial=0) <= 1 + 1e-3
        assert f.passes < 40
    strong = [f for f in fits if f.penalty == "l1" and f.c == 0.01]
    assert all((f.weights == 0).any() for f in strong)


def test_agrees_with_the_librarys_fit(frame):
    from pyspark.ml.classification import LogisticRegression

    from tillwork.operators.models import with_vector

    train = frame.where("fold >= 0")
    n = train.count()
    # The library does not penalize the intercept, so the penalty has to be weak here.
    library = LogisticRegression(labelCol="label", regParam=1e-6 / n, standardization=False, tol=1e-12, maxIter=500).fit(
        with_vector(train, list("abcde"))
    )
    fit = logistic.train(logistic.prepared(frame, list("abcde"), "label", "fold"), 5, [Fit(1e6)])[0]
    assert np.allclose(fit.weights, [*library.coefficients, library.intercept], atol=1e-3)


def test_grid_and_odd_tables(frame):
    data = logistic.prepared(frame, list("abcde"), "label", "fold")
    best, table = logistic.grid(data, 5, 3, (0.1, 10.0))
    assert len(table) == 4 and max(t[2] for t in table) > 0.75
    out = logistic.predict(frame, best, list("abcde"), ["label"])
    assert out.where("prediction = label").count() > 0.75 * frame.count()
    one = frame.where("label = 1")
    only = logistic.train(logistic.prepared(one, list("abcde"), "label", "fold"), 5, [Fit(1.0)])[0]
    assert np.isfinite(only.weights).all() and only.weights[-1] > 0
    none = logistic.train(logistic.prepared(frame.limit(0), list("abcde"), "label", "fold"), 5, [Fit(1.0, "l1")])[0]
    assert (none.weights == 0).all()

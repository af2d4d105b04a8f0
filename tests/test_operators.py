"""Edge fixtures for the relational and statistical operators."""

import math
from datetime import datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwork.functions.columns import holiday_flag, weekend_flag
from tillwork.functions.special import f_upper, t_quantile, t_two_sided
from tillwork.operators import bayes, encode, metrics, outliers, profile, sales, split
from tillwork.operators.components import connected_components
from tillwork.operators.ols import Gram
from tillwork.operators.prefix import dense_index, running_sums
from tillwork.operators.quantiles import exact_quantiles
from tillwork.sources import read_csv_transactions

HEADER = (
    "CustomerID,ProductID,Quantity,Price,TransactionDate,PaymentMethod,StoreLocation,"
    "ProductCategory,DiscountApplied(%),TotalAmount\n"
)


def test_csv_dates_raise_or_become_null(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        HEADER
        + "1,A,2,3.5,2023-12-25 10:30:00,Cash,Town,Books,10,6.3\n"
        + "2,B,1,1.0,not a date,Card,City,Toys,0,1.0\n"
    )
    rows = read_csv_transactions(spark, str(path), coerce_dates=True).orderBy("customer_id").collect()
    assert rows[0]["transaction_date"] == datetime(2023, 12, 25, 10, 30)
    assert rows[1]["transaction_date"] is None and rows[1]["quantity"] == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        read_csv_transactions(spark, str(path)).collect()
    inferred = read_csv_transactions(spark, str(path), infer_schema=True, coerce_dates=True)
    assert inferred.columns == read_csv_transactions(spark, str(path)).columns


def test_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, None), (2, None)], "x int, y string")
    assert profile.duplicate_count(df).first()[0] == 2
    assert profile.drop_duplicates(df).count() == 3
    assert profile.drop_nulls(df).count() == 2
    assert {r[0]: r[1] for r in profile.null_counts(df).collect()} == {"x": 2, "y": 3}
    assert profile.duplicate_count(df.limit(0)).first()[0] == 0


def test_bracketed_quantiles_equal_direct_ones(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([np.full(2000, 7.0), rng.exponential(50, 3001), -rng.exponential(9, 999)])
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(values)], "v double, i int").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = exact_quantiles(df, ["v", "i"], probs, small_rows=0, bracket_distinct=10, accuracy=50)
    assert np.allclose(got["v"], np.quantile(values, probs))
    assert np.allclose(got["i"], np.quantile(np.arange(len(values)), probs))
    assert exact_quantiles(df.limit(0), ["v"], [0.5])["v"] == [None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=60, unique=True))
def test_running_sums_over_ranges(spark, values):
    df = spark.createDataFrame([(v, abs(v)) for v in values], "k int, w int").repartition(3)
    out, totals = running_sums(df, "k", {"upto": "w"}, ascending=False, rows_per_range=5)
    expected = {v: sum(abs(u) for u in values if u >= v) for v in values}
    assert {r["k"]: r["upto"] for r in out.collect()} == expected
    assert totals["upto"] == sum(map(abs, values))


def test_dense_index_of_text(spark):
    words = [f"w{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(w,) for w in reversed(words)], "w string")
    rows = dense_index(df, "w", "i", rows_per_range=40).collect()
    assert {r["w"]: r["i"] for r in rows} == {w: i for i, w in enumerate(words)}


def test_label_codes_beyond_the_literal_limit(spark, monkeypatch):
    monkeypatch.setattr(encode, "LITERAL_LABELS", 3)
    df = spark.createDataFrame([(c,) for c in "dbaceb"], "c string")
    codes = {r["c"]: r["c_code"] for r in encode.label_encode(df, ["c"]).collect()}
    assert codes == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4}


def test_median_ties_are_low(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 5, 5, 5, 9)], "total_amount double")
    rows = encode.label_high_low(df).collect()
    assert sorted((r["total_amount"], r["label_name"], r["label"]) for r in rows)[-1] == (9.0, "High", 0)
    assert sum(r["label"] for r in rows) == 4


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "c double, x double")
    assert {r["c"] for r in encode.minmax_scale(df, ["c"]).collect()} == {0.0}
    assert {r["c"] for r in encode.standardize(df, ["c"]).collect()} == {0.0}
    outside = encode.minmax_scale(df, ["x"], {"x": (1.0, 1.5)}).agg(F.max("x")).first()[0]
    assert outside == 2.0


def test_sequential_fences_differ_from_single_pass(spark):
    rows = [(float(i), float(i)) for i in range(20)] + [(1000.0, 60.0), (1001.0, 61.0), (5.0, 45.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    both = outliers.iqr_filter(df, ["a", "b"]).collect()

    def fences(v):
        q1, q3 = np.quantile(v, [0.25, 0.75])
        return q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)

    kept = rows
    for i in (0, 1):
        lo, hi = fences([r[i] for r in kept])
        kept = [r for r in kept if lo <= r[i] <= hi]
    assert sorted(map(tuple, both)) == sorted(kept)


def test_growth_from_zero_and_gaps(spark):
    rows = [("2024-02-28", 5.0, 1), ("2024-03-02", 10.0, 2)]
    df = spark.createDataFrame(rows, "d string, total_amount double, quantity int").withColumn(
        "transaction_date", F.to_timestamp("d")
    )
    daily = sales.daily_totals(df)
    growth = [(str(r["day"]), r["revenue"], r["growth"]) for r in sales.daily_growth(daily).orderBy("day").collect()]
    assert growth == [
        ("2024-02-28", 5.0, 0.0),
        ("2024-02-29", 0.0, -1.0),
        ("2024-03-01", 0.0, 0.0),
        ("2024-03-02", 10.0, math.inf),
    ]
    months = df.withColumn("transaction_date", F.to_timestamp(F.when(F.col("quantity") == 2, "2024-05-02").otherwise("2024-02-28")))
    found = [(str(r[0]), r[1]) for r in sales.monthly_revenue(months).orderBy("month_end").collect()]
    assert found == [("2024-02-29", 5.0), ("2024-03-31", 0.0), ("2024-04-30", 0.0), ("2024-05-31", 10.0)]


def test_future_calendar_crosses_the_year(spark):
    df = spark.createDataFrame([("2023-12-20",)], "d string").withColumn("transaction_date", F.to_timestamp("d"))
    days = [str(r["day"]) for r in sales.future_calendar(df).orderBy("day").collect()]
    assert days[0] == "2023-12-21" and days[-1] == "2024-01-19" and len(days) == 30


def test_weekend_and_holiday(spark):
    days = [("2023-12-25",), ("2024-01-01",), ("2024-01-06",), ("2024-01-07",), ("2024-01-08",)]
    df = spark.createDataFrame(days, "d string").withColumn("ts", F.to_timestamp("d"))
    rows = df.select("d", weekend_flag("ts").alias("w"), holiday_flag("ts").alias("h")).orderBy("d").collect()
    assert [(r["w"], r["h"]) for r in rows] == [(0, 1), (0, 1), (1, 0), (1, 0), (0, 0)]


def test_stratified_parts_are_exact_and_stable(spark):
    rows = [(f"k{i}", "big" if i % 10 else "small") for i in range(1000)]
    df = spark.createDataFrame(rows, "row_key string, label string")
    first = split.stratified_split(df, "label", 0.3)
    counts = {(r["label"], r["split"]): r["count"] for r in first.groupBy("label", "split").count().collect()}
    assert counts == {("big", "test"): 270, ("big", "train"): 630, ("small", "test"): 30, ("small", "train"): 70}
    again = split.stratified_split(df.repartition(7), "label", 0.3)
    assert sorted(first.collect()) == sorted(again.collect())
    folds = split.stratified_kfold(df, "label", 5).groupBy("label", "fold").count().collect()
    assert {r["count"] for r in folds if r["label"] == "small"} == {20} and len(folds) == 10


def test_metrics_with_ties_and_missing_classes(spark):
    rows = [(1, 0.5, 1), (0, 0.5, 1), (1, 0.5, 1), (0, 0.1, 0)]
    df = spark.createDataFrame(rows, "label int, score double, prediction int")
    assert metrics.roc_auc(df).first()[0] == pytest.approx(0.75)
    ones = spark.createDataFrame([(1, 0.3, 0), (1, 0.2, 0)], "label int, score double, prediction int")
    row = metrics.binary_metrics(ones).first()
    assert (row["precision"], row["specificity"], row["recall"]) == (0.0, 0.0, 0.0)
    assert math.isnan(metrics.roc_auc(ones).first()[0])
    grid = {(r[0], r[1]): r[2] for r in metrics.confusion_matrix(ones).collect()}
    assert grid == {(0, 0): 0, (0, 1): 0, (1, 0): 2, (1, 1): 0}
    assert metrics.comparison_row(df, "m").first()["auc"] == 0.75


def test_auc_agrees_with_the_library(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(2)
    rows = [(float(rng.integers(0, 2)), float(np.round(rng.random(), 2))) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, score double")
    library = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(library.evaluate(df), abs=1e-9)


def regression_rows(n=400, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3))
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(0, 1, n) + 3
    return [(*map(float, a), float(b)) for a, b in zip(x, y)]


@pytest.mark.parametrize("constant", [False, True])
def test_least_squares_agrees_with_the_library(spark, constant):
    from pyspark.ml.regression import LinearRegression

    df = spark.createDataFrame(regression_rows(), "a double, b double, c double, label double")
    fit = Gram(df, ["a", "b", "c"], "label").fit(constant=constant)
    vectors = encode_vectors(df)
    summary = LinearRegression(fitIntercept=constant, solver="normal").fit(vectors).summary
    own_t = dict(zip(fit.features, fit.t))
    own_p = dict(zip(fit.features, fit.p))
    for name, t, p in zip("abc", summary.tValues, summary.pValues):
        assert own_t[name] == pytest.approx(t, rel=1e-6)
        assert own_p[name] == pytest.approx(p, abs=1e-9)
    assert fit.r2 == pytest.approx(summary.r2, rel=1e-9)
    low_high = fit.summary(spark).collect()
    assert all(r["ci_low"] < r["coef"] < r["ci_high"] for r in low_high)


def encode_vectors(df):
    from tillwork.operators.models import with_vector

    return with_vector(df, ["a", "b", "c"])


def test_partial_f_is_t_squared(spark):
    df = spark.createDataFrame(regression_rows(), "a double, b double, c double, label double")
    gram = Gram(df, ["a", "b", "c"], "label")
    fit = gram.fit()
    for (name, f, p), t, q in zip(gram.partial_f(), fit.t, fit.p):
        assert f == pytest.approx(t * t, rel=1e-8) and p == pytest.approx(q, abs=1e-9)
    assert "c" not in gram.backward() and set(gram.backward()) <= {"a", "b"}
    assert set(gram.bidirectional()) >= {"a", "b"}


def test_collinear_columns_keep_all_features(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i * i)) for i in range(1, 30)], "a double, b double, y double")
    assert Gram(df, ["a", "b"], "y").vif_select() == ["a", "b"]


@pytest.mark.parametrize("offset", [0.0, 1e4, 1e5, 1e6, 1e7])
@pytest.mark.parametrize("constant", [False, True])
def test_least_squares_far_from_zero(spark, offset, constant):
    rng = np.random.default_rng(3)
    x = offset + rng.normal(0, 1, 2000)
    w = offset / 3 + rng.normal(0, 2, 2000)
    y = 3 * x - w + rng.normal(0, 1, 2000)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x, w, y)], "x double, w double, y double")
    gram = Gram(df, ["x", "w"], "y")
    fit = gram.fit(constant=constant)
    if constant:
        basis, rhs, slopes = np.column_stack([x - x.mean(), w - w.mean()]), y - y.mean(), fit.coef[1:]
    else:
        basis, rhs, slopes = np.column_stack([x, w]), y, fit.coef
    size = np.linalg.norm(basis, axis=0)
    expected = np.linalg.lstsq(basis / size, rhs, rcond=None)[0] / size
    rest = rhs - basis @ expected
    assert np.allclose(slopes, expected, rtol=1e-6)
    assert fit.rss == pytest.approx(rest @ rest, rel=1e-6)
    u, s, vt = np.linalg.svd(basis / size, full_matrices=False)
    se = np.sqrt(fit.rss / fit.df * np.sum((vt.T / s) ** 2, axis=1)) / size
    assert np.allclose(fit.se[-2:], se, rtol=1e-6)
    assert all(p < 1e-9 for p in fit.p[-2:])


def test_dependent_columns(spark):
    rng = np.random.default_rng(4)
    a, c = rng.normal(5, 1, 500), rng.normal(0, 1, 500)
    y = 2 * a + c + rng.normal(0, 0.5, 500)
    rows = [(float(p), 2 * float(p), float(q), 0.0, float(r)) for p, q, r in zip(a, c, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, zero double, y double")
    gram = Gram(df, ["a", "b", "c"], "y")
    assert gram.vif()["a"] == gram.vif()["b"] == math.inf
    assert gram.vif_select() == ["c"]
    fit = gram.fit()
    x = np.column_stack([a, 2 * a, c])
    least = np.linalg.pinv(x) @ y
    assert np.allclose(fit.coef, least) and fit.rank == 2 and fit.df == 498
    spread = fit.rss / fit.df * np.diag(np.linalg.pinv(x.T @ x))
    assert np.allclose(fit.se, np.sqrt(spread))
    assert gram.backward() == ["a", "b", "c"]
    assert "c" in gram.bidirectional()
    with_zero = Gram(df, ["a", "zero", "c"], "y")
    assert with_zero.backward() == ["a", "c"] and with_zero.vif()["zero"] == math.inf
    with pytest.raises(ValueError, match="no row"):
        Gram(df.limit(0), ["a"], "y")


def test_exact_fit_has_no_residual(spark):
    df = spark.createDataFrame([(float(i), 4.0 + 2.0 * i, 7.0) for i in range(50)], "x double, y double, k double")
    fit = Gram(df, ["x"], "y").fit(constant=True)
    assert np.allclose(fit.coef, [4.0, 2.0]) and fit.r2 == pytest.approx(1.0)
    flat = Gram(df, ["x"], "k").fit(constant=True)
    assert math.isnan(flat.r2) and flat.coef[0] == pytest.approx(7.0)


def test_tail_probabilities():
    # Table values: t with 10 degrees of freedom at 2.228, F(2, 10) at 4.103.
    assert t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert f_upper(4.103, 2, 10) == pytest.approx(0.05, abs=1e-4)
    assert t_quantile(0.05, 10) == pytest.approx(2.228, abs=1e-3)
    # Far out in the degrees of freedom t is normal.
    for t in (0.1, 1.0, 1.7, 1.9, 3.0):
        for df in (1e6, 1e9, 1e12):
            assert t_two_sided(t, df) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-4 if df < 1e9 else 1e-5)
    assert f_upper(9.0, 1, 25) == pytest.approx(t_two_sided(3.0, 25), rel=1e-9)


def test_gaussian_nb_agrees_with_the_library(spark):
    from pyspark.ml.classification import NaiveBayes

    rng = np.random.default_rng(8)
    rows = [(float(a + 2 * y), float(b), int(y)) for a, b, y in zip(rng.normal(0, 1, 300), rng.normal(0, 2, 300), rng.integers(0, 2, 300))]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    own = bayes.fit_gaussian_nb(df, ["a", "b"]).transform(df).orderBy("a").collect()
    from tillwork.operators.models import with_vector

    vectors = with_vector(df, ["a", "b"])
    library = NaiveBayes(modelType="gaussian").fit(vectors).transform(vectors).orderBy("a").collect()
    assert [r["prediction"] for r in own] == [int(r["prediction"]) for r in library]
    assert np.allclose([r["score"] for r in own], [r["probability"][1] for r in library], atol=1e-6)


def test_components_on_driver_and_distributed(spark):
    chain = [(i, i + 1) for i in range(0, 30)] + [(100, 101), (101, 102), (50, 50)]
    df = spark.createDataFrame(chain, "a long, b long")
    expected = {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, 50: 50}
    for limit in (1000, 5):
        found = {r["node"]: r["component"] for r in connected_components(df, limit).collect()}
        assert found == expected

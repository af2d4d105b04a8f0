"""Plans: only needed columns are read, filters reach the scan, nothing is multiplied out."""

import contextlib
import io

import pytest

from tillwork.operators import encode, models
from tillwork.plans import QUERIES, modelling

CHEAP = (
    "scan_transactions", "category_sales", "describe_numeric", "null_counts", "duplicate_count",
    "daily_growth", "monthly_revenue", "future_calendar", "label_encode", "quantile_label",
    "standardize", "iqr_filter", "kde_curve", "histogram", "stratified_split", "confusion_matrix",
    "classification_report", "roc_curve", "best_f1_threshold", "classifier_comparison",
    "ols_predictions", "basket_matrix", "association_rules", "kmeans_assign", "k_distance",
    "smote", "dbscan",
)


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", CHEAP)
def test_no_cross_joins(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_scan_reads_only_needed_columns(spark, small):
    text = plan(QUERIES["category_sales"](spark, small))
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert len(scans) == 2  # lineitem and part, no other dimension
    assert all("l_shipdate" not in s and "p_name" not in s for s in scans)


def test_fences_are_pushed_into_the_scan(spark, small):
    text = plan(QUERIES["iqr_filter"](spark, small))
    assert "GreaterThanOrEqual(l_quantity" in text and "LessThanOrEqual(l_extendedprice" in text


def test_hot_groups_are_limited_before_the_shuffle(spark, small):
    from tillwork.operators.neighbors import _positions

    df = spark.read.parquet(f"{small}/part.parquet")
    text = plan(_positions(df, ["p_size"], "p_partkey", None, None, 5))
    assert "WindowGroupLimit" in text


def test_kernel_features_are_kept_once(spark, small, monkeypatch):
    monkeypatch.setattr(models, "persisted", None)
    assert QUERIES["rbf_svm"](spark, small).count() == 1


def test_few_labels_are_joined_without_a_shuffle(spark, small):
    df = spark.read.parquet(f"{small}/part.parquet")
    text = plan(encode.label_encode(df, ["p_brand", "p_type"]))
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_joined_rows_are_stored_once_and_without_products(spark, small, monkeypatch):
    written, joins = [], []
    store, join = modelling.stored, modelling.transactions
    monkeypatch.setattr(modelling, "stored", lambda df: written.append(df.columns) or store(df))
    monkeypatch.setattr(modelling, "transactions", lambda *a: joins.append(a) or join(*a))
    df, inputs = modelling.multiclass_columns(spark, small)
    assert len(joins) == 1 and len(inputs) == 14 + 55
    assert not any("_x_" in c for columns in written for c in columns)
    assert "Join" not in plan(df)
    train, _ = modelling._amount_frame(spark, small)
    assert len(joins) == 2 and "l_orderkey" not in plan(train)

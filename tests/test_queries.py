"""Every query with SQL must give DuckDB's result on the smallest tables; the others are run there and
held against what must be true of their columns."""

import math

import pytest

from compare import compare, duck
from tillwork.plans import ORACLES, QUERIES

# Rows of one pair share their key at this scale, so rankings by key are not unique.
ONLY_LARGER = {"gaussian_nb", "scan_transactions", "stratified_split", "stratified_kfold"}


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - ONLY_LARGER))
def test_query_matches_sql(spark, small, con, name):
    ok, message, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], small)
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def check_best(rows):
    assert sum(r["best"] for r in rows) == 1
    assert next(r["accuracy"] for r in rows if r["best"]) == max(r["accuracy"] for r in rows)


def check_confusion(rows):
    for r in rows:
        tn, fp, fn, tp = (r[c] for c in ("tn", "fp", "fn", "tp"))
        assert tn + fp + fn + tp > 100
        for value, top, rest in (
            (r["precision"], tp, fp), (r["recall"], tp, fn), (r["specificity"], tn, fp)
        ):
            assert value == pytest.approx(top / (top + rest) if top + rest else 0.0, abs=1e-4)


def check_importance(rows):
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0, abs=1e-6)


def check_path(rows):
    rows = sorted(rows, key=lambda r: r["alpha"])
    leaves = [r["leaves"] for r in rows]
    assert leaves == sorted(leaves, reverse=True) and leaves[-1] == 1


def check_sweep(rows):
    costs = [r["wcss"] for r in sorted(rows, key=lambda r: r["k"])]
    assert len(rows) == 9 and costs == sorted(costs, reverse=True)


#: What must hold where a result has these columns.
CHECKS = [
    ({"best", "accuracy"}, check_best), ({"tn", "fp", "fn", "tp", "precision"}, check_confusion),
    ({"importance"}, check_importance), ({"alpha", "leaves"}, check_path), ({"wcss", "k"}, check_sweep),
]
SHARES = {"accuracy", "score", "precision", "recall", "f1", "auc", "train_accuracy", "test_accuracy", "p_value"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_holds_together(spark, small, name):
    out = QUERIES[name](spark, small)
    rows = out.collect()
    assert rows and len(set(out.columns)) == len(out.columns)
    for needed, check in CHECKS:
        if needed <= set(out.columns):
            check(rows)
    for r in rows:
        for c in SHARES & set(out.columns):
            assert r[c] is None or math.isnan(r[c]) or -1e-9 <= r[c] <= 1 + 1e-9

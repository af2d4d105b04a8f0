"""DBSCAN keeps its rows narrow and sends tables of cells to them."""

import numpy as np

from tillwork.operators import dbscan as module


def points(spark):
    rng = np.random.default_rng(4)
    xy = np.round(np.concatenate([rng.normal(0, 1, (300, 2)), rng.normal(9, 1, (200, 2)), rng.uniform(-20, 30, (40, 2))]), 2)
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xy)], "row_key long, x double, y double")


def test_rows_are_stored_without_cells_and_not_shuffled(spark, monkeypatch):
    tables, plans = [], []
    store = module.stored
    monkeypatch.setattr(module, "stored", lambda df: tables.append(df.columns) or store(df))
    out = module.dbscan(points(spark), ("x", "y"), 0.8, 4)
    assert tables[0] == ["key", "x0", "x1"]
    plans = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plans


def test_many_cells_give_the_same_clusters(spark, monkeypatch):
    few = sorted(module.dbscan(points(spark), ("x", "y"), 0.8, 4).collect())
    monkeypatch.setattr(module, "BROADCAST_CELLS", 0)
    assert sorted(module.dbscan(points(spark), ("x", "y"), 0.8, 4).collect()) == few
    assert len({r["cluster"] for r in few}) > 2

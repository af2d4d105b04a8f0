"""Passes over the rows that give way to fewer or cheaper ones, with the same results."""

import numpy as np
from pyspark.sql import functions as F

from tillwork.functions.columns import hash32
from tillwork.operators import forest, split


def test_stored_hash_gives_the_same_parts(spark, monkeypatch):
    df = spark.createDataFrame(
        [(f"k{i % 900}", [0, 1, None][i % 3]) for i in range(1500)], "row_key string, label int"
    )
    cuts = [0.2, 0.5, 0.9]
    plain = split.stratified_parts(df, "label", cuts)
    hashed = df.withColumn("h", hash32("row_key", 42))
    written = []
    kept = split.cut
    monkeypatch.setattr(split, "cut", lambda x: written.append(kept(x)) or written[-1])
    given = split.stratified_parts(hashed, "label", cuts, hashed="h").drop("h")
    assert sorted(map(str, given.collect())) == sorted(map(str, plain.collect()))
    # What is written are cuts, one row a class, never the rows.
    assert [w.count() for w in written] == [3, 3]


def test_few_values_are_not_sketched(spark, monkeypatch):
    df = spark.createDataFrame(
        [(i % 7, i % 70, i, None) for i in range(3000)], "few int, some int, many int, none double"
    )
    asked = []
    sketch = F.percentile_approx
    monkeypatch.setattr(forest.F, "percentile_approx", lambda v, *a: asked.append(v) or sketch(v, *a))
    few, some, many, none = forest.bin_edges(df, ["few", "some", "many", "none"])
    assert len(asked) == 2
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5]
    assert 55 <= len(some) <= 63 and len(many) == 63 and len(none) == 0
    # An order statistic of a full table lies near its rank.
    assert np.abs(many - np.arange(1, 64) * 3000 / 64).max() < 5

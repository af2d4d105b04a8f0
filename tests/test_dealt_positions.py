"""Rows dealt by position before they are added up, and votes taken on rows added up by position."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.operators import boosting, forest, trees
from tillwork.operators.ensembles import poisson_steps
from tillwork.operators.forest import TEST, Spec
from tillwork.operators.trees import UNBOUNDED


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (4000, 2))
    x[:1500] = 4  # one position with far more rows than a part
    y = ((x[:, 0] * x[:, 1] + rng.normal(0, 9, 4000)) > 18).astype(int)
    listed = [(i, int(a), int(b), int(c), i % 4 - 1) for i, ((a, b), c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(listed, "row_key long, a int, b int, label int, fold int").repartition(6)
    return forest.binned(df, ["a", "b"], forest.class_channels("label", 2), F.col("fold"))


SPECS = [
    Spec(max_depth=UNBOUNDED, seed=7 * i, held_out=i % 2, bootstrap=1.0, bag=(0.8, 5) if i % 3 else None) for i in range(5)
] + [Spec(max_depth=UNBOUNDED, held_out=(0, 1), left_out=(2,))]


def grown(data):
    out = forest.grow(data, SPECS)
    rows = [trees.tree_of(out, i) for i in range(len(SPECS))]
    gains = {(r["tree"], r["feature"]): r["gain"] for r in forest.split_gains(data, SPECS).collect()}
    return [(t.feature.tolist(), t.bin.tolist(), t.stats.tolist(), t.held.tolist()) for t in rows], gains


def test_dealt_rows_grow_the_same_trees(data, monkeypatch):
    plain, gains = grown(data)
    parts = []
    dealt = forest._dealt
    monkeypatch.setattr(forest, "DEALT_ROWS", 300)
    monkeypatch.setattr(forest, "_dealt", lambda *a: parts.append(dealt(*a)) or parts[-1])
    trees_, gains_ = grown(data)
    assert trees_ == plain and gains_ == pytest.approx(gains)
    # Every row once, no part far above the rest, a position in one part unless it is too large for it.
    found = parts[0].toArrow().to_pylist()
    assert sum(r["n"] for r in found) == 4000
    sizes, homes = {}, {}
    for r in found:
        sizes[r["part"]] = sizes.get(r["part"], 0) + r["n"]
        for at in set(map(tuple, np.frombuffer(r["bins"], np.uint8).reshape(2, -1).T.tolist())):
            homes.setdefault(at, set()).add(r["part"])
    assert len(sizes) >= 14 and max(sizes.values()) <= 2 * 300
    assert sorted(map(len, homes.values()))[-2] == 1 and max(map(len, homes.values())) >= 5


def test_votes_of_rows_added_up_are_those_of_rows(data, monkeypatch):
    read, summed = [], boosting.summed
    monkeypatch.setattr(boosting, "summed", lambda *a: read.append(summed(*a)) or read[-1])
    pairs = [(fold, ()) for fold in range(3)]
    fast = trees.forest_grid(data, pairs, trees=(2, 4), depths=(None, 3))
    assert len(read) == 1 and read[0].blocks.agg(F.sum("n")).first()[0] <= 81 * 4 * 2
    monkeypatch.setattr(trees, "VOTED_CELLS", 0)
    assert trees.forest_grid(data, pairs, trees=(2, 4), depths=(None, 3)) == fast and len(read) == 1


@pytest.mark.parametrize("rate", [0.8, 1.0])
def test_draws_are_those_of_the_steps(rate):
    hashes = np.concatenate([np.arange(100_000), np.random.default_rng(1).integers(0, 1 << 32, 100_000)]).astype(np.uint64)
    block = forest.Block(np.zeros((1, 200_000), np.uint8), np.zeros((200_000, 2)), np.zeros(200_000, np.int16), hashes)
    u = forest.fraction(hashes ^ np.uint64((11 * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1)))
    drawn = block.weights(Spec(bootstrap=rate, seed=11, held_out=TEST))
    assert drawn.tolist() == np.searchsorted(poisson_steps(rate), u, "right").tolist()

"""Subtrees grown in memory, and the large blocks that tasks deal to nodes."""

import numpy as np
import pyarrow as pa
import pytest

from tillwork.operators import forest


def blocks(sizes, features=3, channels=2):
    rng = np.random.default_rng(5)
    rows = []
    for n in sizes:
        bins = rng.integers(0, 9, (features, n)).astype(np.uint8)
        stats = rng.integers(0, 3, (n, channels)).astype(float)
        fold, key = np.zeros(n, np.int16), rng.integers(0, 1 << 32, n).astype(np.uint64)
        rows.append((n, *[x.tobytes() for x in (bins, stats, fold, key)]))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["n", "bins", "stats", "fold", "hash"])


def test_small_blocks_are_dealt_to_nodes_together():
    """A node's rows are sent once a task and tree, however many blocks the task reads."""
    batch = blocks([10] * 40)
    (one,) = forest._large(iter([batch]), True)
    parts = list(forest.blocks_of(iter([batch])))
    assert np.array_equal(one.bins, np.concatenate([b.bins for b in parts], 1))
    assert np.array_equal(one.stats, np.concatenate([b.stats for b in parts]))
    assert len(list(forest._large(iter([batch]), False))) == 40


def test_joined_blocks_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(forest, "GATHERED_BYTES", 1000)
    joined = list(forest._large(iter([blocks([10] * 40)]), True))
    assert len(joined) == 10 and sum(len(b.fold) for b in joined) == 400


def test_weights_are_worked_out_once_for_trees_on_the_same_rows(monkeypatch):
    (block,) = forest.blocks_of(iter([blocks([50])]))
    specs = [forest.Spec(max_depth=d, held_out=h, bootstrap=0.5, seed=h) for d in (2, 3) for h in (0, 1)]
    tops = [forest._Top(s) for s in specs]
    made = []
    weights = forest.Block.weights
    monkeypatch.setattr(forest.Block, "weights", lambda b, s: made.append(s.rows()) or weights(b, s))
    walks = list(forest._weighted(block, forest._walks(tops, {t: {0: t} for t in range(4)})))
    assert len(made) == len(set(made)) == 2 and sorted(w[0] for w in walks) == [0, 1, 2, 3]
    assert all(np.array_equal(w, weights(block, specs[t])) for t, _, _, _, w in walks)


@pytest.mark.parametrize("criterion", ["gini", "variance"])
def test_sums_by_bin_and_sorted_rows_give_the_same_tree(monkeypatch, criterion):
    rng = np.random.default_rng(6)
    bins = rng.integers(0, 200, (4, 3000)).astype(np.uint8)
    y = (bins[0].astype(int) * 3 + bins[1] // 7 + rng.integers(0, 40, 3000)) * 1.0
    stats = np.stack([np.ones(3000), y] if criterion == "variance" else [y < 300, y >= 300], 1).astype(float)
    learned = rng.random(3000) < 0.7
    spec = forest.Spec(criterion=criterion, max_depth=12, min_leaf=3)
    trees = []
    for cells in (0, 1e9):
        monkeypatch.setattr(forest, "CELLS_PER_ROW", cells)
        trees.append(forest.grow_rows(bins, stats, learned, spec, 0, forest.root_path(spec)))
    a, b = trees
    for column in ("feature", "bin", "left", "right", "depth", "stats", "held"):
        assert np.array_equal(getattr(a, column), getattr(b, column)), column
    # Every row ends in a leaf, and the sums of the leaves are those of its rows.
    for rows, sums in ((learned, a.stats), (~learned, a.held)):
        leaf = a.leaf_of(bins[:, rows])
        assert (a.feature[leaf] < 0).all()
        found = np.bincount(leaf, stats[rows, 1], len(a))
        assert np.allclose(found[a.feature < 0], sums[a.feature < 0, 1])


def test_no_learned_row_leaves_one_leaf():
    spec = forest.Spec()
    tree = forest.grow_rows(np.zeros((2, 3), np.uint8), np.ones((3, 2)), np.zeros(3, bool), spec, 0, forest.root_path(spec))
    assert len(tree) == 1 and tree.held.tolist() == [[3.0, 3.0]]


def test_broken_sums_are_taken_row_by_row(monkeypatch):
    """Amounts are not added up by bin: the last digits of their sums decide between equal splits."""
    bins, node = np.array([[2, 1, 1, 0]], np.uint8), np.array([0, 0, 0, 1])
    stats = np.array([[1.0, 1.0, 1.0, 1.0], [0.1, 0.2, 0.3, 0.4]])
    monkeypatch.setattr(forest, "CELLS_PER_ROW", 1e9)
    wanted = np.ones(2, bool)
    at, b, sums = forest.Rows(bins, stats, node, False).ordered(0, wanted)
    assert at.tolist() == [0, 0, 0, 1] and b.tolist() == [1, 1, 2, 0] and sums[:, 1].tolist() == [0.2, 0.3, 0.1, 0.4]
    at, b, sums = forest.Rows(bins, stats, node, True).ordered(0, wanted)
    assert at.tolist() == [0, 0, 1] and b.tolist() == [1, 2, 0] and sums[:, 0].tolist() == [2.0, 1.0, 1.0]

"""Trees grown together against brute force, the library's tree, and trees grown one by one."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.operators import forest, trees
from tillwork.operators.forest import TEST, Spec
from tillwork.operators.models import with_vector

FEATURES = ["a", "b", "c"]
SPECS = [
    Spec("gini", max_depth=5),
    Spec("entropy", max_depth=8),
    Spec("gini", splitter="random", seed=3, held_out=1),
    Spec("entropy", max_features=1, min_leaf=5, held_out=2),
    Spec("gini", bootstrap=1.0, max_features=2, seed=9),
    Spec("gini", held_out=(0, 1), left_out=(2,), min_split=10),
]


def rows(n=1500, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 40, (n, 3))
    y = ((x[:, 0] * x[:, 1] + rng.normal(0, 60, n)) > 400).astype(int) + (x[:, 2] > 35)
    return x.astype(float), y, np.arange(n) % 5 - 1


@pytest.fixture(scope="module")
def table(spark):
    x, y, fold = rows()
    data = [(i, *map(float, r), int(c), int(f)) for i, (r, c, f) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(data, "row_key long, a double, b double, c double, label int, fold int").repartition(5).cache()


@pytest.fixture(scope="module")
def data(table):
    return forest.binned(table, FEATURES, forest.class_channels("label", 3), F.col("fold"))


def canonical(tree):
    """Nodes from the root down, left before right."""
    out, stack = [], [0]
    while stack:
        i = stack.pop()
        out.append((int(tree.feature[i]), int(tree.bin[i]), tuple(tree.stats[i]), tuple(tree.held[i])))
        if tree.feature[i] >= 0:
            stack += [int(tree.right[i]), int(tree.left[i])]
    return out


def grown(data, specs, local_rows=forest.LOCAL_ROWS):
    out = forest.grow(data, specs, local_rows)
    return out, [trees.tree_of(out, i) for i in range(len(specs))]


@pytest.fixture(scope="module")
def some(data):
    return grown(data, SPECS)


@pytest.mark.parametrize("local_rows", [0, 250])
def test_levels_and_tasks_grow_the_same_trees(data, some, local_rows):
    _, by_levels = grown(data, SPECS, local_rows)
    for a, b in zip(some[1], by_levels):
        assert canonical(a) == canonical(b)


def test_trees_hold_the_rows_they_should(some):
    _, y, fold = rows()
    for tree, spec in zip(some[1], SPECS):
        held = np.isin(fold, spec.held_out)
        learned = (fold != TEST) & ~held & ~np.isin(fold, spec.left_out)
        assert tree.held[0].tolist() == np.bincount(y[held], minlength=3).tolist()
        if not spec.bootstrap:
            assert tree.stats[0].tolist() == np.bincount(y[learned], minlength=3).tolist()


def by_hand(x, y, criterion, depth, least=2, min_leaf=1):
    """The same tree by trying every threshold: nested (feature, threshold, counts, left, right)."""
    counts = np.bincount(y, minlength=3).astype(float)

    def impurity(labels):
        p = np.bincount(labels, minlength=3) / len(labels)
        p = p[p > 0]
        return len(labels) * (1 - (p**2).sum() if criterion == "gini" else -(p * np.log2(p)).sum())

    best = None
    if depth and len(y) >= least and impurity(y) > 1e-9:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for t in (values[1:] + values[:-1]) / 2:
                side = x[:, f] <= t
                if min(side.sum(), (~side).sum()) < min_leaf:
                    continue
                gain = impurity(y) - impurity(y[side]) - impurity(y[~side])
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, t, side)
    if best is None:
        return (-1, None, counts.tolist())
    _, f, t, side = best
    parts = [by_hand(x[s], y[s], criterion, depth - 1, least, min_leaf) for s in (side, ~side)]
    return (f, t, counts.tolist(), *parts)


def nested(tree, edges, i=0):
    f = int(tree.feature[i])
    if f < 0:
        return (-1, None, tree.stats[i].tolist())
    # A threshold may lie between values that the node does not hold.
    return (f, float(edges[f][tree.bin[i]]), tree.stats[i].tolist(), nested(tree, edges, int(tree.left[i])), nested(tree, edges, int(tree.right[i])))


def same(a, b):
    if a[0] != b[0] or a[2] != b[2]:
        return False
    return a[0] < 0 or (same(a[3], b[3]) and same(a[4], b[4]))


@pytest.mark.parametrize("criterion, min_leaf", [("gini", 1), ("entropy", 7)])
def test_tree_of_exhaustive_search(data, criterion, min_leaf):
    x, y, fold = rows()
    spec = Spec(criterion, max_depth=4, min_leaf=min_leaf, held_out=0)
    tree = grown(data, [spec])[1][0]
    learned = (fold != TEST) & (fold != 0)
    assert same(nested(tree, data.edges), by_hand(x[learned], y[learned], criterion, 4, 2, min_leaf))


def test_predictions_of_the_librarys_tree(table, data, some):
    from pyspark.ml.classification import DecisionTreeClassifier

    vectors = with_vector(table, FEATURES)
    library = DecisionTreeClassifier(labelCol="label", maxDepth=5, maxBins=64).fit(vectors.where("fold >= 0"))
    mine = trees.predict(table, [some[1][0]], data, ["row_key"]).withColumnRenamed("prediction", "mine")
    both = library.transform(vectors).select("row_key", F.col("prediction").cast("int")).join(mine, "row_key")
    assert both.where("prediction <> mine").count() == 0


def test_smaller_variants_are_trees_of_their_own(data):
    spec = Spec("gini", max_depth=trees.UNBOUNDED, held_out=1)
    whole, _ = grown(data, [spec])
    variants = [(3, 2, 0.0), (trees.UNBOUNDED, 40, 0.0), (6, 10, 0.0), (6, 10, 0.004)]
    found = {r["variant"]: r for r in trees.variant_scores(whole, variants).collect()}
    for i, (depth, least, alpha) in enumerate(variants):
        tree = grown(data, [replace(spec, max_depth=depth, min_split=least)])[1][0]
        tree = trees.pruned(tree, "gini", alpha)
        ends = forest.reachable(tree, np.zeros(len(tree), bool))
        hits = tree.held[ends, tree.stats[ends].argmax(1)].sum()
        assert (found[i]["hits"], found[i]["n"], found[i]["leaves"]) == (hits, tree.held[0].sum(), len(ends))


def path_by_hand(tree):
    """(alpha, leaves) by collapsing the weakest link again and again; equal alphas count once."""
    risk = forest.spread(tree.stats, "gini") / tree.stats[0].sum()
    gone = tree.feature < 0

    def below(i):
        if gone[i]:
            return risk[i], 1
        (a, m), (b, n) = below(tree.left[i]), below(tree.right[i])
        return a + b, m + n

    def inner(i):
        return [] if gone[i] else [i, *inner(tree.left[i]), *inner(tree.right[i])]

    out, alpha = {0.0: below(0)[1]}, 0.0
    while nodes := inner(0):
        links = [(risk[i] - below(i)[0]) / (below(i)[1] - 1) for i in nodes]
        alpha = max(alpha, min(links))
        gone[nodes[int(np.argmin(links))]] = True
        out[round(alpha, 10)] = below(0)[1]
    return out


def test_pruning_path(data):
    whole, (tree,) = grown(data, [Spec("gini", max_depth=trees.UNBOUNDED, held_out=1)])
    path = trees.pruning_path(whole).orderBy("step").collect()
    assert {round(r["alpha"], 10): r["leaves"] for r in path} == path_by_hand(tree)
    assert path[-1]["leaves"] == 1 and path[0]["train_accuracy"] > 0.99
    assert [r["impurity"] for r in path] == sorted(r["impurity"] for r in path)
    for r in path[:: len(path) // 6]:
        small = trees.pruned(tree, "gini", r["alpha"])
        ends = forest.reachable(small, np.zeros(len(small), bool))
        hits = small.held[ends, small.stats[ends].argmax(1)].sum()
        assert len(ends) == r["leaves"] and r["test_accuracy"] == pytest.approx(hits / small.held[0].sum())


def test_grid_and_folds(data):
    table, best = trees.tree_grid(data, 4, depths=(3, None), splits=(2, 20), features=(None, "sqrt"), alphas=(0.0, 0.01))
    found = table.collect()
    assert len(found) == 2 * 2 * 2 * 2 * 2 * 2 and sum(r["best"] for r in found) == 1
    top = next(r for r in found if r["best"])
    assert top["accuracy"] == max(r["accuracy"] for r in found) > 0.8
    assert best["max_depth"] == top["max_depth"]
    scores = trees.alpha_cv(data, trees.spec_of(best, 3), 4, [0.0, 0.01, 1.0]).orderBy("alpha").collect()
    assert len(scores) == 3 and scores[0]["accuracy"] > scores[2]["accuracy"]


def test_forest_votes_are_those_of_its_trees(table, data):
    specs = [Spec(max_features=2, bootstrap=1.0, seed=i, held_out=1, max_depth=trees.UNBOUNDED) for i in range(6)]
    whole, members = grown(data, specs)
    votes = {
        (r["variant"], r["trees"]): (r["hits"], r["n"])
        for r in trees.forest_accuracy(whole, [list(range(6))], [(trees.UNBOUNDED, 2), (3, 2)], [2, 6]).collect()
    }
    held = table.where("fold = 1")
    for n in (2, 6):
        direct = trees.predict(held, members[:n], data, ["label"])
        hits = direct.where("prediction = label").count()
        assert votes[0, n] == (hits, held.count())
    assert votes[1, 6][0] <= votes[0, 6][0] + held.count() // 10
    scored = trees.predict_all(whole, held, ["row_key"])
    direct = trees.predict(held, members, data, ["row_key"]).withColumnRenamed("score", "direct").drop("prediction")
    assert scored.join(direct, "row_key").where("abs(score - direct) > 1e-9").count() == 0
    shares = trees.importances(whole).collect()
    assert sum(r["importance"] for r in shares) == pytest.approx(1) and len(shares) == 3


def test_regression_trees_and_empty_folds(spark):
    df = spark.range(400).selectExpr("id as row_key", "cast(id % 20 as double) as x", "cast(id % 7 as double) as z", "cast((id % 20) * 3 as double) as y")
    data = forest.binned(df, ["x", "z"], [F.lit(1.0), F.col("y")], F.lit(0))
    whole, (tree,) = grown(data, [Spec("variance", max_depth=trees.UNBOUNDED)])
    out = trees.predict(df, [tree], data, ["y"], regression=True)
    assert out.where("abs(y - prediction) > 1e-9").count() == 0
    assert trees.importances(whole).first()["feature"] == "x"
    assert trees.node_rows(whole).where("feature is null").count() == 20
    # A tree with nothing to learn from is one leaf.
    _, (empty,) = grown(data, [Spec("variance", held_out=0)])
    assert len(empty) == 1 and empty.stats[0].tolist() == [0, 0]


def test_bags_are_drawn_before_the_trees(data):
    specs = [Spec(bag=(0.8, 1), max_depth=2), Spec(bag=(0.8, 1), bootstrap=1.0, seed=4, max_depth=2), Spec(bag=(0.8, 2), max_depth=2)]
    _, members = grown(data, specs)
    n = (rows()[2] != TEST).sum()
    sizes = [t.stats[0].sum() for t in members]
    assert all(0.7 * n < s < 0.9 * n for s in sizes) and len(set(sizes)) == 3


def test_few_positions_grow_whole_trees_in_one_pass(table, data, monkeypatch):
    _, by_levels = grown(data, SPECS, 250)
    monkeypatch.setattr(forest, "_level", None)
    _, at_once = grown(data, SPECS)
    assert [canonical(a) for a in at_once] == [canonical(b) for b in by_levels]
    # Sums by position: copies of rows, also over blocks that are gathered apart, weigh as many rows.
    monkeypatch.setattr(forest, "GATHERED_ROWS", 100)
    copied = table.unionByName(table).unionByName(table)
    tripled = forest.binned(copied, FEATURES, forest.class_channels("label", 3), F.col("fold"), edges=data.edges)
    spec = Spec("gini", max_features=2, seed=4)
    (one,), (three,) = grown(data, [spec])[1], grown(tripled, [spec])[1]
    assert [x[:2] for x in canonical(one)] == [x[:2] for x in canonical(three)]
    assert np.array_equal(3 * one.stats, three.stats) and np.array_equal(3 * one.held, three.held)

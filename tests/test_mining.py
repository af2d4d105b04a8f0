"""Clustering, rebalancing, rules and tree pruning against brute force and invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.operators import baskets, cluster, encode, ensembles, kmeans, resample
from tillwork.operators.dbscan import dbscan
from tillwork.operators.models import with_vector


def brute_dbscan(points, eps, min_samples):
    keys = [p[0] for p in points]
    xy = np.array([p[1:] for p in points], dtype=float)
    near = [[j for j in range(len(xy)) if ((xy[i] - xy[j]) ** 2).sum() <= eps * eps] for i in range(len(xy))]
    core = [len(n) >= min_samples for n in near]
    label = [-1] * len(xy)
    current = 0
    for i in sorted(range(len(xy)), key=lambda i: keys[i]):
        if core[i] and label[i] < 0:
            stack = [i]
            while stack:
                at = stack.pop()
                if label[at] < 0:
                    label[at] = current
                    stack += [j for j in near[at] if core[j]]
            current += 1
    out = {}
    for i, key in enumerate(keys):
        border = [label[j] for j in near[i] if core[j]]
        out[key] = label[i] if core[i] else (min(border) if border else -1)
    return out


def ring(radius, n, seed):
    rng = np.random.default_rng(seed)
    angle = rng.uniform(0, 2 * math.pi, n)
    return np.c_[radius * np.cos(angle), radius * np.sin(angle)] + rng.normal(0, 0.05, (n, 2))


@pytest.mark.parametrize("driver_edges", [100_000, 3])
def test_dbscan_rings_and_noise(spark, driver_edges):
    rng = np.random.default_rng(0)
    xy = np.concatenate([ring(3, 150, 1), ring(1, 60, 2), rng.uniform(-5, 5, (25, 2)), np.tile([4.5, 4.5], (40, 1))])
    points = [(int(i), *map(float, p.round(4))) for i, p in enumerate(xy)]
    df = spark.createDataFrame(points, "id long, x double, y double").repartition(4)
    found = {r["id"]: r["cluster"] for r in dbscan(df, ["x", "y"], 0.4, 4, "id", driver_edges).collect()}
    assert found == brute_dbscan(points, 0.4, 4)


def test_dbscan_three_dimensions_and_boxes_left_open(spark):
    """Long thin cells: many cell pairs that only halving can decide."""
    rng = np.random.default_rng(6)
    xyz = rng.uniform(0, 3, (250, 3)).round(3)
    points = [(int(i), *map(float, p)) for i, p in enumerate(xyz)]
    df = spark.createDataFrame(points, "id long, x double, y double, z double")
    for eps, m in ((0.35, 3), (0.5, 2)):
        found = {r["id"]: r["cluster"] for r in dbscan(df, ["x", "y", "z"], eps, m, "id").collect()}
        assert found == brute_dbscan(points, eps, m)


def test_dbscan_single_cell(spark):
    df = spark.createDataFrame([(i, 0.0) for i in range(10)], "id long, x double")
    assert {r["cluster"] for r in dbscan(df, ["x"], 1.0, 3, "id").collect()} == {0}


def test_smote_balances_between_neighbours(spark):
    rng = np.random.default_rng(1)
    rows = [(f"m{i}", float(a), float(b), 0) for i, (a, b) in enumerate(rng.normal(0, 1, (90, 2)))]
    rows += [(f"s{i}", float(a), float(b), 1) for i, (a, b) in enumerate(rng.normal(6, 1, (4, 2)))]
    df = spark.createDataFrame(rows, "row_key string, a double, b double, label int")
    out = resample.smote(df, ["a", "b"])
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 90, 1: 90}
    minority = np.array([r[1:3] for r in rows if r[3] == 1])
    made = np.array([[r["a"], r["b"]] for r in out.where("synthetic = 1").collect()])
    assert (made >= minority.min(axis=0) - 1e-9).all() and (made <= minority.max(axis=0) + 1e-9).all()
    again = resample.smote(df.repartition(5), ["a", "b"])
    assert sorted(out.collect()) == sorted(again.collect())


def test_tomek_links_are_mutual(spark):
    rows = [("a", 0.0, 0), ("b", 0.1, 1), ("c", 5.0, 1), ("d", 5.3, 1), ("e", 5.7, 0)]
    df = spark.createDataFrame(rows, "row_key string, x double, label int")
    assert {r["row_key"] for r in resample.tomek_links(df, ["x"]).collect()} == {"a", "b"}


def test_rules_with_full_confidence_and_small_baskets(spark):
    bought = [["a", "b"], ["a", "b"], ["a"], ["c"]]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bought)], "o int, items array<string>")
    rules = {
        (tuple(r["antecedent"]), tuple(r["consequent"])): r
        for r in baskets.association_rules(baskets.frequent_itemsets(df, 0.25)).collect()
    }
    assert set(rules) == {(("a",), ("b",)), (("b",), ("a",))}
    sure = rules[("b",), ("a",)]
    assert sure["confidence"] == 1.0 and sure["conviction"] == math.inf
    assert sure["lift"] == pytest.approx(4 / 3) and sure["zhangs_metric"] == pytest.approx(0.5)
    assert baskets.frequent_itemsets(df, 0.99).count() == 0
    assert baskets.association_rules(baskets.frequent_itemsets(df, 0.99)).count() == 0
    assert baskets.frequent_itemsets(df.limit(0)).count() == 0


def blobs(n=60):
    rng = np.random.default_rng(3)
    return np.concatenate([rng.normal(c, 0.3, (n, 2)) for c in ((0, 0), (5, 5), (0, 8))])


def brute_silhouette(x, label):
    """Mean silhouette on squared distances over all pairs."""
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    out = []
    for i, own in enumerate(label):
        mine = (label == own) & (np.arange(len(x)) != i)
        if not mine.any():
            out.append(0.0)
            continue
        a = d[i, mine].mean()
        b = min(d[i, label == c].mean() for c in set(label.tolist()) - {own})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_all_kmeans_fits_advance_in_shared_passes(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([blobs(), rng.uniform(-3, 9, (40, 2)), np.tile([[9.0, 9.0]], (90, 1))])
    df = spark.createDataFrame([tuple(map(float, p)) for p in x], "x double, y double").repartition(5)
    costs = []
    fits = kmeans.fit_many(
        df, ["x", "y"], (2, 3, 5), restarts=4, on_pass=lambda f: costs.append([g.cost for g in f])
    )
    # As many passes as the slowest fit takes, whatever the number of fits.
    assert len(costs) == max(f.passes for f in fits) and len(fits) == 12
    for earlier, later in zip(costs, costs[1:]):
        assert all(b <= a + 1e-6 for a, b in zip(earlier, later))
    for fit in fits:
        d = ((x[:, None] - fit.centres[None]) ** 2).sum(2)
        label = d.argmin(1)
        assert fit.cost == pytest.approx(d.min(1).sum())
        assert fit.sizes.tolist() == np.bincount(label, minlength=fit.k).tolist()
    best = kmeans.best_fits(fits)
    scores = kmeans.silhouettes(df, ["x", "y"], [best[k] for k in (2, 3, 5)])
    for k, score in zip((2, 3, 5), scores):
        label = ((x[:, None] - best[k].centres[None]) ** 2).sum(2).argmin(1)
        assert score == pytest.approx(brute_silhouette(x, label))


def test_kmeans_costs_are_no_worse_than_the_librarys(spark, small):
    from pyspark.ml.clustering import KMeans

    from tillwork.sources import transactions

    columns = ["price", "quantity", "discount_pct"]
    df = encode.standardize(transactions(spark, small, *columns), columns).cache()
    vectors = cluster.assemble(df, columns).select("features").cache()
    best = kmeans.best_fits(kmeans.fit_many(df, columns, (3, 6)))
    for k in (3, 6):
        library = min(
            KMeans(k=k, maxIter=100, seed=s).fit(vectors).summary.trainingCost for s in (42, 43, 44)
        )
        assert best[k].cost <= library * 1.005


def test_kmeans_of_few_and_equal_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 5 + [(4.0, 2.0)] * 3 + [(None, 1.0)], "x double, y double")
    fits = kmeans.best_fits(kmeans.fit_many(df, ["x", "y"], (2, 4), restarts=2))
    assert fits[2].cost == pytest.approx(0) and sorted(fits[2].sizes.tolist()) == [3, 5]
    assert len(fits[4].centres) == 2
    with pytest.raises(ValueError):
        kmeans.fit_many(df.limit(0), ["x", "y"], (2,))


def test_kmeans_sweep_and_projection(spark):
    df = spark.createDataFrame([tuple(map(float, p)) for p in blobs()], "x double, y double")
    sweep, fits = cluster.kmeans_sweep(df, ["x", "y"], (2, 3, 4))
    rows = sorted(sweep.collect())
    assert rows[0]["wcss"] >= rows[1]["wcss"] >= rows[2]["wcss"]
    assert cluster.best_k(sweep) == 3
    projected, loadings = cluster.pca_2d(df, ["x", "y"])
    assert projected.agg(F.avg("pc1")).first()[0] == pytest.approx(0, abs=1e-9)
    assert all(col[np.argmax(np.abs(col).round(9))] > 0 for col in loadings.T)
    centroids = {r["cluster"]: r for r in cluster.kmeans_centroids(df, ["x", "y"], fits[3]).collect()}
    assert sorted(r["n"] for r in centroids.values()) == [60, 60, 60]
    # The projection of a centroid is the mean of its rows' projections.
    scaled = encode.standardize(df, ["x", "y"])
    planes, _ = cluster.pca_2d(cluster.assign_to(scaled, ["x", "y"], fits[3].centres), ["x", "y"])
    means = {r["cluster"]: (r["a"], r["b"]) for r in planes.groupBy("cluster").agg(F.avg("pc1").alias("a"), F.avg("pc2").alias("b")).collect()}
    for r in cluster.projected_centroids(spark, fits[3], loadings).collect():
        assert (r["pc1"], r["pc2"]) == pytest.approx(means[r["cluster"]], abs=1e-2)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i, (a, b) in enumerate(rng.uniform(0, 1, (600, 2))):
        noise = rng.random() < 0.15
        rows.append((f"k{i}", float(a), float(b), int((a + b > 1) != noise), i % 3, "test" if i % 5 == 0 else "train"))
    df = spark.createDataFrame(rows, "row_key string, a double, b double, label int, fold int, split string")
    return with_vector(df, ["a", "b"]).persist()


def test_ensembles_beat_the_majority(spark, labelled):
    from pyspark.ml.classification import RandomForestClassifier

    train, test = labelled.where("split = 'train'"), labelled.where("split = 'test'")
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    forest = RandomForestClassifier(labelCol="label", numTrees=3, maxDepth=3, seed=1)

    def accuracy(df):
        return df.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]

    bagged = ensembles.bagging(forest, train, test, 3)
    assert accuracy(bagged) > majority
    row = bagged.first()
    assert row["score"] == pytest.approx(sum(row["members"]) / 3)
    for algorithm in ("SAMME", "SAMME.R"):
        boosted, history = ensembles.adaboost(forest, train, test, 3, algorithm=algorithm)
        assert accuracy(boosted) > majority and 1 <= len(history) <= 3
    stacked = ensembles.stacking({"rf": forest}, train, test, 3)
    assert accuracy(stacked) > majority and stacked.count() == test.count()


def test_many_values_encode_without_a_cap(spark):
    df = spark.range(3000).select(F.col("id").alias("o"), F.format_string("v%05d", "id").alias("item"))
    df = df.unionByName(spark.createDataFrame([(3000, None)], "o long, item string"))
    rows = {r["o"]: r["one_hot"] for r in encode.one_hot_vector(df, ["item"]).collect()}
    assert rows[0].size == 2999
    assert rows[0].indices.tolist() == [] and rows[3000].indices.tolist() == []
    assert rows[1].indices.tolist() == [0] and rows[2999].indices.tolist() == [2998]
    codes = {r["o"]: r["codes"] for r in baskets.basket_codes(df, "o", "item").collect()}
    assert codes[7] == [7] and codes[3000] == []


def test_poisson_draws_reach_the_tail():
    steps = ensembles.poisson_steps(30.0)
    assert len(steps) > 60 and steps == sorted(steps) and steps[-1] > 1 - 2.0**-32


def test_kmeans_passes_compare_rows_of_undecided_leaves_only(spark):
    """Leaves whose box belongs to one centre are added whole; sums and costs are those of all rows."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.uniform(-1.0, 1.0, (30_000, 2)), np.zeros((5_000, 2))])
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in x] + [(None, 1.0)], "x double, y double")
    kept = kmeans.packed(rows.repartition(4), ["x", "y"]).cache()
    fits = [rng.uniform(-1.0, 1.0, (k, 2)) for k in (1, 2, 7)] + [np.array([[-0.5, 0.0], [0.5, 0.0], [9.0, 9.0]])]
    for z, (sizes, sums, cost) in zip(fits, kmeans._sums(kept, ["x", "y"], fits)):
        d = ((x[:, None, :] - z[None]) ** 2).sum(2)
        own = d.argmin(1)
        assert sizes.tolist() == np.bincount(own, minlength=len(z)).tolist()
        assert np.allclose(sums, [x[own == j].sum(0) for j in range(len(z))])
        assert np.isclose(cost.sum(), d.min(1).sum())
    boxes = [kmeans._Leaves(np.frombuffer(r[0]).reshape(2, -1)) for r in kept.collect()]
    assert len(boxes) >= 4  # copies are dealt over the tasks as well
    assert sum(int(b.size.sum()) for b in boxes) == len(x)
    decided = sum(int(b.size[b.owners(fits[3])[1]].sum()) for b in boxes)
    assert decided > 0.75 * len(x)
    kept.unpersist()

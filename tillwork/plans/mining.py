"""Neighbour, rebalancing, clustering and basket queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.operators import baskets, cluster, neighbors, outliers, resample
from tillwork.operators.dbscan import dbscan
from tillwork.operators.encode import label_high_low, standardize
from tillwork.operators.split import kfold_assign, train_test_split
from tillwork.plans.registry import hash32_sql, query
from tillwork.sources import table, transactions

CLUSTER_FEATURES = ("price", "quantity", "discount_pct")
CLUSTER_KS = range(2, 11)

# Whole-table brute force is affordable in SQL on the part and customer tables only.
SCALED_PARTS = """
p as (
  select p_partkey, (p_size - avg(p_size) over ()) / stddev_pop(p_size) over () as x,
         (p_retailprice - avg(p_retailprice) over ()) / stddev_pop(p_retailprice) over () as y
  from part
)
"""

NEAREST_PARTS = """
pairs as (
  select a.p_partkey, b.p_partkey as neighbour,
         (a.p_size - b.p_size) * (a.p_size - b.p_size)
           + (a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice) as d2
  from part a, part b
), ranked as (
  select *, row_number() over (partition by p_partkey order by d2, neighbour) as rank from pairs
)
"""

PART_FEATURES = ("p_size", "p_retailprice")


@query(
    "k_nearest",
    "with "
    + NEAREST_PARTS
    + """select p_partkey, cast(rank as integer) as rank, neighbour, round(sqrt(d2), 9) as distance
    from ranked where rank <= 5""",
)
def k_nearest(spark, sf):
    out = neighbors.k_nearest(table(spark, sf, "part"), PART_FEATURES, 5, "p_partkey")
    return out.withColumn("distance", F.round("distance", 9))


@query(
    "k_distance",
    "with "
    + NEAREST_PARTS
    + "select p_partkey, round(sqrt(d2), 9) as k_distance from ranked where rank = 5",
)
def k_distance(spark, sf):
    out = neighbors.k_distance(table(spark, sf, "part"), PART_FEATURES, 5, "p_partkey")
    return out.withColumn("k_distance", F.round("k_distance", 9)).orderBy("k_distance", "p_partkey")


@query("k_distance_transactions")
def k_distance_transactions(spark, sf):
    df = transactions(spark, sf, "row_key", *CLUSTER_FEATURES)
    return neighbors.k_distance(standardize(df, CLUSTER_FEATURES), CLUSTER_FEATURES, 5)


PART_LABEL = "cast(p_type in ('SMALL', 'LARGE', 'MEDIUM') as integer)"


@query(
    "knn_classify",
    f"""with l as (
      select *, {PART_LABEL} as label,
             {hash32_sql('p_partkey', 42)} / 4294967296.0 < 0.2 as is_test from part
    ), pairs as (
      select a.p_partkey, any_value(a.label) over (partition by a.p_partkey) as label, b.label as vote,
             row_number() over (partition by a.p_partkey order by
               (a.p_size - b.p_size) * (a.p_size - b.p_size)
               + (a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice),
               b.p_partkey) as rank
      from l a, l b where a.is_test and not b.is_test)
    select p_partkey, any_value(label) as label, sum(vote) / 7.0 as score,
           cast(2 * sum(vote) > 7 as integer) as prediction
    from pairs where rank <= 7 group by p_partkey""",
)
def knn_classify(spark, sf):
    df = table(spark, sf, "part").withColumn("label", F.expr(PART_LABEL))
    df = train_test_split(df, 0.2, "p_partkey")
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    return neighbors.knn_classify(train, test, PART_FEATURES, 7, key="p_partkey")


@query(
    "knn_k_sweep",
    f"""with l as (
      select *, {PART_LABEL} as label, {hash32_sql('p_partkey', 42)} % 5 as fold from part
    ), pairs as (
      select a.p_partkey, a.fold, a.label, b.label as vote,
             row_number() over (partition by a.p_partkey order by
               (a.p_size - b.p_size) * (a.p_size - b.p_size)
               + (a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice),
               b.p_partkey) as rank
      from l a, l b where a.fold <> b.fold
    ), votes as (
      select p_partkey, fold, label, rank as k,
             sum(vote) over (partition by p_partkey order by rank rows unbounded preceding) as votes
      from pairs where rank <= 30
    ), per_fold as (
      select k, fold, avg(cast(cast(2 * votes > k as integer) = label as integer)) as accuracy
      from votes group by k, fold)
    select cast(k as integer) as k, round(avg(accuracy), 9) as accuracy from per_fold group by k""",
)
def knn_k_sweep(spark, sf):
    df = table(spark, sf, "part").withColumn("label", F.expr(PART_LABEL))
    df = kfold_assign(df, 5, "p_partkey")
    out = neighbors.knn_k_sweep(df, PART_FEATURES, 30, 5, key="p_partkey")
    return out.withColumn("accuracy", F.round("accuracy", 9))


def _smote_sql(seed):
    return f"""
    c as (select p_type, count(*) as n from part group by p_type),
    m as (select p_type, n, max(n) over () - n as need from c),
    ranked as (
      select cast(p.p_partkey as varchar) as id, p.p_type, cast(p_size as double) as x,
             p_retailprice as y, n, need,
             row_number() over (partition by p.p_type
               order by {hash32_sql('p.p_partkey', seed)}, cast(p.p_partkey as varchar)) as r
      from part p join m on p.p_type = m.p_type where need > 0
    ), near as (
      select a.id, b.x as bx, b.y as b_y,
             row_number() over (partition by a.id order by
               (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) - 1 as i
      from ranked a join ranked b on a.p_type = b.p_type and a.id <> b.id
    ), named as (
      select *, id || '~' || cast(j as varchar) as name
      from (select *, unnest(range(1, cast(need // n + cast(r <= need % n as bigint) as bigint) + 1)) as j
            from ranked)
    ), made as (
      select name as p_partkey, p_type,
             x + ({hash32_sql('name', seed + 1)} / cast(4294967296 as double)) * (bx - x) as p_size,
             y + ({hash32_sql('name', seed + 1)} / cast(4294967296 as double)) * (b_y - y) as p_retailprice,
             1 as synthetic
      from named join near on near.id = named.id and near.i = {hash32_sql('name', seed)} % 5
    ), balanced as (
      select cast(p_partkey as varchar) as p_partkey, p_type, cast(p_size as double) as p_size,
             p_retailprice, 0 as synthetic from part
      union all select * from made
    )"""


SMOTE_COLUMNS = """p_partkey, p_type, round(p_size, 6) as p_size,
  round(p_retailprice, 6) as p_retailprice, cast(synthetic as integer) as synthetic"""


def _rounded_parts(df):
    return df.select(
        "p_partkey",
        "p_type",
        F.round("p_size", 6).alias("p_size"),
        F.round("p_retailprice", 6).alias("p_retailprice"),
        "synthetic",
    )


@query("smote", f"with {_smote_sql(5805)} select {SMOTE_COLUMNS} from balanced")
def smote(spark, sf):
    df = table(spark, sf, "part")
    return _rounded_parts(resample.smote(df, PART_FEATURES, "p_type", 5, "p_partkey"))


@query(
    "smote_tomek",
    f"""with {_smote_sql(42)}, nn as (
      select a.p_partkey as id, a.p_type as t, b.p_partkey as other, b.p_type as other_t,
             row_number() over (partition by a.p_partkey order by
               (a.p_size - b.p_size) * (a.p_size - b.p_size)
               + (a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice),
               b.p_partkey) as r
      from balanced a join balanced b on a.p_partkey <> b.p_partkey
    ), one as (select * from nn where r = 1),
    links as (select p.id from one p join one q on p.other = q.id and q.other = p.id
              where p.t <> q.t)
    select {SMOTE_COLUMNS} from balanced where p_partkey not in (select id from links)""",
)
def smote_tomek(spark, sf):
    df = table(spark, sf, "part")
    return _rounded_parts(resample.smote_tomek(df, PART_FEATURES, "p_type", 5, "p_partkey"))


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    """Elbow and silhouette curve on all rows: ten restarts of each number of clusters."""
    return cluster.kmeans_sweep(transactions(spark, sf, *CLUSTER_FEATURES), CLUSTER_FEATURES, CLUSTER_KS)[0]


def _best_fit(df):
    """The fit with the best silhouette of the sweep."""
    sweep, fits = cluster.kmeans_sweep(df, CLUSTER_FEATURES, CLUSTER_KS)
    return fits[cluster.best_k(sweep)]


@query("kmeans_centroids")
def kmeans_centroids(spark, sf):
    """Centroids, in original units, of the number of clusters that the silhouette prefers."""
    df = transactions(spark, sf, *CLUSTER_FEATURES)
    return cluster.kmeans_centroids(df, CLUSTER_FEATURES, _best_fit(df))


@query("kmeans_centroids_pca")
def kmeans_centroids_pca(spark, sf):
    """The same centroids in the plane of the two principal components of the rows."""
    df = transactions(spark, sf, *CLUSTER_FEATURES)
    _, loadings = cluster.pca_2d(df, CLUSTER_FEATURES)
    return cluster.projected_centroids(spark, _best_fit(df), loadings)


@query("scatter_by_cluster")
def scatter_by_cluster(spark, sf):
    """Rows per cluster in bins of (price, quantity), standardized, and of the principal components."""
    df = transactions(spark, sf, *CLUSTER_FEATURES)
    fit = _best_fit(df)
    assigned = cluster.assign_to(standardize(df, CLUSTER_FEATURES), CLUSTER_FEATURES, fit.centres)
    projected, _ = cluster.pca_2d(assigned, CLUSTER_FEATURES)
    return outliers.scatter_bins(projected, [("price", "quantity"), ("pc1", "pc2")], group="cluster")


# Centres in standardized units, for the assignment step alone.
CENTRES = ((-1.0, -1.0, 0.0), (1.0, -1.0, 0.5), (0.0, 1.0, -0.5))

ASSIGNED = (
    """z as (
  select row_key, (price - avg(price) over ()) / stddev_pop(price) over () as a,
         (quantity - avg(quantity) over ()) / stddev_pop(quantity) over () as b,
         (discount_pct - avg(discount_pct) over ()) / stddev_pop(discount_pct) over () as c from tx
), d as (select row_key, """
    + ", ".join(
        f"power(a - ({x}), 2) + power(b - ({y}), 2) + power(c - ({z}), 2) as d{i}"
        for i, (x, y, z) in enumerate(CENTRES)
    )
    + """ from z),
assigned as (select row_key, cast(case when d0 <= d1 and d0 <= d2 then 0
                                  when d1 <= d2 then 1 else 2 end as integer) as cluster from d)
"""
)


def _assigned(spark, sf):
    df = standardize(transactions(spark, sf, "row_key", *CLUSTER_FEATURES), CLUSTER_FEATURES)
    return cluster.assign_to(df, CLUSTER_FEATURES, CENTRES).select("row_key", "cluster")


@query("kmeans_assign", "with {tx}, " + ASSIGNED + " select row_key, cluster from assigned")
def kmeans_assign(spark, sf):
    return _assigned(spark, sf)


@query(
    "cluster_counts",
    "with {tx}, " + ASSIGNED + " select cluster, count(*) as n from assigned group by cluster",
)
def cluster_counts(spark, sf):
    return cluster.cluster_counts(_assigned(spark, sf))


@query("pca_2d")
def pca_2d(spark, sf):
    df = transactions(spark, sf, "row_key", *CLUSTER_FEATURES)
    out, _ = cluster.pca_2d(df, CLUSTER_FEATURES)
    return out.select("row_key", "pc1", "pc2")


CUSTOMER_FEATURES = ("c_nationkey", "c_acctbal")


@query(
    "dbscan",
    """with recursive z as (
      select c_custkey as k,
             (c_nationkey - avg(c_nationkey) over ()) / stddev_pop(c_nationkey) over () as x,
             (c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over () as y
      from customer
    ), near as (
      select a.k as a, b.k as b from z a join z b
        on (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.1 * 0.1
    ), core as (select a as k from near group by a having count(*) >= 3),
    edge as (select a, b from near where a in (select k from core) and b in (select k from core)),
    reach as (
      select k as a, k as b from core
      union select r.a, e.b from reach r join edge e on r.b = e.a
    ), component as (select a as k, min(b) as root from reach group by a),
    numbered as (select k, dense_rank() over (order by root) - 1 as cluster from component),
    border as (
      select a as k, min(cluster) as cluster from near join numbered n on n.k = b
      where a not in (select k from core) group by a
    )
    select z.k as c_custkey, cast(coalesce(n.cluster, b.cluster, -1) as integer) as cluster,
           cast(n.k is not null as integer) as is_core
    from z left join numbered n on n.k = z.k left join border b on b.k = z.k""",
)
def dbscan_customers(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", *CUSTOMER_FEATURES)
    scaled = standardize(df, CUSTOMER_FEATURES)
    out = dbscan(scaled, CUSTOMER_FEATURES, 0.1, 3, "c_custkey")
    return out.withColumn("is_core", F.col("is_core").cast("int"))


@query("dbscan_transactions")
def dbscan_transactions(spark, sf):
    df = standardize(transactions(spark, sf, "row_key", *CLUSTER_FEATURES), CLUSTER_FEATURES)
    return dbscan(df, CLUSTER_FEATURES, 1.0, 3)


@query("dbscan_pca")
def dbscan_pca(spark, sf):
    df = transactions(spark, sf, "row_key", *CLUSTER_FEATURES)
    projected, _ = cluster.pca_2d(df, CLUSTER_FEATURES)
    return dbscan(projected, ("pc1", "pc2"), 1.0, 3)


@query(
    "baskets",
    """with {tx} select customer_id, string_agg(distinct product_category, '|' order by product_category) as items
    from tx group by customer_id""",
)
def customer_baskets(spark, sf):
    out = baskets.baskets(transactions(spark, sf, "customer_id", "product_category"))
    return out.withColumn("items", F.concat_ws("|", "items"))


CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "basket_matrix",
    "with {tx} select customer_id, "
    + ", ".join(
        f"""cast(count(*) filter (where product_category = '{c}') > 0 as integer) as "{c}" """
        for c in CATEGORIES
    )
    + " from tx group by customer_id",
)
def basket_matrix(spark, sf):
    df = transactions(spark, sf, "customer_id", "product_category")
    return baskets.basket_matrix(df)


def _itemset_sql(owner):
    bits = " + ".join(
        f"cast(bool_or(product_category = '{c}') as integer) * {1 << i}"
        for i, c in enumerate(CATEGORIES)
    )
    names = " ".join(f"when {i} then '{c}'" for i, c in enumerate(CATEGORIES))
    return f"""
    b as (select {owner} as o, {bits} as bits from tx group by {owner}),
    n as (select count(*) as n from b),
    sets as (
      select s.mask, count(*) as freq, count(*) / any_value(n.n) as support
      from (select unnest(range(1, 64)) as mask) s join b on (b.bits & s.mask) = s.mask, n
      group by s.mask having count(*) >= 0.003 * any_value(n.n)
    ), named as (
      select mask, string_agg(case i {names} end, '|' order by i) as items
      from sets, (select unnest(range(0, 6)) as i) where (mask >> i) & 1 = 1 group by mask
    )"""


def _rule_sql(owner):
    return (
        "with {tx}, "
        + _itemset_sql(owner)
        + """, r as (
      select a.mask as am, c.mask as cm, a.support as sa, c.support as sc, w.support as s
      from sets w join sets a on (a.mask & w.mask) = a.mask and a.mask <> w.mask
      join sets c on c.mask = w.mask - a.mask
    ), m as (
      select *, s / sa as conf, s - sa * sc as lev,
             greatest(s * (1 - sa), sa * (sc - s)) as widest from r)
    select x.items as antecedent, y.items as consequent, round(sa, 9) as antecedent_support,
           round(sc, 9) as consequent_support, round(s, 9) as support, round(conf, 9) as confidence,
           round(conf / sc, 9) as lift, round(lev, 9) as leverage,
           case when conf = 1 then cast('inf' as double) else round((1 - sc) / (1 - conf), 6) end as conviction,
           case when widest = 0 then 0 else round(lev / widest, 6) end as zhangs_metric,
           round(s / (sa + sc - s), 9) as jaccard,
           case when sc = 1 then 0 else round((conf - sc) / (1 - sc), 6) end as certainty,
           round((s / sa + s / sc) / 2, 9) as kulczynski
    from m join named x on x.mask = am join named y on y.mask = cm where conf >= 0.003"""
    )


def _rules(spark, sf, owner):
    bought = baskets.baskets(transactions(spark, sf, owner, "product_category"), owner)
    out = baskets.association_rules(baskets.frequent_itemsets(bought))
    six = ("conviction", "zhangs_metric", "certainty")
    nine = [c for c in out.columns[2:-1] if c not in six]
    return out.select(
        F.concat_ws("|", "antecedent").alias("antecedent"),
        F.concat_ws("|", "consequent").alias("consequent"),
        *[F.round(c, 9).alias(c) for c in nine],
        *[F.round(c, 6).alias(c) for c in six],
    )


def _itemsets(spark, sf, owner):
    bought = baskets.baskets(transactions(spark, sf, owner, "product_category"), owner)
    out = baskets.frequent_itemsets(bought)
    return out.select(
        F.concat_ws("|", "items").alias("items"), "freq", F.round("support", 9).alias("support")
    )


ITEMSET_SELECT = " select items, freq, round(support, 9) as support from sets join named using (mask)"


@query("frequent_itemsets", "with {tx}, " + _itemset_sql("customer_id") + ITEMSET_SELECT)
def frequent_itemsets(spark, sf):
    return _itemsets(spark, sf, "customer_id")


@query("frequent_itemsets_orders", "with {tx}, " + _itemset_sql("order_id") + ITEMSET_SELECT)
def frequent_itemsets_orders(spark, sf):
    return _itemsets(spark, sf, "order_id")


@query("association_rules", _rule_sql("customer_id"))
def association_rules(spark, sf):
    return _rules(spark, sf, "customer_id")


@query("association_rules_orders", _rule_sql("order_id"))
def association_rules_orders(spark, sf):
    return _rules(spark, sf, "order_id")


@query("knn_classify_transactions")
def knn_classify_transactions(spark, sf):
    """High/Low target from the seven raw features, every test row against all training rows."""
    df = transactions(
        spark, sf, "row_key", *CLUSTER_FEATURES, "transaction_date", "total_amount"
    )
    df = train_test_split(label_high_low(df), 0.2).select(
        "row_key",
        "label",
        "split",
        *CLUSTER_FEATURES,
        F.month("transaction_date").alias("month"),
        F.dayofmonth("transaction_date").alias("day"),
        F.hour("transaction_date").alias("hour"),
        F.weekday("transaction_date").alias("day_of_week"),
    )
    features = (*CLUSTER_FEATURES, "month", "day", "hour", "day_of_week")
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    return neighbors.knn_classify(train, test, features, 5)

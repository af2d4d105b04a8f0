"""Baskets, frequent itemsets and association rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import ratio
from tillwork.operators.encode import label_encode, sorted_labels


def baskets(df: DataFrame, owner: str = "customer_id", item: str = "product_category") -> DataFrame:
    """(owner, items): the sorted distinct items of each owner."""
    return df.groupBy(owner).agg(F.sort_array(F.collect_set(item)).alias("items"))


def basket_matrix(
    df: DataFrame,
    owner: str = "customer_id",
    item: str = "product_category",
    values: Sequence | None = None,
) -> DataFrame:
    """One 0/1 column per item: whether the owner bought it. For many items see ``basket_codes``."""
    values = list(values) if values else sorted_labels(df, item)
    counts = df.groupBy(owner).pivot(item, values).agg(F.count(item))
    return counts.select(
        owner, *[(F.coalesce(F.col(f"`{v}`"), F.lit(0)) > 0).cast("int").alias(str(v)) for v in values]
    )


def basket_codes(df: DataFrame, owner: str = "customer_id", item: str = "product_category") -> DataFrame:
    """(owner, codes): the places of the ones in a row of ``basket_matrix``, for any number of items."""
    return baskets(label_encode(df, [item]), owner, f"{item}_code").withColumnRenamed("items", "codes")


def frequent_itemsets(basket: DataFrame, min_support: float = 0.003) -> DataFrame:
    """(items, freq, support): itemsets contained in at least ``min_support`` of the baskets."""
    n = basket.count()
    if n == 0:
        return basket.select("items", F.lit(0).cast("bigint").alias("freq"), F.lit(0.0).alias("support"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(basket)
    return model.freqItemsets.select(
        F.sort_array("items").alias("items"), "freq", (F.col("freq") / F.lit(n)).alias("support")
    )


def association_rules(itemsets: DataFrame, min_confidence: float = 0.003) -> DataFrame:
    """Every antecedent/consequent split of every itemset, with its measures.

    Subsets are enumerated as bit masks of the itemset, and their supports found by two joins back
    to the itemsets (every subset of a frequent itemset is frequent).
    """
    wide = itemsets.where(F.size("items") >= 2)
    last_mask = F.expr("cast(shiftleft(1L, size(items)) - 2 as bigint)")
    splits = wide.withColumn("mask", F.explode(F.sequence(F.lit(1).cast("bigint"), last_mask)))
    chosen = "filter(items, (x, j) -> (shiftright(mask, j) & 1) = {})"
    splits = splits.select(
        "support",
        F.expr(chosen.format(1)).alias("antecedent"),
        F.expr(chosen.format(0)).alias("consequent"),
    )
    left = itemsets.select(F.col("items").alias("antecedent"), F.col("support").alias("sa"))
    right = itemsets.select(F.col("items").alias("consequent"), F.col("support").alias("sc"))
    joined = splits.join(left, "antecedent").join(right, "consequent")
    s, sa, sc = F.col("support"), F.col("sa"), F.col("sc")
    confidence = s / sa
    leverage = s - sa * sc
    widest = F.greatest(s * (1 - sa), sa * (sc - s))
    return joined.select(
        "antecedent",
        "consequent",
        sa.alias("antecedent_support"),
        sc.alias("consequent_support"),
        "support",
        confidence.alias("confidence"),
        (confidence / sc).alias("lift"),
        leverage.alias("leverage"),
        ratio(1 - sc, 1 - confidence, float("inf")).alias("conviction"),
        ratio(leverage, widest).alias("zhangs_metric"),
        (s / (sa + sc - s)).alias("jaccard"),
        ratio(confidence - sc, 1 - sc).alias("certainty"),
        ((s / sa + s / sc) / 2).alias("kulczynski"),
        F.lit(1.0).alias("representativity"),
    ).where(F.col("confidence") >= min_confidence)

"""Category, product and calendar aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import exact_sum, ratio
from tillwork.session import cut


def category_sales(df: DataFrame, key: str = "product_category") -> DataFrame:
    """Total sales and quantity per category."""
    return df.groupBy(key).agg(
        exact_sum("total_amount").alias("total_sales"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
    )


def class_distribution(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def imbalance_ratio(df: DataFrame, key: str) -> DataFrame:
    counts = class_distribution(df, key)
    return counts.agg((F.max("n") / F.min("n")).alias("imbalance_ratio"))


def product_analysis(df: DataFrame, key: str = "product_id") -> DataFrame:
    """Average price and sales frequency per product, both from one grouping."""
    return df.groupBy(key).agg(
        (exact_sum("price") / F.count("price")).alias("average_price"),
        F.count("*").alias("sales_frequency"),
    )


def product_analysis_joined(df: DataFrame, key: str = "product_id") -> DataFrame:
    """The same table as a join of two groupings (one shuffle more than ``product_analysis``)."""
    price = df.groupBy(key).agg((exact_sum("price") / F.count("price")).alias("average_price"))
    frequency = df.groupBy(key).agg(F.count("*").alias("sales_frequency"))
    return price.join(frequency, key, "inner")


def top_products(df: DataFrame, n: int = 5, best: bool = True, key: str = "product_id") -> DataFrame:
    """The ``n`` most (or least) frequently sold products; ties go to the smaller id."""
    frequency = F.col("sales_frequency")
    order = frequency.desc() if best else frequency.asc()
    return product_analysis(df, key).orderBy(order, F.col(key)).limit(n)


def _days(df: DataFrame, date: str) -> DataFrame:
    """Every day from the first to the last transaction."""
    span = df.agg(F.min(F.to_date(date)).alias("lo"), F.max(F.to_date(date)).alias("hi"))
    return span.where(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("day"))


def daily_totals(df: DataFrame, date: str = "transaction_date") -> DataFrame:
    """Revenue and quantity for every calendar day; days without sales are 0."""
    # One row per day: kept, since both the calendar's ends and its values are read from it.
    sold = cut(
        df.groupBy(F.to_date(date).alias("day")).agg(
            exact_sum("total_amount").alias("revenue"),
            F.sum("quantity").cast("bigint").alias("volume"),
        )
    )
    return (
        _days(sold, "day")
        .join(sold, "day", "left")
        .select(
            "day",
            F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
            F.coalesce("volume", F.lit(0)).alias("volume"),
        )
    )


def monthly_revenue(df: DataFrame, date: str = "transaction_date") -> DataFrame:
    """Revenue per month, labelled by the month's last day; months without sales are 0."""
    sold = cut(
        df.groupBy(F.last_day(F.to_date(date)).alias("month_end")).agg(
            exact_sum("total_amount").alias("revenue")
        )
    )
    span = sold.agg(
        F.trunc(F.min("month_end"), "month").alias("lo"),
        F.trunc(F.max("month_end"), "month").alias("hi"),
    ).where(F.col("lo").isNotNull())
    starts = F.sequence("lo", "hi", F.expr("interval 1 month"))
    months = span.select(F.explode(starts).alias("start")).select(
        F.last_day("start").alias("month_end")
    )
    return months.join(sold, "month_end", "left").select(
        "month_end", F.coalesce("revenue", F.lit(0.0)).alias("revenue")
    )


def daily_growth(daily: DataFrame) -> DataFrame:
    """Change against the day before: 0 on the first day and for 0 -> 0, infinite from 0.

    The calendar has no gaps, so the previous row is found by an equi-join on the day.
    """
    previous = daily.select(
        F.date_add("day", 1).alias("day"), F.col("revenue").alias("previous")
    )
    change = F.col("revenue") - F.col("previous")
    growth = (
        F.when(F.col("previous").isNull(), 0.0)
        .when(F.col("previous") != 0, ratio(change, F.col("previous")))
        .when(change > 0, float("inf"))
        .when(change < 0, float("-inf"))
        .otherwise(0.0)
    )
    return daily.join(previous, "day", "left").select("day", "revenue", growth.alias("growth"))


def future_calendar(df: DataFrame, date: str = "transaction_date", days: int = 30) -> DataFrame:
    """The ``days`` days after the last transaction, with calendar features."""
    last = df.agg(F.max(F.to_date(date)).alias("last")).where(F.col("last").isNotNull())
    ahead = F.sequence(F.date_add("last", 1), F.date_add("last", days))
    return last.select(F.explode(ahead).alias("day")).select(
        "day",
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        F.weekday("day").alias("day_of_week"),
    )


def pair_matrix(df: DataFrame, columns: Sequence[str], measure: str = "covariance") -> DataFrame:
    """Sample covariance or Pearson correlation of all pairs, in long form, from one aggregate."""
    from tillwork.operators.profile import rows_from

    function = {"covariance": F.covar_samp, "correlation": F.corr}[measure]
    pairs = list(combinations_with_replacement(columns, 2))
    aggs = [
        function(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    rows = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            rows.append({"feature": F.lit(x), "other": F.lit(y), "value": F.col(f"p{i}")})
    return rows_from(df.agg(*aggs), rows)

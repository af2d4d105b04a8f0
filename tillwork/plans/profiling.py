"""Scan, inspection, cleaning and projection queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillwork.functions.columns import (
    date_parts,
    discount_amount,
    holiday_flag,
    row_total,
    weekend_flag,
)
from tillwork.operators import profile
from tillwork.plans.registry import query
from tillwork.session import shared_dir
from tillwork.sources import events, read_csv_transactions, table, transactions
from tillwork.sources.transactions import CSV_COLUMNS


def _day_text(df, column="transaction_date"):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


SCAN_SQL = """
select row_key, customer_id, product_id, cast(quantity as bigint) as quantity, price,
       strftime(transaction_date, '%Y-%m-%d') as transaction_date, payment_method, store_location,
       product_category, round(discount_pct, 6) as discount_pct,
       round(total_amount, 4) as total_amount
"""


def _scanned(df):
    return _day_text(df).select(
        "row_key",
        "customer_id",
        "product_id",
        F.col("quantity").cast("bigint").alias("quantity"),
        "price",
        "transaction_date",
        "payment_method",
        "store_location",
        "product_category",
        F.round("discount_pct", 6).alias("discount_pct"),
        F.round("total_amount", 4).alias("total_amount"),
    )


@query("scan_transactions", "with {tx} " + SCAN_SQL + " from tx")
def scan_transactions(spark, sf):
    return _scanned(transactions(spark, sf))


@query("csv_scan", "with {tx} " + SCAN_SQL.replace("row_key, ", "") + " from tx")
def csv_scan(spark, sf):
    """The transactions as headered CSV files in the shared folder, scanned with the declared schema."""
    rows = transactions(spark, sf).withColumn("quantity", F.col("quantity").cast("int"))
    target = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    rows.select([F.col(new).alias(old) for old, new in CSV_COLUMNS.items()]).write.option("header", True).csv(target)
    return _scanned(read_csv_transactions(spark, target).withColumn("row_key", F.lit(""))).drop("row_key")


@query("head_rows", "with {tx} " + SCAN_SQL + " from tx order by row_key, price limit 5")
def head_rows(spark, sf):
    return profile.head_rows(_scanned(transactions(spark, sf)), 5, ("row_key", "price"))


INFO_SQL = """
with {tx}
select * from (
  select 0 as ordinal, 'customer_id' as column_name, 'bigint' as dtype, count(customer_id) as non_null from tx
  union all select 1, 'product_id', 'string', count(product_id) from tx
  union all select 2, 'quantity', 'double', count(quantity) from tx
  union all select 3, 'price', 'double', count(price) from tx
  union all select 4, 'transaction_date', 'timestamp_ntz', count(transaction_date) from tx
  union all select 5, 'payment_method', 'string', count(payment_method) from tx
  union all select 6, 'store_location', 'string', count(store_location) from tx
  union all select 7, 'product_category', 'string', count(product_category) from tx
  union all select 8, 'discount_pct', 'double', count(discount_pct) from tx
  union all select 9, 'total_amount', 'double', count(total_amount) from tx
)
"""


@query("table_info", INFO_SQL)
def table_info(spark, sf):
    return profile.table_info(transactions(spark, sf).drop("row_key"))


def _describe_sql(column):
    return f"""
    select '{column}' as column_name, count({column}) as n, round(avg({column}), 4) as mean,
           round(stddev_samp({column}), 4) as std, round(min({column}), 4) as min,
           round(quantile_cont({column}, 0.25), 4) as q25,
           round(quantile_cont({column}, 0.5), 4) as q50,
           round(quantile_cont({column}, 0.75), 4) as q75, round(max({column}), 4) as max
    from tx"""


@query(
    "describe_numeric",
    "with {tx} "
    + " union all ".join(map(_describe_sql, ("quantity", "price", "discount_pct"))),
)
def describe_numeric(spark, sf):
    df = transactions(spark, sf, "quantity", "price", "discount_pct")
    out = profile.describe_numeric(df, ["quantity", "price", "discount_pct"])
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    return out.select("column_name", "n", *rounded)


# The given tables hold no nulls; blanking fixed values makes the operator's work visible.
BLANKED = """
blanked as (
  select row_key, nullif(product_category, 'PROMO') as product_category,
         nullif(quantity, 1) as quantity, nullif(price, 0) as price from tx
)
"""


def _blanked(spark, sf):
    df = transactions(spark, sf, "row_key", "product_category", "quantity", "price")
    return df.select(
        "row_key",
        F.expr("nullif(product_category, 'PROMO')").alias("product_category"),
        F.expr("nullif(quantity, 1)").alias("quantity"),
        F.expr("nullif(price, 0)").alias("price"),
    )


@query(
    "null_counts",
    "with {tx}, "
    + BLANKED
    + " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as null_count from blanked"
        for c in ("row_key", "product_category", "quantity", "price")
    ),
)
def null_counts(spark, sf):
    return profile.null_counts(_blanked(spark, sf))


@query(
    "drop_nulls",
    "with {tx}, "
    + BLANKED
    + """select row_key, product_category, cast(quantity as bigint) as quantity, price from blanked
         where product_category is not null and quantity is not null and price is not null""",
)
def drop_nulls(spark, sf):
    df = profile.drop_nulls(_blanked(spark, sf))
    return df.withColumn("quantity", F.col("quantity").cast("bigint"))


DUPLICATE_COLUMNS = ("product_id", "payment_method", "quantity", "discount_pct")


@query(
    "duplicate_count",
    """with {tx}
    select cast(sum(n - 1) as bigint) as duplicate_rows from (
      select count(*) as n from tx group by product_id, payment_method, quantity, discount_pct)""",
)
def duplicate_count(spark, sf):
    return profile.duplicate_count(transactions(spark, sf, *DUPLICATE_COLUMNS))


@query(
    "drop_duplicates",
    """with {tx}
    select distinct product_id, payment_method, cast(quantity as bigint) as quantity,
           round(discount_pct, 6) as discount_pct from tx""",
)
def drop_duplicates(spark, sf):
    df = profile.drop_duplicates(transactions(spark, sf, *DUPLICATE_COLUMNS))
    return df.select(
        "product_id",
        "payment_method",
        F.col("quantity").cast("bigint").alias("quantity"),
        F.round("discount_pct", 6).alias("discount_pct"),
    )


@query(
    "project_features",
    """with {tx}
    select row_key, cast(quantity as bigint) as quantity, price,
           round(discount_pct, 6) as discount_pct from tx""",
)
def project_features(spark, sf):
    df = transactions(spark, sf, "row_key", "quantity", "price", "discount_pct", "total_amount")
    return df.drop("total_amount").select(
        "row_key",
        F.col("quantity").cast("bigint").alias("quantity"),
        "price",
        F.round("discount_pct", 6).alias("discount_pct"),
    )


@query(
    "row_total",
    "with {tx} select row_key, round(quantity * price, 2) as row_total from tx",
)
def row_total_query(spark, sf):
    df = transactions(spark, sf, "row_key", "quantity", "price")
    return df.select("row_key", F.round(row_total(), 2).alias("row_total"))


@query(
    "discount_amount",
    "with {tx} select row_key, round((discount_pct / 100.0) * price, 4) as discount_amount from tx",
)
def discount_amount_query(spark, sf):
    df = transactions(spark, sf, "row_key", "price", "discount_pct")
    return df.select("row_key", F.round(discount_amount(), 4).alias("discount_amount"))


@query(
    "date_parts",
    """select event_id, cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
              cast(day(ts) as integer) as day, cast(hour(ts) as integer) as hour,
              cast(isodow(ts) - 1 as integer) as day_of_week
       from events""",
)
def date_parts_query(spark, sf):
    df = events(spark, sf).withColumn("ts", F.to_timestamp(F.col("ts").cast("string")))
    return df.select("event_id", *[c.alias(n) for n, c in date_parts("ts").items()])


@query(
    "parse_dates_coerce",
    """select event_id, case when event_type = 'error' then null
              else strftime(ts, '%Y-%m-%d %H:%M:%S') end as parsed
       from events""",
)
def parse_dates_coerce(spark, sf):
    """Timestamps read back from text; the text of 'error' events is not a date."""
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), F.col("props"))).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    parsed = F.try_to_timestamp(text)
    return events(spark, sf).select(
        "event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed")
    )


@query(
    "calendar_flags",
    """select event_id, strftime(ts, '%Y-%m-%d') as day,
              cast(case when isodow(ts) in (6, 7) then 1 else 0 end as integer) as is_weekend,
              cast(case when strftime(ts, '%Y-%m-%d') in ('2023-12-25', '2024-01-01')
                   then 1 else 0 end as integer) as is_holiday
       from events""",
)
def calendar_flags(spark, sf):
    return events(spark, sf).select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        weekend_flag("ts").alias("is_weekend"),
        holiday_flag("ts").alias("is_holiday"),
    )

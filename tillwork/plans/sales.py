"""Category, product, calendar, encoding, scaling and distribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.operators import encode, outliers, sales
from tillwork.operators.profile import numeric_columns
from tillwork.plans.registry import query
from tillwork.sources import transactions

EXACT = "cast(sum(cast({0} as decimal(18,4))) as double)"


@query(
    "category_sales",
    f"""with {{tx}}
    select product_category, {EXACT.format('total_amount')} as total_sales,
           cast(sum(quantity) as bigint) as total_quantity
    from tx group by product_category""",
)
def category_sales(spark, sf):
    df = transactions(spark, sf, "product_category", "quantity", "total_amount")
    return sales.category_sales(df)


@query(
    "class_distribution",
    "with {tx} select product_category, count(*) as n from tx group by product_category",
)
def class_distribution(spark, sf):
    return sales.class_distribution(transactions(spark, sf, "product_category"), "product_category")


@query(
    "imbalance_ratio",
    """with {tx}
    select round(max(n) / min(n), 9) as imbalance_ratio
    from (select count(*) as n from tx group by product_category)""",
)
def imbalance_ratio(spark, sf):
    df = sales.imbalance_ratio(transactions(spark, sf, "product_category"), "product_category")
    return df.select(F.round("imbalance_ratio", 9).alias("imbalance_ratio"))


PRODUCT_SQL = f"""
select product_id, round({EXACT.format('price')} / count(price), 6) as average_price,
       count(*) as sales_frequency
from tx group by product_id
"""


def _rounded_products(df):
    return df.select(
        "product_id", F.round("average_price", 6).alias("average_price"), "sales_frequency"
    )


@query("product_analysis", "with {tx} " + PRODUCT_SQL)
def product_analysis(spark, sf):
    return _rounded_products(sales.product_analysis(transactions(spark, sf, "product_id", "price")))


@query("product_analysis_joined", "with {tx} " + PRODUCT_SQL)
def product_analysis_joined(spark, sf):
    df = transactions(spark, sf, "product_id", "price")
    return _rounded_products(sales.product_analysis_joined(df))


@query(
    "best_selling",
    "with {tx} " + PRODUCT_SQL + " order by sales_frequency desc, product_id limit 5",
)
def best_selling(spark, sf):
    df = transactions(spark, sf, "product_id", "price")
    return _rounded_products(sales.top_products(df, 5))


@query("worst_selling", "with {tx} " + PRODUCT_SQL + " order by sales_frequency, product_id limit 5")
def worst_selling(spark, sf):
    df = transactions(spark, sf, "product_id", "price")
    return _rounded_products(sales.top_products(df, 5, best=False))


DAILY = f"""
sold as (
  select cast(transaction_date as date) as day, {EXACT.format('total_amount')} as revenue,
         cast(sum(quantity) as bigint) as volume
  from tx group by 1
), days as (
  select cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as day from sold
), daily as (
  select days.day, coalesce(revenue, 0.0) as revenue, coalesce(volume, 0) as volume
  from days left join sold on days.day = sold.day
)
"""


def _daily(spark, sf):
    return sales.daily_totals(
        transactions(spark, sf, "transaction_date", "total_amount", "quantity")
    )


def _iso(column="day"):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


@query(
    "daily_revenue",
    "with {tx}, " + DAILY + " select strftime(day, '%Y-%m-%d') as day, revenue from daily",
)
def daily_revenue(spark, sf):
    return _daily(spark, sf).select(_iso(), "revenue")


@query(
    "daily_volume",
    "with {tx}, " + DAILY + " select strftime(day, '%Y-%m-%d') as day, volume from daily",
)
def daily_volume(spark, sf):
    return _daily(spark, sf).select(_iso(), "volume")


@query(
    "daily_growth",
    "with {tx}, "
    + DAILY
    + """
    , lagged as (select day, revenue, lag(revenue) over (order by day) as previous from daily)
    select strftime(day, '%Y-%m-%d') as day, revenue,
           round(case when previous is null then 0.0
                when previous <> 0 then (revenue - previous) / previous
                when revenue > 0 then cast('inf' as double)
                when revenue < 0 then cast('-inf' as double) else 0.0 end, 6) as growth
    from lagged""",
)
def daily_growth(spark, sf):
    df = sales.daily_growth(_daily(spark, sf))
    return df.select(_iso(), "revenue", F.round("growth", 6).alias("growth"))


@query(
    "monthly_revenue",
    f"""with {{tx}}, sold as (
      select last_day(cast(transaction_date as date)) as month_end,
             {EXACT.format('total_amount')} as revenue
      from tx group by 1
    ), months as (
      select last_day(cast(unnest(generate_series(
               date_trunc('month', min(month_end)), max(month_end), interval 1 month)) as date)) as month_end
      from sold
    )
    select strftime(m.month_end, '%Y-%m-%d') as month_end, coalesce(revenue, 0.0) as revenue
    from months m left join sold s on m.month_end = s.month_end""",
)
def monthly_revenue(spark, sf):
    df = sales.monthly_revenue(transactions(spark, sf, "transaction_date", "total_amount"))
    return df.select(_iso("month_end"), "revenue")


@query(
    "future_calendar",
    """with {tx}, last as (select max(cast(transaction_date as date)) as d from tx),
    ahead as (select cast(d + cast(i as integer) as date) as day
              from last, (select unnest(range(1, 31)) as i))
    select strftime(day, '%Y-%m-%d') as day, cast(year(day) as integer) as year,
           cast(month(day) as integer) as month, cast(day(day) as integer) as day_of_month,
           cast(isodow(day) - 1 as integer) as day_of_week
    from ahead""",
)
def future_calendar(spark, sf):
    df = sales.future_calendar(transactions(spark, sf, "transaction_date"))
    return df.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def _codes_sql(column):
    return f"(select v, row_number() over (order by v) - 1 as c from (select distinct {column} as v from tx))"


@query(
    "label_encode",
    f"""with {{tx}}
    select row_key, product_category, store_location,
           cast(a.c as bigint) as product_category_code, cast(b.c as bigint) as store_location_code
    from tx join {_codes_sql('product_category')} a on a.v = product_category
            join {_codes_sql('store_location')} b on b.v = store_location""",
)
def label_encode(spark, sf):
    df = transactions(spark, sf, "row_key", "product_category", "store_location")
    return encode.label_encode(df, ["product_category", "store_location"])


@query(
    "one_hot_drop_first",
    """with {tx} select row_key,
      cast(product_category = 'LARGE' as integer) as "product_category_LARGE",
      cast(product_category = 'MEDIUM' as integer) as "product_category_MEDIUM",
      cast(product_category = 'PROMO' as integer) as "product_category_PROMO",
      cast(product_category = 'SMALL' as integer) as "product_category_SMALL",
      cast(product_category = 'STANDARD' as integer) as "product_category_STANDARD"
    from tx""",
)
def one_hot_drop_first(spark, sf):
    df = transactions(spark, sf, "row_key", "product_category")
    return encode.one_hot_drop_first(df, ["product_category"])


@query(
    "quantile_label",
    """with {tx}, m as (select quantile_cont(total_amount, 0.5) as median from tx)
    select row_key, case when total_amount <= median then 'Low' else 'High' end as label_name,
           cast(total_amount <= median as integer) as label
    from tx, m""",
)
def quantile_label(spark, sf):
    df = transactions(spark, sf, "row_key", "total_amount")
    return encode.label_high_low(df).select("row_key", "label_name", "label")


SCALED = ("quantity", "price", "discount_pct")


@query(
    "standardize",
    "with {tx} select row_key, "
    + ", ".join(
        f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) as {c}" for c in SCALED
    )
    + " from tx",
)
def standardize(spark, sf):
    df = transactions(spark, sf, "row_key", *SCALED)
    scaled = encode.standardize(df, numeric_columns(df))
    return scaled.select("row_key", *[F.round(c, 6).alias(c) for c in SCALED])


@query(
    "interaction_features",
    """with {tx} select row_key, round(quantity * price, 4) as quantity_x_price,
      round(quantity * discount_pct, 4) as quantity_x_discount_pct,
      round(price * discount_pct, 4) as price_x_discount_pct from tx""",
)
def interaction_features(spark, sf):
    df = transactions(spark, sf, "row_key", *SCALED)
    out = encode.interaction_features(df, SCALED)
    return out.select("row_key", *[F.round(c, 4).alias(c) for c in out.columns if "_x_" in c])


FENCED = ("total_amount", "price", "quantity")


def _quartiles(column, source, name):
    return f"""{name} as (select quantile_cont({column}, 0.25) as q1,
      quantile_cont({column}, 0.75) as q3 from {source})"""


@query(
    "iqr_bounds",
    "with {tx} "
    + " union all ".join(
        f"""select '{c}' as column_name, round(q1, 4) as q25, round(q3, 4) as q75,
        round(q1 - 1.5 * (q3 - q1), 4) as lower, round(q3 + 1.5 * (q3 - q1), 4) as upper
        from (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from tx)"""
        for c in FENCED
    ),
)
def iqr_bounds(spark, sf):
    out = outliers.bounds_table(transactions(spark, sf, *FENCED), FENCED)
    return out.select(
        "column_name", *[F.round(c, 4).alias(c) for c in ("q25", "q75", "lower", "upper")]
    )


def _sequential_iqr_sql():
    steps, source = [], "tx"
    for i, c in enumerate(FENCED):
        steps.append(_quartiles(c, source, f"b{i}"))
        steps.append(
            f"""s{i} as (select {source}.* from {source}, b{i}
            where {c} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))"""
        )
        source = f"s{i}"
    return (
        "with {tx}, "
        + ", ".join(steps)
        + f""" select row_key, cast(quantity as bigint) as quantity, price,
        round(total_amount, 4) as total_amount from {source}"""
    )


@query("iqr_filter", _sequential_iqr_sql())
def iqr_filter(spark, sf):
    df = transactions(spark, sf, "row_key", *FENCED)
    return outliers.iqr_filter(df, FENCED).select(
        "row_key",
        F.col("quantity").cast("bigint").alias("quantity"),
        "price",
        F.round("total_amount", 4).alias("total_amount"),
    )


@query(
    "boxplot_stats",
    "with {tx} "
    + " union all ".join(
        f"""select '{c}' as column_name, round(any_value(q1), 4) as q25, round(any_value(q2), 4) as q50,
        round(any_value(q3), 4) as q75,
        round(min({c}) filter (where {c} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 4) as whisker_low,
        round(max({c}) filter (where {c} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 4) as whisker_high,
        count(*) filter (where not {c} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as outliers
        from tx, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as q2,
                         quantile_cont({c}, 0.75) as q3 from tx)"""
        for c in FENCED
    ),
)
def boxplot_stats(spark, sf):
    out = outliers.boxplot_stats(transactions(spark, sf, *FENCED), FENCED)
    numbers = ("q25", "q50", "q75", "whisker_low", "whisker_high")
    return out.select("column_name", *[F.round(c, 4).alias(c) for c in numbers], "outliers")


LIMITS = "lim as (select min(price) as lo, max(price) as hi, (max(price) - min(price)) / 30 as w from tx)"


@query(
    "histogram",
    f"""with {{tx}}, {LIMITS},
    c as (select cast(least(floor((price - lo) / w), 29) as integer) as bin, count(*) as n
          from tx, lim group by 1)
    select cast(g.bin as integer) as bin, round(lo + g.bin * w, 6) as left_edge,
           round(lo + (g.bin + 1) * w, 6) as right_edge, coalesce(n, 0) as n
    from (select unnest(range(30)) as bin) g left join c on c.bin = g.bin, lim""",
)
def histogram(spark, sf):
    out = outliers.histogram(transactions(spark, sf, "price"), "price", 30)
    return out.select(
        "bin",
        F.round("left_edge", 6).alias("left_edge"),
        F.round("right_edge", 6).alias("right_edge"),
        "n",
    )


@query(
    "kde_curve",
    """with {tx}, lim as (
      select count(price) as n, stddev_samp(price) * power(count(price), -0.2) as bw,
             min(price) as lo, max(price) as hi, (max(price) - min(price)) / 512 as w from tx
    ), b as (
      select lo + (least(floor((price - lo) / w), 511) + 0.5) * w as centre, count(*) as c
      from tx, lim group by 1
    ), g as (
      select i, (lo - 3 * bw) + i * (((hi + 3 * bw) - (lo - 3 * bw)) / 199) as x
      from lim, (select unnest(range(200)) as i)
    )
    select cast(i as integer) as point, round(x, 4) as x,
           round(sum(c * exp(-0.5 * power((x - centre) / bw, 2)))
             / any_value(n * bw * sqrt(2 * pi())), 12) as density
    from g, b, lim group by i, x""",
)
def kde_curve(spark, sf):
    out = outliers.kde_curve(transactions(spark, sf, "price"), "price")
    return out.select("point", F.round("x", 4).alias("x"), F.round("density", 12).alias("density"))


def _bin_sql(column, lo, hi):
    return f"cast(least(floor(({column} - {lo}) / (({hi} - {lo}) / 20)), 19) as integer)"


@query(
    "scatter_bins",
    """with {tx}, lim as (select min(quantity) ql, max(quantity) qh, min(price) pl, max(price) ph,
                               min(total_amount) tl, max(total_amount) th from tx)
    select 'quantity' as x_name, 'total_amount' as y_name, """
    + _bin_sql("quantity", "ql", "qh")
    + " as x_bin, "
    + _bin_sql("total_amount", "tl", "th")
    + """ as y_bin, count(*) as n from tx, lim group by all
    union all select 'price', 'total_amount', """
    + _bin_sql("price", "pl", "ph")
    + ", "
    + _bin_sql("total_amount", "tl", "th")
    + ", count(*) from tx, lim group by all",
)
def scatter_bins(spark, sf):
    df = transactions(spark, sf, "quantity", "price", "total_amount")
    return outliers.scatter_bins(df, [("quantity", "total_amount"), ("price", "total_amount")])


def _matrix_sql(function, digits):
    parts = []
    for a in SCALED:
        for b in SCALED:
            value = f"{function}({a}, {b})"
            parts.append(
                f"select '{a}' as feature, '{b}' as other, round({value}, {digits}) as value from tx"
            )
    return "with {tx} " + " union all ".join(parts)


@query("covariance_matrix", _matrix_sql("covar_samp", 3))
def covariance_matrix(spark, sf):
    out = sales.pair_matrix(transactions(spark, sf, *SCALED), SCALED)
    return out.withColumn("value", F.round("value", 3))


@query("pearson_matrix", _matrix_sql("corr", 9))
def pearson_matrix(spark, sf):
    out = sales.pair_matrix(transactions(spark, sf, *SCALED), SCALED, "correlation")
    return out.withColumn("value", F.round("value", 9))

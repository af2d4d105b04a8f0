"""Least-squares inference queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.operators.ols import Gram, feature_values
from tillwork.plans.registry import query
from tillwork.sources import transactions

PAIR = ("quantity", "price")

# Two-feature fit in closed form, without a constant.
CLOSED = """
g as (
  select count(*) as n, sum(quantity * quantity) as qq, sum(price * price) as pp,
         sum(quantity * price) as qp, sum(quantity * total_amount) as qy,
         sum(price * total_amount) as py, sum(total_amount * total_amount) as yy from tx
), b as (
  select *, qq * pp - qp * qp as det, (pp * qy - qp * py) / (qq * pp - qp * qp) as bq,
         (qq * py - qp * qy) / (qq * pp - qp * qp) as bp from g
), fit as (
  select *, yy - bq * qy - bp * py as rss, (yy - bq * qy - bp * py) / (n - 2) as s2 from b
), stats as (
  select *, sqrt(s2 * pp / det) as seq, sqrt(s2 * qq / det) as sep, 1 - rss / yy as r2,
         -n / 2.0 * (ln(2 * pi()) + ln(rss / n) + 1) as llf from fit
)
"""


def _gram(spark, sf, features=PAIR):
    df = transactions(spark, sf, *features, "total_amount")
    return Gram(df, features, "total_amount")


def _fit_table(fit, spark):
    return fit.table(spark).select(
        "n",
        F.round("r2", 8).alias("r2"),
        F.round("adj_r2", 8).alias("adj_r2"),
        F.round("f", 2).alias("f"),
        F.round("aic", 2).alias("aic"),
        F.round("bic", 2).alias("bic"),
    )


@query(
    "ols_fit",
    "with {tx}, "
    + CLOSED
    + """ select n, round(r2, 8) as r2, round(1 - n / (n - 2) * (1 - r2), 8) as adj_r2,
      round((r2 / 2) / ((1 - r2) / (n - 2)), 2) as f, round(4 - 2 * llf, 2) as aic,
      round(2 * ln(n) - 2 * llf, 2) as bic from stats""",
)
def ols_fit(spark, sf):
    return _fit_table(_gram(spark, sf).fit(), spark)


@query(
    "ols_fit_const",
    """with {tx}, m as (
      select count(*) as n, var_pop(quantity) as vq, var_pop(price) as vp,
             covar_pop(quantity, price) as cqp, covar_pop(quantity, total_amount) as cqy,
             covar_pop(price, total_amount) as cpy, var_pop(total_amount) as vy from tx
    ), r as (
      select *, (vp * cqy - cqp * cpy) / (vq * vp - cqp * cqp) as bq,
             (vq * cpy - cqp * cqy) / (vq * vp - cqp * cqp) as bp from m
    ), s as (select *, (bq * cqy + bp * cpy) / vy as r2,
                    n * (vy - bq * cqy - bp * cpy) as rss from r),
    t as (select *, -n / 2.0 * (ln(2 * pi()) + ln(rss / n) + 1) as llf from s)
    select n, round(r2, 8) as r2, round(1 - (n - 1) / (n - 3) * (1 - r2), 8) as adj_r2,
           round((r2 / 2) / ((1 - r2) / (n - 3)), 2) as f, round(6 - 2 * llf, 2) as aic,
           round(3 * ln(n) - 2 * llf, 2) as bic from t""",
)
def ols_fit_const(spark, sf):
    return _fit_table(_gram(spark, sf).fit(constant=True), spark)


@query(
    "ols_fit_offset",
    """with {tx}, d as (
      select quantity as a, date_diff('day', date '1970-01-01', cast(transaction_date as date)) as b,
             total_amount as y from tx
    ), m as (
      select count(*) as n, var_pop(a) as va, var_pop(b) as vb, covar_pop(a, b) as cab,
             covar_pop(a, y) as cay, covar_pop(b, y) as cby, var_pop(y) as vy from d
    ), r as (
      select *, (vb * cay - cab * cby) / (va * vb - cab * cab) as ba,
             (va * cby - cab * cay) / (va * vb - cab * cab) as bb from m
    ), s as (select *, n * (vy - ba * cay - bb * cby) as rss, va - cab * cab / vb as wa,
                    vb - cab * cab / va as wb from r)
    select n, round(rss / (n * vy), 8) as unexplained, round(ba, 4) as quantity, round(bb, 5) as day,
           round(ba / sqrt(rss / (n - 3) / (n * wa)), 3) as t_quantity,
           round(bb / sqrt(rss / (n - 3) / (n * wb)), 4) as t_day from s""",
)
def ols_fit_offset(spark, sf):
    """A column far from zero: days since 1970, with a constant."""
    df = transactions(spark, sf, "quantity", "transaction_date", "total_amount")
    df = df.withColumn("day", F.unix_date(F.col("transaction_date").cast("date")))
    fit = Gram(df, ("quantity", "day"), "total_amount").fit(constant=True)
    row = (fit.n, 1.0 - fit.r2, *map(float, fit.coef[1:]), *map(float, fit.t[1:]))
    out = spark.createDataFrame(
        [row], "n long, unexplained double, quantity double, day double, t_quantity double, t_day double"
    )
    places = {"unexplained": 8, "quantity": 4, "day": 5, "t_quantity": 3, "t_day": 4}
    return out.select("n", *[F.round(c, p).alias(c) for c, p in places.items()])


@query(
    "ols_summary",
    "with {tx}, "
    + CLOSED
    + """ select 'quantity' as feature, round(bq, 4) as coef, round(seq, 6) as std_err,
                 round(bq / seq, 4) as t from stats
    union all select 'price', round(bp, 4), round(sep, 6), round(bp / sep, 4) from stats""",
)
def ols_summary(spark, sf):
    out = _gram(spark, sf).fit().summary(spark)
    return out.select(
        "feature",
        F.round("coef", 4).alias("coef"),
        F.round("std_err", 6).alias("std_err"),
        F.round("t", 4).alias("t"),
    )


@query("ols_intervals")
def ols_intervals(spark, sf):
    """The whole coefficient table: p values and confidence limits need the t distribution."""
    return _gram(spark, sf, ("quantity", "price", "discount_pct")).fit(constant=True).summary(spark)


@query(
    "partial_f_test",
    "with {tx}, "
    + CLOSED
    + """ select 'quantity' as feature, round((bq / seq) * (bq / seq), 1) as f from stats
    union all select 'price', round((bp / sep) * (bp / sep), 1) from stats""",
)
def partial_f_test(spark, sf):
    rows = [(c, f, p) for c, f, p in _gram(spark, sf).partial_f()]
    out = spark.createDataFrame(rows, "feature string, f double, p double")
    return out.select("feature", F.round("f", 1).alias("f"))


@query(
    "ols_predictions",
    "with {tx}, "
    + CLOSED
    + """ select row_key, round(total_amount, 4) as y, round(bq * quantity + bp * price, 1) as yhat
    from tx, b""",
)
def ols_predictions(spark, sf):
    fit = _gram(spark, sf).fit()
    df = transactions(spark, sf, "row_key", *PAIR, "total_amount")
    return df.select(
        "row_key",
        F.round("total_amount", 4).alias("y"),
        F.round(fit.predict(), 1).alias("yhat"),
    )


TRIPLE = ("quantity", "price", "discount_pct")

VIF_SQL = """
g as (select sum(quantity * quantity) as aa, sum(price * price) as bb,
             sum(discount_pct * discount_pct) as cc, sum(quantity * price) as ab,
             sum(quantity * discount_pct) as ac, sum(price * discount_pct) as bc from tx),
d as (select *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) as det
      from g),
v as (select 'quantity' as feature, aa * (bb * cc - bc * bc) / det as vif from d
      union all select 'price', bb * (aa * cc - ac * ac) / det from d
      union all select 'discount_pct', cc * (aa * bb - ab * ab) / det from d)
"""


@query("vif", "with {tx}, " + VIF_SQL + " select feature, round(vif, 6) as vif from v")
def vif(spark, sf):
    out = feature_values(spark, _gram(spark, sf, TRIPLE).vif(), "vif")
    return out.select("feature", F.round("vif", 6).alias("vif"))


@query(
    "vif_select",
    "with {tx}, "
    + VIF_SQL
    + """ select feature from v where vif <= 10
    union all select feature from (select feature from v order by vif, feature limit 2)
    where not exists (select 1 from v where vif <= 10)""",
)
def vif_select(spark, sf):
    kept = _gram(spark, sf, TRIPLE).vif_select()
    return spark.createDataFrame([(c,) for c in kept], "feature string")


STEP_FEATURES = ("quantity", "price", "discount_pct", "month", "day", "day_of_week")


def _step_gram(spark, sf):
    df = transactions(spark, sf, *TRIPLE, "transaction_date", "total_amount").select(
        *TRIPLE,
        "total_amount",
        F.month("transaction_date").alias("month"),
        F.dayofmonth("transaction_date").alias("day"),
        F.weekday("transaction_date").alias("day_of_week"),
    )
    return Gram(df, STEP_FEATURES, "total_amount")


def _selection(spark, kept):
    rows = [(c, c in kept) for c in STEP_FEATURES]
    return spark.createDataFrame(rows, "feature string, selected boolean")


@query("stepwise_backward")
def stepwise_backward(spark, sf):
    return _selection(spark, _step_gram(spark, sf).backward())


@query("stepwise_bidirectional")
def stepwise_bidirectional(spark, sf):
    return _selection(spark, _step_gram(spark, sf).bidirectional())

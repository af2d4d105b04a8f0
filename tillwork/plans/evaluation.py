"""Sampling, split, fold and metric queries.

The metric queries score rows with a fixed linear expression, so that the SQL can compute the same
predictions; the fitted models in ``plans.models`` go through the same operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.operators import metrics, split
from tillwork.operators.encode import label_high_low, minmax_scale, ranges
from tillwork.plans.registry import hash32_sql, query
from tillwork.sources import transactions


@query(
    "sample_rows",
    f"""with {{tx}} select row_key, price from tx
    where {hash32_sql('row_key', 5805)} / 4294967296.0 < 0.2""",
)
def sample_rows(spark, sf):
    return split.sample_rows(transactions(spark, sf, "row_key", "price"), 0.2)


@query(
    "train_test_split",
    f"""with {{tx}} select row_key, case when {hash32_sql('row_key', 42)} / 4294967296.0 < 0.2
    then 'test' else 'train' end as split from tx""",
)
def train_test_split(spark, sf):
    return split.train_test_split(transactions(spark, sf, "row_key"), 0.2)


@query(
    "stratified_split",
    f"""with {{tx}}, r as (
      select row_key, product_category, count(*) over (partition by product_category) as n,
             row_number() over (partition by product_category
                                order by {hash32_sql('row_key', 42)}, row_key) as i
      from tx)
    select row_key, product_category,
           case when i <= floor(n * 0.3 + 0.5) then 'test' else 'train' end as split from r""",
)
def stratified_split(spark, sf):
    df = transactions(spark, sf, "row_key", "product_category")
    return split.stratified_split(df, "product_category", 0.3)


@query(
    "kfold_assign",
    f"""with {{tx}}
    select row_key, cast({hash32_sql('row_key', 42)} % 5 as integer) as fold from tx""",
)
def kfold_assign(spark, sf):
    return split.kfold_assign(transactions(spark, sf, "row_key"), 5)


@query(
    "stratified_kfold",
    f"""with {{tx}}, r as (
      select row_key, product_category, count(*) over (partition by product_category) as n,
             row_number() over (partition by product_category
                                order by {hash32_sql('row_key', 7)}, row_key) as i
      from tx)
    select row_key, product_category,
           cast((i > floor(n * cast(0.2 as double) + 0.5)) as integer)
             + cast((i > floor(n * cast(0.4 as double) + 0.5)) as integer)
             + cast((i > floor(n * cast(0.6 as double) + 0.5)) as integer)
             + cast((i > floor(n * cast(0.8 as double) + 0.5)) as integer) as fold
    from r""",
)
def stratified_kfold(spark, sf):
    df = transactions(spark, sf, "row_key", "product_category")
    return split.stratified_kfold(df, "product_category", 5, seed=7)


@query(
    "minmax_scale",
    f"""with {{tx}}, s as (
      select row_key, price, quantity,
             {hash32_sql('row_key', 42)} / 4294967296.0 < 0.2 as is_test from tx
    ), lim as (select min(price) pl, max(price) ph, min(quantity) ql, max(quantity) qh
               from s where not is_test)
    select row_key, round((price - pl) / (ph - pl), 9) as price,
           round((quantity - ql) / (qh - ql), 9) as quantity from s, lim where is_test""",
)
def minmax_scaled(spark, sf):
    """Ranges fitted on the training rows, applied to the test rows."""
    df = split.train_test_split(transactions(spark, sf, "row_key", "price", "quantity"))
    columns = ["price", "quantity"]
    fitted = ranges(df.where("split = 'train'"), columns)
    scaled = minmax_scale(df.where("split = 'test'"), columns, fitted)
    return scaled.select("row_key", *[F.round(c, 9).alias(c) for c in columns])


SCORE = "floor(1000 * (1 - 0.6 * quantity / 50 - 0.4 * price / 105000)) / 1000"

SCORED = f"""
m as (select quantile_cont(total_amount, 0.5) as median from tx),
scored as (
  select row_key, cast(total_amount <= median as integer) as label,
         cast(floor(cast(1000 as double) * (1 - cast(0.6 as double) * quantity / 50
           - cast(0.4 as double) * price / 105000)) / 1000 as double) as score
  from tx, m
), predictions as (
  select row_key, label, score, cast(score >= cast(0.5 as double) as integer) as prediction
  from scored
)
"""


def _predictions(spark, sf):
    df = label_high_low(transactions(spark, sf, "row_key", "quantity", "price", "total_amount"))
    scored = df.select(
        "row_key",
        "label",
        F.expr(SCORE.replace("0.6", "0.6D").replace("0.4", "0.4D")).alias("score"),
    )
    return metrics.apply_threshold(scored, 0.5)


@query(
    "confusion_matrix",
    "with {tx}, "
    + SCORED
    + """, grid as (select a.v as label, b.v as prediction
                    from (values (0), (1)) a(v), (values (0), (1)) b(v))
    select cast(g.label as integer) as label, cast(g.prediction as integer) as prediction,
           count(p.label) as n
    from grid g left join predictions p on p.label = g.label and p.prediction = g.prediction
    group by all""",
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_predictions(spark, sf), labels=[0, 1])


COUNTS = """
, counts as (
  select count(*) filter (where label = 0 and prediction = 0) as tn,
         count(*) filter (where label = 0 and prediction = 1) as fp,
         count(*) filter (where label = 1 and prediction = 0) as fn,
         count(*) filter (where label = 1 and prediction = 1) as tp
  from predictions)
"""


@query(
    "classification_report",
    "with {tx}, "
    + SCORED
    + COUNTS
    + """, per as (
      select '0' as class, tn / (tn + fn) as precision, tn / (tn + fp) as recall,
             2 * tn / (2 * tn + fn + fp) as f1, tn + fp as support from counts
      union all
      select '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn from counts
    ), everything as (
      select * from per
      union all select 'accuracy', (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp),
             (tn + tp) / (tn + fp + fn + tp), tn + fp + fn + tp from counts
      union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from per
      union all select 'weighted avg', sum(precision * support) / sum(support),
             sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
             from per)
    select class, round(precision, 9) as precision, round(recall, 9) as recall,
           round(f1, 9) as f1, cast(support as bigint) as support from everything""",
)
def classification_report(spark, sf):
    out = metrics.classification_report(_predictions(spark, sf))
    rounded = [F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")]
    return out.select("class", *rounded, "support")


@query(
    "binary_metrics",
    "with {tx}, "
    + SCORED
    + COUNTS
    + """ select tn, fp, fn, tp, round((tn + tp) / (tn + fp + fn + tp), 9) as accuracy,
      round(tp / (tp + fp), 9) as precision, round(tp / (tp + fn), 9) as recall,
      round(tn / (tn + fp), 9) as specificity, round(2 * tp / (2 * tp + fp + fn), 9) as f1
    from counts""",
)
def binary_metrics(spark, sf):
    out = metrics.binary_metrics(_predictions(spark, sf))
    rates = ("accuracy", "precision", "recall", "specificity", "f1")
    return out.select("tn", "fp", "fn", "tp", *[F.round(c, 9).alias(c) for c in rates])


POINTS = """
, collapsed as (
  select score, count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg
  from predictions group by score
), curve as (
  select score, pos, neg, sum(pos) over w as tp, sum(neg) over w as fp,
         sum(pos) over () as p, sum(neg) over () as n
  from collapsed window w as (order by score desc rows unbounded preceding))
"""


@query(
    "roc_curve",
    "with {tx}, "
    + SCORED
    + POINTS
    + """ select score as threshold, round(fp / n, 9) as fpr, round(tp / p, 9) as tpr from curve
    union all select cast('inf' as double), 0.0, 0.0""",
)
def roc_curve(spark, sf):
    out = metrics.roc_curve(_predictions(spark, sf))
    return out.select("threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query(
    "roc_auc",
    "with {tx}, "
    + SCORED
    + POINTS
    + """, hard as (select count(*) filter (where label = 1 and prediction = 1) / count(*) filter (where label = 1) as tpr,
                       count(*) filter (where label = 0 and prediction = 1) / count(*) filter (where label = 0) as fpr
                from predictions)
    select 'score' as source, round(sum(neg * (2 * tp - pos)) / any_value(2 * p * n), 9) as auc from curve
    union all select 'hard labels', round((1 + tpr - fpr) / 2, 9) from hard""",
)
def roc_auc(spark, sf):
    """Area from the scores and from the hard 0/1 predictions."""
    df = _predictions(spark, sf)
    soft = metrics.roc_auc(df).withColumn("source", F.lit("score"))
    hard = metrics.roc_auc(df, score="prediction").withColumn("source", F.lit("hard labels"))
    return soft.unionByName(hard).select("source", F.round("auc", 9).alias("auc"))


PR = POINTS + """
, pr as (select score as threshold, tp / (tp + fp) as precision, tp / p as recall,
                2 * tp / (tp + fp + p) as f1 from curve)
"""


@query(
    "pr_curve",
    "with {tx}, "
    + SCORED
    + PR
    + """ select threshold, round(precision, 9) as precision, round(recall, 9) as recall,
                 round(f1, 9) as f1 from pr
          union all select null, 1.0, 0.0, 0.0""",
)
def pr_curve(spark, sf):
    out = metrics.pr_curve(_predictions(spark, sf))
    return out.select("threshold", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "best_f1_threshold",
    "with {tx}, "
    + SCORED
    + PR
    + "select threshold, round(f1, 9) as f1 from pr order by pr.f1 desc, threshold limit 1",
)
def best_f1_threshold(spark, sf):
    out = metrics.best_f1_threshold(_predictions(spark, sf))
    return out.select("threshold", F.round("f1", 9).alias("f1"))


@query(
    "classifier_comparison",
    "with {tx}, "
    + SCORED
    + """, twice as (
      select 'at 0.5' as model, label, score, prediction from predictions
      union all select 'at 0.4', label, score, cast(score >= cast(0.4 as double) as integer)
      from predictions
    ), counts as (
      select model, count(*) filter (where label = 0 and prediction = 0) as tn,
             count(*) filter (where label = 0 and prediction = 1) as fp,
             count(*) filter (where label = 1 and prediction = 0) as fn,
             count(*) filter (where label = 1 and prediction = 1) as tp
      from twice group by model)
    """
    + POINTS
    + """, area as (select round(sum(neg * (2 * tp - pos)) / any_value(2 * p * n), 4) as auc from curve)
    select model, round(tp / (tp + fp), 4) as precision, round(tp / (tp + fn), 4) as recall,
           round(tn / (tn + fp), 4) as specificity, round(2 * tp / (2 * tp + fp + fn), 4) as f1,
           auc, tn, fp, fn, tp from counts, area""",
)
def classifier_comparison(spark, sf):
    df = _predictions(spark, sf)
    return metrics.classifier_comparison(
        {"at 0.5": df, "at 0.4": metrics.apply_threshold(df, 0.4)}
    )


@query(
    "kfold_summary",
    "with {tx}, "
    + SCORED
    + f""", folds as (
      select {hash32_sql('row_key', 42)} % 5 as fold, avg(cast(label = prediction as integer)) as accuracy
      from predictions group by 1)
    select 'linear score' as model,
           string_agg(cast(cast(round(accuracy * 1000000) as bigint) as varchar), ' ' order by fold) as accuracies_ppm,
           round(max(accuracy), 9) as max_accuracy, round(min(accuracy), 9) as min_accuracy,
           round(avg(accuracy), 9) as avg_accuracy from folds""",
)
def kfold_summary(spark, sf):
    df = split.kfold_assign(_predictions(spark, sf), 5).withColumn("model", F.lit("linear score"))
    out = metrics.kfold_summary(metrics.fold_accuracies(df))
    ppm = F.transform("accuracies", lambda a: F.round(a * 1_000_000).cast("bigint").cast("string"))
    rounded = [F.round(c, 9).alias(c) for c in ("max_accuracy", "min_accuracy", "avg_accuracy")]
    return out.select("model", F.concat_ws(" ", ppm).alias("accuracies_ppm"), *rounded)


@query(
    "regression_metrics",
    """with {tx}, p as (select total_amount as y, quantity * 50000 * 0.95 as yhat from tx)
    select round(avg((y - yhat) * (y - yhat)) / 1e6, 3) as mse_millions,
           round(avg(abs(y - yhat)), 3) as mae,
           round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y)), 9) as r2 from p""",
)
def regression_metrics(spark, sf):
    df = transactions(spark, sf, "quantity", "total_amount").select(
        F.col("total_amount").alias("label"), F.expr("quantity * 50000 * 0.95D").alias("prediction")
    )
    return metrics.regression_metrics(df).select(
        F.round(F.col("mse") / 1e6, 3).alias("mse_millions"),
        F.round("mae", 3).alias("mae"),
        F.round("r2", 9).alias("r2"),
    )

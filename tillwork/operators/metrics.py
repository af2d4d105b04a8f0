"""Evaluation metrics as aggregates over a predictions frame (label, prediction, score)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import ratio
from tillwork.operators.prefix import running_sums
from tillwork.session import cut


def confusion_matrix(
    predictions: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    labels: Sequence | None = None,
) -> DataFrame:
    """Counts for every (label, prediction) pair of classes, zero cells included."""
    counts = predictions.groupBy(label, prediction).agg(F.count("*").alias("n"))
    dtype = predictions.schema[label].dataType
    counts = counts.select(
        F.col(label).alias("label"), F.col(prediction).cast(dtype).alias("prediction"), "n"
    )
    if labels is None:
        seen = counts.select(F.array_distinct(F.flatten(F.collect_set(F.array("label", "prediction")))))
    else:
        seen = predictions.sparkSession.range(1).select(
            F.array(*[F.lit(v).cast(dtype) for v in labels])
        )
    # One row holding the class list, exploded twice: the grid has (number of classes)^2 rows.
    grid = (
        seen.toDF("classes")
        .select(F.explode("classes").alias("label"), "classes")
        .select("label", F.explode("classes").alias("prediction"))
    )
    return grid.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def classification_report(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1, support per class, then accuracy, macro and weighted averages."""
    cells = predictions.groupBy(
        F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")
    ).agg(F.count("*").alias("n"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = cells.select(
        "n",
        hit.alias("hit"),
        F.explode(F.array(F.struct(F.col("y").alias("c"), F.lit(1).alias("truth")),
                          F.struct(F.col("p").alias("c"), F.lit(0).alias("truth")))).alias("side"),
    )
    per_class = sides.groupBy(F.col("side.c").alias("class")).agg(
        F.sum(F.when(F.col("side.truth") == 1, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("side.truth") == 0, F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("side.truth") == 1, F.col("hit")).otherwise(0)).alias("tp"),
    )
    tp = F.col("tp").cast("double")
    scored = per_class.select(
        "class",
        ratio(tp, F.col("predicted")).alias("precision"),
        ratio(tp, F.col("support")).alias("recall"),
        ratio(2 * tp, F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )
    measures = ("precision", "recall", "f1")
    total = F.sum("support")

    def summary(name: str, values: dict[str, Column]) -> DataFrame:
        return scored.agg(
            F.lit(name).alias("class"),
            *[values[m].alias(m) for m in measures],
            total.alias("support"),
        )

    accuracy = ratio(F.sum("tp").cast("double"), total)
    return (
        scored.drop("tp")
        .unionByName(summary("accuracy", dict.fromkeys(measures, accuracy)))
        .unionByName(summary("macro avg", {m: F.avg(m) for m in measures}))
        .unionByName(
            summary("weighted avg", {m: ratio(F.sum(F.col(m) * F.col("support")), total) for m in measures})
        )
    )


def binary_metrics(
    predictions: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    group: str | None = None,
) -> DataFrame:
    """tn, fp, fn, tp and the rates built from them, for class 1, in one aggregate."""
    y, p = F.col(label), F.col(prediction)
    counts = predictions.groupBy(*([group] if group else [])).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )
    return _rates(counts, *([group] if group else []))


def _rates(counts: DataFrame, *keep: str) -> DataFrame:
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        *keep,
        "tn",
        "fp",
        "fn",
        "tp",
        ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tn, tn + fp).alias("specificity"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def score_counts(
    predictions: DataFrame, label: str = "label", score: str = "score"
) -> tuple[DataFrame, int, int]:
    """Positives and negatives at or above every distinct score, and how many there are in all."""
    collapsed = predictions.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return _running(collapsed)


def _running(collapsed: DataFrame) -> tuple[DataFrame, int, int]:
    sums = {"tp": "pos", "fp": "neg"}
    counts, totals = running_sums(collapsed, "threshold", sums, ascending=False)
    return counts, totals["tp"], totals["fp"]


def roc_curve(predictions: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, preceded by the point (inf, 0, 0)."""
    counts, pos, neg = score_counts(predictions, label, score)
    points = counts.select(
        "threshold",
        (F.col("fp") / F.lit(max(neg, 1))).alias("fpr"),
        (F.col("tp") / F.lit(max(pos, 1))).alias("tpr"),
    )
    start = predictions.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def roc_auc(predictions: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid area under the ROC curve, exact also for tied scores.

    The point before a score is its running count minus its own count, so no neighbour row is
    looked up; twice the area is summed in exact integers.
    """
    return _area(*score_counts(predictions, label, score))


def _area(counts: DataFrame, pos: int, neg: int) -> DataFrame:
    doubled = F.sum(
        F.col("neg").cast("decimal(19,0)") * (2 * F.col("tp") - F.col("pos")).cast("decimal(19,0)")
    )
    size = F.lit(2.0 * pos * neg)
    return counts.agg(ratio(doubled.cast("double"), size, float("nan")).alias("auc"))


def pr_curve(predictions: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision, recall and F1 when scores at or above each threshold are predicted positive.

    The last point, precision 1 and recall 0, has no threshold: nothing is predicted positive.
    """
    counts, pos, _ = score_counts(predictions, label, score)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    points = counts.select(
        "threshold",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, F.lit(float(pos))).alias("recall"),
        ratio(2 * tp, tp + fp + F.lit(float(pos))).alias("f1"),
    )
    end = predictions.sparkSession.createDataFrame([(None, 1.0, 0.0, 0.0)], "threshold double, precision double, recall double, f1 double")
    return points.unionByName(end)


def best_f1_threshold(predictions: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Threshold with the highest F1; the lowest such threshold wins ties."""
    best = F.struct("f1", -F.col("threshold"))
    return pr_curve(predictions, label, score).where("threshold is not null").agg(
        F.max_by("threshold", best).alias("threshold"), F.max("f1").alias("f1")
    )


def apply_threshold(predictions: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    return predictions.withColumn("prediction", (F.col(score) >= F.lit(threshold)).cast("int"))


def regression_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    error = F.col(label) - F.col(prediction)
    sse = F.sum(error * error)
    sst = F.var_pop(label) * F.count(label)
    return predictions.agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - ratio(sse, sst, float("nan"))).alias("r2"),
    )


def fold_accuracies(
    predictions: DataFrame,
    fold: str = "fold",
    label: str = "label",
    prediction: str = "prediction",
    model: str = "model",
) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return predictions.groupBy(model, fold).agg(F.avg(hit).alias("accuracy"))


def kfold_summary(accuracies: DataFrame, model: str = "model", fold: str = "fold") -> DataFrame:
    """Accuracies of the folds in order, with their maximum, minimum and mean."""
    ordered = F.sort_array(F.collect_list(F.struct(fold, "accuracy")))
    return accuracies.groupBy(model).agg(
        F.transform(ordered, lambda s: s["accuracy"]).alias("accuracies"),
        F.max("accuracy").alias("max_accuracy"),
        F.min("accuracy").alias("min_accuracy"),
        F.avg("accuracy").alias("avg_accuracy"),
    )


def comparison_row(
    predictions: DataFrame, model: str, label: str = "label", score: str = "score", digits: int = 4
) -> DataFrame:
    """One row of the model comparison table.

    The rows are scored once: counts per (score, prediction) hold all that the row needs.
    """
    cells = cut(
        predictions.groupBy(F.col(score).cast("double").alias("score"), "prediction").agg(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
        )
    )
    positive = F.col("prediction") == 1
    rates = _rates(
        cells.agg(
            _total(~positive, "neg").alias("tn"),
            _total(positive, "neg").alias("fp"),
            _total(~positive, "pos").alias("fn"),
            _total(positive, "pos").alias("tp"),
        )
    )
    by_score = cells.groupBy(F.col("score").alias("threshold")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    area = _area(*_running(by_score)).first()["auc"]
    return rates.withColumn("auc", F.lit(area)).select(
        F.lit(model).alias("model"),
        *[F.round(c, digits).alias(c) for c in ("precision", "recall", "specificity", "f1", "auc")],
        "tn",
        "fp",
        "fn",
        "tp",
    )


def _total(condition: Column, value: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0))


def classifier_comparison(models: dict[str, DataFrame], **options) -> DataFrame:
    """Comparison rows of several models, one predictions frame each."""
    table = None
    for name, predictions in models.items():
        row = comparison_row(predictions, name, **options)
        table = row if table is None else table.unionByName(row)
    return table

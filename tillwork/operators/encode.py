"""Label encoding, one-hot columns, binning, scaling and interaction features."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.operators.prefix import dense_index
from tillwork.operators.quantiles import exact_quantiles

# A literal lookup stays in the plan and in every task, so it must stay small.
LITERAL_LABELS = 2_000


def label_table(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values numbered from 0: (label, code).

    A few values are sorted on the driver and marked for broadcast, since a frame made there has no
    size that Spark knows; beyond ``LITERAL_LABELS`` the numbering is a distributed one.
    """
    labels = df.select(F.col(column).alias("label")).where(F.col("label").isNotNull()).distinct()
    few = labels.limit(LITERAL_LABELS + 1).collect()
    if len(few) > LITERAL_LABELS:
        return dense_index(labels, "label", "code")
    rows = [(label, code) for code, label in enumerate(sorted(r.label for r in few))]
    schema = T.StructType([labels.schema["label"], T.StructField("code", T.LongType())])
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def label_encode(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Replace nothing, add ``<column>_code``: the rank of the value among the sorted values."""
    for c in columns:
        mapping = label_table(df, c).select(
            F.col("label").alias(f"__{c}"), F.col("code").alias(f"{c}{suffix}")
        )
        df = df.join(mapping, F.col(c) == F.col(f"__{c}"), "left").drop(f"__{c}")
    return df


def label_decode(df: DataFrame, code_column: str, labels: DataFrame, name: str) -> DataFrame:
    """Inverse of ``label_encode``: join the codes back to their values."""
    mapping = labels.select(F.col("code").alias("__code"), F.col("label").alias(name))
    return df.join(mapping, F.col(code_column) == F.col("__code"), "left").drop("__code")


def sorted_labels(df: DataFrame, column: str, limit: int = LITERAL_LABELS) -> list:
    """Distinct values as a driver list, refused when there are more than ``limit``."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    found = [r[0] for r in values.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values, too many for columns: use its codes")
    return sorted(found)


def one_hot_drop_first(
    df: DataFrame, columns: Sequence[str], labels: dict[str, list] | None = None
) -> DataFrame:
    """0/1 column per value except the alphabetically first, named ``<column>_<value>``."""
    for c in columns:
        values = labels[c] if labels else sorted_labels(df, c)
        df = df.withColumns(
            {f"{c}_{v}": F.when(F.col(c) == F.lit(v), 1).otherwise(0) for v in values[1:]}
        ).drop(c)
    return df


def one_hot_vector(df: DataFrame, columns: Sequence[str], output: str = "one_hot") -> DataFrame:
    """``one_hot_drop_first`` as one sparse vector, for any number of values.

    Places follow the sorted values of each column in turn; null, like the first value, has none.
    """
    df = label_encode(df, columns, "__code")
    names = []
    for c in columns:
        labels = label_table(df, c)
        n = max(labels.count(), 1)
        # The encoder leaves out the last place: there goes the first value.
        place = F.coalesce(F.pmod(F.col("code") - 1, F.lit(n)), F.lit(n - 1)).cast("double")
        encoder = OneHotEncoder(inputCol=f"__{c}_place", outputCol=f"__{c}_hot")
        model = encoder.fit(df.sparkSession.range(n - 1, n).select(F.col("id").cast("double").alias(f"__{c}_place")))
        df = model.transform(df.withColumnRenamed(f"{c}__code", "code").withColumn(f"__{c}_place", place))
        df = df.drop("code", f"__{c}_place", c)
        names.append(f"__{c}_hot")
    return VectorAssembler(inputCols=names, outputCol=output).transform(df).drop(*names)


def quantile_bin(
    df: DataFrame, column: str, labels: Sequence[str] = ("Low", "High"), approx: bool = False
) -> Column:
    """Equal-frequency bin name of ``column``; bins are closed on the right."""
    probs = [i / len(labels) for i in range(1, len(labels))]
    if approx:
        cuts = df.agg(F.percentile_approx(column, F.array(*map(F.lit, probs)), 10_000)).first()[0]
    else:
        cuts = exact_quantiles(df, [column], probs)[column]
    value = F.col(column)
    binned = F.when(value.isNull(), F.lit(None).cast("string"))
    for cut, name in zip(cuts, labels):
        binned = binned.when(value <= F.lit(cut), F.lit(name))
    return binned.otherwise(F.lit(labels[-1]))


def label_high_low(
    df: DataFrame, column: str = "total_amount", measured: DataFrame | None = None
) -> DataFrame:
    """Binary target: ``label_name`` Low/High at the median, ``label`` High = 0, Low = 1.

    ``measured`` may hold the same rows with fewer joins behind them, to find the median on.
    """
    name = quantile_bin(df if measured is None else measured, column)
    return df.withColumn("label_name", name).withColumn(
        "label", (F.col("label_name") == "Low").cast("int")
    )


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, from one aggregate row."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def standardize(
    df: DataFrame,
    columns: Sequence[str],
    fitted: dict[str, tuple[float, float]] | None = None,
    suffix: str = "",
) -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0."""
    fitted = fitted or moments(df, columns)

    def scaled(c: str) -> Column:
        mean, std = fitted[c]
        return (F.col(c).cast("double") - F.lit(mean)) / F.lit(std if std else 1.0)

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def unstandardize(value: Column, mean: float, std: float) -> Column:
    return value * F.lit(std) + F.lit(mean)


def ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(
        *[f(c).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in columns}


def minmax_scale(
    df: DataFrame,
    columns: Sequence[str],
    fitted: dict[str, tuple[float, float]] | None = None,
    suffix: str = "",
) -> DataFrame:
    """(x - min) / (max - min) with the fitted range; values outside it leave [0, 1]."""
    fitted = fitted or ranges(df, columns)

    def scaled(c: str) -> Column:
        lo, hi = fitted[c]
        return (F.col(c).cast("double") - F.lit(lo)) / F.lit((hi - lo) or 1.0)

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def interaction_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the product of every pair of distinct columns as ``<a>_x_<b>``."""
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations(columns, 2)})

"""Inspection and cleaning: head, info, describe, nulls, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.operators.quantiles import exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def rows_from(aggregate: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn one row of named aggregates into several rows."""
    structs = [F.struct(*[v.alias(k) for k, v in row.items()]) for row in rows]
    return aggregate.select(F.inline(F.array(*structs)))


def head_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] = ("row_key",)) -> DataFrame:
    """First ``n`` rows in an explicit order (a distributed table has no position)."""
    return df.orderBy(*order_by).limit(n)


def table_info(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return rows_from(
        counts,
        [
            {"ordinal": F.lit(i), "column_name": F.lit(c), "dtype": F.lit(t), "non_null": F.col(c)}
            for i, (c, t) in enumerate(df.dtypes)
        ],
    )


def null_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return rows_from(
        counts, [{"column_name": F.lit(c), "null_count": F.col(c)} for c in df.columns]
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False
) -> DataFrame:
    """count, mean, sample std, min, quartiles and max, one row per column."""
    columns = list(columns or numeric_columns(df))
    aggs = []
    for c in columns:
        aggs += [
            F.count(c).alias(f"{c}_count"),
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_std"),
            F.min(c).cast("double").alias(f"{c}_min"),
            F.max(c).cast("double").alias(f"{c}_max"),
        ]
        if approx:
            quartiles = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
            aggs.append(F.percentile_approx(c, quartiles, 10_000).alias(f"{c}_q"))
    exact = {} if approx else exact_quantiles(df, columns, (0.25, 0.5, 0.75))

    def quartile(c: str, i: int) -> Column:
        value = F.col(f"{c}_q")[i] if approx else F.lit(exact[c][i])
        return value.cast("double")

    return rows_from(
        df.agg(*aggs),
        [
            {
                "column_name": F.lit(c),
                "n": F.col(f"{c}_count"),
                "mean": F.col(f"{c}_mean"),
                "std": F.col(f"{c}_std"),
                "min": F.col(f"{c}_min"),
                "q25": quartile(c, 0),
                "q50": quartile(c, 1),
                "q75": quartile(c, 2),
                "max": F.col(f"{c}_max"),
            }
            for c in columns
        ],
    )

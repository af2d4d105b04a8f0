"""Distributed running totals and dense numbering over a total order.

A window without partitions would move the whole table into one task. Here the order is cut into
ranges of about ``ROWS_PER_RANGE`` rows at quantiles of the ordering column; each range is summed,
the few range sums give every range its starting offset, and the running total is finished inside
the ranges. A table of no more than one range's rows, known by counting, needs no cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 4_096


def range_id(order: str, edges: Sequence) -> Column:
    """Index of the range a value lies in; ranges are closed on the right."""

    @F.pandas_udf("int")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bounds = np.asarray(edges, dtype=object if isinstance(edges[0], str) else None)
        for values in batches:
            yield pd.Series(np.searchsorted(bounds, values.to_numpy(), side="left"))

    return search(F.col(order)) if edges else F.lit(0)


def _text_edges(df: DataFrame, order: str, ranges: int) -> list:
    # No quantile sketch for text: a bounded, hash-chosen set of values only places the cuts.
    some = df.select(order).orderBy(F.xxhash64(order)).limit(ranges * 8)
    return sorted({v for v in sorted(r[0] for r in some.collect())[7::8]})


def running_sums(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    ascending: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
) -> tuple[DataFrame, dict[str, int]]:
    """Inclusive running sum of ``sums[name]`` as ``name`` along the distinct values of ``order``.

    Also returns the grand totals, which the sizing pass finds anyway.
    """
    numeric = isinstance(df.schema[order].dataType, T.NumericType)
    sizing = [F.count("*").alias("__n")] + [F.sum(v).alias(k) for k, v in sums.items()]
    if numeric:
        # One parsed literal: building thousands of literals one by one is slow.
        probs = ", ".join(f"{i / MAX_RANGES}D" for i in range(1, MAX_RANGES))
        sketch = f"percentile_approx(`{order}`, array({probs}), {4 * MAX_RANGES})"
        sizing.append(F.expr(sketch).alias("__edges"))
    row = df.agg(*sizing).first()
    ranges = min(max(-(-row["__n"] // rows_per_range), 1), MAX_RANGES)
    edges: list = []
    if ranges > 1:
        cuts = row["__edges"] if numeric else _text_edges(df, order, ranges)
        stride = max(len(cuts) // ranges, 1)
        edges = sorted(set(cuts[stride - 1 :: stride]))

    def key(name: str) -> Column:
        return F.col(name) if ascending else F.col(name).desc()

    upto = (Window.unboundedPreceding, Window.currentRow)
    if not edges:
        whole = Window.orderBy(key(order)).rowsBetween(*upto)
        out = df.select(*df.columns, *[F.sum(v).over(whole).alias(k) for k, v in sums.items()])
    else:
        tagged = df.withColumn("__range", range_id(order, edges))
        totals = tagged.groupBy("__range").agg(*[F.sum(v).alias(k) for k, v in sums.items()])
        # At most MAX_RANGES rows, in the window and in the broadcast.
        before = Window.orderBy(key("__range")).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            F.col("__range").alias("__r"),
            *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"__{k}") for k in sums],
        )
        inside = Window.partitionBy("__range").orderBy(key(order)).rowsBetween(*upto)
        joined = tagged.join(F.broadcast(offsets), F.col("__range") == F.col("__r"))
        out = joined.select(
            *df.columns,
            *[(F.sum(v).over(inside) + F.col(f"__{k}")).alias(k) for k, v in sums.items()],
        )
    return out, {k: row[k] or 0 for k in sums}


def dense_index(
    df: DataFrame, order: str, name: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Number the rows 0, 1, 2, ... along ``order``, whose values must be distinct."""
    ones = df.withColumn("__one", F.lit(1))
    counted, _ = running_sums(ones, order, {name: "__one"}, rows_per_range=rows_per_range)
    return counted.withColumn(name, (F.col(name) - 1).cast("bigint")).drop("__one")

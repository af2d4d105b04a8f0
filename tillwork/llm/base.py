"""Registry of the queries over text tables, and small helpers of the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the SQL of its rows."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Number of partitions of a shuffle, as set for the input at hand."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_bytes(text: str = "text") -> Column:
    """The UTF-8 bytes of a text; no bytes for null."""
    return F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit(b""))


def null_safe(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Equi-join on ``columns``, nulls being equal to each other; the left columns are kept."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}" if c in columns else c) for c in right.columns])
    on = [left[c].eqNullSafe(renamed[f"__r_{c}"]) for c in columns]
    joined = left.join(renamed, on, how)
    return joined.drop(*[f"__r_{c}" for c in columns])


#: Rows and bytes handed to a Python task at once.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the Arrow batches of its session: rows with whole texts are large."""
    conf = df.sparkSession.conf
    for name, bound in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int(conf.get(key).lower().rstrip("b"))
        if not 0 < now <= bound:
            conf.set(key, str(bound))
    return df


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow, giving back its memory at the end: workers live on between tasks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return task

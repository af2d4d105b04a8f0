"""Reproducible sampling, splits and folds by key hash: the same under any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.columns import bucket, hash32, hash_fraction
from tillwork.session import cut

# Leading hash bits that locate a cut inside a class before rows are ranked.
PREFIX_BITS = 16
# Classes whose cuts are broadcast; beyond it they are joined by shuffling.
BROADCAST_CLASSES = 10_000


def sample_rows(df: DataFrame, fraction: float, key: str = "row_key", seed: int = 5805) -> DataFrame:
    return df.where(hash_fraction(key, seed) < fraction)


def train_test_split(
    df: DataFrame, test_size: float = 0.2, key: str = "row_key", seed: int = 42
) -> DataFrame:
    """Add ``split``: 'test' for the given share of keys, else 'train'."""
    is_test = hash_fraction(key, seed) < test_size
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def kfold_assign(df: DataFrame, k: int, key: str = "row_key", seed: int = 42) -> DataFrame:
    return df.withColumn("fold", bucket(key, seed, k))


def stratified_parts(
    df: DataFrame,
    label: str,
    cuts: Sequence[float | Column],
    name: str = "part",
    key: str = "row_key",
    seed: int = 42,
    hashed: str | None = None,
) -> DataFrame:
    """Split each class at exact ranks of the hashed key: part 0 up to cuts[0] of the class, ...

    A cut is a share of the class, or a column over the label and the ``size`` of its class giving
    a number of rows.
    Rows are counted per class and hash prefix, which tells the one prefix a cut falls into; only
    its rows are ranked, to find the row of the cut, and every row is then compared with the cuts of
    its class. So no class is ever sorted as a whole, and the frame is read twice: for label and key
    alone, and for the result, which needs no shuffle. Rows with the same key stay together.
    ``hashed`` names a column of a stored ``df`` that holds ``hash32(key, seed)`` already: then
    nothing is hashed or written again.
    """
    shift = 32 - PREFIX_BITS
    hash_ = F.col(hashed) if hashed else hash32(key, seed)
    rows = df.select(F.col(label).alias("__label"), hash_.alias("__hash"), F.col(key).alias("__key"))
    rows = (rows if hashed else cut(rows)).withColumn("__prefix", F.shiftright("__hash", shift))
    counts = rows.groupBy("__label", "__prefix").agg(F.count("*").alias("n"))
    # At most 2^PREFIX_BITS rows per class.
    order = Window.partitionBy("__label").orderBy("__prefix")
    running = counts.select(
        F.col("__label").alias(label),
        "__prefix",
        "n",
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(Window.partitionBy("__label")).alias("size"),
    )
    bounds = []
    for i, share in enumerate(cuts):
        wanted = share
        if not isinstance(share, Column):
            wanted = F.floor(F.col("size") * F.lit(share) + F.lit(0.5))
        holds = (F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted)
        bounds += [
            F.max(F.when(holds, F.col("__prefix"))).alias(f"p{i}"),
            F.max(F.when(holds, wanted - (F.col("upto") - F.col("n")))).alias(f"r{i}"),
        ]
    # One row per class. A checkpoint has no size statistics, so they are counted here.
    edges = cut(running.groupBy(F.col(label).alias("__label")).agg(*bounds))
    few = edges.limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES
    at_cut = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"p{i}").alias("p"), F.col(f"r{i}").alias("r")) for i in range(len(cuts))])
    wanted_rows = edges.select("__label", F.explode(at_cut).alias("c")).select("__label", "c.*").where("p is not null")
    wanted_rows = wanted_rows.withColumnRenamed("__label", "__l")
    on_edge = rows.join(
        F.broadcast(wanted_rows) if few else wanted_rows,
        F.col("__label").eqNullSafe(F.col("__l")) & (F.col("__prefix") == F.col("p")),
    )
    place = Window.partitionBy("__label", "i").orderBy("__hash", "__key")
    ranked = on_edge.withColumn("__rank", F.row_number().over(place)).where(F.col("__rank") == F.col("r"))
    # A cut without a row has an empty part before it.
    last = F.struct(F.col("__hash").alias("h"), F.col("__key").alias("k"))
    found = ranked.groupBy("__label").agg(*[F.max(F.when(F.col("i") == i, last)).alias(f"c{i}") for i in range(len(cuts))])
    found = cut(edges.select("__label").withColumnRenamed("__label", "__l").join(
        found, F.col("__l").eqNullSafe(F.col("__label")), "left"
    ).drop("__label"))
    if few:
        found = F.broadcast(found)
    me = F.struct(hash_.alias("h"), F.col(key).alias("k"))
    part = F.lit(0)
    for i in range(len(cuts)):
        part = part + F.coalesce(me > F.col(f"c{i}"), F.lit(True)).cast("int")
    return df.join(found, F.col(label).eqNullSafe(F.col("__l"))).select(*df.columns, part.alias(name))


def stratified_split(
    df: DataFrame, label: str, test_size: float = 0.3, key: str = "row_key", seed: int = 42
) -> DataFrame:
    """Add ``split``; every class gives exactly its rounded share to 'test'."""
    parts = stratified_parts(df, label, [test_size], "split", key, seed)
    return parts.withColumn("split", F.when(F.col("split") == 0, "test").otherwise("train"))


def stratified_kfold(
    df: DataFrame, label: str, k: int, key: str = "row_key", seed: int = 42
) -> DataFrame:
    """Add ``fold``; within a class the folds differ by at most one row."""
    return stratified_parts(df, label, [i / k for i in range(1, k)], "fold", key, seed)

"""Uniform shuffle of a table into shards of exact size, by a communication matrix.

Rows lie in blocks (a hash of their key). How many rows of each block go to each shard is drawn
exactly: row by row of a matrix with the block sizes as row sums and the shard sizes as column sums,
each row multivariate hypergeometric given those before it. That is the law of the counts under a
uniform shuffle. A block's rows are then permuted and cut by its row of the matrix, moved, and
permuted again inside their shard. Only the block sizes and the matrix pass through the driver.

Inside a shard the second permutation runs in sub-blocks, drawn by hash, so that no task holds a
whole shard; their counts give each its first slot.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.llm.base import partitions, query, table, text_bytes
from tillwork.session import cut

SHARDS = 24
#: Rows of the communication matrix, which the driver holds, at most.
MAX_BLOCKS = 4_096


def hypergeometric(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn from ``good + bad`` are good.

    The generator takes populations below 1e9; larger ones are drawn by inverting the distribution
    from the ratios of neighbouring probabilities, 40 deviations around the mode.
    """
    if good + bad < 1_000_000_000:
        return int(draw.hypergeometric(good, bad, n)) if good + bad else 0
    low, high = max(0, n - bad), min(n, good)
    mode = (n + 1) * (good + 1) // (good + bad + 2)
    spread = 40 * (1 + int((n * (good / (good + bad)) * (bad / (good + bad))) ** 0.5))
    k = np.arange(max(low, mode - spread), min(high, mode + spread) + 1, dtype=np.float64)
    ratios = (good - k[:-1]) * (n - k[:-1]) / ((k[:-1] + 1) * (bad - n + k[:-1] + 1))
    logs = np.concatenate([[0.0], np.cumsum(np.log(ratios))])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(mass, draw.random() * mass[-1], side="right")])


def communication_matrix(sizes: list[int], shards: int, seed: int) -> list[list[int]]:
    """For each block the running sums of the rows it sends to shards 0, 1, ..."""
    rows = sum(sizes)
    left = [rows // shards + (s < rows % shards) for s in range(shards)]
    draw = np.random.default_rng(seed)
    matrix = []
    for size in sizes:
        rest, room, sums = size, sum(left), [0]
        for s in range(shards):
            sent = hypergeometric(draw, left[s], room - left[s], rest)
            room -= left[s]
            left[s] -= sent
            rest -= sent
            sums.append(sums[-1] + sent)
        matrix.append(sums[1:])
    return matrix


def shuffle_into_shards(df: DataFrame, key: list[str], shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """``df`` with shard (0 to ``shards`` - 1) and slot (gapless from 0 in its shard).

    Shard sizes differ by one row at most. The permutations are hashes of ``key`` and the seed, so
    results do not depend on partitioning or lost tasks. Rows with equal keys, null ones included,
    are told apart by all their columns; wholly equal rows get neighbouring places. Columns named
    shard or slot are replaced. ``df`` is written to the shared folder first; an empty one stays empty.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    blocks = min(partitions(spark), MAX_BLOCKS)
    subs = max(1, blocks // shards)

    def dice(salt: str) -> Column:
        return F.xxhash64(F.lit(f"{seed}:{salt}"), *key)

    kept = df.columns
    rows = cut(df.withColumn("__block", F.pmod(dice("block"), F.lit(blocks)).cast("int")))
    counted = {r["__block"]: r["count"] for r in rows.groupBy("__block").count().collect()}
    matrix = communication_matrix([counted.get(b, 0) for b in range(blocks)], shards, seed)

    # At most MAX_BLOCKS x shards numbers, as one literal.
    bounds = F.element_at(F.from_json(F.lit(json.dumps(matrix)), "array<array<bigint>>"), F.col("__block") + 1)
    whole_row = F.xxhash64(F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}))
    local = Window.partitionBy("__block").orderBy(dice("local"), whole_row)
    sent = rows.withColumn("__rank", F.row_number().over(local)).withColumn(
        "shard", F.size(F.filter(bounds, lambda b: b < F.col("__rank"))).cast("int")
    )
    sent = cut(sent.withColumn("__sub", F.pmod(dice("sub"), F.lit(subs)).cast("int")))
    before = Window.partitionBy("shard").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        sent.groupBy("shard", "__sub")
        .count()
        .select("shard", "__sub", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__first"))
    )
    within = Window.partitionBy("shard", "__sub").orderBy(dice("slot"), whole_row)
    return (
        sent.withColumn("__place", F.row_number().over(within) - 1)
        .join(firsts, ["shard", "__sub"])
        .select(*kept, "shard", (F.col("__first") + F.col("__place")).cast("long").alias("slot"))
    )


@query("op5_shards")
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by one at most."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text_bytes()).alias("text_crc32"),
    )
    return shuffle_into_shards(docs, ["doc_id"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

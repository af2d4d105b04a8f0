"""Near duplicates: fast similarity sketches, banding, exact verification, connected components.

A document's set holds its distinct word shingles, as 64-bit hashes. The sketch places the set's
elements into ``COORDINATES`` bins in rounds: in round i an element falls into the bin its i-th hash
names, with value i plus a fraction; after as many rounds as there are bins, round i puts every
element into one bin in turn. A bin keeps its least value, so every coordinate fills after at most
twice as many rounds, and equal coordinates estimate the similarity with the concentration of
independent samples. ``BANDS`` bands of four coordinates make the buckets; a pair at similarity 0.8
misses all of them with probability (1 - 0.8^4)^32, below 1e-7.

Documents with equal sets are one node from the start, so copies cost one row. In a bucket every
member is compared with the smallest one on the full sets; what that links needs no other
comparison. Members of a bucket that still lie in different components are then compared with the
members of the bucket in other components, through their short differences from the smallest one.
So a group of copies costs one comparison of full sets a member, and no candidate pair goes
unchecked unless its ends are linked already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.base import frugal, null_safe, query, small_batches, table
from tillwork.operators.components import connected_components
from tillwork.session import cut

COORDINATES, BANDS = 128, 32
#: A link needs DENOMINATOR * |A and B| >= NUMERATOR * |A or B|.
NUMERATOR, DENOMINATOR = 80, 100
MEMORY = 200_000

M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


class Shingler:
    """Sets of ``k``-word shingles of lower-cased (A-Z) words between white space."""

    def __init__(self, k: int):
        self.k = k
        self.words = _Words()

    def set_of(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; fewer than k words are one shingle; no words, no set."""
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.words) > MEMORY:
            self.words.clear()
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        k = min(self.k, len(h))
        n = len(h) - k + 1
        rolled = np.full(n, k, np.uint64)
        for i in range(k):
            rolled = mix(rolled * M1 + h[i : i + n])
        return np.unique(rolled)


def sketch(elements: np.ndarray, bins: int = COORDINATES) -> np.ndarray:
    """The least value of each bin as an integer, round in the high bits. For a non-empty set."""
    width = np.uint64(bins.bit_length() - 1)  # bins is a power of two
    best = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    done = 0
    while done < 2 * bins:
        free = best == np.iinfo(np.uint64).max
        if not free.any():
            break
        # As many rounds at once as may fill the bins; earlier rounds win by their high bits.
        rounds = min(2 * bins - done, max(1, 2 * bins // len(elements)))
        i = np.arange(done, done + rounds, dtype=np.uint64)[:, None]
        h = mix(elements[None, :] + (i + np.uint64(1)) * M1)
        bin_of = np.where(i < bins, h >> (np.uint64(64) - width), i - np.uint64(bins))
        value = (i << np.uint64(48)) | (h & np.uint64((1 << 48) - 1))
        bin_of, value = bin_of.ravel(), value.ravel()
        order = np.argsort(value)[::-1]
        placed = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
        placed[bin_of[order]] = value[order]  # the last one written is the least
        best = np.where(free, placed, best)
        done += rounds
    return best


def bands_of(coordinates: np.ndarray, bands: int = BANDS) -> np.ndarray:
    parts = coordinates.reshape(bands, -1)
    out = mix(np.arange(bands, dtype=np.uint64) * M1)
    for column in parts.T:
        out = mix(out * M1 + column)
    return out


def _sketches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)
        for batch in batches:
            sizes, a, b, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                elements = shingler.set_of(text)
                sizes.append(len(elements))
                sums = np.array([elements.sum(), mix(elements ^ M1).sum()], np.uint64).view(np.int64)
                a.append(int(sums[0]))
                b.append(int(sums[1]))
                bands.append(bands_of(sketch(elements)).view(np.int64) if len(elements) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "a", "b", "bands"],
            )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)
        for batch in batches:
            sets = [shingler.set_of(t).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "elements"]
            )

    return run


def _similar(shared: Column, n: Column, m: Column) -> Column:
    return DENOMINATOR * shared >= NUMERATOR * (n + m - shared)


def _sizes_allow(n: Column, m: Column) -> Column:
    return DENOMINATOR * F.least(n, m) >= NUMERATOR * F.greatest(n, m)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) of nodes whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(_similar(shared, F.size("x"), F.size("y")))
        .select("a", "b")
        .distinct()
    )


def _bits(elements: str) -> Column:
    """Which of 64 classes occur among the elements."""
    return F.expr(f"aggregate({elements}, 0L, (bits, x) -> bits | shiftleft(1L, cast(pmod(x, 64) as int)))")


def _common(a: str, b: str) -> Column:
    """At most so many elements of a are in b: each class that b lacks holds one that is not."""
    side = "_2" if a.endswith("_2") else ""
    other = "" if side else "_2"
    mine, theirs = (F.col(f"{x.removesuffix('_2')}_bits{y}") for x, y in ((a, side), (b, other)))
    return F.size(a) - F.bit_count(mine.bitwiseAND(F.bitwise_not(theirs)))


def _across(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) inside buckets whose members still lie in different components.

    Each member is written as its difference from the bucket's centre c. What v and x share is then
    |c| - |c-v or c-x| + |v-c and x-c|, exactly, from short lists instead of full sets; it is tested
    in the join itself, so only links come out of it.
    """
    placed = members.join(labels, "node", "left").select(
        "bucket", "node", "n", "centre", F.coalesce("component", "node").alias("component")
    )
    mixed = (
        placed.groupBy("bucket")
        .agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"),
            F.max(F.when(F.col("node") == F.col("centre"), F.col("component"))).alias("home"),
        )
        .where((F.col("low") < F.col("high")) & (F.col("size") > 2))
        .select("bucket", "home")
    )
    rest = cut(placed.join(mixed, "bucket"))
    centre = sets.select(F.col("node").alias("centre"), F.col("elements").alias("c"))
    own = sets.select("node", F.col("elements").alias("v"))
    differences = (
        rest.select("centre", "node").distinct().join(centre, "centre").join(own, "node")
        .select(
            "centre", "node", F.size("c").alias("n_centre"),
            F.array_except("c", "v").alias("gone"), F.array_except("v", "c").alias("more"),
        )
    )
    full = cut(
        rest.join(differences, ["centre", "node"]).drop("centre")
        .withColumn("gone_bits", _bits("gone")).withColumn("more_bits", _bits("more"))
    )
    # One end at least lies outside the component of the centre, which is the largest as a rule.
    left = full.where(F.col("component") != F.col("home"))
    right = full.select("bucket", *[F.col(c).alias(f"{c}_2") for c in full.columns if c != "bucket"])
    once = (F.col("component_2") == F.col("home")) | (F.col("node") < F.col("node_2"))
    in_centre = (
        F.col("n_centre") - F.size("gone") - F.size("gone_2") + F.size(F.array_intersect("gone", "gone_2"))
    )
    shared = in_centre + F.size(F.array_intersect("more", "more_2"))
    n, m = F.col("n"), F.col("n_2")
    # The same from bit sets alone, as a bound that spares most of the intersections.
    at_most = (
        F.col("n_centre") - F.size("gone") - F.size("gone_2")
        + F.least(_common("gone", "gone_2"), _common("gone_2", "gone"))
        + F.least(_common("more", "more_2"), _common("more_2", "more"))
    )
    return cut(
        left.join(right, "bucket")
        .where((F.col("component") != F.col("component_2")) & once)
        .where(_sizes_allow(n, m) & _similar(at_most, n, m))
        .where(_similar(shared, n, m))
        .select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """(doc_id, copy, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Null, empty and blank texts have an empty set and are linked with nothing. A null id takes no
    part in linking: its component is null and it is kept. Rows with the same id and text fare
    alike; an id with several texts, where it names a group, joins what any of them links. An empty
    table gives no rows. Intermediate tables are written to the shared folder.
    """
    docs = small_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    sketches = cut(
        docs.mapInArrow(
            frugal(_sketches(shingle)), "doc_id long, n_shingles long, a long, b long, bands array<long>"
        )
    )
    # One node for each distinct set: the smallest id that has it.
    key = ["a", "b", "n_shingles"]
    full = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    nodes = cut(full.groupBy(*key).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")))
    buckets = nodes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    centres = buckets.groupBy("bucket").agg(
        F.min(F.struct("node", "n")).alias("c"), F.max("node").alias("last")
    ).where(F.col("c.node") < F.col("last"))
    members = cut(
        buckets.join(centres, "bucket").select("bucket", "node", "n", F.col("c.node").alias("centre"), F.col("c.n").alias("m"))
    )
    stars = (
        members.where((F.col("node") != F.col("centre")) & _sizes_allow(F.col("n"), F.col("m")))
        .select(F.col("centre").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    stars = cut(stars)
    # Full sets of the nodes that share a bucket with another, from the texts.
    shared = members.select("node").distinct()
    texts = (
        docs.join(shared, docs["doc_id"] == shared["node"])
        .select("node", "text", F.xxhash64("text").alias("copy"))
        .dropDuplicates(["node", "copy"])
    )
    sets = cut(texts.mapInArrow(frugal(_sets(shingle)), "node long, elements array<long>"))
    links = cut(_verified(stars, sets))
    labels = connected_components(links, driver_edges=0)

    late = _across(members, labels, sets)
    if late.limit(1).count():
        labels = connected_components(links.unionByName(late), driver_edges=0)

    grouped = nodes.join(labels, "node", "left").select(
        *key, F.coalesce("component", "node").alias("component_id")
    )
    rows = sketches.drop("bands").join(grouped, key, "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return rows.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that with the smallest id."""
    gone = near_duplicates(docs, shingle).where(~F.col("kept")).select("doc_id").distinct()
    return null_safe(docs, gone.withColumn("__gone", F.lit(True)), ["doc_id"], "left").where(
        F.col("__gone").isNull()
    ).drop("__gone")


@query("op4_near_dedup")
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document, on sets of two-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, shingle=2)

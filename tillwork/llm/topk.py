"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates lie in blocks by a hash of their id. In a block each dimension has a list of the
candidates sorted by that component. A query walks its lists downwards where its weight is positive
and upwards where it is negative, some places at a time, and scores in full each candidate it meets
for the first time. What no list has shown yet scores at most the sum of the weights times the
components at the present depth; once that bound is below the k-th best score, the block is done.
The blocks' winners, k a query and block, are merged by score.

Queries meet blocks as a grid of bounded cells: so many queries against so many candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.llm.base import query, table
from tillwork.session import cut

#: Candidates and queries of one cell.
BLOCK, QUERIES_AT_ONCE = 16_384, 1_024
STEP = 64
RESULT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): distinct vectors as floor(scale * x); null ids, nulls and non-finite ones go."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
        .select(
            F.col("vec_id").cast("long"),
            F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("v"),
        )
        .distinct()
    )


def matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a table, by ascending id; short vectors end in zeros."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("vec_id", "ascending")]))
    ids = rows.column("vec_id").to_numpy()
    lengths = pc.list_value_length(rows.column("v")).to_numpy()
    out = np.zeros((len(ids), int(lengths.max(initial=0))))
    flat = rows.column("v").combine_chunks().flatten().to_numpy()
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    return ids, out


class SortedLists:
    """Candidates of one block and their per-dimension lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(vectors, self.order, axis=0)
        # Products and sums of integers below 2^53 are exact in doubles, in any order.
        self.largest = float(np.abs(vectors).max(initial=0.0))

    def top(self, query_id: int, weights: np.ndarray, k: int, step: int = STEP) -> tuple[list, list, int]:
        """(ids, scores, depth): the k best, ties to the smaller id, and how deep the lists were read."""
        n = len(self.ids)
        exact = self.largest * float(np.abs(weights).sum()) < 2.0**53
        vectors = self.vectors if exact else self.vectors.astype(object)
        if not exact:
            weights = np.array([int(w) for w in weights], dtype=object)
            vectors = np.vectorize(int, otypes=[object])(vectors) if vectors.size else vectors
        used = np.flatnonzero(weights != 0)
        down = used[weights[used] > 0]
        up = used[weights[used] < 0]
        seen = np.zeros(n, bool)
        best_at = np.empty(0, np.int64)
        best = weights[:0] if exact else np.empty(0, object)
        depth = 0
        while depth < n:
            stop = min(n, depth + step) if len(used) else n
            if len(used):
                met = np.concatenate([self.order[n - stop : n - depth, down].ravel(), self.order[depth:stop, up].ravel()])
                new = np.zeros(n, bool)
                new[met] = True
                new &= ~seen
                at = np.flatnonzero(new)
                seen |= new
            else:
                at = np.arange(n)
            depth = stop
            step *= 2
            scores = vectors[at] @ weights
            own = self.ids[at] != query_id
            best_at = np.concatenate([best_at, at[own]])
            best = np.concatenate([best, scores[own]])
            if len(best) > k:
                if exact:
                    kth = np.partition(best, len(best) - k)[len(best) - k]
                    best_at, best = best_at[best >= kth], best[best >= kth]
                order = sorted(range(len(best)), key=lambda i: (-best[i], self.ids[best_at[i]]))[:k]
                best_at, best = best_at[order], best[order]
            if len(best) == k and depth < n:
                bound = (self.values[n - depth - 1, down] * weights[down]).sum() + (
                    self.values[depth, up] * weights[up]
                ).sum()
                if bound < best.min():
                    break
        order = sorted(range(len(best)), key=lambda i: (-best[i], self.ids[best_at[i]]))
        top = 2**63 - 1
        scores = [max(-top, min(top, int(best[i]))) for i in order]
        return [int(self.ids[best_at[i]]) for i in order], scores, depth


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    block: int = BLOCK,
    queries_at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of highest inner product of each query.

    Both tables are (vec_id, v) with integers in doubles, as ``quantised`` makes them. Candidates
    with the query's id are left out; ties go to the smaller id; fewer candidates give fewer rows.
    Missing components of shorter vectors count as zero. A score beyond 64 bits is returned as the
    largest or smallest long. Without queries or candidates there are no rows.
    """
    candidates, queries = cut(candidates), cut(queries)
    blocks = max(1, -(-candidates.count() // block))
    chunks = max(1, -(-queries.count() // queries_at_once))

    def dealt(df: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(own)
        each = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other)
        return df.select("vec_id", "v", part, each)

    cells = dealt(candidates, "__block", blocks, "__chunk", chunks)
    asked = dealt(queries, "__chunk", chunks, "__block", blocks)

    def search(found: pa.Table, wanted: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, int]] = []
        if found.num_rows and wanted.num_rows:
            ids, vectors = matrix(found)
            query_ids, weights = matrix(wanted)
            width = max(vectors.shape[1], weights.shape[1])
            lists = SortedLists(ids, np.pad(vectors, ((0, 0), (0, width - vectors.shape[1]))))
            weights = np.pad(weights, ((0, 0), (0, width - weights.shape[1])))
            for query_id, w in zip(query_ids.tolist(), weights):
                best, scores, _ = lists.top(query_id, w, k)
                rows += zip([query_id] * len(best), best, scores)
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.table(
            {name: pa.array(c, pa.int64()) for name, c in zip(("query_id", "vec_id", "score"), columns)}
        )

    merged = (
        cells.groupBy("__block", "__chunk")
        .cogroup(asked.groupBy("__block", "__chunk"))
        .applyInArrow(search, RESULT)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        merged.distinct()
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


SQL = """
with e as (
  select distinct vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]) as bigint) as score
  from e q join e c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), ranked as (
  select query_id, vec_id, score,
         row_number() over (partition by query_id order by score desc, vec_id) as rank
  from scored
)
select query_id, cast(rank as int) as rank, vec_id, score from ranked where rank <= 5
"""


@query("op7_top_k", SQL)
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of all vectors for every vector whose id is divisible by 50."""
    vectors = quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors)

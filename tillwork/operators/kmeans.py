"""Many k-means fits at once: each pass over the rows advances all fits that still move.

All fits of a sweep, every number of clusters with all its restarts, read the same rows. These are
laid out once so that near rows lie together, in leaves of a space tree. One pass gives a whole leaf
to a centre of a running fit where its bounding box shows that no other centre can be nearest to any
of its rows (the filtering of Kanungo et al.); the rows of the other leaves are compared one by one.
A task sends one row of sums for each (fit, centre); these are added up by Spark. Seeding is shared
as well: each restart draws one pool of candidates by k-means|| (rounds of weighted sampling by
squared distance, exactly ``2 k`` rows a round), and the fits of that restart start from weighted
draws from its pool. The driver holds centres, pools and sums, whose sizes depend on k and the
restarts alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.operators.models import persisted

#: Rounds of sampling, each followed by an update of the distances to the pool.
ROUNDS = 3
#: Rows whose distances to all centres are held at once.
SLICE = 1_024
#: Rows of a leaf, and values of one packed chunk of leaves.
LEAF, VALUES = 64, 200_000
#: Bits of a column, and of all columns, in the order in which rows are laid out.
COLUMN_BITS, ORDER_BITS = 10, 60
POINTS = "__points"


@dataclass
class Fit:
    """One fit: its centres, its cost at the last pass, the passes it took."""

    k: int
    restart: int
    centres: np.ndarray
    sizes: np.ndarray | None = None
    cost: float = np.inf
    passes: int = 0
    moving: bool = True


def packed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows without nulls as chunks of leaves: one column of binaries, each a matrix of doubles
    with a row per column, cut into leaves of ``LEAF`` rows (the last may hold fewer).

    Rows are dealt over the partitions by ranges of an interleaved grid code; rows of one code are
    dealt by number, so copies never gather in one task.
    """
    if rows.columns == [POINTS]:
        return rows
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    found = rows.agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    ).first()
    coded = list(columns)[:ORDER_BITS]
    bits = min(COLUMN_BITS, ORDER_BITS // len(coded))
    code = F.lit(0).cast("long")
    places = []
    for c in coded:
        mean, std = found[f"m_{c}"] or 0.0, found[f"s_{c}"] or 0.0
        # Three deviations to each side; what lies beyond is put into the outer cells.
        share = (F.col(c) - F.lit(mean)) / F.lit(6.0 * std if std else 1.0) + F.lit(0.5)
        places.append(F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * F.lit(2.0**bits - 1.0)))
    for bit in reversed(range(bits)):
        for place in places:
            code = F.shiftleft(code, 1).bitwiseOR(F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("long")))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    dealt = rows.withColumns({"__code": code, "__id": F.monotonically_increasing_id()})
    dealt = dealt.repartitionByRange(tasks, "__code", "__id").sortWithinPartitions("__code", "__id")
    size = max(VALUES // len(columns) // LEAF, 1) * LEAF

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            x = np.stack([np.asarray(batch.column(c), dtype=np.float64) for c in columns])
            held.append(x)
            count += x.shape[1]
            while count >= size:
                x = np.concatenate(held, axis=1)
                yield _chunk(x[:, :size])
                held, count = [x[:, size:]], count - size
        if count:
            yield _chunk(np.concatenate(held, axis=1))

    return dealt.select(*columns).mapInArrow(pack, f"{POINTS} binary")


def _chunk(x: np.ndarray) -> pa.RecordBatch:
    """The points, one a column of ``x``, in the order of their leaves: halved along the widest side."""
    order = np.arange(x.shape[1])
    todo = [(0, x.shape[1])]
    while todo:
        a, b = todo.pop()
        if b - a <= LEAF:
            continue
        mine = x[:, order[a:b]]
        width = mine.max(1) - mine.min(1)
        if not width.max() > 0:
            continue
        half = -(-(b - a) // LEAF) // 2 * LEAF
        order[a:b] = order[a:b][np.argpartition(mine[width.argmax()], half)]
        todo += [(a, a + half), (a + half, b)]
    return pa.RecordBatch.from_arrays(
        [pa.array([np.ascontiguousarray(x[:, order]).tobytes()], pa.binary())], names=[POINTS]
    )


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The packed matrices, a row per column of the data."""
    for batch in batches:
        for value in batch.column(0):
            yield np.frombuffer(value.as_buffer(), np.float64).reshape(width, -1)


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The rows as matrices of at most ``SLICE`` rows, so that distances to all centres stay small."""
    for points in _chunks(batches, width):
        for low in range(0, points.shape[1], SLICE):
            yield np.ascontiguousarray(points[:, low : low + SLICE].T)


class _Leaves:
    """Sizes, sums and bounding boxes of the leaves of a chunk."""

    def __init__(self, points: np.ndarray):
        starts = np.arange(0, points.shape[1], LEAF)
        self.size = np.diff(np.append(starts, points.shape[1]))
        self.low = np.minimum.reduceat(points, starts, axis=1)
        self.high = np.maximum.reduceat(points, starts, axis=1)
        self.total = np.add.reduceat(points, starts, axis=1)
        self.mean = self.total / self.size
        off = points - np.repeat(self.mean, self.size, axis=1)
        self.squares = np.add.reduceat((off * off).sum(0), starts)
        self.middle, self.half = (self.low + self.high) / 2, (self.high - self.low) / 2
        self.reach = (self.middle * self.middle).sum(0) + (self.half * self.half).sum(0)

    def owners(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The centre nearest to the middle of each leaf, and whether it is so for the whole box."""
        own = (centres * centres).sum(1)
        relative = own - 2.0 * (self.middle.T @ centres.T)
        nearest = relative.argmin(1)
        at = np.arange(len(nearest))
        # By how much another centre is farther, at the corner of the box that is nearest to it.
        least = relative - relative[at, nearest][:, None]
        apart = np.abs(centres[:, None, :] - centres[None, :, :])
        for i, half in enumerate(self.half):
            least -= 2.0 * half[:, None] * apart[nearest, :, i]
        least[at, nearest] = np.inf
        # What rounding could turn round is left to the rows.
        return nearest, least.min(1) > 1e-9 * (self.reach + own.max())

    def farthest(self, pool: np.ndarray) -> np.ndarray:
        """No row of a leaf is farther from the pool than this, in squared distance."""
        out = np.zeros((len(pool), len(self.size)))
        for low, high, column in zip(self.low, self.high, pool.T):
            out += np.maximum(np.abs(column[:, None] - low), np.abs(high - column[:, None])) ** 2
        return out.min(0)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Rows by centres, never negative."""
    d = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)
    return np.maximum(d, 0.0, out=d)


def _uniform(x: np.ndarray, seed: int) -> np.ndarray:
    """A fraction in (0, 1) from each row's values: the same under any partitioning."""
    h = np.full(len(x), (seed * 0x9E3779B97F4A7C15) & (2**64 - 1), np.uint64)
    for column in np.ascontiguousarray(x.T).view(np.uint64):
        h = (h ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def _drawn(
    rows: DataFrame, columns: Sequence[str], pools: list[np.ndarray], wanted: int, seed: int
) -> list[np.ndarray]:
    """For each restart ``wanted`` distinct rows, drawn by their squared distance to its pool.

    Weighted sampling without replacement by keys: a row's key is log(u) / weight, the highest keys
    are drawn. Every task keeps its highest, so little is sorted.
    """
    names = [f"x{i}" for i in range(len(columns))]

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[dict[bytes, float]] = [{} for _ in pools]
        least = [-np.inf] * len(pools)
        for points in _chunks(batches, len(columns)):
            leaves, whole = _Leaves(points), points.T
            for r, pool in enumerate(pools):
                drawn = np.log(_uniform(whole, seed + 1_000_003 * r))
                # A key is at most what the whole leaf's largest weight would make of the draw.
                far = leaves.farthest(pool) if len(pool) else np.ones(len(leaves.size))
                with np.errstate(divide="ignore"):
                    most = drawn / np.repeat(far, leaves.size) * (1 - 1e-9)
                for low in range(0, len(whole), SLICE):
                    some = low + np.flatnonzero(most[low : low + SLICE] >= least[r])
                    if not len(some):
                        continue
                    x = whole[some]
                    weight = squared_distances(x, pool).min(1) if len(pool) else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        key = drawn[some] / weight
                    key[weight <= 1e-24] = -np.inf
                    # Equal rows have equal keys and count once.
                    _, first = np.unique(key, return_index=True)
                    for i in first[::-1][: 2 * wanted]:
                        if key[i] > -np.inf:
                            best[r][x[i].tobytes()] = float(key[i])
                    if len(best[r]) >= 2 * wanted:
                        top = sorted(best[r].items(), key=lambda e: -e[1])[:wanted]
                        best[r], least[r] = dict(top), top[-1][1]
        out = [
            (r, key, *np.frombuffer(row).tolist())
            for r, found in enumerate(best)
            for row, key in sorted(found.items(), key=lambda e: -e[1])[:wanted]
        ]
        if out:
            arrays = [pa.array(c) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays([arrays[0].cast(pa.int32()), *arrays[1:]], names=["restart", "key", *names])

    schema = "restart int, key double, " + ", ".join(f"{n} double" for n in names)
    order = Window.partitionBy("restart").orderBy(F.desc("key"), *names)
    sent = rows.mapInArrow(highest, schema).distinct()
    top = sent.withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted)
    found: list[list] = [[] for _ in pools]
    for row in top.collect():
        found[row["restart"]].append([row[n] for n in names])
    return [np.array(sorted(f), np.float64).reshape(-1, len(columns)) for f in found]


def _sums(
    rows: DataFrame, columns: Sequence[str], centres: list[np.ndarray], about: list[np.ndarray] | None = None
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sizes, sums, costs) of the centres of every fit, from one pass over packed rows.

    The costs are squared distances to the row's centre, or to the point of ``about`` in its place.
    """
    about = centres if about is None else about
    edges = np.concatenate([[0], np.cumsum([len(c) for c in centres])]).tolist()
    count, width = edges[-1], len(columns)
    names = [f"s{i}" for i in range(width)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, cost, sums = np.zeros(count), np.zeros(count), np.zeros((width, count))
        for points in _chunks(batches, width):
            leaves = _Leaves(points)
            for a, b, fit, targets in zip(edges, edges[1:], centres, about):
                nearest, alone = leaves.owners(fit)
                mine = nearest[alone]
                off = leaves.mean[:, alone] - targets.T[:, mine]
                squares = leaves.squares[alone] + leaves.size[alone] * (off * off).sum(0)
                sizes[a:b] += np.bincount(mine, leaves.size[alone], b - a)
                cost[a:b] += np.bincount(mine, squares, b - a)
                for total, column in zip(sums, leaves.total):
                    total[a:b] += np.bincount(mine, column[alone], b - a)
                rest = points[:, np.repeat(~alone, leaves.size)]
                # A squared distance less the row's own square, for all centres, is a matrix product.
                own = (fit * fit).sum(1)[:, None]
                for low in range(0, rest.shape[1], SLICE):
                    x = rest[:, low : low + SLICE]
                    nearest_of = (own - 2.0 * (fit @ x)).argmin(0)
                    off = x - targets.T[:, nearest_of]
                    cost[a:b] += np.bincount(nearest_of, (off * off).sum(0), b - a)
                    sizes[a:b] += np.bincount(nearest_of, minlength=b - a)
                    for total, column in zip(sums, x):
                        total[a:b] += np.bincount(nearest_of, column, b - a)
        used = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(sizes[used]), pa.array(cost[used])]
            + [pa.array(s[used]) for s in sums],
            names=["centre", "n", "cost", *names],
        )

    schema = "centre int, n double, cost double, " + ", ".join(f"{n} double" for n in names)
    added = rows.mapInArrow(add, schema).groupBy("centre").agg(
        *[F.sum(c).alias(c) for c in ("n", "cost", *names)]
    )
    sizes, sums, cost = np.zeros(count), np.zeros((count, width)), np.zeros(count)
    for row in added.collect():  # one row a centre
        i = row["centre"]
        sizes[i], cost[i], sums[i] = row["n"], row["cost"], [row[n] for n in names]
    return [(sizes[a:b], sums[a:b], cost[a:b]) for a, b in zip(edges, edges[1:])]


def _start(pool: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the pool by k-means++ on its weights, then a few weighted Lloyd steps."""
    chosen = [int(rng.choice(len(pool), p=weight / weight.sum()))]
    trials = 2 + int(np.log(k))
    nearest = squared_distances(pool, pool[chosen])[:, 0]
    while len(chosen) < min(k, len(pool)):
        mass = weight * nearest
        if mass.sum() <= 0:
            break
        # The best of several draws, as greedy k-means++ does.
        draws = rng.choice(len(pool), size=trials, p=mass / mass.sum())
        after = np.minimum(nearest[None, :], squared_distances(pool[draws], pool))
        best = int((after * weight).sum(1).argmin())
        chosen.append(int(draws[best]))
        nearest = after[best]
    centres = pool[chosen].copy()
    for _ in range(10):
        label = squared_distances(pool, centres).argmin(1)
        for j in range(len(centres)):
            mine = label == j
            if weight[mine].sum() > 0:
                centres[j] = np.average(pool[mine], axis=0, weights=weight[mine])
    return centres


def seeded(
    rows: DataFrame, columns: Sequence[str], ks: Sequence[int], restarts: int, seed: int
) -> list[Fit]:
    """Starting centres of every (k, restart) from shared passes."""
    wanted = 2 * max(ks)
    pools = [np.empty((0, len(columns))) for _ in range(restarts)]
    pools = [p[:1] for p in _drawn(rows, columns, pools, 1, seed)]
    if not len(pools[0]):
        raise ValueError("no rows to cluster")
    for i in range(ROUNDS):
        more = _drawn(rows, columns, pools, wanted, seed + 7_919 * (i + 1))
        pools = [np.concatenate([p, m]) for p, m in zip(pools, more)]
    weights = [sizes for sizes, _, _ in _sums(rows, columns, pools)]
    return [
        Fit(k, r, _start(pool, weight, k, np.random.default_rng([seed, r, k])))
        for k in ks
        for r, (pool, weight) in enumerate(zip(pools, weights))
    ]


def fit_many(
    rows: DataFrame,
    columns: Sequence[str],
    ks: Sequence[int],
    restarts: int = 10,
    max_iter: int = 100,
    tol: float = 1e-4,
    seed: int = 42,
    on_pass: Callable[[list[Fit]], None] | None = None,
) -> list[Fit]:
    """All fits of ``ks`` x ``restarts``; Lloyd steps until the centres of a fit move little.

    ``tol`` is relative to the mean variance of the columns, against the sum of squared moves. A
    centre without rows stays where it is. Rows with nulls are left out. ``rows`` may be packed
    already; then it is read once per pass, so callers keep it cached.
    """
    if rows.columns != [POINTS]:
        with persisted(packed(rows, columns)) as kept:
            return fit_many(kept, columns, ks, restarts, max_iter, tol, seed, on_pass)
    middle = np.zeros((1, len(columns)))
    (size, total, _), = _sums(rows, columns, [middle])
    (_, _, squares), = _sums(rows, columns, [middle], [total / max(size[0], 1.0)])
    limit = tol * float(squares[0]) / max(size[0], 1.0) / len(columns)
    fits = seeded(rows, columns, ks, restarts, seed)
    while any(f.moving for f in fits):
        running = [f for f in fits if f.moving]
        for fit, (sizes, sums, cost) in zip(running, _sums(rows, columns, [f.centres for f in running])):
            moved = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1.0)[:, None], fit.centres)
            shift = float(((moved - fit.centres) ** 2).sum())
            fit.passes += 1
            fit.cost, fit.sizes = float(cost.sum()), sizes
            # The cost and the sizes belong to the centres they were measured with.
            if shift <= limit or fit.passes > max_iter:
                fit.moving = False
            else:
                fit.centres = moved
        if on_pass:
            on_pass(fits)
    return fits


def best_fits(fits: Sequence[Fit]) -> dict[int, Fit]:
    """The fit of lowest cost of each k; the first restart wins ties."""
    out: dict[int, Fit] = {}
    for fit in fits:
        if fit.k not in out or fit.cost < out[fit.k].cost:
            out[fit.k] = fit
    return out


def silhouettes(rows: DataFrame, columns: Sequence[str], fits: Sequence[Fit]) -> list[float]:
    """Mean silhouette of each fit on squared distances, from two passes for all of them.

    The mean squared distance to a cluster follows from its size, its sum and its sum of squares;
    a row's own cluster is taken without the row itself. A row alone in its cluster counts 0.
    """
    rows = packed(rows, columns)
    centres = [f.centres for f in fits]
    told = _sums(rows, columns, centres)
    edges = np.concatenate([[0], np.cumsum([len(c) for c in centres])]).tolist()
    n = np.concatenate([s for s, _, _ in told])
    means = np.concatenate([t / np.maximum(s, 1.0)[:, None] for s, t, _ in told])
    parted = [means[a:b] for a, b in zip(edges, edges[1:])]
    spread = np.concatenate([c for _, _, c in _sums(rows, columns, centres, parted)])
    stacked = np.concatenate(centres)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(len(centres)), 0
        for x in _matrices(batches, len(columns)):
            count += len(x)
            nearest_of = squared_distances(x, stacked)
            to_mean = squared_distances(x, means)
            for f, (a, b) in enumerate(zip(edges, edges[1:])):
                own = nearest_of[:, a:b].argmin(1)
                size, squares = n[a:b], spread[a:b]
                sums = size * to_mean[:, a:b] + squares  # over all rows of each cluster
                at = np.arange(len(x))
                mine = sums[at, own] / np.maximum(size[own] - 1, 1.0)
                others = np.where(size > 0, sums / np.maximum(size, 1.0), np.inf)
                others[at, own] = np.inf
                other = others.min(1)
                most = np.maximum(mine, other)
                fair = (size[own] > 1) & np.isfinite(other) & (most > 0)
                total[f] += ((other - mine)[fair] / most[fair]).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(centres), dtype=np.int32)), pa.array(total), pa.array(np.full(len(centres), count))],
            names=["fit", "total", "n"],
        )

    added = rows.mapInArrow(score, "fit int, total double, n long").groupBy("fit").agg(
        (F.sum("total") / F.sum("n")).alias("score")
    )
    found = {r["fit"]: r["score"] for r in added.collect()}
    return [float(found[i]) for i in range(len(centres))]


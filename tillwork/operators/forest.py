"""Many decision trees grown together over features that are binned once.

The table is binned and packed into blocks of rows. All trees of a grid, its folds and its forests
grow at the same time:

* A level of all trees is one pass: tasks send each node with many rows as a histogram, histograms
  of a node are added up and its split is chosen in a task; the driver gets the chosen splits only.
  Trees that see the same rows share the histograms of equal boxes, whatever their parameters.
* A node of at most ``local_rows`` rows is finished in one task: its rows are sent there, once for
  all trees that share the box, and the rest of the subtree grows on arrays, all its nodes by level.
* Few features leave few positions: three of 64 bins 262,144, however many rows there are. Rows of
  one position are then added up before they are sent, and whole trees grow in tasks after one pass.

Splits depend on the rows, the parameters and hashes of (seed, path), not on partitions. Rows that a
tree does not learn from (its held-out fold, or the test rows) go along to the leaves and are counted
there by class; with the counts of all nodes, every truncation (depth, least rows to split) and every
cost-complexity pruning of a tree is scored without growing it again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import hash32
from tillwork.operators.ensembles import poisson_steps
from tillwork.session import cut, over_cores, stored

#: Rows of a block; rows of a node that one task may finish; cells of histograms held by a task.
BLOCK_ROWS, LOCAL_ROWS, HISTOGRAM_CELLS = 20_000, 50_000, 1 << 22
#: Positions (bins of all features) that cost a task no more than a row of ``local_rows``; rows of
#: blocks that a task adds up by position at once.
POSITIONS_PER_ROW, GATHERED_ROWS = 6, 1_000_000
#: Cells of a level's histograms that cost a task no more than putting a row in order; bytes of rows that
#: a task joins before it deals them to nodes.
CELLS_PER_ROW, GATHERED_BYTES = 4, 1 << 26
#: Rows of a table from which on, and for each part in which, rows are dealt by position; rows that draws
#: are made for at once.
DEALT_ROWS, DRAWN_ROWS = 1_000_000, 1 << 15
#: Fold of rows that no tree learns from.
TEST = -1
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M2
    x = (x ^ (x >> np.uint64(29))) * M1
    return x ^ (x >> np.uint64(32))


def fraction(x: np.ndarray) -> np.ndarray:
    return (mixed(x) >> np.uint64(11)).astype(np.float64) * 2.0**-53


@dataclass(frozen=True)
class Spec:
    """How one tree grows. ``criterion``: gini, entropy or variance (of the second channel).

    ``held_out``: the folds it does not learn from, whose rows are counted at its leaves; TEST for
    the rows that no tree learns from. ``left_out``: folds it does not see at all. ``bootstrap``:
    mean number of times a row is drawn, 0 for every row once; ``bag`` (mean, seed): a draw before it
    that several trees have in common. ``max_features`` None: all.
    """

    criterion: str = "gini"
    splitter: str = "best"
    max_features: int | None = None
    min_leaf: float = 1.0
    min_split: float = 2.0
    max_depth: int = 30
    seed: int = 0
    held_out: int | tuple[int, ...] = TEST
    left_out: tuple[int, ...] = ()
    bootstrap: float = 0.0
    bag: tuple[float, int] | None = None
    #: For boosting: (fit, class) whose gradients the tree is grown on.
    target: tuple[int, int] | None = None

    def rows(self) -> tuple:
        """Trees with the same value learn the same from the same rows with the same weights."""
        return (self.held_out, self.left_out, self.bootstrap, self.seed if self.bootstrap else 0, self.bag, self.target)


@dataclass
class Binned:
    """Blocks of binned rows: bins (features x rows, bytes), stats (rows x channels), fold, hash."""

    blocks: DataFrame
    features: list[str]
    edges: list[np.ndarray]
    channels: int
    #: Turns a block's row into the channels that trees grow on; None: its stats.
    gradients: Callable[[Block, Spec], np.ndarray] | None = None

    def widths(self) -> list[int]:
        """Bins of each feature."""
        return [len(e) + 1 for e in self.edges]

    def stats_of(self, block: Block, spec: Spec) -> np.ndarray:
        return block.stats if self.gradients is None else self.gradients(block, spec)


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = 64) -> list[np.ndarray]:
    """Thresholds of each feature: between all its values if they are few, else near quantiles.

    Null values are left out; a row goes left of a threshold if its value is not above it.
    """
    values = [F.col(c).cast("double") for c in features]
    counted = df.agg(*[F.approx_count_distinct(v).alias(f"d{i}") for i, v in enumerate(values)]).first()
    few = [i for i in range(len(features)) if counted[f"d{i}"] <= 2 * max_bins]
    probs = [i / max_bins for i in range(1, max_bins)]

    def sketched(wanted: Sequence[int]) -> list[Column]:
        return [F.percentile_approx(values[i], probs, 10_000).alias(f"q{i}") for i in wanted]

    # Sketches cost most: they are left to the features that turn out to need them.
    many = [i for i in range(len(features)) if i not in few]
    sets = [F.sort_array(F.collect_set(values[i])).alias(f"s{i}") for i in few]
    found = df.agg(*sketched(many), *sets).first().asDict() if features else {}
    more = [i for i in few if len(found[f"s{i}"]) > max_bins]
    if more:
        found |= df.agg(*sketched(more)).first().asDict()
    edges = []
    for i in range(len(features)):
        if i in few and i not in more:
            x = np.array(sorted(found[f"s{i}"]), np.float64)
            edges.append((x[1:] + x[:-1]) / 2)
        else:
            edges.append(np.unique(np.array(found[f"q{i}"] or [], np.float64)))
    return edges


def binned(
    df: DataFrame,
    features: Sequence[str],
    stats: Sequence[Column],
    fold: Column,
    key: str = "row_key",
    max_bins: int = 64,
    edges: list[np.ndarray] | None = None,
) -> Binned:
    """Bin and block ``df`` once. ``stats``: one column per channel, as ``class_channels`` gives.

    ``fold`` numbers the folds from 0, TEST is for rows held out from all. Nulls of a feature fall
    into its last bin. At most 255 thresholds a feature.
    """
    edges = edges or bin_edges(df.where(fold != TEST), features, max_bins)
    names = [f"x{i}" for i in range(len(features))]
    channels = [f"s{i}" for i in range(len(stats))]
    schema = "block long, n int, bins binary, stats binary, fold binary, hash binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(low, BLOCK_ROWS)
                x = [np.asarray(part.column(c), dtype=np.float64) for c in names]
                bins = np.stack([np.searchsorted(e, v, "left") for e, v in zip(edges, x)]).astype(np.uint8)
                s = np.stack([np.asarray(part.column(c), dtype=np.float64) for c in channels], 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()), pa.array([part.num_rows], pa.int32()), pa.array([bins.tobytes()]), pa.array([s.tobytes()]),
                        pa.array([np.asarray(part.column("fold")).astype(np.int16).tobytes()]),
                        pa.array([np.asarray(part.column("hash")).astype(np.uint64).tobytes()]),
                    ],
                    names=["block", "n", "bins", "stats", "fold", "hash"],
                )
                number += 1

    chosen = df.select(
        *[F.col(c).cast("double").alias(n) for c, n in zip(features, names)],
        *[s.cast("double").alias(c) for s, c in zip(stats, channels)],
        fold.cast("int").alias("fold"),
        hash32(key, 0).alias("hash"),
    )
    # Blocks are dealt anew if the rows came in few partitions; they are read many times.
    blocks = cut(chosen.mapInArrow(pack, schema))
    dealt = over_cores(blocks)
    return Binned(blocks if dealt is blocks else cut(dealt), list(features), edges, len(channels))


def class_channels(label: str, classes: int, weight: Column | None = None) -> list[Column]:
    """One channel per class 0, 1, ...: the weight of the rows of that class."""
    w = F.lit(1.0) if weight is None else weight
    return [F.when(F.col(label) == c, w).otherwise(0.0) for c in range(classes)]


#: Per rate the steps of the Poisson counts, and the count that 16 bits of a hash decide (-1: not yet).
_DRAWS: dict[float, tuple[np.ndarray, np.ndarray]] = {}


@dataclass
class Block:
    bins: np.ndarray
    stats: np.ndarray
    fold: np.ndarray
    hash: np.ndarray
    #: How many rows of the table each row stands for; None: one.
    counts: np.ndarray | None = None
    #: For boosting: scores (fits x classes x rows), and what is worked out from them.
    margins: np.ndarray | None = None
    worked: dict = field(default_factory=dict)

    def part(self, rows: slice | np.ndarray) -> Block:
        """Some of the rows of a block without scores."""
        counts = None if self.counts is None else self.counts[rows]
        return Block(self.bins[:, rows], self.stats[rows], self.fold[rows], self.hash[rows], counts)

    def held(self, spec: Spec) -> np.ndarray:
        return np.isin(self.fold, spec.held_out)

    def weights(self, spec: Spec) -> np.ndarray:
        """How often each row counts for the trees of ``spec.rows()``; 0 where it is not learned from."""
        learned = (self.fold != TEST) & ~self.held(spec) & ~np.isin(self.fold, spec.left_out)
        out = learned.astype(np.float64)
        if spec.bag:
            # Trees of one bag follow each other.
            bag, drawn = self.worked.get("bag", (None, None))
            if bag != spec.bag:
                drawn = self._drawn(*spec.bag)
                self.worked["bag"] = (spec.bag, drawn)
            out *= drawn
        return out * self._drawn(spec.bootstrap, spec.seed) if spec.bootstrap else out

    def _drawn(self, rate: float, seed: int) -> np.ndarray:
        """Poisson counts from the hashes of the rows."""
        if rate not in _DRAWS:
            steps = np.array(poisson_steps(rate))
            low = np.arange(1 << 16) * 2.0**-16
            least, most = (np.searchsorted(steps, u, "right") for u in (low, np.nextafter(low + 2.0**-16, 0.0)))
            _DRAWS[rate] = steps, np.where(least == most, least, -1)
        steps, table = _DRAWS[rate]
        h = mixed(self.hash ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1)))
        # The first 16 bits decide, but for the few values next to a step.
        out = table[(h >> np.uint64(48)).astype(np.int64)]
        open_ = np.flatnonzero(out < 0)
        out[open_] = np.searchsorted(steps, (h[open_] >> np.uint64(11)).astype(np.float64) * 2.0**-53, "right")
        return out


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for row in batch.to_pylist():
            n = row["n"]
            block = Block(
                np.frombuffer(row["bins"], np.uint8).reshape(-1, n),
                np.frombuffer(row["stats"]).reshape(n, -1),
                np.frombuffer(row["fold"], np.int16),
                np.frombuffer(row["hash"], np.uint64),
            )
            if "counts" in row:
                block.counts = np.frombuffer(row["counts"])
            if "margins" in row:
                block.margins = np.frombuffer(row["margins"], np.float32)
            yield block


# choosing splits


def spread(stats: np.ndarray, criterion: str) -> np.ndarray:
    """Impurity times weight of each row of channel sums."""
    if criterion == "variance":  # but for the sum of squares, which splits do not change
        return -(stats[:, 1] ** 2) / np.maximum(stats[:, 0], 1e-300)
    w = np.maximum(stats.sum(1), 1e-300)
    if criterion == "gini":
        return w - (stats**2).sum(1) / w
    p = np.maximum(stats, 0.0) / w[:, None]
    return -w * (p * np.log2(np.where(p > 0, p, 1.0))).sum(1)


def weight_of(stats: np.ndarray, criterion: str) -> np.ndarray:
    return stats[:, 0] if criterion == "variance" else stats.sum(1)


class Histograms:
    """Nodes as histograms (nodes x features x bins x channels)."""

    def __init__(self, cells: np.ndarray, criterion: str):
        self.cells = cells
        self.weight = cells[..., 0] if criterion == "variance" else cells.sum(3)
        self.features = cells.shape[1]

    def extent(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        there = self.weight[:, f] > 0
        return there.argmax(1), there.shape[1] - 1 - there[:, ::-1].argmax(1)

    def ordered(self, f: int, wanted: np.ndarray):
        node, b = np.nonzero((self.weight[:, f] > 0) & wanted[:, None])
        return node, b, self.cells[node, f, b]


class Rows:
    """Nodes as rows (features x rows, channels x rows) in the order of their ``node``, counted from 0.

    ``whole``: all stats are whole numbers, which give the same sums in any order. Other sums are taken
    row by row, since their last digits decide between splits of equal gain.
    """

    def __init__(self, bins: np.ndarray, stats: np.ndarray, node: np.ndarray, whole: bool):
        self.bins, self.stats, self.node, self.whole = bins, stats, node, whole
        self.features = len(bins)
        self.starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))

    def extent(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        b = self.bins[f]
        return np.minimum.reduceat(b, self.starts).astype(np.int64), np.maximum.reduceat(b, self.starts).astype(np.int64)

    def ordered(self, f: int, wanted: np.ndarray):
        node, b, stats = self.node, self.bins[f], self.stats
        if not wanted.all():
            rows = np.flatnonzero(wanted[node])
            node, b, stats = node[rows], b[rows], stats[:, rows]
        bits = max(int(b.max()).bit_length(), 1)
        key = (node << bits) | b
        if self.whole and len(wanted) << bits <= CELLS_PER_ROW * len(key):
            # Many rows a node: added up by bin.
            there = np.flatnonzero(np.bincount(key))
            sums = np.stack([np.bincount(key, s)[there] for s in stats], 1)
        else:
            order = np.sort((key << 32) | np.arange(len(key)))
            there, sums = order >> 32, np.stack([s[order & 0xFFFFFFFF] for s in stats], 1)
        return there >> bits, there & ((1 << bits) - 1), sums


@dataclass
class Splits:
    """Per node: feature (-1: none), bin, channel sums of the left side, gain."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray


def choose(nodes: Histograms | Rows, totals: np.ndarray, path: np.ndarray, spec: Spec) -> Splits:
    """The best split of each node; lower features and bins win ties."""
    n, channels = totals.shape
    extents = [nodes.extent(f) for f in range(nodes.features)]
    varies = np.stack([high > low for low, high in extents], 1)
    allowed = varies
    m = spec.max_features or nodes.features
    seeds = [mixed(path + np.uint64((f + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) for f in range(nodes.features)]
    if m < nodes.features:
        # The first m features that vary in the node, in an order of its own.
        place = np.where(varies, np.stack([fraction(s) for s in seeds], 1), np.inf)
        rank = place.argsort(1, kind="stable").argsort(1, kind="stable")
        allowed = varies & (rank < m)
    out = Splits(np.full(n, -1), np.full(n, -1), np.zeros((n, channels)), np.zeros(n))
    before = spread(totals, spec.criterion)
    least = 1e-10 * np.maximum(weight_of(totals, spec.criterion), 1e-300)
    for f in range(nodes.features):
        wanted = allowed[:, f]
        if not wanted.any():
            continue
        node, b, stats = nodes.ordered(f, wanted)
        sums = np.cumsum(stats, 0)
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        if spec.splitter == "random":
            low, high = extents[f]
            u = fraction(seeds[f] ^ M2)
            drawn = low + np.minimum((u * (high - low)).astype(np.int64), np.maximum(high - low - 1, 0))
            at = np.flatnonzero(wanted)
            places = np.searchsorted(node * 256 + b, at * 256 + drawn[at], "right") - 1
        else:
            places = np.flatnonzero((node[1:] == node[:-1]) & (b[1:] != b[:-1]))
        if not len(places):
            continue
        start = np.zeros(n, np.int64)
        start[node[first]] = first
        owner = node[places]
        left = sums[places] - (sums[start[owner]] - stats[start[owner]])
        right = totals[owner] - left
        gain = before[owner] - spread(left, spec.criterion) - spread(right, spec.criterion)
        small = np.minimum(weight_of(left, spec.criterion), weight_of(right, spec.criterion)) < spec.min_leaf
        gain[small] = -np.inf
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        best = np.maximum.reduceat(gain, starts)
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(owner))))
        hits = np.flatnonzero(gain == best[of])
        hit = hits[np.unique(of[hits], return_index=True)[1]]
        who = owner[hit]
        better = gain[hit] > np.maximum(out.gain[who] * (1 + 1e-12), least[who])
        hit, who = hit[better], who[better]
        out.feature[who], out.bin[who] = f, b[places[hit]]
        out.left[who], out.gain[who] = left[hit], gain[hit]
    return out


def children(path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mixed(path * np.uint64(2) + M1), mixed(path * np.uint64(2) + M2)


def root_path(spec: Spec) -> np.ndarray:
    return mixed(np.array([(spec.seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)], np.uint64))


def may_split(totals: np.ndarray, depth: np.ndarray, spec: Spec) -> np.ndarray:
    w = weight_of(totals, spec.criterion)
    open_ = (w >= spec.min_split) & (w >= 2 * spec.min_leaf) & (depth < spec.max_depth)
    if spec.criterion != "variance":
        open_ &= spread(totals, spec.criterion) > 1e-10 * w
    return open_


@dataclass
class Nodes:
    """A tree, or a part of one, as arrays; node 0 is its root. ``held``: rows not learned from."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    stats: np.ndarray
    held: np.ndarray

    def __len__(self) -> int:
        return len(self.feature)

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row (features x rows)."""
        at = np.zeros(bins.shape[1], np.int64)
        rows = np.flatnonzero(self.feature[at] >= 0)
        while len(rows):
            node = at[rows]
            right = bins[self.feature[node], rows] > self.bin[node]
            at[rows] = np.where(right, self.right[node], self.left[node])
            rows = rows[self.feature[at[rows]] >= 0]
        return at


def grow_rows(
    bins: np.ndarray, stats: np.ndarray, learned: np.ndarray, spec: Spec, depth: int, path: np.ndarray
) -> Nodes:
    """Grow a subtree on rows in memory, all nodes of a level at once.

    ``stats`` are weighted channels; rows that are not ``learned`` only go along to the leaves.
    """
    channels = stats.shape[1]
    parts = []  # one entry a level: feature, bin, left, right, depth, stats
    n, total = 1, 1
    # The rows that are left to split, in the order of their nodes.
    x, s = bins[:, learned], np.ascontiguousarray(stats[learned].T)
    node, whole = np.zeros(x.shape[1], np.int64), bool((s == np.rint(s)).all())
    while True:
        sums = np.stack([np.bincount(node, c, n) for c in s], 1)
        depths = np.full(n, depth)
        feature, b = np.full(n, -1), np.full(n, -1)
        left, right = np.full(n, -1), np.full(n, -1)
        opened = np.flatnonzero(may_split(sums, depths, spec))
        split = opened[:0]
        if len(opened):
            if len(opened) < n:
                index = np.full(n, -1)
                index[opened] = np.arange(len(opened))
                node = index[node]
                rows = np.flatnonzero(node >= 0)
                x, s, node = x[:, rows], s[:, rows], node[rows]
            splits = choose(Rows(x, s, node, whole), sums[opened], path[opened], spec)
            taken = splits.feature >= 0
            split = opened[taken]
            feature[split], b[split] = splits.feature[taken], splits.bin[taken]
            left[split] = total + 2 * np.arange(len(split))
            right[split] = left[split] + 1
        parts.append((feature, b, left, right, depths, sums))
        if not len(split):
            break
        rows = np.flatnonzero(taken[node])
        node = node[rows]
        goes_right = x[splits.feature[node], rows] > splits.bin[node]
        child = 2 * (np.cumsum(taken) - 1)[node] + goes_right
        n, total, depth = 2 * len(split), total + 2 * len(split), depth + 1
        order = np.argsort(child.astype(np.uint16) if n <= 1 << 16 else child, kind="stable")
        rows, node = rows[order], child[order]
        x, s = x[:, rows], s[:, rows]
        path = np.stack(children(path[split]), 1).ravel()
    tree = Nodes(*[np.concatenate(c) for c in zip(*parts)], np.zeros((total, channels)))
    if not learned.all():
        apart = stats[~learned]
        at = tree.leaf_of(bins[:, ~learned])
        tree.held = np.stack([np.bincount(at, apart[:, c], total) for c in range(channels)], 1)
    return tree


# growing all trees


@dataclass
class _Top:
    """The part of a tree that is grown by levels, on the driver: nodes of many rows."""

    spec: Spec
    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [-1])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    depth: list = field(default_factory=lambda: [0])
    stats: list = field(default_factory=lambda: [None])
    path: list = field(default_factory=list)
    box: list = field(default_factory=lambda: [()])

    def __post_init__(self):
        self.path = [root_path(self.spec)[0]]

    def walker(self) -> Nodes:
        none = np.zeros((0, 0))
        return Nodes(*(np.array(x) for x in (self.feature, self.bin, self.left, self.right, self.depth)), none, none)

    def split(self, node: int, feature: int, b: int, left: np.ndarray) -> list[int]:
        """Children of a split node: their boxes tell which trees share them."""
        i = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.right[node] = feature, b, i, i + 1
        a, c = children(np.array([self.path[node]], np.uint64))
        sides = dict(self.box[node])
        low, high = sides.get(feature, (-1, 256))
        for path, bounds, sums in (
            (a[0], (low, min(b, high)), left), (c[0], (max(b, low), high), self.stats[node] - left)
        ):
            for column, value in zip(
                (self.feature, self.bin, self.left, self.right, self.depth, self.stats, self.path, self.box),
                (-1, -1, -1, -1, self.depth[node] + 1, sums, path, tuple(sorted((sides | {feature: bounds}).items()))),
            ):
                column.append(value)
        return [i, i + 1]


def _cells(tops: list[_Top], wanted: list[tuple[int, int]]) -> tuple[list[list[tuple[int, int]]], dict]:
    """Nodes (tree, node) with the same rows, together; and per owning tree its nodes' cells."""
    shared: dict = {}
    for tree, node in wanted:
        top = tops[tree]
        shared.setdefault((top.spec.rows(), top.box[node]), []).append((tree, node))
    cells = list(shared.values())
    owned: dict = {}
    for cell, members in enumerate(cells):
        tree, node = members[0]
        owned.setdefault(tree, {})[node] = cell
    return cells, owned


def _walks(tops: list[_Top], owned: dict) -> list[tuple]:
    """What tasks need to find the cells of rows: (tree, spec, walker, cell of each node).

    Trees on the same rows follow each other, so that tasks hold the weights of one of them.
    """
    out: dict[tuple, list[tuple]] = {}
    for tree, nodes in owned.items():
        cell = np.full(len(tops[tree].feature), -1)
        for node, c in nodes.items():
            cell[node] = c
        out.setdefault(tops[tree].spec.rows(), []).append((tree, tops[tree].spec, tops[tree].walker(), cell))
    return [walk for same in out.values() for walk in same]


def _weighted(block: Block, walks: list[tuple]) -> Iterator[tuple]:
    """The walks, each with the weights of a block's rows."""
    rows, w = None, None
    for tree, spec, walker, cell_of in walks:
        if spec.rows() != rows:
            rows, w = spec.rows(), block.weights(spec)
        yield tree, spec, walker, cell_of, w


def _level(data: Binned, tops: list[_Top], wanted: list[tuple[int, int]]) -> dict[tuple[int, int], tuple]:
    """Splits (feature, bin, left) of nodes, from one pass of histograms."""
    cells, owned = _cells(tops, wanted)
    features, channels = len(data.features), data.channels
    width = max((len(e) for e in data.edges), default=0) + 1
    size = features * width * channels
    walks = _walks(tops, owned)
    at_once = max(1, HISTOGRAM_CELLS // size)
    data_stats, plain = Binned(None, [], [], channels, data.gradients).stats_of, data.gradients is None
    members = [[(t, n, tops[t].spec, tops[t].path[n]) for t, n in m] for m in cells]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def sent():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([h.tobytes() for h in held.values()], pa.binary())],
                names=["cell", "counts"],
            )
            held.clear()

        for block in _large(batches, plain):
            for _, spec, walker, cell_of, w in _weighted(block, walks):
                rows = np.flatnonzero(w > 0)
                cell = cell_of[walker.leaf_of(block.bins[:, rows])]
                rows, cell = rows[cell >= 0], cell[cell >= 0]
                if not len(rows):
                    continue
                stats = data_stats(block, spec)
                used, index = np.unique(cell, return_inverse=True)
                for low in range(0, len(used), at_once):
                    part = (index >= low) & (index < low + at_once)
                    mine, i = rows[part], index[part] - low
                    n = min(at_once, len(used) - low)
                    counts = np.zeros((n, features, width, channels))
                    weighted = [stats[mine, c] * w[mine] for c in range(channels)]
                    for f in range(features):
                        place = i * width + block.bins[f, mine]
                        for c in range(channels):
                            counts[:, f, :, c] = np.bincount(place, weighted[c], n * width).reshape(n, width)
                    for k, one in zip(used[low : low + n].tolist(), counts):
                        if k in held:
                            held[k] += one
                        else:
                            held[k] = one
                    if len(held) >= at_once:
                        yield from sent()
        if held:
            yield from sent()

    def decide(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x).reshape(1, features, width, channels) for x in group.column("counts").to_pylist())
        out = []
        totals = counts[:, 0].sum(1)
        for tree, node, spec, path in members[key[0].as_py()]:
            s = choose(Histograms(counts, spec.criterion), totals, np.array([path], np.uint64), spec)
            out.append((tree, node, int(s.feature[0]), int(s.bin[0]), s.left[0].tolist(), totals[0].tolist()))
        columns = list(zip(*out))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["tree", "node", "feature", "bin", "left", "total"]
        )

    schema = "tree int, node int, feature int, bin int, left array<double>, total array<double>"
    sent = data.blocks.mapInArrow(count, "cell int, counts binary").groupBy("cell").applyInArrow(decide, schema)
    return {(r["tree"], r["node"]): (r["feature"], r["bin"], np.array(r["left"]), np.array(r["total"])) for r in sent.collect()}


PARTS = (
    "tree int, at int, feature array<int>, bin array<int>, left array<int>, right array<int>, "
    "depth array<int>, stats array<double>, held array<double>"
)


def _part(tree: int, at: int, nodes: Nodes) -> tuple:
    numbers = [x.astype(np.int32) for x in (nodes.feature, nodes.bin, nodes.left, nodes.right, nodes.depth)]
    return (tree, at, *numbers, nodes.stats.ravel(), nodes.held.ravel())


@dataclass
class Forest:
    """Grown trees. ``parts`` is a stored table of subtrees; the tops are on the driver."""

    data: Binned
    tops: list[_Top]
    parts: DataFrame

    def top_rows(self, held: dict) -> list[tuple]:
        rows = []
        for tree, top in enumerate(self.tops):
            w = top.walker()
            w.stats = np.array(top.stats)
            w.held = np.array([held.get((tree, n), np.zeros(self.data.channels)) for n in range(len(w))])
            rows.append(_part(tree, -1, w))
        return rows


def _grow_tops(data: Binned, specs: Sequence[Spec], local_rows: int) -> tuple[list[_Top], list[tuple[int, int]]]:
    """The trees down to nodes of few rows, and those nodes, all trees a level at a time."""
    tops = [_Top(s) for s in specs]
    waiting = [(t, 0) for t in range(len(tops))]
    small: list[tuple[int, int]] = []
    started = False
    while waiting:
        opened = []
        for (tree, node), (feature, b, left, total) in _level(data, tops, waiting).items():
            top = tops[tree]
            if not started:
                top.stats[node] = total
                if not may_split(total[None], np.array([0]), top.spec)[0]:
                    continue
                if weight_of(total[None], top.spec.criterion)[0] <= local_rows:
                    small.append((tree, node))
                    continue
            if feature >= 0:
                opened += [(tree, child) for child in top.split(node, feature, b, left)]
        if not started:
            # Trees without a row that they learn from are single empty leaves.
            for top in tops:
                if top.stats[0] is None:
                    top.stats[0] = np.zeros(data.channels)
        started = True
        waiting = []
        for tree, node in opened:
            top = tops[tree]
            total = top.stats[node][None]
            if may_split(total, np.array([top.depth[node]]), top.spec)[0]:
                w = weight_of(total, top.spec.criterion)[0]
                (small if w <= local_rows else waiting).append((tree, node))
    return tops, small


def grow(data: Binned, specs: Sequence[Spec], local_rows: int = LOCAL_ROWS) -> Forest:
    """Grow all trees; the table of their parts is written to the shared folder."""
    spark = data.blocks.sparkSession
    if math.prod(data.widths()) <= POSITIONS_PER_ROW * local_rows:
        parts = stored(_grow_positions(data, specs, local_rows))
        there = {r["tree"] for r in parts.where("at < 0").select("tree").collect()}
        leaf = [x.tolist() for x in _part(0, -1, _leaf(data.channels))[2:]]
        empty = [(t, -1, *leaf) for t in range(len(specs)) if t not in there]
        if empty:  # trees without any row
            parts = parts.unionByName(spark.createDataFrame(empty, PARTS))
        return Forest(data, [_Top(s) for s in specs], parts)
    tops, small = _grow_tops(data, specs, local_rows)
    forest = Forest(data, tops, None)
    grown, held = _finish(data, tops, small)
    whole = [(*r[:2], *[x.tolist() for x in r[2:]]) for r in forest.top_rows(held)]
    top_parts = spark.createDataFrame(whole, PARTS)
    forest.parts = stored(top_parts.unionByName(grown)) if grown is not None else stored(top_parts)
    return forest


GAINS = "tree int, feature int, gain double"


def _gains(tree: int, nodes: Nodes, spec: Spec, features: int) -> list[tuple]:
    inner = np.flatnonzero(nodes.feature >= 0)
    impure = spread(nodes.stats, spec.criterion)
    gain = impure[inner] - impure[nodes.left[inner]] - impure[nodes.right[inner]]
    sums = np.bincount(nodes.feature[inner], gain, features).astype(float)
    return [(tree, f, x) for f, x in enumerate(sums.tolist())]


def split_gains(data: Binned, specs: Sequence[Spec], local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(tree, feature, gain): impurity times weight that the splits of a feature remove from a tree.

    The trees are grown as in ``grow``, but the tasks that grow their parts keep only these sums, and
    rows that a tree does not learn from are not sent. The rows of a tree are to be added up.
    """
    if math.prod(data.widths()) <= POSITIONS_PER_ROW * local_rows:
        return _grow_positions(data, specs, local_rows, gains=True)
    tops, small = _grow_tops(data, specs, local_rows)
    rows = []
    for tree, top in enumerate(tops):
        nodes = top.walker()
        nodes.stats = np.array(top.stats)
        rows += _gains(tree, nodes, top.spec, len(data.features))
    added = data.blocks.sparkSession.createDataFrame(rows, GAINS)
    grown, _ = _finish(data, tops, small, gains=True)
    return added if grown is None else added.unionByName(grown)


def grow_shallow(data: Binned, specs: Sequence[Spec]) -> list[Nodes]:
    """Trees of a small depth, by levels alone; their nodes are no more than the depth allows."""
    out = []
    for top in _grow_tops(data, specs, 0)[0]:
        tree = top.walker()
        tree.stats = np.array(top.stats)
        tree.held = np.zeros_like(tree.stats)
        out.append(tree)
    return out


def _gathered(blocks: Iterator[Block], at_once: float | None = None, most: float = math.inf) -> Iterator[Block]:
    """Blocks joined to larger ones of about ``at_once`` rows, or ``most`` bytes if that is less."""
    held: list[Block] = []

    def joined() -> Block:
        one = Block(
            np.concatenate([b.bins for b in held], 1),
            *[np.concatenate([getattr(b, c) for b in held]) for c in ("stats", "fold", "hash")],
        )
        held.clear()
        return one

    for block in blocks:
        held.append(block)
        size = sum(b.bins.nbytes + b.stats.nbytes + 10 * len(b.fold) for b in held)
        if sum(len(b.fold) for b in held) >= (at_once or GATHERED_ROWS) or size >= most:
            yield joined()
    if held:
        yield joined()


def _large(batches: Iterator[pa.RecordBatch], plain: bool) -> Iterator[Block]:
    """Blocks for passes that handle a block tree by tree: large ones, if no row has scores to keep."""
    blocks = blocks_of(batches)
    return _gathered(blocks, most=GATHERED_BYTES) if plain else blocks


def _narrow(x: np.ndarray) -> bytes:
    """Numbers as 16-bit counts if they are such, else as they are."""
    counts = x.astype(np.uint16) if x.size and 0 <= x.min() and x.max() < 1 << 16 else None
    return counts.tobytes() if counts is not None and np.array_equal(counts, x) else x.tobytes()


def _widened(raw: bytes, n: int, channels: int) -> np.ndarray:
    narrow = n and len(raw) == 2 * n * channels
    return np.frombuffer(raw, np.uint16 if narrow else np.float64).reshape(n, channels).astype(np.float64)


def _taken(tree: Nodes, nodes: list[int]) -> Nodes:
    """Nodes of a tree in a new order; children that are left out end in leaves."""
    new = np.full(len(tree) + 1, -1)
    new[nodes] = np.arange(len(nodes))
    inner = new[tree.left[nodes]] >= 0
    columns = [np.where(inner, x, -1) for x in (
        tree.feature[nodes], tree.bin[nodes], new[tree.left[nodes]], new[tree.right[nodes]]
    )]
    return Nodes(*columns, tree.depth[nodes], tree.stats[nodes], tree.held[nodes])


def _parted(number: int, tree: Nodes, spec: Spec, local_rows: int) -> list[tuple]:
    """The parts of a whole tree, numbered as if nodes of few rows had been grown apart."""
    opens, weight = may_split(tree.stats, tree.depth, spec), weight_of(tree.stats, spec.criterion)
    top, waiting, small = [0], [0], []
    if opens[0] and weight[0] <= local_rows:
        waiting, small = [], [(0, 0)]
    while waiting:
        opened = [c for x in waiting if tree.feature[x] >= 0 for c in (int(tree.left[x]), int(tree.right[x]))]
        small += [(len(top) + i, x) for i, x in enumerate(opened) if opens[x] and weight[x] <= local_rows]
        waiting = [x for x in opened if opens[x] and weight[x] > local_rows]
        top += opened
    out = [_part(number, -1, _taken(tree, top))]
    for at, root in small:
        nodes, level = [], [root]
        while level:
            nodes += level
            level = [c for x in level if tree.feature[x] >= 0 for c in (int(tree.left[x]), int(tree.right[x]))]
        out.append(_part(number, at, _taken(tree, nodes)))
    return out


def _grow_positions(data: Binned, specs: Sequence[Spec], local_rows: int, gains: bool = False) -> DataFrame:
    """Whole trees, or their gains, from sums by position (the bins of all features) in place of rows."""
    widths, channels = data.widths(), data.channels
    strides = np.cumprod([1, *widths[:-1]])
    data_stats = Binned(None, [], [], channels, data.gradients).stats_of
    shared: dict[tuple, list[int]] = {}
    for tree, spec in enumerate(specs):
        shared.setdefault(spec.rows(), []).append(tree)
    # Trees on the same rows are dealt over tasks as well.
    tasks = 4 * data.blocks.sparkSession.sparkContext.defaultParallelism
    at_once = -(-len(specs) // tasks)
    parts = [(rows, trees[i : i + at_once]) for rows, trees in shared.items() for i in range(0, len(trees), at_once)]
    members = [[(t, specs[t]) for t in trees] for _, trees in parts]
    cells: dict[tuple, list[int]] = {}
    for cell, (rows, _) in enumerate(parts):
        cells.setdefault(rows, []).append(cell)
    wanted = [(specs[shared[rows][0]], numbers) for rows, numbers in cells.items()]
    schema = "cell int, learned int, position binary, stats binary"

    plain = data.gradients is None

    def sums(block: Block) -> Iterator[pa.RecordBatch]:
        position = (block.bins.astype(np.int64) * strides[:, None]).sum(0)
        used, index = np.unique(position, return_inverse=True)
        if plain:  # draws of few rows at once stay near the processor
            cuts = [slice(low, low + DRAWN_ROWS) for low in range(0, len(index), DRAWN_ROWS)]
            pieces = [(block.part(rows), index[rows]) for rows in cuts]
        else:
            pieces = [(block, index)]
        for spec, numbers in wanted:
            added = np.zeros((2, channels, len(used)))
            there = np.zeros((2, len(used)), bool)
            for piece, at in pieces:
                w, stats = piece.weights(spec), data_stats(piece, spec)
                apart = np.zeros(0, np.int64) if gains else np.flatnonzero(piece.held(spec) & ~(w > 0))
                for learned, rows in ((1, np.flatnonzero(w > 0)), (0, apart)):
                    i = at[rows]
                    there[learned, i] = True
                    for c in range(channels):
                        weighted = stats[rows, c] * w[rows] if learned else stats[rows, c]
                        low, high = (int(i.min()), int(i.max()) + 1) if len(i) else (0, 0)
                        added[learned, c, low:high] += np.bincount(i - low, weighted, high - low)
            out = []
            for learned in (1, 0):
                some = np.flatnonzero(there[learned])
                if len(some):
                    sent = (learned, used[some].astype(np.int32).tobytes(), _narrow(added[learned][:, some].T.copy()))
                    out += [(cell, *sent) for cell in numbers]
            if out:
                yield _table(out, schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _gathered(blocks_of(batches)):
            yield from sums(block)

    def send_part(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        (block,) = _gathered(blocks_of(iter(group.to_batches())), math.inf)
        order = np.argsort((block.bins.astype(np.int64) * strides[:, None]).sum(0), kind="stable")
        return pa.Table.from_batches(list(sums(block.part(order))), _table([], schema).schema)

    def finish(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        codes, stats = [], []
        for p in group.to_pylist():
            position = np.frombuffer(p["position"], np.int32).astype(np.int64)
            codes.append(2 * position + p["learned"])
            stats.append(_widened(p["stats"], len(position), channels))
        used, index = np.unique(np.concatenate(codes), return_inverse=True)
        stats = np.concatenate(stats)
        sums = np.stack([np.bincount(index, stats[:, c], len(used)) for c in range(channels)], 1)
        bins = np.stack([(used >> 1) // stride % width for stride, width in zip(strides, widths)]).astype(np.uint8)
        learned = (used & 1).astype(bool)
        out = []
        for t, spec in members[key[0].as_py()]:
            tree = grow_rows(bins, sums, learned, spec, 0, root_path(spec))
            out += _gains(t, tree, spec, len(widths)) if gains else _parted(t, tree, spec, local_rows)
        return _gained(out) if gains else _parts(out)

    rows = data.blocks.agg(F.sum("n")).first()[0] or 0
    if plain and rows > DEALT_ROWS:
        # A position is added up in one part: what is sent does not grow with the rows.
        sent = _dealt(data, strides, rows).groupBy("part").applyInArrow(send_part, schema)
    else:
        sent = data.blocks.mapInArrow(send, schema)
    return sent.groupBy("cell").applyInArrow(finish, GAINS if gains else PARTS)


def _dealt(data: Binned, strides: np.ndarray, rows: int) -> DataFrame:
    """Blocks by part, a part being a set of positions of about ``DEALT_ROWS`` rows at most; rows of a
    position that has more are dealt over several parts."""
    number = int(np.prod(data.widths()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(number, np.int64)
        for block in blocks_of(batches):
            found += np.bincount((block.bins.astype(np.int64) * strides[:, None]).sum(0), minlength=number)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["position", "n"])

    found = data.blocks.mapInArrow(count, "position long, n long").groupBy("position").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(number, np.int64)
    counts[np.asarray(found.column("position"))] = np.asarray(found.column("n"))
    parts = max(4 * data.blocks.sparkSession.sparkContext.defaultParallelism, -(-rows // DEALT_ROWS))
    share = -(-rows // parts)
    over = -(-counts // share)
    # Positions of more than a part's rows get parts of their own; the others fill parts in turn.
    shared = over <= 1
    first = np.cumsum(np.where(shared, counts, 0)) // share
    own = np.cumsum(np.where(shared, 0, over)) - np.where(shared, 0, over)
    first = np.where(shared, first, int(first.max()) + 1 + own).astype(np.int32)
    over = np.maximum(over, 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _gathered(blocks_of(batches)):
            position = (block.bins.astype(np.int64) * strides[:, None]).sum(0)
            part = first[position] + (mixed(block.hash + M1) % over[position].astype(np.uint64)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            for at in np.split(order, cuts):
                b = block.part(at)
                columns = (np.ascontiguousarray(b.bins), b.stats, b.fold, b.hash)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(part[at[0]])], pa.int32()), pa.array([len(at)], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
                    names=["part", "n", "bins", "stats", "fold", "hash"],
                )

    return data.blocks.mapInArrow(deal, "part int, n int, bins binary, stats binary, fold binary, hash binary")


def _leaf(channels: int) -> Nodes:
    none, zeros = np.array([-1]), np.zeros((1, channels))
    return Nodes(none, none, none, none, np.array([0]), zeros, zeros)


def _parts(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), *[pa.list_(pa.int32())] * 5, *[pa.list_(pa.float64())] * 2]
    names = [c.split()[0] for c in PARTS.split(", ")]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _gained(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.float64())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["tree", "feature", "gain"])


def _finish(data: Binned, tops: list[_Top], small: list[tuple[int, int]], gains: bool = False):
    """Subtrees of the small nodes, and what the other leaves of the tops hold of rows not learned from.

    With ``gains`` only the gains of the subtrees, and nothing of rows not learned from.
    """
    cells, owned = _cells(tops, small)
    channels = data.channels
    for tree in range(len(tops)):
        owned.setdefault(tree, {})
    walks = _walks(tops, owned)
    features = len(data.features)
    data_stats, plain = Binned(None, [], [], channels, data.gradients).stats_of, data.gradients is None
    members = [[(t, n, tops[t].spec, tops[t].depth[n], tops[t].path[n]) for t, n in m] for m in cells]
    schema = "cell int, tree int, node int, bins binary, stats binary, learned binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[tuple[int, int], np.ndarray] = {}
        for block in _large(batches, plain):
            for tree, spec, walker, cell_of, w in _weighted(block, walks):
                out = []
                apart = np.zeros(len(w), bool) if gains else block.held(spec)
                rows = np.flatnonzero((w > 0) | apart)
                leaf = walker.leaf_of(block.bins[:, rows])
                cell = cell_of[leaf]
                tally = apart[rows] & (cell < 0)
                for node in np.unique(leaf[tally]).tolist():
                    sums = data_stats(block, spec)[rows[tally & (leaf == node)]].sum(0)
                    tallies[tree, node] = tallies.get((tree, node), 0.0) + sums
                rows, cell = rows[cell >= 0], cell[cell >= 0]
                order = np.argsort(cell, kind="stable")
                rows, cell = rows[order], cell[order]
                starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else []
                stats = data_stats(block, spec)
                for at, part in zip(cell[starts].tolist(), np.split(rows, starts[1:])) if len(cell) else []:
                    learned = w[part] > 0
                    s = stats[part] * np.where(learned, w[part], 1.0)[:, None]
                    out.append((at, -1, -1, block.bins[:, part].tobytes(), _narrow(s), learned.tobytes()))
                if out:
                    yield _table(out, schema)
        if tallies:
            yield _table([(-1, t, n, b"", s.tobytes(), b"") for (t, n), s in tallies.items()], schema)

    def finish(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        pieces = group.to_pylist()
        stats = [_widened(p["stats"], len(p["learned"]), channels) for p in pieces]
        bins = np.concatenate(
            [np.frombuffer(p["bins"], np.uint8).reshape(features, -1) for p in pieces], 1
        )
        stats = np.concatenate(stats)
        learned = np.frombuffer(b"".join(p["learned"] for p in pieces), bool)
        out = []
        for t, n, spec, depth, path in members[key[0].as_py()]:
            tree = grow_rows(bins, stats, learned, spec, depth, np.array([path], np.uint64))
            out += _gains(t, tree, spec, features) if gains else [_part(t, n, tree)]
        return _gained(out) if gains else _parts(out)

    if gains:
        sent = data.blocks.mapInArrow(send, schema)
        return (sent.groupBy("cell").applyInArrow(finish, GAINS) if cells else None), {}
    sent = cut(data.blocks.mapInArrow(send, schema))
    held: dict[tuple[int, int], np.ndarray] = {}
    for r in sent.where("cell < 0").select("tree", "node", "stats").collect():  # leaves of the tops
        at = (r["tree"], r["node"])
        held[at] = held.get(at, 0.0) + np.frombuffer(r["stats"])
    if not cells:
        return None, held
    return sent.where("cell >= 0").groupBy("cell").applyInArrow(finish, PARTS), held


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    fields = [c.split() for c in ddl.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields]
    )


# trees put together again


def assembled(parts: list[dict], channels: int) -> Nodes:
    """One tree from its top (at -1) and its subtrees; held rows are counted at every node."""
    parts = sorted(parts, key=lambda p: p["at"])
    columns: list[list] = [[] for _ in range(7)]
    offset = 0
    roots = {}
    for p in parts:
        arrays = [np.array(p[c], np.int64) for c in ("feature", "bin", "left", "right", "depth")]
        for side in (2, 3):
            arrays[side] = np.where(arrays[side] >= 0, arrays[side] + offset, -1)
        for column, x in zip(columns, arrays):
            column.append(x)
        for column, c in zip(columns[5:], ("stats", "held")):
            column.append(np.array(p[c], np.float64).reshape(-1, channels))
        if p["at"] >= 0:
            roots[p["at"]] = offset
        offset += len(arrays[0])
    tree = Nodes(*[np.concatenate(c) for c in columns])
    # The root of a subtree takes the place of the top's leaf; its own row stays unused.
    for at, root in roots.items():
        for x in (tree.feature, tree.bin, tree.left, tree.right, tree.stats, tree.held):
            x[at] = x[root]
        tree.feature[root] = -1
    for d in range(int(tree.depth.max()) - 1, -1, -1):
        inner = np.flatnonzero((tree.depth == d) & (tree.feature >= 0))
        tree.held[inner] = tree.held[tree.left[inner]] + tree.held[tree.right[inner]]
    return tree


def reachable(tree: Nodes, stops: np.ndarray) -> np.ndarray:
    """The nodes at which rows end when the nodes marked in ``stops`` are leaves."""
    ends = stops | (tree.feature < 0)
    out, level = [], np.zeros(1, np.int64)
    while len(level):
        out.append(level[ends[level]])
        inner = level[~ends[level]]
        level = np.concatenate([tree.left[inner], tree.right[inner]])
    return np.concatenate(out)


def weakest_links(tree: Nodes, criterion: str, stops: np.ndarray | None = None) -> np.ndarray:
    """The alpha from which each node is a leaf of the best pruned tree; infinity for leaves.

    Repeatedly the nodes of weakest link collapse. Only ancestors of a collapsed node change, so
    links are kept in a heap and brought up to date along the way to the root.
    """
    from heapq import heapify, heappop, heappush

    n = len(tree)
    w = weight_of(tree.stats[:1], criterion)[0]
    risk = spread(tree.stats, criterion) / max(w, 1e-300)
    leaf = tree.feature < 0 if stops is None else (tree.feature < 0) | stops
    parent = np.full(n, -1)
    order, level = [], np.zeros(1, np.int64)
    while len(level):
        order.append(level)
        inner = level[~leaf[level]]
        for side in (tree.left, tree.right):
            parent[side[inner]] = inner
        level = np.concatenate([tree.left[inner], tree.right[inner]])
    below, leaves = risk.copy(), np.ones(n, np.int64)
    for nodes in order[::-1]:
        inner = nodes[~leaf[nodes]]
        below[inner] = below[tree.left[inner]] + below[tree.right[inner]]
        leaves[inner] = leaves[tree.left[inner]] + leaves[tree.right[inner]]
    alphas = np.full(n, np.inf)
    inner = np.concatenate([x[~leaf[x]] for x in order])
    link = np.full(n, np.inf)
    link[inner] = (risk[inner] - below[inner]) / (leaves[inner] - 1)
    heap = list(zip(link[inner].tolist(), inner.tolist()))
    heapify(heap)
    gone = np.zeros(n, bool)
    alpha = 0.0
    left, right, up = tree.left.tolist(), tree.right.tolist(), parent.tolist()
    while heap:
        g, node = heappop(heap)
        if gone[node] or g != link[node]:
            continue
        alpha = max(alpha, g)
        # The node collapses, and with it all that is left below it.
        stack = [node]
        while stack:
            x = stack.pop()
            if leaf[x] or gone[x]:
                continue
            gone[x] = True
            alphas[x] = alpha
            stack += [left[x], right[x]]
        gain, lost = risk[node] - below[node], leaves[node] - 1
        below[node], leaves[node] = risk[node], 1
        at = up[node]
        while at >= 0:
            below[at] += gain
            leaves[at] -= lost
            link[at] = (risk[at] - below[at]) / (leaves[at] - 1) if leaves[at] > 1 else -np.inf
            heappush(heap, (float(link[at]), at))
            at = up[at]
    return alphas

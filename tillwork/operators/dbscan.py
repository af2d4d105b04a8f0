"""DBSCAN on a grid whose cells are small enough that all points of a cell are neighbours.

A cell with ``min_samples`` points is all core and acts as one graph node, however many points it
holds. Only points of thinner cells are tested one by one, through the nearest-neighbour join.
Two core cells are linked when some pair of their core points is within eps: decided by bounding
boxes, which are halved for the cell pairs that the boxes leave open.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.operators.components import DRIVER_EDGES, connected_components
from tillwork.operators.neighbors import with_neighbours
from tillwork.operators.prefix import dense_index
from tillwork.session import cut, stored

MAX_HALVINGS = 40
#: Tables of at most so many cells are sent to the rows, which are then not shuffled.
BROADCAST_CELLS = 100_000


def dbscan(
    df: DataFrame,
    features: Sequence[str],
    eps: float,
    min_samples: int,
    key: str = "row_key",
    driver_edges: int = DRIVER_EDGES,
) -> DataFrame:
    """(key, cluster, is_core); a point counts as its own neighbour, noise is -1.

    Clusters are numbered by their smallest core key; a border point joins the lowest-numbered
    cluster that has a core point within eps.
    """
    d = len(features)
    side = eps / math.sqrt(d) * (1 - 1e-9)
    xs = [f"x{i}" for i in range(d)]
    rows = df.select(
        F.col(key).alias("key"),
        *[(F.col(c).cast("double") + F.lit(0.0)).alias(x) for c, x in zip(features, xs)],
    ).na.drop(subset=xs)
    # The table is read by every step below: its source plan runs once. Cells are worked out when read.
    located = stored(rows).withColumn("cell", F.array(*[F.floor(F.col(x) / F.lit(side)) for x in xs]))
    cells = cut(located.groupBy("cell").agg(F.count("*").alias("n")))

    def sent(some: DataFrame) -> DataFrame:
        """A table of at most all cells, for a join with rows."""
        return F.broadcast(some) if few else some

    few = cells.count() <= BROADCAST_CELLS
    thin = cells.where(F.col("n") < min_samples).select("cell")
    tested = cut(_test_thin_points(located, cells, thin, xs, eps, min_samples, sent))
    core_thin = tested.where("is_core").select("key", *xs, "cell")
    dense = cells.where(F.col("n") >= min_samples).select("cell")
    core = located.join(sent(dense), "cell", "left_semi").select("key", *xs, "cell").unionByName(core_thin)
    core_cells = cut(core.groupBy("cell").agg(F.min("key").alias("first_key")))
    links = _link_cells(core, core_cells, xs, eps, side, sent)
    graph = links.unionByName(
        core_cells.select(_cell_name("cell").alias("a"), _cell_name("cell").alias("b"))
    )
    component = connected_components(graph, driver_edges)
    named = core_cells.withColumn("node", _cell_name("cell")).join(component, "node")
    roots = named.groupBy("component").agg(F.min("first_key").alias("first_key"))
    numbered = dense_index(roots, "first_key", "cluster").select(
        "component", F.col("cluster").cast("int").alias("cluster")
    )
    of_cell = cut(named.join(numbered, "component").select("cell", "cluster"))
    in_dense = (
        located.join(sent(dense), "cell", "left_semi")
        .join(sent(of_cell), "cell")
        .select("key", "cluster", F.lit(True).alias("is_core"))
    )
    thin_core = tested.where("is_core").join(of_cell, "cell").select("key", "cluster", "is_core")
    # A neighbour within eps is a core point if its cell is dense or it was tested as core itself.
    near = (
        tested.where(~F.col("is_core"))
        .select("key", F.explode("near").alias("n"))
        .select("key", F.col("n.key").alias("other"), F.col("n.pos").alias("pos"))
        .withColumn("cell", F.transform("pos", lambda v: F.floor(v / F.lit(side))))
    )
    through_dense = near.join(dense, "cell", "left_semi").join(of_cell, "cell")
    through_thin = near.join(core_thin.select(F.col("key").alias("other")), "other", "left_semi").join(
        of_cell, "cell"
    )
    border = (
        through_dense.select("key", "cluster")
        .unionByName(through_thin.select("key", "cluster"))
        .groupBy("key")
        .agg(F.min("cluster").alias("cluster"))
    )
    others = (
        tested.where(~F.col("is_core"))
        .select("key")
        .join(border, "key", "left")
        .select("key", F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.lit(False).alias("is_core"))
    )
    return in_dense.unionByName(thin_core).unionByName(others).withColumnRenamed("key", key)


def _cell_name(cell: str) -> Column:
    return F.concat_ws(",", F.transform(cell, lambda v: v.cast("string")))


def _around(cells: DataFrame, d: int, half: bool = False) -> DataFrame:
    """(cell, other): all cells close enough to hold a point within eps of the cell."""
    reach = math.ceil(math.sqrt(d)) + 1
    offsets = [
        o
        for o in product(range(-reach, reach + 1), repeat=d)
        if sum(max(abs(v) - 1, 0) ** 2 for v in o) <= d * 1.0001 and (not half or o > (0,) * d)
    ]
    literal = ", ".join("array(" + ", ".join(map(str, o)) + ")" for o in offsets)
    return cells.withColumn("o", F.explode(F.expr(f"array({literal})"))).select(
        "cell", F.zip_with("cell", "o", lambda a, b: a + b).alias("other")
    )


def _test_thin_points(located, cells, thin, xs, eps, min_samples, sent):
    """Points of thin cells with their neighbours within eps, at most ``min_samples`` of them."""
    points = located.join(sent(thin), "cell", "left_semi")
    if thin.limit(1).count() == 0:
        kind = located.schema["key"].dataType.simpleString()
        entry = f"struct<d2: double, key: {kind}, payload: double, pos: array<double>>"
        empty = F.expr(f"cast(array() as array<{entry}>)")
        return points.select("key", *xs, "cell", empty.alias("near"), F.lit(False).alias("is_core"))
    around = _around(thin, len(xs)).select(F.col("other").alias("cell")).distinct()
    zone = cut(cells.select("cell").join(around, "cell", "left_semi"))
    candidates = located.join(sent(zone), "cell", "left_semi")
    found = with_neighbours(points, candidates, xs, min_samples, "key", keep=[*xs, "cell"])
    near = F.filter("neighbours", lambda n: n["d2"] <= F.lit(eps * eps))
    return found.select("key", *xs, "cell", near.alias("near")).withColumn(
        "is_core", F.size("near") >= min_samples
    )


def _link_cells(core, core_cells, xs, eps, side, sent):
    """(a, b): names of core cells that hold core points within eps of each other."""
    d = len(xs)
    bound = eps * eps

    def halved(level: int) -> Column:
        """Which part of its cell a point lies in."""
        inside = [F.col(x) - F.col("cell")[i] * F.lit(side) for i, x in enumerate(xs)]
        return F.array(*[F.floor(v / F.lit(side) * F.lit(2.0**level)) for v in inside])

    def nodes(level: int, rows: DataFrame) -> DataFrame:
        # After the last halving every position is a node of its own, which leaves nothing open.
        sub = halved(level) if level <= MAX_HALVINGS else F.array(*xs)
        return (
            rows.groupBy("cell", sub.alias("sub"), halved(max(level - 1, 0)).alias("parent"))
            .agg(
                F.array(*[F.min(x) for x in xs]).alias("lo"),
                F.array(*[F.max(x) for x in xs]).alias("hi"),
                F.min(F.array(*xs)).alias("rep"),
            )
        )

    def squares(term) -> Column:
        total = term(0) * term(0)
        for i in range(1, d):
            total = total + term(i) * term(i)
        return total

    def side_of(table: DataFrame, prefix: str) -> DataFrame:
        return table.select(*[F.col(c).alias(f"{prefix}{c}") for c in table.columns])

    first = cut(nodes(0, core).drop("parent"))
    pairs = (
        _around(core_cells.select("cell"), d, half=True)
        .withColumnsRenamed({"cell": "acell", "other": "bcell"})
        .join(side_of(first, "a"), "acell")
        .join(side_of(first, "b"), "bcell")
    )
    linked = None
    for level in range(MAX_HALVINGS + 2):
        near = squares(
            lambda i: F.greatest(F.col("blo")[i] - F.col("ahi")[i], F.col("alo")[i] - F.col("bhi")[i], F.lit(0.0))
        )
        far = squares(
            lambda i: F.greatest(F.col("bhi")[i] - F.col("alo")[i], F.col("ahi")[i] - F.col("blo")[i])
        )
        between = squares(lambda i: F.col("arep")[i] - F.col("brep")[i])
        judged = cut(
            pairs.withColumn("linked", (far <= bound) | (between <= bound)).where(near <= bound)
        )
        found = judged.where("linked").select("acell", "bcell").distinct()
        linked = found if linked is None else linked.unionByName(found)
        still = judged.where(~F.col("linked")).join(found, ["acell", "bcell"], "left_anti")
        if level > MAX_HALVINGS or still.limit(1).count() == 0:
            break
        # Only cells of open pairs are looked at more closely.
        open_cells = still.select(F.explode(F.array("acell", "bcell")).alias("cell")).distinct()
        finer = cut(nodes(level + 1, core.join(sent(open_cells), "cell", "left_semi")))
        a_side = side_of(finer, "a").withColumnRenamed("aparent", "asub_parent")
        b_side = side_of(finer, "b").withColumnRenamed("bparent", "bsub_parent")
        open_pairs = still.select(
            "acell", "bcell", F.col("asub").alias("asub_parent"), F.col("bsub").alias("bsub_parent")
        )
        pairs = open_pairs.join(a_side, ["acell", "asub_parent"]).join(b_side, ["bcell", "bsub_parent"])
    return linked.select(_cell_name("acell").alias("a"), _cell_name("bcell").alias("b"))

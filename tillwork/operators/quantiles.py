"""Exact quantiles without gathering a column in one task.

``percentile`` keeps every distinct value of a column in one aggregation buffer, so it is used
only once the row count is known to be small. Beyond that each order statistic is bracketed with
the bounded-memory ``percentile_approx``, the bracket is narrowed until it holds few distinct
values, and only those values are fetched.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 1_000_000
BRACKET_DISTINCT = 20_000


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    small_rows: int = SMALL_ROWS,
    bracket_distinct: int = BRACKET_DISTINCT,
    accuracy: int = 10_000,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column, nulls ignored."""
    columns, probs = list(columns), list(probs)
    if not columns:
        return {}
    frame = df.select(columns)
    counts = frame.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    sizes = {c: counts[f"n{i}"] for i, c in enumerate(columns)}
    small = [c for c in columns if sizes[c] <= small_rows]
    result: dict[str, list[float | None]] = {}
    if small:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        row = frame.agg(*[F.percentile(F.col(c), wanted).alias(c) for c in small]).first()
        for c in small:
            result[c] = list(row[c]) if row[c] is not None else [None] * len(probs)
    large = [c for c in columns if sizes[c] > small_rows]
    ranks = {c: sorted({r for p in probs for r in _neighbour_ranks(p, sizes[c])}) for c in large}
    values = _order_statistics(frame, ranks, sizes, bracket_distinct, accuracy)
    for c in large:
        result[c] = []
        for p in probs:
            position = (sizes[c] - 1) * p
            lower, upper = (values[c, r] for r in _neighbour_ranks(p, sizes[c]))
            result[c].append(lower + (upper - lower) * (position - math.floor(position)))
    return {c: result[c] for c in columns}


def _neighbour_ranks(p: float, n: int) -> tuple[int, int]:
    position = (n - 1) * p
    return math.floor(position), min(math.ceil(position), n - 1)


def _order_statistics(frame, ranks, sizes, bracket_distinct, accuracy):
    """Value at each zero-based rank, for every (column, rank)."""
    targets = [(c, r) for c, rs in ranks.items() for r in rs]
    found: dict[tuple[str, int], float] = {}
    # bracket: lowest and highest candidate value, and how many rows lie below the bracket
    open_: dict[tuple[str, int], tuple[float | None, float | None]] = {
        t: (None, None) for t in targets
    }
    below: dict[tuple[str, int], int] = dict.fromkeys(targets, 0)
    inside: dict[tuple[str, int], int] = {t: sizes[t[0]] for t in targets}
    while open_:
        narrowed = _narrow(frame, open_, below, inside, accuracy)
        checks = []
        for i, (t, (lo, hi)) in enumerate(narrowed.items()):
            c = F.col(t[0])
            within = c.between(lo, hi)
            checks += [
                F.count_if(c < lo).alias(f"b{i}"),
                F.count_if(within).alias(f"i{i}"),
                F.approx_count_distinct(F.when(within, c)).alias(f"d{i}"),
            ]
        row = frame.agg(*checks).first()
        fetch = []
        for i, (t, (lo, hi)) in enumerate(narrowed.items()):
            if not row[f"b{i}"] <= t[1] < row[f"b{i}"] + row[f"i{i}"]:
                # The sketch missed the rank: keep the old bracket and ask for a finer sketch.
                continue
            open_[t], below[t], inside[t] = (lo, hi), row[f"b{i}"], row[f"i{i}"]
            if lo == hi:
                found[t] = lo
                del open_[t]
            elif row[f"d{i}"] <= bracket_distinct:
                fetch.append(t)
        accuracy *= 2
        for t in fetch:
            lo, hi = open_.pop(t)
            c = F.col(t[0])
            groups = frame.where(c.between(lo, hi)).groupBy(c.alias("v")).agg(F.count("*").alias("n"))
            remaining = t[1] - below[t]
            for value, n in sorted((r["v"], r["n"]) for r in groups.toLocalIterator()):
                if remaining < n:
                    found[t] = value
                    break
                remaining -= n
    return found


def _narrow(frame, open_, below, inside, accuracy):
    """One sketch job: tighter brackets around every open rank."""
    sketches = []
    for i, (t, (lo, hi)) in enumerate(open_.items()):
        c = F.col(t[0])
        scope = c if lo is None else F.when(c.between(lo, hi), c)
        p = (t[1] - below[t]) / max(inside[t] - 1, 1)
        slack = 2.0 / accuracy
        edges = F.array(F.lit(max(p - slack, 0.0)), F.lit(min(p + slack, 1.0)))
        sketches.append(F.percentile_approx(scope, edges, accuracy).alias(f"q{i}"))
    row = frame.agg(*sketches).first()
    return {t: tuple(row[f"q{i}"]) for i, t in enumerate(open_)}

"""Structure repair of conversations by weighted interval parsing.

A repaired conversation has role initials ``(s?(ua)+)?``. Repairs are parsed bottom-up, by span
length, over a grammar in Chomsky normal form. A nonterminal ``pq`` covers the rewritings of a span
that lead from point p of that pattern to point q: 0 nothing yet, 1 after s, 2 after u, 3 after a.

* ``pq -> pr rq`` for every point r;
* ``pq -> row`` for each edit of one row: keep, rerole, delete;
* ``pq ->`` nothing but insertions: the closure, applied at both ends of every row.

A cell holds the least (cost, audit) of its span and nonterminal. Since every point r has its rule,
all splits of a span give the same cell, so one split of each span is enough: spans of 1, 2, 4, ...
rows. The audits of equal cost are never prefixes of one another (they cover the same rows, and
more insertions cost more), so the least audit of a whole is put together from least audits.

Rows are sorted over the whole table by (conversation, turn, role, text), so a conversation of any
length is dealt over many tasks. A task parses chunks of at most ``CHUNK`` rows. A conversation that
lies inside one chunk is finished there. Of the others the cells of the chunks are combined in a
second step, 16 cells with a letter a row each; their texts stay in chunks, which are rewritten once
the points at their ends are known, and hashed in order as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillwork.llm.base import frugal, null_safe, partitions, query, small_batches, table
from tillwork.session import cut

#: Rows parsed as one span by one task before cells go to the second step.
CHUNK = 256
KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: White space, end marks and legal neighbours of role initials (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
END_MARKS = ".!?"
LEGAL = {"su", "ua", "au"}
#: Points of the pattern before and after a user and an assistant.
STEPS = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
POINTS = range(4)
ACCEPTED = (0, 3)
#: Role sequences remembered by a task before it starts afresh.
MEMORY = 20_000

Cell = tuple[int, str]
Cells = dict[tuple[int, int], Cell]


def product(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two parts."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in POINTS:
            other = right.get((r, q))
            if other is not None:
                found = (cost + other[0], audit + other[1])
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def _closure() -> Cells:
    """Insertions alone; a second round through the same point never pays."""
    out: Cells = {(p, p): (0, "") for p in POINTS}
    inserts = {step: (INSERT_COST, INSERT) for initial in "ua" for step in STEPS[initial]}
    for _ in POINTS:
        out = product(out, {(p, p): (0, "") for p in POINTS} | inserts)
    return out


CLOSURE = _closure()


def leaf(initial: str, forced: bool, truncated: bool, copies: int) -> Cells:
    """Cells of one row and its later copies, which have to go."""
    extra = (DELETE_COST * (copies - 1), DELETE * (copies - 1))
    cells: Cells = {}

    def offer(step: tuple[int, int], cost: int, letter: str) -> None:
        found = (cost + extra[0], letter + extra[1])
        cells[step] = min(cells.get(step, found), found)

    for p in POINTS:
        offer((p, p), DELETE_COST, DELETE)
    if not forced:
        penalty = TRUNCATED_COST if truncated else 0
        for step in STEPS.get(initial, ()):
            offer(step, penalty, KEEP)
        for step in STEPS["u"] + STEPS["a"]:
            offer(step, REROLE_COST + penalty, REROLE)
    return product(product(CLOSURE, cells), CLOSURE)


def levels(leaves: list[Cells]) -> list[list[Cells]]:
    """Cells of the spans of 1, 2, 4, ... parts, up to the whole; an odd last one moves up."""
    out = [leaves]
    while len(out[-1]) > 1:
        last = out[-1]
        pairs = [product(a, b) for a, b in zip(last[::2], last[1::2])]
        out.append(pairs + ([last[-1]] if len(last) % 2 else []))
    return out


def best(cells: Cells) -> tuple[tuple[int, int], Cell]:
    """The accepted nonterminal of least (cost, audit)."""
    return min((((0, q), cells[0, q]) for q in ACCEPTED if (0, q) in cells), key=lambda x: x[1])


def trace(spans: list[list[Cells]], pq: tuple[int, int]) -> list[tuple[int, int]]:
    """The nonterminal of each part, given that of the whole."""
    wanted = [pq]
    for below, above in zip(spans[-2::-1], spans[:0:-1]):
        parts = []
        for i, (p, q) in enumerate(wanted):
            if 2 * i + 1 == len(below):
                parts.append((p, q))
                continue
            left, right = below[2 * i], below[2 * i + 1]
            r = next(
                r for r in POINTS
                if (p, r) in left and (r, q) in right
                and tuple(a + b for a, b in zip(left[p, r], right[r, q])) == above[i][p, q]
            )
            parts += [(p, r), (r, q)]
        wanted = parts
    return wanted


def rewrite(rows: list[tuple[str, str, int]], audit: str, point: int = 0) -> list[str]:
    """Lines ``role:text`` after the edits of an audit, for rows (role, text, copies)."""
    source = iter([(role, text) for role, text, copies in rows for _ in range(copies)])
    out = []
    for letter in audit:
        role, text = ("", "") if letter == INSERT else next(source)
        if letter == DELETE:
            continue
        if letter != KEEP:
            role = "assistant" if point == 2 else "user"
        out.append(f"{role}:{text}")
        point = {"s": 1, "u": 2, "a": 3}[role[0]]
    return out


class Parser:
    """Parses spans of rows (initial, forced, truncated, copies); remembers whole sequences."""

    def __init__(self, memory: int = MEMORY):
        self.memory = memory
        self.leaves: dict[tuple, Cells] = {}
        self.spans: dict[tuple, Cells] = {}

    def leaf(self, kind: tuple) -> Cells:
        if kind not in self.leaves:
            if len(self.leaves) > self.memory:
                self.leaves.clear()
            self.leaves[kind] = leaf(*kind)
        return self.leaves[kind]

    def span(self, kinds: tuple) -> Cells:
        if not kinds:
            return {(p, p): (0, "") for p in POINTS}
        if len(kinds) > 16:
            return levels([self.leaf(k) for k in kinds])[-1][0]
        if kinds not in self.spans:
            if len(self.spans) > self.memory:
                self.spans.clear()
            self.spans[kinds] = levels([self.leaf(k) for k in kinds])[-1][0]
        return self.spans[kinds]


COUNTS = ("blank", "duplicate", "truncated", "illegal")
#: What a chunk tells of its rows; ``first``/``last`` are the initials at its ends.
SUMMARY = (
    "low long, high long, turns long, first_turn long, last_turn long, "
    + ", ".join(f"{c} long" for c in COUNTS)
    + ", first string, last string"
)


def summarize(rows: list[dict]) -> dict:
    """Counts over rows in order, each with its copies."""
    out = dict.fromkeys(COUNTS, 0) | dict.fromkeys(("low", "high", "first_turn", "last_turn", "first", "last"))
    out["turns"] = 0
    for row in rows:
        n = row["copies"]
        if not n:
            continue
        if row["blank"]:
            out["blank"] += n
        else:
            out["duplicate"] += n if row["repeats"] else n - 1
            out["truncated"] += bool(row["truncated"] and not row["repeats"])
        initial = row["role"][:1]
        out["illegal"] += n - 1
        if out["last"] is None:
            out["first"] = initial
        elif out["last"] + initial not in LEGAL:
            out["illegal"] += 1
        out["last"] = initial
        turn = row["turn"]
        if turn is not None:
            if out["low"] is None:
                out["low"] = out["first_turn"] = turn
            out["turns"] += out["last_turn"] != turn
            out["high"] = out["last_turn"] = turn
    return out


def merge(a: dict, b: dict) -> dict:
    """The summary of two neighbouring chunks."""
    if b["last"] is None:
        return a
    if a["last"] is None:
        return b
    out = {c: a[c] + b[c] for c in COUNTS}
    out["illegal"] += a["last"] + b["first"] not in LEGAL
    out["turns"] = a["turns"] + b["turns"] - (a["last_turn"] is not None and a["last_turn"] == b["first_turn"])
    out["first"], out["last"] = a["first"], b["last"]
    out["low"] = b["low"] if a["low"] is None else a["low"]
    out["first_turn"] = b["first_turn"] if a["first_turn"] is None else a["first_turn"]
    out["high"] = a["high"] if b["high"] is None else b["high"]
    out["last_turn"] = a["last_turn"] if b["last_turn"] is None else b["last_turn"]
    return out


def gaps(summary: dict) -> int:
    return 0 if summary["low"] is None else summary["high"] - summary["low"] + 1 - summary["turns"]


CHUNKS = (
    "conv_id {conv}, part int, chunk int, whole boolean, gaps long, " + SUMMARY + ", cost long, audit string, "
    "repaired string, points array<int>, costs array<long>, audits array<string>, "
    "roles array<string>, texts array<string>, copies array<int>"
)


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def ordered_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, blank, truncated, repeats), one for each distinct row.

    Equal rows are one row with ``copies``; a row may say with ``copies`` 0 that it is not there.
    """
    rows = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("int").alias("copies"))
    rows = rows.withColumn("digest", F.sha2("text", 256))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    earliest = rows.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("place"))
    known = null_safe(rows, earliest, ["conv_id", "role", "digest"], "left")
    bare = F.rtrim("text", F.lit(BLANKS))
    return known.select(
        "conv_id", "turn", "role", "text", "copies",
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(*END_MARKS)).alias("truncated"),
        F.coalesce(F.col("place") < place, F.lit(False)).alias("repeats"),
    )


def _parse_chunks(schema: pa.Schema, chunk_rows: int):
    """Chunks of the sorted rows of a task, with cells, and texts where a conversation may go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, part = Parser(), TaskContext.get().partitionId()
        rows = (row for batch in batches for row in batch.to_pylist())
        out: list[dict] = []
        size = 0
        last: dict | None = None  # whole only once another conversation follows in the task
        for i, (conv, run_rows) in enumerate(groupby(rows, key=lambda r: r["conv_id"])):
            if last:
                out.append(finished(last))
            chunk, held = 0, []
            for row in run_rows:
                if len(held) == chunk_rows:
                    out.append(chunk_of(conv, part, chunk, held, parser, False))
                    chunk, held = chunk + 1, []
                held.append(row)
                size += len(row["text"])
                if size > 4 << 20 and out:
                    yield _arrow(out, schema)
                    out, size = [], 0
            last = chunk_of(conv, part, chunk, held, parser, i > 0 and chunk == 0)
        if last:
            out.append(last | {"whole": False})
        if out:
            yield _arrow(out, schema)

    return run


def chunk_of(conv, part: int, chunk: int, rows: list[dict], parser: Parser, whole: bool) -> dict:
    kinds = tuple(
        (r["role"][:1], r["blank"] or r["repeats"], r["truncated"], r["copies"]) for r in rows if r["copies"]
    )
    cells = parser.span(kinds)
    return {
        "conv_id": conv, "part": part, "chunk": chunk, "whole": whole, "cells": cells, **summarize(rows),
        "points": [4 * p + q for p, q in cells], "costs": [c for c, _ in cells.values()],
        "audits": [a for _, a in cells.values()],
        "roles": [r["role"] for r in rows if r["copies"]], "texts": [r["text"] for r in rows if r["copies"]],
        "copies": [r["copies"] for r in rows if r["copies"]],
    }


def finished(chunk: dict) -> dict:
    """The result of a conversation that lies inside the chunk; others stay as they are."""
    if not chunk["whole"]:
        return chunk
    _, (cost, audit) = best(chunk["cells"])
    rows = list(zip(chunk["roles"], chunk["texts"], chunk["copies"]))
    kept = {c: v for c, v in chunk.items() if c not in ("points", "costs", "audits", "roles", "texts", "copies")}
    return kept | {"cost": cost, "audit": audit, "gaps": gaps(chunk), "repaired": "\n".join(rewrite(rows, audit))}


def _combine(schema: pa.Schema):
    """One row for each chunk of a conversation: its share of the audit, and the whole's numbers."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        chunks = sorted(group.to_pylist(), key=lambda c: (c["part"], c["chunk"]))
        spans = levels(
            [
                {divmod(x, 4): (cost, audit) for x, cost, audit in zip(c["points"], c["costs"], c["audits"])}
                for c in chunks
            ]
        )
        whole, (cost, audit) = best(spans[-1][0])
        summary = chunks[0]
        for c in chunks[1:]:
            summary = merge(summary, c)
        numbers = {c: summary[c] for c in COUNTS} | {"gaps": gaps(summary), "cost": cost}
        out = [
            {"conv_id": c["conv_id"], "part": c["part"], "chunk": c["chunk"], "from": pq[0], "edits": cells[pq][1]}
            | (numbers | {"audit": audit} if i == 0 else {})
            for i, (c, cells, pq) in enumerate(zip(chunks, spans[0], trace(spans, whole)))
        ]
        return pa.Table.from_pylist(out, schema=schema)

    return run


def _rewrite_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [
            "\n".join(rewrite(list(zip(r["roles"], r["texts"], r["copies"])), r["edits"], r["from"]))
            if r["edits"].strip(DELETE) else None
            for r in batch.select(["roles", "texts", "copies", "edits", "from"]).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "part", "chunk")), pa.array(lines, pa.string())],
            names=["conv_id", "part", "chunk", "lines"],
        )


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation, whose chunks come in order; one text at a time."""
    done, conv, digest, begun, started = ([], []), None, None, False, False

    def close():
        done[0].append(conv)
        done[1].append(digest.hexdigest())

    kind = pa.null()
    for batch in batches:
        kind = batch.column("conv_id").type
        for c, lines in zip(batch.column("conv_id").to_pylist(), batch.column("lines").to_pylist()):
            if not started or c != conv:
                if started:
                    close()
                conv, digest, begun, started = c, hashlib.sha256(), False, True
            if lines is not None:
                digest.update(b"\n" if begun else b"")
                digest.update(lines.encode())
                begun = True
    if started:
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(done[0], kind), pa.array(done[1], pa.string())], names=["conv_id", "repaired_sha256"]
        )


def repair(turns: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """Repair every conversation of ``turns`` (conv_id, turn, role, text, copies).

    Gives conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 and the
    repaired text itself, ``role:text`` lines; the latter is null for a conversation longer than a
    chunk or at the edge of a task, whose text is hashed as a stream and never held whole.

    ``copies`` (absent: 1) says how often a row stands there; 0 lists a conversation without rows,
    which gives zeros and the digest of nothing. Null roles and texts are one space, so such rows
    are blank or have no legal initial. Null turns come first; ties of a turn are ordered by role and
    text, nulls of conv_id make one conversation. Empty texts are blank. Equal rows are copies: all
    but the first are duplicates. Very long texts are moved once for the sort and never compared as
    a whole but by digest. An empty table gives no rows. Other columns are ignored.
    """
    spark = turns.sparkSession
    conv = turns.schema["conv_id"].dataType.simpleString()
    there = F.col("copies") if "copies" in turns.columns else F.lit(1)
    filled = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        there.alias("copies"),
    )
    order = ["conv_id", "turn", "role", "text"]
    rows = small_batches(ordered_rows(filled)).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    chunk_ddl = CHUNKS.format(conv=conv)
    chunks = cut(rows.mapInArrow(frugal(_parse_chunks(_schema(chunk_ddl), chunk_rows)), chunk_ddl))
    numbers = ["conv_id", "gaps", *COUNTS, "cost", "audit"]
    whole = chunks.where("whole").select(*numbers, F.sha2("repaired", 256).alias("repaired_sha256"), "repaired")
    split = chunks.where("not whole")
    shares = (
        f"conv_id {conv}, part int, chunk int, `from` int, edits string, gaps long, "
        + ", ".join(f"{c} long" for c in COUNTS) + ", cost long, audit string"
    )
    cells = split.select(
        "conv_id", "part", "chunk", "points", "costs", "audits", *[p.split()[0] for p in SUMMARY.split(", ")]
    )
    shared = cut(cells.groupBy("conv_id").applyInArrow(_combine(_schema(shares)), shares))
    texts = split.select("conv_id", "part", "chunk", "roles", "texts", "copies")
    edits = shared.select("conv_id", "part", "chunk", "from", "edits")
    joined = null_safe(texts, edits, ["conv_id", "part", "chunk"], "inner")
    lines = joined.mapInArrow(frugal(_rewrite_chunks), f"conv_id {conv}, part int, chunk int, lines string")
    hashed = (
        lines.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
        .mapInArrow(frugal(_hash_lines), f"conv_id {conv}, repaired_sha256 string")
    )
    finals = null_safe(shared.where("cost is not null").select(*numbers), hashed, ["conv_id"], "inner")
    return whole.unionByName(finals.withColumn("repaired", F.lit(None).cast("string")))


def damage(turns: DataFrame) -> DataFrame:
    """Damaged rows with their copies; nulls count as one space, in the key as well."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat_ws(":", spaced["conv_id"], spaced["turn"]).cast("binary")) % 20
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(spaced["role"]).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(spaced["text"], END_MARKS, ""))
        .otherwise(spaced["text"]).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage to its rows."""
    return repair(damage(table(spark, sf_dir, "conversations"))).drop("repaired")

"""Removes lines that repeat earlier text, judged by overlapping windows of three lines.

A window is three consecutive lines of a document, compared as they are. All windows of all
documents are hashed (128 bits) and grouped; the first occurrence in the order of (document id,
text hash, line) stays, and every line that a later occurrence covers is removed. Covered positions
of overlapping windows merge. Where a later occurrence overlaps the first one in the same document,
the lines of the first stay. Windows are judged on the input, not on what is left.

A frequent window is one key of many rows: its first occurrence is found by partial aggregation,
and the join that tells each occurrence its first is one that Spark can split by rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillwork.llm.base import null_safe, query, small_batches, table

WINDOW = 3


def _hash(lines: Column, seed: str) -> Column:
    return F.xxhash64(F.lit(seed), lines)


@F.pandas_udf(StringType())
def _without(texts: pd.Series, covered: pd.Series) -> pd.Series:
    """Texts without the lines at the covered positions."""

    def rest(text: str | None, positions) -> str | None:
        if text is None or positions is None:
            return text
        gone = set(positions.tolist())
        return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)

    return pd.Series([rest(t, c) for t, c in zip(texts, covered)], dtype=object)


def covered_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, copy, covered): sorted distinct positions, from 0, of the lines to remove.

    ``docs`` has doc_id, copy (a hash of the text) and text. Documents that lose nothing are not
    in the result.
    """
    lines = F.split(F.col("text"), "\n", -1)
    shingle = lambda i: F.slice(F.col("lines"), i, window)
    hashed = F.transform(
        F.sequence(F.lit(1), F.size("lines") - window + 1),
        lambda i: F.struct(
            (i - 1).alias("at"), _hash(shingle(i), "a").alias("h1"), _hash(shingle(i), "b").alias("h2")
        ),
    )
    windows = (
        docs.select("doc_id", "copy", lines.alias("lines"))
        .where(F.size("lines") >= window)
        .select("doc_id", "copy", F.explode(hashed).alias("w"))
        .select("doc_id", "copy", "w.at", "w.h1", "w.h2")
    )
    place = F.struct("doc_id", "copy", "at")
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("h1", "h2", "first")
    )
    same = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.copy") == F.col("copy"))
    start = F.when(same, F.greatest(F.col("at"), F.col("first.at") + window)).otherwise(F.col("at"))
    later = (
        windows.join(repeated, ["h1", "h2"])
        .where(F.struct("doc_id", "copy", "at") != F.col("first"))
        .select("doc_id", "copy", start.alias("start"), (F.col("at") + window - 1).alias("stop"))
        .where(F.col("start") <= F.col("stop"))
    )
    spans = F.transform(F.collect_set(F.struct("start", "stop")), lambda s: F.sequence(s["start"], s["stop"]))
    return later.groupBy("doc_id", "copy").agg(
        F.array_sort(F.array_distinct(F.flatten(spans))).alias("covered")
    )


def remove_repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` rid of repeated windows, and n_lines and n_removed_lines.

    Null texts stay null with 0 lines; an empty text is one empty line. Texts of fewer lines than a
    window are left as they are. Rows with the same id and text are one document and fare alike.
    Null ids come first in the order. Other columns pass; those named n_lines or n_removed_lines
    are replaced. A document all of whose lines are removed gets an empty text.
    """
    keyed = small_batches(docs).drop("n_lines", "n_removed_lines").withColumn("__copy", F.xxhash64("text"))
    covered = covered_lines(keyed.select("doc_id", F.col("__copy").alias("copy"), "text"), window)
    covered = covered.select("doc_id", F.col("copy").alias("__copy"), F.col("covered").alias("__covered"))
    joined = null_safe(keyed, covered, ["doc_id", "__copy"], "left")
    lines = F.split(F.col("text"), "\n", -1)
    return joined.select(
        *[
            _without("text", "__covered").alias("text")
            if c == "text"
            else F.col(c)
            for c in docs.columns
            if c not in ("n_lines", "n_removed_lines")
        ],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__covered"), F.lit(0)).cast("long").alias("n_removed_lines"),
    )


SQL = """
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         unnest(range(len(string_split(text, chr(10))))) as pos
  from documents
), windows as (
  select doc_id, pos, line, lead(line, 1) over w as l2, lead(line, 2) over w as l3
  from lines window w as (partition by doc_id order by pos)
), firsts as (
  select *, min(doc_id) over g as first_doc,
         first_value(doc_id * 1000000000 + pos) over (partition by line, l2, l3 order by doc_id, pos) as first_place,
         doc_id * 1000000000 + pos as place
  from windows where l3 is not null window g as (partition by line, l2, l3)
), spans as (
  select doc_id, pos + 2 as stop,
         case when first_place // 1000000000 = doc_id
              then greatest(pos, first_place % 1000000000 + 3) else pos end as start
  from firsts where place <> first_place
), covered as (
  select distinct doc_id, unnest(range(start, stop + 1)) as pos from spans where start <= stop
)
select d.doc_id, count(l.pos) as n_lines, count(c.pos) as n_removed_lines,
       sha256(coalesce(string_agg(l.line, chr(10) order by l.pos) filter (c.pos is null), '')) as kept_sha256
from documents d left join lines l on l.doc_id = d.doc_id
left join covered c on c.doc_id = l.doc_id and c.pos = l.pos
group by d.doc_id
"""


@query("op6_line_dedup", SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those removed, and a digest of the text that is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_lines(docs).select(
        "doc_id",
        "n_lines",
        "n_removed_lines",
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"),
    )

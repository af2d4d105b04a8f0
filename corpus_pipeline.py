"""Five stages from raw documents to packed sequences.

Each stage takes all that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.base import query, table
from tillwork.llm.decontaminate import contamination
from tillwork.llm.language import UNKNOWN, fit, identify
from tillwork.llm.line_dedup import remove_repeated_lines
from tillwork.llm.near_dedup import keep_one
from tillwork.llm.packing import packed
from tillwork.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Predictions below this probability are rejected.
MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Null texts and texts without letters go."""
    docs = docs.select(*COLUMNS)
    found = identify(docs, fit(docs))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated three-line windows; those of which no text is left go."""
    left = remove_repeated_lines(docs.select(*COLUMNS))
    emptied = (F.col("n_removed_lines") > 0) & (F.trim("text") == "")
    return left.where(~F.coalesce(emptied, F.lit(False))).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, on five-word shingles."""
    return keep_one(docs.select(*COLUMNS), shingle=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    items = table(spark, sf_dir, "benchmark")
    return contamination(docs.select(*COLUMNS), items).where(F.col("n_hit") == 0).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents that are left and its place in a sequence."""
    return packed(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("best_fit_packing", best_fit_packing),
]

#: Neither learned languages nor token ids can be expressed in SQL.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written to the shared folder and reread."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

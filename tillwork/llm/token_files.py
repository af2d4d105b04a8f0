"""Token ids of whole texts in ORC files, ordered by document id.

The files are what the native ORC writer makes of (doc_id, n_tokens, ids): integer run-length
encoding, a row index every ``stride`` rows and Bloom filters on the document id, so readers take
stripes in parallel and skip those that cannot hold a wanted id. Documents are dealt by ranges of
their id and sorted before they are encoded, because texts are smaller to move than ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.llm.base import frugal, partitions, query, small_batches, table
from tillwork.llm.encoding import Encoder
from tillwork.session import shared_dir

STRIDE = 1_000
FILES = "doc_id long, block int, row int, n_tokens long, ids array<int>"


def write_ids(
    docs: DataFrame,
    target: str,
    tokenizer_file: str,
    end_id: int,
    glues_space: bool = True,
    stride: int = STRIDE,
) -> None:
    """Encode ``docs`` (doc_id, text) and write the ids, each document closed by ``end_id``.

    Null and empty texts hold the end id alone. Null document ids come first. Rows with the same
    id are neighbours, ordered by text. Other columns are left out. An empty table writes files
    without rows.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_file, glues_space)
        end = np.array([end_id], "<u4").tobytes()
        block, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            ids = [encoder.encode(t) + end for t in batch.column("text").to_pylist()]
            counts = np.array([len(x) // 4 for x in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(n, block, np.int32)),
                    pa.array(np.arange(row, row + n, dtype=np.int32)),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(offsets), flat),
                ],
                names=["doc_id", "block", "row", "n_tokens", "ids"],
            )
            row += n

    ordered = (
        small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    (
        ordered.mapInArrow(frugal(encode), FILES)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.row.index.stride", stride)
        .option("compression", "zstd")
        .orc(target)
    )


def read_ids(spark: SparkSession, target: str) -> DataFrame:
    """The files of ``write_ids``; filters on doc_id skip stripes by their index."""
    return spark.read.schema(FILES).orc(target)


def documents_in(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files.

    ``start`` counts the ids of all documents before it: those in earlier blocks, of which there
    are as many as files, and those before it in its block.
    """
    crc_schema = "doc_id long, block int, row int, n_tokens long, ids_crc32 long"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = np.asarray(ids.values, dtype="<i4")
            at = np.asarray(ids.offsets)
            crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(crcs, pa.int64())],
                names=["doc_id", "block", "row", "n_tokens", "ids_crc32"],
            )

    rows = read_ids(spark, target).mapInArrow(frugal(digest), crc_schema)
    sums = read_ids(spark, target).groupBy("block").agg(F.sum("n_tokens").alias("__sum"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("block", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(starts, "block").select(
        "doc_id",
        (F.col("__start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in ORC, read back."""
    import public_tokenizers

    target = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    write_ids(docs, target, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return documents_in(spark, target)

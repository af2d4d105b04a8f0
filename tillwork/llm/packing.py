"""Packs documents into as few token sequences of a fixed length as it can.

Bounded-space online best fit: pieces are taken one by one; each goes to the open bin with the
least free space that still holds it. Open bins are kept by their free space, and a bit set, an
integer with bit f set if a bin with f free places is open, finds the least f that is large enough.
Only so many bins may be open; beyond that the fullest closes first.

Only the lengths of pieces are packed. They are dealt by a hash into groups of bounded size. A group
is taken in hash order, in runs that cannot need more bins than may be open; inside a run longer
pieces come first, which leaves the small ones to fill gaps. So no bin closes before the small pieces
of its run have come.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwork.llm.base import frugal, query, small_batches, table
from tillwork.llm.encoding import Encoder
from tillwork.session import cut

LENGTH = 2_048
OPEN_BINS = 4_096
#: Stretches of text that a task remembers.
MEMORY = 400_000
#: Pieces packed together.
GROUP = 100_000

PIECES = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Open bins by free space. ``place(size)`` gives (bin, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        if capacity < 1 or open_bins < 1:
            raise ValueError("capacity and open_bins must be positive")
        self.capacity = capacity
        self.open_bins = open_bins
        self.bits = 0
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0
        self.made = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            self.bits &= ~(1 << space)
        self.open -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        if not 0 < size <= self.capacity:
            raise ValueError(f"a piece of {size} does not fit a bin of {self.capacity}")
        fitting = self.bits >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            chosen = self._take(space)
        else:
            space, chosen = self.capacity, self.made
            self.made += 1
        left = space - size
        if left:
            if self.open == self.open_bins:  # the fullest has the least free space
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest >= left:
                    return chosen, self.capacity - space  # the bin at hand is the fullest
                self._take(fullest)
            self.by_space[left].append(chosen)
            self.bits |= 1 << left
            self.open += 1
        return chosen, self.capacity - space


def cut_pieces(
    docs: DataFrame, tokenizer_file: str, end_id: int, length: int = LENGTH, glues_space: bool = False
) -> DataFrame:
    """Encode documents (doc_id, text) and cut those longer than ``length``.

    Null and empty texts are the end id alone. ``copy`` is a hash of the text; it tells apart rows
    of different texts with the same id. Other columns are left out.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_file, glues_space, MEMORY)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            ids_of = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "copy", "text")))
            for doc, copy, text in ids_of:
                ids = encoder.encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    rows.append((doc, copy, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) if rows else [()] * 6
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "copy", "piece", "start", "length", "ids_crc32"],
            )

    read = small_batches(docs).select(
        F.col("doc_id").cast("long"),
        F.xxhash64(F.col("text").cast("string")).alias("copy"),
        F.col("text").cast("string"),
    )
    return read.mapInArrow(frugal(pieces), PIECES)


def runs(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(from, to) of successive stretches of ``lengths`` with a sum of at most ``most``, or one long."""
    ends, at = np.cumsum(lengths), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, to
        at = to


def pack(
    pieces: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, group: int = GROUP
) -> DataFrame:
    """``pieces`` (doc_id, copy, piece, length, ...) with sequence_id and offset.

    A sequence has at most ``length`` tokens, its offsets are gapless from 0. Pieces of one length and
    run are placed one after the other in the order of (doc_id, copy, piece), null ids first. Of the
    bins of a run at most one is half empty or more, so ``open_bins`` hold a run of half as many full
    ones. No pieces, no sequences. ``pieces`` is written to the shared folder, so it is made once.
    """
    pieces = cut(pieces)
    groups = max(1, -(-pieces.count() // group))
    names = pieces.columns
    hashed = pieces.withColumn("__hash", F.xxhash64(F.lit("pack"), "doc_id", "copy", "piece"))
    hashed = hashed.withColumn("__group", F.pmod("__hash", F.lit(groups)))
    schema = StructType([*hashed.schema]).add("sequence_id", "long").add("offset", "long")

    def place(part: pa.Table) -> pa.Table:
        ties = [(k, "ascending") for k in ("doc_id", "copy", "piece")]

        def ordered(rows: pa.Table, *first: tuple[str, str]) -> pa.Table:
            return rows.take(pc.sort_indices(rows, sort_keys=[*first, *ties], null_placement="at_start"))

        part = ordered(part, ("__hash", "ascending"))
        lengths = part.column("length").to_numpy()
        base, done = part.column("__group")[0].as_py() << 32, []
        for at, to in runs(lengths, max(length, open_bins * length // 2)):
            run = ordered(part.slice(at, to - at), ("length", "descending"))
            bins = BestFit(length, open_bins)
            placed = [bins.place(n) for n in run.column("length").to_pylist()]
            ids = pa.array([base + b for b, _ in placed], pa.int64())
            offsets = pa.array([o for _, o in placed], pa.int64())
            done.append(run.append_column("sequence_id", ids).append_column("offset", offsets))
            base += bins.made
        return pa.concat_tables(done)

    return (
        hashed
        .groupBy("__group")
        .applyInArrow(place, schema)
        .select(*names, "sequence_id", "offset")
    )


def sequences(pieces_with_ids: DataFrame) -> DataFrame:
    """(sequence_id, ids) from placed pieces that carry their ``ids``."""
    by_place = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces_with_ids.groupBy("sequence_id").agg(
        F.flatten(F.transform(by_place, lambda p: p["ids"])).alias("ids")
    )


def packed(docs: DataFrame) -> DataFrame:
    """All pieces of ``docs`` and their places, under the 49k word vocabulary, end id 0."""
    import public_tokenizers

    pieces = cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0)
    return pack(pieces).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return packed(table(spark, sf_dir, "documents"))

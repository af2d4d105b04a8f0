"""Finds passages of benchmark items in training text through a positional inverted index.

The index is distributed by documents and transient: it is built for one Arrow batch of them, over
the words that occur in items, searched and dropped; no postings are stored. Each block holds, for every word that an item uses,
the sorted positions of that word in the block, documents lying one after the other with a gap
between them. A passage of k words is looked up from its rarest word in the block: the positions of
that word, less its offset in the passage, are the candidate starts, and the lists of the other
words, adjusted by their offsets, are intersected with them from the rarest on. With ``slop`` the
words may lie apart: each next word is the first one behind the last, and a match may have at most
``slop`` foreign words in all.

Items reach every block. Their size is summed first, and beyond ``CHUNK_BYTES`` they are taken in
chunks below that size, one pass over the documents each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.llm.base import frugal, query, small_batches, table

WINDOW = 10
CHUNK_BYTES = 32 << 20

#: A-Z become a-z; a-z, 0-9 and all bytes of other alphabets stay; the rest separates words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

RESULT = (
    T.LongType(),
    T.LongType(),
    T.ArrayType(T.StringType()),
    T.ArrayType(T.StructType().add("start", "long").add("stop", "long")),
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split(b" ") if text else []


def split_words(text: str | None) -> list[bytes]:
    return [w for w in words_of(text) if w]


def passages(text: str | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Distinct windows of a text; a text of fewer words is one, a text of none has none."""
    words = split_words(text)
    if not words:
        return []
    last = max(1, len(words) - window + 1)
    return list(dict.fromkeys(tuple(words[i : i + window]) for i in range(last)))


class Lookup:
    """Passages of some items: their words numbered, and the items of each."""

    def __init__(self, items: list[tuple[int, str | None]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[int]] = {}
        for k, (_, text) in enumerate(items):
            for passage in passages(text, window):
                key = tuple(self.numbers.setdefault(w, len(self.numbers)) for w in passage)
                self.items.setdefault(key, []).append(k)
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for key in self.items:
            by_length.setdefault(len(key), []).append(key)
        self.by_length = {k: np.array(v, np.int32) for k, v in by_length.items()}


class Index:
    """Positions of the numbered words in one block of documents."""

    def __init__(self, texts: list[str | None], numbers: dict[bytes, int], gap: int):
        number = numbers.get
        blocks, starts, sizes, at = [], [], [], 0
        for text in texts:
            found = split_words(text)
            starts.append(at)
            sizes.append(len(found))
            blocks.append(np.array([number(w, -1) for w in found], np.int32))
            blocks.append(np.full(gap, -1, np.int32))
            at += len(found) + gap
        self.starts = np.array(starts, np.int64)
        self.sizes = np.array(sizes, np.int64)
        tokens = np.concatenate(blocks) if blocks else np.empty(0, np.int32)
        at = np.flatnonzero(tokens >= 0)
        words = tokens[at]
        self.order = at[np.argsort(words, kind="stable")]
        self.counts = np.bincount(words, minlength=len(numbers))
        self.ends = np.cumsum(self.counts)

    def postings(self, word: int) -> np.ndarray:
        return self.order[self.ends[word] - self.counts[word] : self.ends[word]]

    def phrase(self, words: np.ndarray) -> np.ndarray:
        """Positions where the words follow each other."""
        by_rarity = np.argsort(self.counts[words], kind="stable")
        starts = self.postings(words[by_rarity[0]]) - by_rarity[0]
        for k in by_rarity[1:]:
            if not len(starts):
                break
            found = self.postings(words[k])
            wanted = starts + k
            at = np.searchsorted(found, wanted)
            at[at == len(found)] = 0
            starts = starts[found[at] == wanted]
        return starts

    def near(self, words: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) where the words follow in order with at most ``slop`` others between."""
        starts = self.postings(words[0])
        last = starts.copy()
        for word in words[1:]:
            found = self.postings(word)
            at = np.searchsorted(found, last, side="right")
            inside = at < len(found)
            starts, last = starts[inside], found[at[inside]]
            close = last - starts < len(words) + slop
            starts, last = starts[close], last[close]
        return starts, last - starts + 1

    def matches(self, lookup: Lookup, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
        """(start, length, items) of every passage that occurs."""
        for length, keys in lookup.by_length.items():
            present = keys[self.counts[keys].min(axis=1) > 0]
            for words in present:
                if slop:
                    starts, lengths = self.near(words, slop)
                else:
                    starts = self.phrase(words)
                    lengths = np.full(len(starts), length)
                if len(starts):
                    yield starts, lengths, lookup.items[tuple(words.tolist())]


def item_chunks(items: DataFrame, chunk_bytes: int) -> Iterator[list[tuple]]:
    """Items (item_id, text) in lists below ``chunk_bytes``, dealt by a hash; at least one list."""
    sized = items.select("item_id", F.col("text").cast("string").alias("text"))
    total = sized.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    chunks = max(1, -(-2 * total // chunk_bytes)) if total > chunk_bytes else 1
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks))
    for k in range(chunks):
        rows = sized.where(dealt == k).collect()
        yield sorted(((r[0], r[1]) for r in rows), key=lambda r: (str(r[0]), r[1] or ""))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids and spans.

    ``item_ids`` are the items with a passage in the document, as sorted distinct strings; ``spans``
    the disjoint runs of hit words as structs (start, stop), stop excluded; ``n_hit`` their words.
    Null and empty texts have no words and no hits; items without words have no passages, and
    without items nothing is hit. Null item ids count as hits but have no name. Rows are taken one
    by one, so repeated rows fare alike. Columns with one of these names are replaced.
    """
    added = ["n_words", "n_hit", "item_ids", "spans"]
    kept = [c for c in docs.columns if c not in added]
    result = small_batches(docs).select(*kept, F.col("text").cast("string").alias("__text"))
    first = True
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    for chunk in item_chunks(items, chunk_bytes):
        before = [] if first else added
        schema = docs.select(*kept).schema.add("__text", "string")
        for name, kind in zip(added, RESULT):
            schema = schema.add(name, kind)

        def search(batches: Iterator[pa.RecordBatch], chunk=chunk, before=before) -> Iterator[pa.RecordBatch]:
            lookup = Lookup(chunk, window)
            names = [None if i is None else str(i) for i, _ in chunk]
            for batch in batches:
                n = batch.num_rows
                index = Index(batch.column("__text").to_pylist(), lookup.numbers, window + slop)
                hits: list[set[int]] = [set() for _ in range(n)]
                change = np.zeros(int(index.starts[-1] + index.sizes[-1]) + 1 if n else 1, np.int32)
                for starts, lengths, found in index.matches(lookup, slop):
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + lengths, -1)
                    for row in np.unique(np.searchsorted(index.starts, starts, side="right") - 1).tolist():
                        hits[row].update(found)
                covered = np.cumsum(change) > 0
                edges = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
                begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                rows = np.searchsorted(index.starts, begins, side="right") - 1
                spans: list[list] = [[] for _ in range(n)]
                for row, a, b in zip(rows.tolist(), begins.tolist(), ends.tolist()):
                    at = int(index.starts[row])
                    spans[row].append({"start": a - at, "stop": b - at})
                ids = [sorted({names[k] for k in found} - {None}) for found in hits]
                if before:
                    ids = [sorted({*a, *b}) for a, b in zip(ids, batch.column("item_ids").to_pylist())]
                    spans = [merge(a + b) for a, b in zip(spans, batch.column("spans").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in [*kept, "__text"]]
                    + [
                        pa.array(index.sizes, pa.int64()),
                        pa.array([sum(s["stop"] - s["start"] for s in x) for x in spans], pa.int64()),
                        pa.array(ids, pa.list_(pa.string())),
                        pa.array(spans, pa.list_(span)),
                    ],
                    names=[*kept, "__text", *added],
                )

        result = result.mapInArrow(frugal(search), schema)
        first = False
    return result.drop("__text")


def merge(spans: list[dict]) -> list[dict]:
    """Disjoint ascending spans that cover the same words."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["stop"])):
        if out and s["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], s["stop"])
        else:
            out.append(dict(s))
    return out


SQL = r"""
with dw as (
  select doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), iw as (
  select item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), passages as (
  select distinct item_id, least(len(w), 10) as k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as p
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from iw where len(w) > 0)
), grams as (
  select doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') as p
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i
        from dw, (select distinct k from passages) where len(w) >= k)
), found as (
  select doc_id, i, k, item_id from grams join passages using (k, p)
), hit as (
  select doc_id, count(distinct pos) as n from (select doc_id, unnest(range(i, i + k)) as pos from found) group by doc_id
), named as (
  select doc_id, count(*) as n, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from found) group by doc_id
)
select dw.doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, coalesce(hit.n, 0) as n_hit,
       coalesce(named.n, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(hit.n, 0) > 0 as contaminated
from dw left join hit using (doc_id) left join named using (doc_id)
"""


@query("op3_decontamination", SQL)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, those inside benchmark passages, and the items they belong to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )

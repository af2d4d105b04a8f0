"""Token counts of a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton lists all vocabulary matches of a word by their end; a dynamic program
over the ends carries the best score and the number of pieces on the best path. The rules are
those of the unigram model of the ``tokenizers`` library with a ``Metaspace`` pre-tokenizer:

* spaces become U+2581, one is put in front unless the text starts with one, and words are cut
  before each of them;
* among equal scores the path that reached the end first wins, which is the one whose last piece
  starts earliest;
* a character that is no piece costs the lowest score less 10; neighbours of that kind are one
  unknown piece, or as many byte pieces as they have bytes if the vocabulary has all 256.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.base import frugal, query, small_batches, table

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words remembered by a task before it starts afresh.
MEMORY = 500_000

COUNTS = "n_words long, n_tokens long, score double"


def read_pieces(model_file: str) -> list[tuple[str, float]]:
    """The pieces and scores of a SentencePiece model file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class PieceCounter:
    """Counts the pieces of texts; remembers the counts of words."""

    def __init__(self, pieces: list[tuple[str, float]], memory: int = MEMORY):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        known = set()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
                known.add(piece)
        if known:
            self.automaton.make_automaton()
        self.empty = not known
        self.single = {p for p in known if len(p) == 1}
        self.bytes = all(f"<0x{b:02X}>" in known for b in range(256))
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.memory = memory
        self.words: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best path over a word."""
        n = len(word)
        score = [0.0] + [-inf] * n
        count = [0] * (n + 1)
        # Ends of characters that are no piece: the path may always pass them as unknown.
        odd = [i + 1 for i, c in enumerate(word) if c not in self.single]
        odd.append(n + 1)
        passed = set()
        k, gap = 0, odd[0]

        def through(upto: int) -> int:
            # After the matches of an odd end, its unknown piece, which starts later than they do.
            nonlocal k
            while odd[k] < upto:
                end = odd[k]
                k += 1
                if self.unknown + score[end - 1] > score[end]:
                    score[end] = self.unknown + score[end - 1]
                    passed.add(end)
                    added = len(word[end - 1].encode()) if self.bytes else end - 1 not in passed
                    count[end] = count[end - 1] + added
            return odd[k]

        # Matches come by ascending end, those of one end by ascending start.
        for last, (length, worth) in self.automaton.iter(word) if not self.empty else ():
            end = last + 1
            if end > gap:
                gap = through(end)
            total = worth + score[end - length]
            if total > score[end]:
                score[end] = total
                count[end] = count[end - length] + 1
        through(n + 1)
        return count[n], score[n]

    def text(self, text: str | None) -> tuple[int, int, float]:
        """(words, pieces, score) of a text; null and empty have none."""
        if not text:
            return 0, 0, 0.0
        marked = text.replace(" ", MARK)
        words = marked.split(MARK)
        if marked[0] == MARK:
            words = words[1:]
        known = self.words
        if len(known) > self.memory:
            known.clear()
        pieces = 0
        score = 0.0
        for word in words:
            found = known.get(word)
            if found is None:
                found = known[word] = self.word(MARK + word)
            pieces += found[0]
            score += found[1]
        return len(words), pieces, score


def count_tokens(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_tokens and score of the best path.

    Null and empty texts count 0. Columns of ``docs`` with one of these names are replaced. Rows
    are taken as they come, so repeated rows and null ids need no rule. No shuffle.
    """
    added = [c.split()[0] for c in COUNTS.split(", ")]
    kept = [c for c in docs.columns if c not in added]
    schema = docs.select(*kept).schema
    for part in COUNTS.split(", "):
        schema = schema.add(*part.split())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(read_pieces(model_file))
        for batch in batches:
            rows = [counter.text(t) for t in batch.column("__text").to_pylist()]
            counts = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(c, pa.int64()) for c in counts[:2]]
                + [pa.array(counts[2], pa.float64())],
                names=kept + added,
            )

    return small_batches(docs).select(*kept, F.col(text).alias("__text")).mapInArrow(frugal(count), schema)


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, tokens and score under the 32k piece vocabulary."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    counted = count_tokens(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_words", "n_tokens", "score")

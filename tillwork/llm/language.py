"""Language identification by sparse multinomial logistic regression on character n-grams.

Features are the 1- to 3-grams of the lower-cased text, hashed into ``BUCKETS`` counts and weighted
by TF-IDF with unit length. Document frequencies come from all learnable documents. The weights
are trained with follow-the-regularised-leader (per-coordinate, elastic-net penalty) on at most
``SAMPLE`` labelled documents a language, chosen by a hash of their id; the probabilities are then
calibrated by one temperature, fitted on other documents, at most ``CALIBRATION`` a language.
Every label that occurs is a class; beyond 200 labels there are fewer documents of each.
Prediction reads the text alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.llm.base import frugal, query, small_batches, table

BUCKETS = 1 << 15
ORDERS = 3
#: Documents a language that the weights, and the temperature, are fitted on at most.
SAMPLE, CALIBRATION = 600, 200
#: Sampled documents of all languages together, unless that leaves fewer than ``LEAST`` a language.
DOCUMENTS, LEAST = 160_000, 8
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.02, 0.02
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in iter_letters(text))


def iter_letters(text: str) -> Iterator[str]:
    return (m.group() for m in LETTER.finditer(text))


def gram_counts(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) of the hashed n-grams of a text, by ascending bucket."""
    data = text.lower().encode("utf-32-le", "surrogatepass")
    chars = np.frombuffer(data, dtype="<u4") + np.uint32(1)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    grams, rolling = [], np.zeros(len(chars), np.uint32)
    for order in range(min(ORDERS, len(chars))):
        rolling = rolling[: len(chars) - order] * np.uint32(0x9E3779B1) + chars[order:]
        mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        grams.append(mixed >> shift)
    if not grams:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    counts = np.bincount(np.concatenate(grams), minlength=buckets)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, counts = gram_counts(text, len(self.idf))
        values = (1.0 + np.log(counts)) * self.idf[at]
        norm = np.sqrt((values * values).sum())
        return at, values / norm if norm else values

    def logits(self, text: str) -> np.ndarray:
        at, values = self.features(text)
        return values @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, probability); ``und`` and 0 without a letter or a learned language."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], min(1.0, float(p[best]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], buckets: int, classes: int) -> tuple:
    """FTRL-proximal with per-coordinate rates; the bias is not penalised."""
    z = np.zeros((buckets, classes))
    n = np.zeros((buckets, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def weights(z: np.ndarray, n: np.ndarray, l1: float, l2: float) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + l2)

    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in order.permutation(len(examples)):
            at, values, label = examples[i]
            w, b = weights(z[at], n[at], L1, L2), weights(zb, nb, 0.0, 0.0)
            error = softmax(values @ w + b)
            error[label] -= 1.0
            g = values[:, None] * error
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
            zb += error - (np.sqrt(nb + error * error) - np.sqrt(nb)) / ALPHA * b
            nb += error * error
    for at in range(0, buckets, 1024):  # in place: z and n grow with the number of classes
        z[at : at + 1024] = weights(z[at : at + 1024], n[at : at + 1024], L1, L2)
    return z, weights(zb, nb, 0.0, 0.0)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0
    rows = np.arange(len(labels))

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(t))[rows, labels], 1e-12)).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; 2 means held out. Null ids count as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4, F.lit(2))


def learnable(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: (doc_id, text, lang)."""
    rows = docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    return rows.where((remainder() != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, over all rows; and the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, texts = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if has_letter(text):
                    found[gram_counts(text)[0]] += 1
                    texts += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *at], pa.int32()), pa.array([texts, *found[at]], pa.int64())],
            names=["bucket", "n"],
        )

    sums = rows.select("text").mapInArrow(frugal(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n"))
    frequencies, texts = np.zeros(BUCKETS, np.int64), 0
    for bucket, n in sums.collect():  # at most BUCKETS + 1 rows
        if bucket < 0:
            texts = n
        else:
            frequencies[bucket] = n
    return frequencies, texts


def share(languages: int) -> int:
    """Sampled documents of each language at most, to fit and to calibrate on."""
    return min(SAMPLE + CALIBRATION, max(LEAST, DOCUMENTS // max(1, languages)))


def first_by_hash(ids: DataFrame, bound: int, languages: int | None = None) -> list[Row]:
    """The first ``bound`` (__id, __lang, __rank) of each language by the hash of doc_id.

    All languages are taken, or the ``languages`` with most rows, by name where equal; of many
    languages ``share`` rows each. Counts tell below which hash some four times the rows wanted
    lie, so only those are ranked; a language that comes out short, as with one id repeated, is
    ranked again with more, at last with all.
    """
    counts = ids.groupBy("lang").agg(F.count("*").alias("n"))
    if languages is not None:
        counts = counts.orderBy(F.desc("n"), "lang").limit(languages)
    left, times, out = {r["lang"]: r["n"] for r in counts.collect()}, 4, []
    bound = min(bound, share(len(left)))
    while left:
        ends = [
            (x, min(2**64 - 1, (times * bound << 64) // n) - 2**63) for x, n in left.items()
        ]
        ends = ids.sparkSession.createDataFrame(ends, "__lang string, __end long")
        first = (
            ids.withColumn("__hash", F.xxhash64(F.lit("language"), "doc_id"))
            .join(F.broadcast(ends), (F.col("lang") == F.col("__lang")) & (F.col("__hash") <= F.col("__end")))
        )
        order = Window.partitionBy("__lang").orderBy("__hash", "doc_id")
        ranked = first.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= bound)
        # Bounded: DOCUMENTS ids, or LEAST a language.
        found = ranked.select(F.col("doc_id").alias("__id"), "__lang", "__rank").collect()
        sizes = Counter(r["__lang"] for r in found)
        short = {x: n for x, n in left.items() if sizes[x] < min(n, bound) and times * bound < n}
        out += [r for r in found if r["__lang"] not in short]
        left, times = short, 16 * times
    return out


def fit(docs: DataFrame) -> Model:
    """Learn from ``docs`` (doc_id, text, lang); without learnable rows nothing is learned."""
    rows = learnable(small_batches(docs))
    lettered = rows.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "lang")
    chosen = first_by_hash(lettered, SAMPLE + CALIBRATION)
    if not chosen:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0))
    sizes = Counter(r["__lang"] for r in chosen)
    languages = sorted(sizes)
    number = {x: i for i, x in enumerate(languages)}
    # Bounded: DOCUMENTS ids, or LEAST a language.
    spark = docs.sparkSession
    firsts = {}
    for r in chosen:
        key = r["__id"], r["__lang"]
        firsts[key] = min(r["__rank"], firsts.get(key, r["__rank"]))
    wanted = spark.createDataFrame([(*k, rank) for k, rank in firsts.items()], "__id long, __lang string, __first int")
    frequencies, texts = document_frequencies(rows)
    model = Model(languages, np.log((1 + texts) / (1 + frequencies)) + 1, None, None)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [model.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__lang"),
                    batch.column("__rank"),
                    pa.array([a.astype("<i4").tobytes() for a, _ in made], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary()),
                ],
                names=["lang", "rank", "at", "value"],
            )

    # All rows of a repeated id join, so they are ranked again: a language has no more rows than bound.
    bound = share(len(languages))
    order = Window.partitionBy("__lang").orderBy("__first", F.xxhash64("text"), "text")
    sample = (
        rows.where(F.col("text").rlike(r"\p{L}"))
        .join(F.broadcast(wanted), (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang")))
        .select("__lang", "text", F.row_number().over(order).alias("__rank"))
        .where(F.col("__rank") <= bound)
        .mapInArrow(frugal(featurise), "lang string, rank int, at binary, value binary")
    )
    fitted_on = bound * SAMPLE // (SAMPLE + CALIBRATION)
    fitting, checking, labels = [], [], []
    for r in sorted(sample.collect()):  # bounded: ``bound`` rows a language
        at, values = np.frombuffer(r["at"], "<i4"), np.frombuffer(r["value"], "<f4").astype(float)
        # Languages with few documents are fitted on all of them.
        if r["rank"] <= fitted_on and not (sizes[r["lang"]] > 8 and r["rank"] % 4 == 0):
            fitting.append((at, values, number[r["lang"]]))
        else:
            checking.append((at, values))
            labels.append(number[r["lang"]])
    model.weights, model.bias = train(fitting, BUCKETS, len(languages))
    logits = np.array([v @ model.weights[a] + model.bias for a, v in checking]).reshape(-1, len(languages))
    model.temperature = fit_temperature(logits, np.array(labels, dtype=np.int64))
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score; columns of these names are replaced.

    Null texts and texts without a letter give ``und`` and 0, as does a model that learned nothing.
    Rows are taken one by one, so repeated rows and null ids need no rule.
    """
    docs = small_batches(docs)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
                names=[*kept, "lang_pred", "score"],
            )

    return docs.select(*kept, F.col("text").cast("string").alias("__text")).mapInArrow(frugal(predict), schema)


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document and its calibrated probability."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs)
    texts = docs.select("doc_id", "text", (remainder() == 2).alias("held_out"))
    return identify(texts, model).select("doc_id", "held_out", "lang_pred", "score")

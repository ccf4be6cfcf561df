"""Toxicity: a factorization machine over hashed terms, trained on a bounded sample of labelled documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.pieces import WordTable
from bitextloom.llm.tables import stored, text_or_empty

# Labelled documents that the model is fitted on, at most; those with the smallest hashes of doc_id.
SAMPLE_ROWS = 16_384
# Terms are hashed to so many buckets: with fewer, a word that tells shares its bucket with a common one here and there, and tells
# nothing.
BUCKETS = 1 << 24
# Buckets that the model has places for, at most: those of the most sampled documents, and none of fewer than MIN_DOCUMENTS.
PLACES = 1 << 16
MIN_DOCUMENTS = 3
FACTORS = 8
THRESHOLD = 0.3
# Texts whose terms are held at once.
SCORED_ROWS = 128
WORD = re.compile(r"\w+")
PREFIXES = (4, 5)


def term_hashes(word: str) -> tuple[int, ...]:
    """Buckets of a word and of its longer prefixes, which inflected forms share."""
    terms = [word, *(f"{word[:n]}~" for n in PREFIXES if len(word) > n)]
    return tuple(xxhash.xxh3_64_intdigest(t) & (BUCKETS - 1) for t in terms)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels are never learned from; a null id is in neither part."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class FactorMachine:
    """sigmoid(w0 + sum of w + half of (square of the summed factors - sum of their squares)), over binary terms."""

    def __init__(self, buckets: np.ndarray, rate: float) -> None:
        self.place = {int(b): i for i, b in enumerate(buckets)}
        self.bias = float(np.log(rate / (1 - rate)))
        self.weights = np.zeros(len(buckets))
        self.factors = np.random.default_rng(7).normal(0, 0.05, (len(buckets), FACTORS))

    def parts(self, index: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and summed factors; row r owns index[starts[r]:starts[r + 1]]."""
        summed = row_sums(self.factors[index], starts)
        linear = row_sums((self.weights - 0.5 * (self.factors**2).sum(axis=1))[index], starts)
        return self.bias + linear + 0.5 * (summed**2).sum(axis=1), summed

    def probability(self, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return sigmoid(self.parts(index, starts)[0])

    def fit(self, index: np.ndarray, starts: np.ndarray, labels: np.ndarray, epochs: int = 40, size: int = 512) -> None:
        """Logistic loss by AdaGrad over small batches, with a ridge on weights and factors."""
        rng = np.random.default_rng(11)
        sums = [np.zeros(1), np.zeros_like(self.weights), np.zeros_like(self.factors)]
        lengths = np.diff(starts)
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for first in range(0, len(order), size):
                batch = order[first : first + size]
                count = lengths[batch]
                begins = np.concatenate([[0], np.cumsum(count)])
                own = index[np.arange(begins[-1]) + np.repeat(starts[batch] - begins[:-1], count)]
                raw, summed = self.parts(own, begins)
                error = sigmoid(raw) - labels[batch]
                row = np.repeat(np.arange(len(batch)), count)
                # Places are below PLACES; of 16 bits they are sorted by counting.
                order_of = np.argsort(own.astype(np.uint16), kind="stable")
                ranked, row = own[order_of], row[order_of]
                heads = np.flatnonzero(np.diff(ranked, prepend=-1))
                used, each = ranked[heads], error[row]
                plain = np.add.reduceat(each, heads) if len(heads) else each
                g_w = plain + 0.02 * self.weights[used]
                # Over the rows of a term, the error times the summed factors but its own.
                g_v = np.add.reduceat(each[:, None] * summed[row], heads) if len(heads) else summed[:0]
                g_v = g_v - plain[:, None] * self.factors[used] + 0.05 * self.factors[used]
                sums[0] += error.sum() ** 2
                sums[1][used] += g_w**2
                sums[2][used] += g_v**2
                self.bias -= float(0.1 * error.sum() / np.sqrt(sums[0][0] + 1e-8))
                self.weights[used] -= 0.2 * g_w / np.sqrt(sums[1][used] + 1e-8)
                self.factors[used] -= 0.05 * g_v / np.sqrt(sums[2][used] + 1e-8)

    def terms(self, word: str) -> tuple[int, ...]:
        """Places of the kept terms of a word; of most words, none."""
        place = self.place
        return tuple(place[t] for t in term_hashes(word) if t in place)


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values[starts[r]:starts[r + 1]], of none 0."""
    out = np.zeros((len(starts) - 1, *values.shape[1:]))
    filled = starts[1:] > starts[:-1]
    if filled.any():
        out[filled] = np.add.reduceat(values, starts[:-1][filled])
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def text_terms(text: str, table: WordTable) -> set[int]:
    found: set[int] = set()
    found.update(*map(table.__getitem__, set(WORD.findall(text.lower()))))
    return found


def layout(sets: list[set[int]]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.fromiter((i for s in sets for i in sorted(s)), np.int64, int(starts[-1])), starts


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """label and terms (buckets of a document, packed) of the sample: at most `rows` rows."""
    labelled = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    labelled = labelled.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    sample = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(sample), "doc_id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(term_hashes)
        for batch in batches:
            packed = [np.array(sorted(text_terms(t, table)), "<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), pa.array(packed, pa.binary())], ["label", "terms"])

    return texts.select("label", "text").mapInArrow(hashed, "label int, terms binary")


def known_terms(rows: DataFrame) -> np.ndarray:
    """Buckets of the most sampled documents, whatever their labels: a term may tell only beside another."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, n = np.unique(np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u4"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (found, n)], ["term", "n"])

    counts = rows.mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    most = counts.filter(F.col("n") >= MIN_DOCUMENTS).orderBy(F.desc("n"), "term").limit(PLACES)
    return np.array(sorted(r["term"] for r in most.select("term").collect()), np.int64)


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> FactorMachine:
    """The model. Terms are counted by Spark tasks; what reaches the driver is at most `rows` rows of at most PLACES places.

    Without labels, or with one label only, the model is a constant rate.
    """
    sample = stored(training_rows(docs, labels, rows), "toxicity-sample")
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    positive, negative = counts.get(1, 0), sum(n for label, n in counts.items() if label != 1)
    rate = (positive + 0.1) / (positive + negative + 1)
    if not positive or not negative:
        return FactorMachine(np.zeros(0, np.int64), rate)
    buckets = known_terms(sample)
    model = FactorMachine(buckets, rate)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.flatnonzero(np.isin(buckets, np.frombuffer(p, "<u4"))).astype("<u4").tobytes() for p in batch.column("terms").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(own, pa.binary())], ["label", "places"])

    found = sorted((r["places"], r["label"]) for r in sample.mapInArrow(placed, "label int, places binary").collect())
    starts = np.concatenate([[0], np.cumsum([len(p) // 4 for p, _ in found])]).astype(np.int64)
    index = np.frombuffer(b"".join(p for p, _ in found), "<u4").astype(np.int64)
    model.fit(index, starts, np.array([label == 1 for _, label in found], float))
    return model


def toxicity(model: FactorMachine, spark) -> Column:
    """The score of column text, from 0 to 1; a null text is scored as an empty one."""
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        table = WordTable(known.terms)
        for batch in batches:
            # The terms of so many texts at a time, however many rows a batch has.
            parts = (batch.iloc[first : first + SCORED_ROWS] for first in range(0, max(1, len(batch)), SCORED_ROWS))
            yield pd.Series(np.concatenate([known.probability(*layout([text_terms(text or "", table) for text in part])) for part in parts]))

    return F.pandas_udf(score, "double")(F.col("text").cast("string"))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted (1 from `threshold` on).

    Only the text makes a score; equal texts have equal scores. Null and empty texts have the score of no terms.
    """
    score = toxicity(fit_toxicity(docs, labels), docs.sparkSession)
    scored = docs.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the documents whose score reaches `threshold`; columns stay as they are."""
    return docs.filter(toxicity(fit_toxicity(docs, labels), docs.sparkSession) < threshold)

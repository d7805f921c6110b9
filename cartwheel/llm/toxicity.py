"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct buckets of its words, pairs of neighbours and pairs with one word
between; words are runs of letters and digits, with A-Z in lower case. Training visits a bounded sample
of whole labelled documents in hash order. Per-coordinate rates and the L1 threshold leave few weights
other than zero; those are shipped to the tasks (at most 2 ** BITS of them).

Edge cases: a null or empty text, or one without words, scores as the intercept says. Without training
rows every score is 0.5. The filter rejects neither of these, since nothing says that they are toxic. Repeated rows and ids are scored one by one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from cartwheel.llm.blocks import BLOCK_BYTES, LOWER, WORD, Block, Hasher, arrow_batches, blocks, bounded_sample, mixed, runs, with_fields

BITS = 20
THRESHOLD = 0.5


@dataclass(frozen=True)
class Settings:
    """alpha and beta set the rates, l1 and l2 the penalties; the sample is bounded by rows and bytes.

    A feature is admitted once it occurs in min_texts documents of the sample.
    """

    bits: int = BITS
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 0.0
    epochs: int = 4
    min_texts: int = 4
    max_rows: int = 12_000
    max_bytes: int = 40 << 20


@dataclass(frozen=True)
class Weights:
    """The weights that are not zero, by bucket, and the intercept; fitted says whether there were training rows."""

    buckets: np.ndarray
    values: np.ndarray
    intercept: float
    bits: int
    fitted: bool = True

    def table(self) -> np.ndarray:
        dense = np.zeros(1 << self.bits, np.float32)
        dense[self.buckets] = self.values
        return dense


def features(block: Block, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every n-gram and skip-gram, with repetitions."""
    starts, ends, text = runs(WORD, block)
    words = Hasher(LOWER[block.data]).spans(starts, ends)
    found, owner = [words], [text]
    for gap, factor in ((1, 0xBF58476D1CE4E5B9), (2, 0x94D049BB133111EB)):
        if len(words) > gap:
            same = text[gap:] == text[:-gap]
            found.append(mixed(words[:-gap] * np.uint64(factor) + words[gap:])[same])
            owner.append(text[gap:][same])
    return np.concatenate(owner), (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


def distinct(text: np.ndarray, bucket: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique((text << bits) | bucket)
    return pairs >> bits, pairs & ((1 << bits) - 1)


def train(sample: pa.Table, settings: Settings) -> Weights:
    """Pass over the sample with the FTRL-proximal update, one document at a time."""
    texts, labels = sample.select(["text"]).to_batches(), sample["label"].to_pylist()
    size = 1 << settings.bits
    seen = np.zeros(size, np.int32)
    for block in blocks(iter(texts), limit=BLOCK_BYTES // 2):
        seen += np.bincount(distinct(*features(block, settings.bits), settings.bits)[1], minlength=size).astype(np.int32)
    parts, ends = [], [np.zeros(1, np.int64)]
    for block in blocks(iter(texts), limit=BLOCK_BYTES // 2):
        text, bucket = features(block, settings.bits)
        admitted = seen[bucket] >= settings.min_texts
        text, bucket = distinct(text[admitted], bucket[admitted], settings.bits)
        parts.append(bucket.astype(np.int32))
        ends.append(np.searchsorted(text, np.arange(1, block.size + 1)) + ends[-1][-1])
    flat, bounds = np.concatenate([np.zeros(0, np.int32), *parts]), np.concatenate(ends)
    documents = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    del parts
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(settings.epochs if documents else 0):
        for own, label in zip(documents, labels, strict=True):
            at = np.append(own, size)
            w = proximal(z[at], n[at], settings)
            error = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            rate = (np.sqrt(n[at] + error * error) - np.sqrt(n[at])) / settings.alpha
            z[at] += error - rate * w
            n[at] += error * error
    w = proximal(z, n, settings)
    # The intercept has no penalty worth the name: its coordinate is seen by every document.
    kept = np.flatnonzero(w[:size])
    return Weights(kept, w[kept].astype(np.float32), float(w[size]), settings.bits, len(documents) > 0)


def proximal(z: np.ndarray, n: np.ndarray, settings: Settings) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - settings.l1, 0)
    return -shrunk / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2)


def fit(documents: DataFrame, labels: DataFrame, train_rows: Column, label: str = "toxic", settings: Settings | None = None) -> Weights:
    """Learn from the labelled documents among the training rows, in one task that holds the bounded sample."""
    arrow_batches(documents.sparkSession)
    settings = settings or Settings()
    sample = bounded_sample(documents, labels, label, train_rows, settings.max_rows, settings.max_bytes)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = list(batches)
        table = pa.Table.from_batches(whole) if whole else pa.table({"text": pa.array([], pa.string()), "label": pa.array([], pa.int32())})
        found = train(table, settings)
        yield pa.record_batch(
            {"buckets": [found.buckets.tobytes()], "weights": [found.values.tobytes()], "intercept": [found.intercept], "fitted": [found.fitted]}
        )

    row = sample.mapInArrow(learned, "buckets binary, weights binary, intercept double, fitted boolean").first()
    if row is None:
        return Weights(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0, settings.bits, False)
    buckets, values = np.frombuffer(row["buckets"], np.int64), np.frombuffer(row["weights"], np.float32)
    return Weights(buckets, values, row["intercept"], settings.bits, row["fitted"])


def block_scores(block: Block, table: np.ndarray, intercept: float, bits: int) -> np.ndarray:
    text, bucket = features(block, bits)
    used = table[bucket] != 0
    text, bucket = distinct(text[used], bucket[used], bits)
    margin = np.bincount(text, table[bucket], block.size) + intercept
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def score(documents: DataFrame, weights: Weights, text: str = "text") -> DataFrame:
    """All columns of the documents and `toxicity`, a probability, which replaces a column of that name."""
    documents = documents.drop("toxicity")
    arrow_batches(documents.sparkSession)
    shipped = documents.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        table = model.table()
        for block in blocks(batches, text):
            yield block.rows.append_column("toxicity", pa.array(block_scores(block, table, model.intercept, model.bits)))

    return documents.mapInArrow(scored, with_fields(documents, "toxicity double"))


def without_toxic(documents: DataFrame, weights: Weights, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents, with their columns, but for those with words that a fitted model scores at or above the threshold."""
    if not weights.fitted:
        return documents
    arrow_batches(documents.sparkSession)
    shipped = documents.sparkSession.sparkContext.broadcast(weights)

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        table = model.table()
        for block in blocks(batches, text):
            worded = np.bincount(runs(WORD, block)[2], minlength=block.size) > 0
            yield block.rows.filter(pa.array(~worded | (block_scores(block, table, model.intercept, model.bits) < threshold)))

    return documents.mapInArrow(left, documents.schema)

"""Quality classifier: a byte-level convolutional network in NumPy.

Filters of WIDTH bytes are tables of a value for each place and byte, so a convolution is a sum of table
rows. Chunks of CHUNK bytes, each overlapping the next, cover the whole document. The largest response
of each filter in a chunk is its pooled value; the document has their maximum and mean over the chunks,
and a logistic layer combines these into one probability. Training uses a bounded sample of whole
labelled documents and Adam; a filter's gradient reaches only the places that gave the maxima.

Edge cases: a null or empty text is one blank chunk. Without training rows, or with one class only, the
network learns that class; with none every score is 0.5. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from cartwheel.llm.blocks import Block, arrow_batches, blocks, bounded_sample, with_fields

WIDTH = 6
FILTERS = 8
CHUNK = 512
STEP = 448
GROUP = 128


@dataclass(frozen=True)
class Settings:
    max_rows: int = 3_000
    max_bytes: int = 12 << 20
    epochs: int = 8
    batch: int = 32
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 5


@dataclass
class Network:
    table: np.ndarray  # WIDTH x 256 x FILTERS
    dense: np.ndarray  # 2 * FILTERS for maximum and mean, then the intercept


def chunks(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of all texts as rows of bytes padded with zeros, and the number of chunks of each."""
    sizes = np.diff(block.bounds)
    counts = np.maximum(1, -(-(sizes - (CHUNK - STEP)) // STEP))
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(block.bounds[:-1], counts) + inner * STEP
    left = np.repeat(block.bounds[1:], counts) - start
    padded = np.concatenate([block.data, np.zeros(CHUNK, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[start].copy()
    short = left < CHUNK
    rows[short] *= np.arange(CHUNK) < left[short, None]
    return rows, counts


def responses(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Every filter at every place of every chunk."""
    places = CHUNK - WIDTH + 1
    out = table[0][rows[:, :places]]
    for j in range(1, WIDTH):
        out += table[j][rows[:, j : j + places]]
    return out


def pooled(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    parts = [responses(rows[i : i + GROUP], table).max(1) for i in range(0, len(rows), GROUP)]
    return np.maximum(np.concatenate(parts), 0)


def combined(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    first = np.cumsum(counts) - counts
    mean = np.add.reduceat(values, first, axis=0) / counts[:, None]
    return np.concatenate([np.maximum.reduceat(values, first, axis=0), mean, np.ones((len(counts), 1))], axis=1)


def block_scores(block: Block, network: Network) -> np.ndarray:
    rows, counts = chunks(block)
    margin = combined(pooled(rows, network.table), counts) @ network.dense
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def train(sample: pa.Table, settings: Settings) -> Network:
    random = np.random.default_rng(settings.seed)
    network = Network(random.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(2 * FILTERS + 1))
    labels = np.array(sample["label"].to_pylist(), float)
    if not len(labels):
        return network
    network.dense[:-1] = random.normal(0, 0.3, 2 * FILTERS)
    texts = [block_chunks for b in blocks(iter(sample.select(["text"]).to_batches())) for block_chunks in split(*chunks(b))]
    weights = [network.table, network.dense]
    moments = [[np.zeros_like(w, float), np.zeros_like(w, float)] for w in weights]
    step = 0
    for _ in range(settings.epochs):
        order = random.permutation(len(texts))
        for i in range(0, len(order), settings.batch):
            own = order[i : i + settings.batch]
            step += 1
            rows, counts = np.concatenate([texts[k] for k in own]), np.array([len(texts[k]) for k in own])
            gradients = backward(rows, counts, labels[own], network)
            for w, (m, v), g in zip(weights, moments, gradients, strict=True):
                g = g + settings.decay * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def split(rows: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(rows, np.cumsum(counts)[:-1])


def backward(rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, network: Network) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the mean log loss: table, dense."""
    places, values = [], []
    for i in range(0, len(rows), GROUP):
        out = responses(rows[i : i + GROUP], network.table)
        at = out.argmax(1)
        places.append(at)
        values.append(np.take_along_axis(out, at[:, None], 1)[:, 0])
    at, value = np.concatenate(places), np.concatenate(values)
    active = np.maximum(value, 0)
    x = combined(active, counts)
    error = (1 / (1 + np.exp(-np.clip(x @ network.dense, -35, 35))) - labels) / len(labels)
    owner = np.repeat(np.arange(len(counts)), counts)
    top = active >= x[owner, :FILTERS]
    to_max = error[owner, None] * network.dense[:FILTERS] * top
    to_mean = error[owner, None] * network.dense[FILTERS:-1] / counts[owner, None]
    up = (to_max + to_mean) * (value > 0)
    table = np.zeros(network.table.size)
    for j in range(WIDTH):
        seen = rows[np.arange(len(rows))[:, None], at + j].astype(np.int64)
        index = (j * 256 + seen) * FILTERS + np.arange(FILTERS)
        table += np.bincount(index.ravel(), up.ravel(), table.size)
    return table.reshape(network.table.shape), x.T @ error


def fit(documents: DataFrame, labels: DataFrame, train_rows: Column, label: str = "quality", settings: Settings | None = None) -> Network:
    settings = settings or Settings()
    return train(bounded_sample(documents, labels, label, train_rows, settings.max_rows, settings.max_bytes).toArrow(), settings)


def score(documents: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """All columns of the documents and `quality`, a probability, which replaces a column of that name."""
    documents = documents.drop("quality")
    arrow_batches(documents.sparkSession)
    shipped = documents.sparkSession.sparkContext.broadcast(network)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for block in blocks(batches, text):
            yield block.rows.append_column("quality", pa.array(block_scores(block, model)))

    return documents.mapInArrow(scored, with_fields(documents, "quality double"))

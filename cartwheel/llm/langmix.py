"""Language identification by multilingual mixture inference.

Each language has a multinomial over hashed byte trigrams, from counts over all training documents. A
document is a mixture of languages: expectation-maximisation estimates the proportions, and languages
enter in the order of their proportion as long as the likelihood, less half a logarithm of the number of
trigrams for each, improves. The answer is the largest share of the selected set.

Edge cases: a text that is null or has no letter is `und` with score 0; ties go to the first language by
name; without training rows everything is `und`. Languages are the distinct values in training rows, at
most MAX_LANGUAGES, since their tables are shipped to the tasks. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.blocks import LOWER, Block, arrow_batches, blocks

BINS = 4_096
MAX_LANGUAGES = 512
SMOOTHING = 0.1
ROUNDS = 8
TEXTS = 512

# ASCII that is not a letter counts as a space.
FOLD = LOWER.copy()
FOLD[:128][~np.isin(np.arange(128), [*range(65, 91), *range(97, 123)])] = 32


@dataclass(frozen=True)
class Languages:
    names: list[str]
    chances: np.ndarray  # languages x BINS


def bins(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Text and bin of every trigram that is not blank."""
    data = FOLD[block.data].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    spread = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    text = np.repeat(np.arange(block.size), np.diff(block.bounds))
    inside = (text[2:] == text[:-2]) & ((data[:-2] != 32) | (data[1:-1] != 32) | (data[2:] != 32))
    return text[2:][inside], spread[inside]


def fit(rows: DataFrame, text: str = "text", lang: str = "lang") -> Languages:
    """Counts of every trigram bin in each language, over all rows with a language."""
    arrow_batches(rows.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for block in blocks(batches, "text"):
            coded = block.rows.column(1).dictionary_encode()
            names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            of, own = bins(block)
            table = np.bincount(code[of] * BINS + own, minlength=len(names) * BINS).reshape(len(names), BINS)
            for name, counts in zip(names, table, strict=True):
                total[name] = total.get(name, 0) + counts
        for name, counts in total.items():
            yield pa.record_batch({"lang": [name] * BINS, "bin": np.arange(BINS, dtype=np.int32), "n": counts})

    known = rows.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    parts = known.mapInArrow(counted, "lang string, bin int, n long")
    # One row for each language: its counts in the order of the bins.
    summed = parts.groupBy("lang", "bin").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("t"))
    found = summed.orderBy("lang").limit(MAX_LANGUAGES + 1).select("lang", F.col("t.n").alias("n")).toArrow()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.array(found["n"].to_pylist(), np.float64).reshape(-1, BINS) + SMOOTHING
    return Languages(found["lang"].to_pylist(), (counts / counts.sum(1, keepdims=True)).astype(np.float32))


def mixture(counts: np.ndarray, chances: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages in each row of counts, and the log-likelihood."""
    share = (allowed / allowed.sum(1, keepdims=True)).astype(np.float32)
    n = np.maximum(counts.sum(1, keepdims=True), 1)
    for _ in range(ROUNDS):
        share = share * ((counts / (share @ chances)) @ chances.T) / n
        share /= np.maximum(share.sum(1, keepdims=True), 1e-30)
    return share, np.einsum("ij,ij->i", counts, np.log(np.maximum(share @ chances, 1e-30)), dtype=np.float64)


def select(counts: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """The proportions of the selected languages, zero for the others."""
    size, k = len(counts), len(chances)
    likelihood = counts @ np.log(chances).T
    share = np.zeros((size, k), np.float32)
    share[np.arange(size), likelihood.argmax(1)] = 1
    best = likelihood.max(1).astype(np.float64)
    if k == 1:
        return share
    full, _ = mixture(counts, chances, np.ones((size, k), bool))
    order = np.argsort(-full, axis=1, kind="stable")
    cost = 0.5 * np.log(np.maximum(counts.sum(1), 2))
    going = np.arange(size)
    for used in range(2, k + 1):
        allowed = np.zeros((len(going), k), bool)
        np.put_along_axis(allowed, order[going, :used], True, axis=1)
        trial, reached = mixture(counts[going], chances, allowed)
        better = reached - (used - 1) * cost[going] > best[going]
        going, trial, reached = going[better], trial[better], reached[better]
        if not len(going):
            break
        share[going], best[going] = trial, reached - (used - 1) * cost[going]
    return share


def identify(documents: DataFrame, languages: Languages, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, lang_pred, score (its proportion), and languages with the proportions of the selected set."""
    arrow_batches(documents.sparkSession)
    shipped = documents.sparkSession.sparkContext.broadcast(languages)
    asked = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("spoken"))

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for block in blocks(batches):
            spoken = block.rows.column(2).to_numpy(zero_copy_only=False) & bool(model.names)
            of, own = bins(block)
            shares = []
            for first in range(0, block.size, TEXTS):
                last = min(block.size, first + TEXTS)
                a, b = np.searchsorted(of, [first, last])
                counts = np.bincount((of[a:b] - first) * BINS + own[a:b], minlength=(last - first) * BINS).reshape(-1, BINS)
                if model.names:
                    shares.append(select(counts.astype(np.float32), model.chances))
            share = np.concatenate(shares) if shares else np.zeros((block.size, 1), np.float32)
            top = share.argmax(1)
            names = np.array([*model.names, "und"], object)
            told = [
                sorted(((model.names[j], float(p[j])) for j in np.flatnonzero(p > 0)), key=lambda x: (-x[1], x[0])) if s else []
                for p, s in zip(share, spoken, strict=True)
            ]
            yield pa.record_batch(
                {
                    "key": block.rows.column(0),
                    "lang_pred": pa.array(np.where(spoken, names[top], "und"), pa.string()),
                    "score": np.where(spoken, np.minimum(share[np.arange(block.size), top], 1), 0).astype(np.float64),
                    "languages": pa.array([[{"lang": n, "share": s} for n, s in x] for x in told], pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
                }
            )

    kind = asked.schema["key"].dataType.simpleString()
    out = asked.mapInArrow(identified, f"key {kind}, lang_pred string, score double, languages array<struct<lang: string, share: double>>")
    return out.withColumnRenamed("key", key)

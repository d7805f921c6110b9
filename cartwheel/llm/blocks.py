"""Text columns as blocks of bytes, and words and hashes of whole blocks at once.

Every operator on text that runs in NumPy reads Arrow batches through `blocks`: a few megabytes of
whole documents at a time, so that memory does not depend on how many rows a batch or a task has.
A document larger than a block is a block of its own. A null text has no bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BLOCK_BYTES = 1 << 20
BATCH_ROWS = 2_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# What the contracts call white space: space and 09 to 0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SOLID = ~SPACE

# Letters, digits and everything outside ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


@dataclass(frozen=True)
class Block:
    """Some rows of a batch; text i is data[bounds[i]:bounds[i + 1]]."""

    rows: pa.RecordBatch
    data: np.ndarray
    bounds: np.ndarray

    @property
    def size(self) -> int:
        return len(self.bounds) - 1

    def counts(self, sorted_positions: np.ndarray) -> np.ndarray:
        """How many of the positions lie in each text."""
        return np.diff(np.searchsorted(sorted_positions, self.bounds))


def arrow_batches(spark: SparkSession) -> None:
    """Batches of a bounded number of rows for the Python operators of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    for batch in batches:
        column = pc.fill_null(batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()), b"")
        if not len(column):
            continue
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
            yield Block(batch.slice(first, last - first), whole[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
            first = last


def runs(member: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each maximal run of member bytes; runs end where texts end."""
    mask = member[block.data]
    if not len(mask):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    before, after = np.empty_like(mask), np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    after[-1], after[:-1] = False, mask[1:]
    inner = block.bounds[(block.bounds > 0) & (block.bounds < len(mask))]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.repeat(np.arange(block.size), block.counts(starts))


# Fixed odd multiplier of the polynomial hash, its inverse, and a random value for each byte.
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Remembered(dict):
    """What a process remembers for itself: functions that use it are shipped to tasks without the content."""

    def __reduce__(self) -> tuple:
        return Remembered, ()


_powers: dict[str, np.ndarray] = Remembered()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP and BACK to the powers 0 to n; kept while they are not larger than a few blocks."""
    have = _powers.get("step")
    if have is None or len(have) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        made = []
        for base in (STEP, BACK):
            series = np.full(size, base, np.uint64)
            series[0] = 1
            made.append(np.cumprod(series, dtype=np.uint64))
        if size > 4 * BLOCK_BYTES:
            return made[0], made[1]
        _powers["step"], _powers["back"] = made
    return _powers["step"], _powers["back"]


class Hasher:
    """Hashes of any spans of a block, each in constant time from sums over its bytes."""

    def __init__(self, data: np.ndarray):
        step, self.back = powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE[data] * step[: len(data)], out=self.sums[1:])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed(self.raw(starts, ends))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that every bit can be used."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def hash_bytes(values: list[bytes]) -> np.ndarray:
    """The hash that Hasher.spans gives to these bytes."""
    ends = np.cumsum([len(v) for v in values], dtype=np.int64)
    starts = ends - np.array([len(v) for v in values], np.int64)
    return Hasher(np.frombuffer(b"".join(values), np.uint8)).spans(starts, ends) if values else np.zeros(0, np.uint64)


def with_fields(frame: DataFrame, fields: str) -> StructType:
    """The schema of the frame and further columns, which may be null."""
    return StructType([*frame.schema.fields, *StructType.fromDDL(fields).fields])


def fold(key: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def bounded_sample(
    documents: DataFrame, labels: DataFrame, label: str, train: Column, max_rows: int, max_bytes: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Columns text and label: at most so many rows and bytes of whole labelled training texts, in one partition.

    Only training reads a sample; it takes the documents in the order of a hash of their ids, and leaves out
    each one that would pass the bytes left, so that a long text cannot push out the others. A document
    without label or with a null one is left out; of contradicting rows the higher counts. Ids and
    lengths are joined first, so that no text is shuffled; then at most max_rows ids, which is what bounds
    the broadcast, pick their texts.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    sizes = documents.where(train).select(key, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("_bytes"))
    found = sizes.join(marks, key).select(F.col(key).alias("key"), "label", "_bytes", F.xxhash64(key, F.lit(17)).alias("_order"))
    short = found.where(F.col("_bytes") <= max_bytes)
    first = short.orderBy("_order", "key", "_bytes").limit(max_rows).toArrow()
    left, fits = max_bytes, []
    for size in first["_bytes"].to_pylist():
        fits.append(size <= left)
        left -= size * fits[-1]
    chosen = first.filter(pa.array(fits, pa.bool_())).group_by(["key", "label", "_order", "_bytes"]).aggregate([([], "count_all")])
    picked = documents.sparkSession.createDataFrame(chosen).toDF("_key", "label", "_order", "_bytes", "_many")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    texts = documents.where(train).select(F.col(key).alias("_key"), F.col(text).alias("text"), size.alias("_bytes"))
    # Of rows that share id and length, as many as fit.
    number = F.row_number().over(Window.partitionBy("_key", "_bytes").orderBy("text"))
    own = texts.join(F.broadcast(picked), ["_key", "_bytes"]).withColumn("_number", number).where(F.col("_number") <= F.col("_many"))
    return own.orderBy("_order", "_key", "_bytes", "_number").limit(max(1, sum(fits))).select("text", "label")

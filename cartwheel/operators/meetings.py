"""Blocks of one side meet all packs of the other, one after another in the block's own task: no pair of them is shuffled.

Both sides are packed into rows of bytes first. A task holds its block and what it has found so far, and packs pass by it
as they are read, so neither side is copied for the other, and only what is found in the end is sent on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT = 1 << 18  # candidates beyond the limits that wait for the next cut
OUT_ROWS = 100_000  # of a batch


class Best:
    """The best (row, id, score) of every row, out of candidates that come in parts; equal scores in order of their ids.

    With `distinct` an id counts once for a row, with its highest score.
    """

    def __init__(self, limits: np.ndarray, distinct: bool = False):
        self.limits, self.distinct = limits, distinct
        self.parts: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        self.size, self.most = 0, int(1.5 * np.maximum(limits, 0).sum()) + KEPT

    def add(self, rows: np.ndarray, ids: pa.Array, scores: np.ndarray) -> None:
        if len(rows):
            self.parts.append((rows, ids, scores))
            self.size += len(rows)
        if self.size > self.most:
            self.parts = [self.cut()]
            self.size = len(self.parts[0][0])

    def cut(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """What is among the best so far, by row and rank."""
        rows, scores = (np.concatenate([np.empty(0, kind), *(p[i] for p in self.parts)]) for i, kind in ((0, np.int64), (2, np.float64)))
        if not len(rows):
            return rows, pa.nulls(0), scores
        ids = pa.concat_arrays([p[1] for p in self.parts])
        code = pc.rank(ids, sort_keys="ascending", tiebreaker="dense").to_numpy()
        if self.distinct:
            order = np.lexsort((-scores, code, rows))
            new = (np.diff(rows[order], prepend=-1) != 0) | (np.diff(code[order].astype(np.int64), prepend=-1) != 0)
            kept = order[new]
            rows, code, scores, ids = rows[kept], code[kept], scores[kept], ids.take(pa.array(kept))
        order = np.lexsort((code, -scores, rows))
        place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
        order = order[place < self.limits[rows[order]]]
        return rows[order], ids.take(pa.array(order)), scores[order]


def numbers(matrix: np.ndarray) -> bytes:
    return np.ascontiguousarray(matrix, np.float64).tobytes()


def matrix(data: pa.Scalar, rows: int) -> np.ndarray:
    """The rows of numbers in a pack's bytes."""
    values = np.frombuffer(data.as_buffer(), np.float64)
    return values.reshape(rows, -1) if rows else np.empty((0, 1))


def list_of(values: pa.ChunkedArray | pa.Array) -> pa.Array:
    """One list that holds all values."""
    flat = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def met(packs: DataFrame, blocks: DataFrame, n_blocks: int, tasks: int, kernel: Callable[[], object], schema: T.StructType) -> DataFrame:
    """What every block finds among all packs. `blocks` has an int `block` below `n_blocks`, and both are stored tables.

    The kernel gives an object for a task's block: `hold(row)` gets the block's columns once, `meet(row)` each pack's, and
    `found()` gives the batches of the result. Where blocks are fewer than `tasks`, packs are dealt out too, and a
    block finds something in each of several tasks.
    """
    dealt = packs.coalesce(max(1, -(-2 * tasks // max(n_blocks, 1)) if n_blocks < 2 * tasks else 1))
    # A block has a row with its columns, which meets the first pack of a task only, and a small one for all packs.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    rows = blocks.withColumn("_whole", F.lit(True)).unionByName(blocks.select("block", F.lit(False).alias("_whole")), allowMissingColumns=True)
    placed = rows.repartitionById(max(n_blocks, 1), F.col("block"))
    pairs = dealt.withColumn("_first", first).join(placed.hint("shuffle_replicate_nl"), F.col("_first") | ~F.col("_whole"))
    passing = [F.when(~F.col("_whole"), F.col(c)).alias(c) for c in packs.columns]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, object] = {}
        early: dict[int, list[dict[str, pa.Scalar]]] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch[name][at] for name in batch.schema.names}
                block = row["block"].as_py()
                if row["_whole"].as_py():
                    if block not in held:
                        held[block] = kernel()
                        held[block].hold(row)
                        for pack in early.pop(block, []):
                            held[block].meet(pack)
                elif block in held:
                    held[block].meet(row)
                else:  # the first pack, where the small row comes first
                    early.setdefault(block, []).append(row)
        for one in held.values():
            yield from one.found()

    return pairs.select("block", "_whole", *[c for c in blocks.columns if c != "block"], *passing).mapInArrow(meet, schema)


def batches_of(columns: list[pa.Array], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield from pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema).to_batches(OUT_ROWS)

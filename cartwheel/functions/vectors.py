"""Vector arithmetic: column expressions, and NumPy kernels for blocks that Spark has grouped."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPSILON = 1e-8
SCORE_DIGITS = 8  # scores are compared after rounding, so that equal items tie in every engine
TILE_CELLS = 1 << 18
STRIP = 1_024
FIRST = 256  # items of the first strip
MOST_SINGLE = 1e15


def dot(left: Column, right: Column, dim: int) -> Column:
    """Inner product, spelled out per element so that it is compiled with the rest of the stage."""
    return sum_of([left[i] * right[i] for i in range(dim)])


def norm(vector: Column, dim: int) -> Column:
    return F.sqrt(dot(vector, vector, dim))


def cosine(left: Column, right: Column, dim: int) -> Column:
    """Cosine with a small constant in the norms, so that a zero vector scores 0."""
    return dot(left, right, dim) / ((norm(left, dim) + EPSILON) * (norm(right, dim) + EPSILON))


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def mean_vector(vector: Column, dim: int) -> Column:
    """Aggregate: element-wise mean, NULL elements where the group has no vector.

    One average per element keeps the aggregation partial (map-side) and never collects a group.
    """
    return F.array(*[F.coalesce(F.avg(vector[i]), F.lit(0.0)) for i in range(dim)])


def hyperplanes(dim: int, n_tables: int, n_functions: int, seed: int) -> np.ndarray:
    """Random hyperplanes, shape (tables, dim, functions), drawn table by table."""
    return np.random.RandomState(seed).randn(n_tables, dim, n_functions)


def sign_keys(vector: Column, planes: np.ndarray) -> Column:
    """One key of '0'/'1' signs per table, as an array of strings."""

    def keys(vectors: pa.Array) -> pa.Array:
        rows = as_matrix(vectors)
        bits = np.einsum("nd,tdf->ntf", rows, planes) > 0
        codes = (bits.astype(np.uint8) + ord("0")).view(f"S{bits.shape[2]}")
        offsets = np.arange(0, codes.size + 1, bits.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel().astype(str)))

    return F.arrow_udf(keys, T.ArrayType(T.StringType()))(vector)


def as_matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an Arrow list column as a matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(len(vectors), -1) if len(vectors) else np.empty((0, 1))


def unit_rows(rows: np.ndarray) -> np.ndarray:
    return rows / (np.linalg.norm(rows, axis=1, keepdims=True) + EPSILON)


def top_products(
    queries: np.ndarray,
    items: np.ndarray,
    limits: np.ndarray,
    masked: tuple[np.ndarray, np.ndarray] | None = None,
    floor: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `limits[q]` largest inner products of every query row: (query, item, score).

    Scores are rounded, and equal scores keep item order. `masked` lists (query, item) cells that must not be returned.
    With a `floor` for every query, products well below it may be left out.
    """
    if not len(queries) or not len(items):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    before = None if floor is None else np.repeat(floor[:, None], max(int(limits.max()), 0), axis=1)
    return _best_cells(queries, items, limits, masked, _strips(np.arange(len(items)), STRIP), queries.shape[1], before=before)[:3]


def top_bounded_products(
    queries: np.ndarray,
    items: np.ndarray,
    k: int,
    masked: tuple[np.ndarray, np.ndarray] | None = None,
    strip: int = STRIP,
    before: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """What `top_products` finds with a limit of k, without scoring every pair, and the number of pairs left out.

    Rows end with (1, c) for queries and (b, 1) for items. Items are taken in strips, the long vectors first; a product is at
    most |q| times the longest vector left, plus the largest b left, plus c, and a query whose k-th best product
    is above that is done. `before` has the k best products, without c, that each query has met elsewhere, -inf where there
    are fewer: what cannot be among the best beside these is left out.
    """
    if not len(queries) or not len(items) or k <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), 0
    lengths, reach = np.linalg.norm(items[:, :-2], axis=1), np.linalg.norm(queries[:, :-2], axis=1)
    strips = _strips(np.argsort(-(lengths * reach.mean() + items[:, -2]), kind="stable"), strip)
    left = lambda values: np.maximum.accumulate([values[s].max() for s in reversed(strips)])[::-1]
    # c is the same for all items of a query, so it only joins the scores that are returned.
    return _best_cells(
        queries, items, np.full(len(queries), k), masked, strips, queries.shape[1] - 1, (reach, left(lengths), left(items[:, -2])), before
    )


def _strips(order: np.ndarray, strip: int) -> list[np.ndarray]:
    """A short strip for first k-th scores, then strips of equal size; items ascend in each."""
    ends = [0, *range(min(FIRST, strip), len(order), strip), len(order)]
    return [np.sort(order[lo:hi]) for lo, hi in zip(ends, ends[1:]) if hi > lo]


def _approximate(queries: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both sides in single precision where their numbers allow it, and how far a product of each query can be off."""
    most = max(np.abs(queries).max(), np.abs(items).max())
    kind = np.float32 if most < MOST_SINGLE else np.float64
    lengths = np.linalg.norm(queries, axis=1) * np.linalg.norm(items, axis=1).max()
    return queries.astype(kind), items.astype(kind), (queries.shape[1] + 8) * float(np.finfo(kind).eps) * lengths


def _best_cells(
    queries: np.ndarray,
    items: np.ndarray,
    limits: np.ndarray,
    masked: tuple[np.ndarray, np.ndarray] | None,
    strips: list[np.ndarray],
    wide: int,
    bounds: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
    before: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, item, score) of the largest products, and the number of pairs that `bounds` left out.

    Products of the first `wide` columns are taken in single precision, in tiles that stay in the cache. Whatever can
    be among the largest, given how far these may be off, is scored again in double precision, and only that counts.
    `bounds` holds the reach of each query, and of each strip and those behind it the longest vector and the largest addend.
    `before` has the best products of each query elsewhere.
    """
    own, others, doubt = _approximate(queries[:, :wide], items[:, :wide])
    # Rounding keeps the order, so what ranks among the first after rounding lies at most one step below the last of them.
    slack = 2 * doubt + 2 * 10**-SCORE_DIGITS
    by_limit = np.argsort(limits, kind="stable")
    right = [np.ascontiguousarray(others[s].T) for s in strips]
    widest = max(map(len, strips))
    height = min(len(queries), max(1, TILE_CELLS // widest))
    room, marks = np.empty(height * widest, own.dtype), np.empty(height * widest, bool)
    if masked is not None:
        strip_of, column = np.empty(len(items), np.int64), np.empty(len(items), np.int64)
        for i, s in enumerate(strips):
            strip_of[s], column[s] = i, np.arange(len(s))
        place = np.empty(len(queries), dtype=np.int64)
        place[by_limit] = np.arange(len(queries))
        meeting = place[masked[0]] // height * len(strips) + strip_of[masked[1]]
        order = np.argsort(meeting, kind="stable")
        meeting, mask_rows, mask_cols = meeting[order], place[masked[0]][order] % height, column[masked[1]][order]
    found, skipped = [], 0
    for start in range(0, len(queries), height):
        tile = by_limit[start : start + height]
        k = int(min(max(limits[tile[-1]], 0), len(items))) if before is None else before.shape[1]
        if k <= 0:
            continue
        near, loose = own[tile], slack[tile]
        best, active = np.full((len(tile), k), -np.inf, own.dtype), np.arange(len(tile))
        if before is not None:
            best = before[tile].astype(own.dtype)
        rows, cols, values = [], [], []
        for i, s in enumerate(strips):
            if bounds is not None:
                bound = bounds[0][tile[active]] * bounds[1][i] + bounds[2][i]
                active = active[bound + loose[active] + 1e-9 * np.abs(bound) >= best[active].min(axis=1)]
                skipped += (len(tile) - len(active)) * len(s)
                if not len(active):
                    skipped += len(tile) * sum(len(x) for x in strips[i + 1 :])
                    break
            shape = len(active), len(s)
            scores = room[: shape[0] * shape[1]].reshape(shape)
            np.matmul(near if shape[0] == len(tile) else near[active], right[i], out=scores)
            if masked is not None:
                line = np.full(len(tile), -1)
                line[active] = np.arange(len(active))
                lo, hi = np.searchsorted(meeting, start // height * len(strips) + np.array([i, i + 1]))
                at = line[mask_rows[lo:hi]]
                scores[at[at >= 0], mask_cols[lo:hi][at >= 0]] = -np.inf
            if i == 0:
                width = min(k, len(s))
                here = np.partition(scores, len(s) - width, axis=1)[:, len(s) - width :]
                if before is None:
                    best[active, :width] = here
                else:
                    best[active] = np.partition(np.hstack([best[active], here]), width, axis=1)[:, width:]
            floor = (best[active].min(axis=1) - loose[active]).astype(own.dtype)
            likely = np.greater_equal(scores, floor[:, None], out=marks[: scores.size].reshape(shape))
            at = np.flatnonzero(likely)
            value = scores.ravel()[at]
            if masked is not None:
                at, value = at[value > -np.inf], value[value > -np.inf]
            row, col = np.divmod(at, len(s))
            if i and len(row):
                # Only what beats a k-th score can move it: few cells, next to each other for each query.
                changed, first, counts = np.unique(row, return_index=True, return_counts=True)
                new = np.full((len(changed), counts.max()), -np.inf, own.dtype)
                new[np.repeat(np.arange(len(changed)), counts), np.arange(len(row)) - np.repeat(first, counts)] = value
                both = np.hstack([best[active[changed]], new])
                best[active[changed]] = np.partition(both, both.shape[1] - k, axis=1)[:, both.shape[1] - k :]
            rows.append(active[row])
            cols.append(s[col])
            values.append(value)
        row, col, value = (np.concatenate(part) for part in (rows, cols, values))
        # Many passed an early floor and not the last.
        late = value >= (best.min(axis=1) - loose).astype(own.dtype)[row]
        row, col = row[late], col[late]
        score = np.einsum("nd,nd->n", queries[tile[row]], items[col])
        score = np.round(score, SCORE_DIGITS) + 0.0
        order = np.lexsort((col, -score, row))
        row, col, score = row[order], col[order], score[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < limits[tile[row]]
        found.append((tile[row[keep]], col[keep], score[keep]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), skipped
    row, col, score = (np.concatenate(part) for part in zip(*found))
    return row, col, score, skipped


def sum_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)

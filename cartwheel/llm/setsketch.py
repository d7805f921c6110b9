"""MinHash near-dedup with SetSketch registers.

A document is the set of its distinct shingles: WORDS words in a row, or all its words if there are
fewer; words are runs of anything but white space, A-Z in lower case. Sets are compared by 64-bit hashes.

1. Each set gets REGISTERS registers: minima of exponential variates, spaced by powers of BASE and
   truncated. Equal sets become one class, however many documents share it.
2. Bands of ROWS registers are bucket keys. Members of a bucket are compared by registers alone: a pair
   is plausible if the joint likelihood of the registers, given the sizes, still rises at a similarity
   MARGIN standard deviations below the threshold. A bucket returns a spanning forest of its plausible
   pairs, never the pairs.
3. Within each component of plausible pairs, pairs that pass the same test are verified on the full sets,
   and again a spanning forest of the true links is returned. Its components are the answer.

Buckets and components of more than BLOCK members are cut into blocks, and each pair of blocks is a task
of its own, so that no task holds more than 2 * BLOCK members and every pair still meets. The price is
that a group of m different texts that resemble each other costs m * m / BLOCK set transfers; equal
sets do not count. A link of similarity 0.85 shares no band with a probability of about 1e-10.

Edge cases: documents without words (null, empty, white space) have no shingles and link with nothing.
Rows that repeat an id are one node. A null id links with nothing, has a null component and is kept. An
empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.blocks import LOWER, SOLID, Block, Hasher, arrow_batches, blocks, mixed, runs
from cartwheel.session import shared_path, stored

WORDS = 5
REGISTERS = 128
ROWS = 4
BASE = 1.02
TOP = 4_095
MARGIN = 4.5
BLOCK = 256

_random = np.random.default_rng(11)
TURN = _random.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2)
FACTOR = _random.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHAIN = np.uint64(0xD1342543DE82EF95)


def shingle_sets(block: Block) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    starts, ends, text = runs(SOLID, block)
    words = Hasher(LOWER[block.data]).spans(starts, ends)
    first = np.searchsorted(text, np.arange(block.size + 1))
    rolled = words[: max(0, len(words) - WORDS + 1)].copy()
    for k in range(1, WORDS):
        rolled = rolled * CHAIN + words[k : len(words) - WORDS + 1 + k]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for word in words[a:b]:
                whole = whole * CHAIN + word
            out.append(mixed(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of sets that are not empty, one row each."""
    if not sets:
        return np.zeros((0, REGISTERS), np.uint16)
    values = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    least = np.empty((REGISTERS, len(sets)), np.uint64)
    buffer = np.empty_like(values)
    for i in range(REGISTERS):
        np.bitwise_xor(values, TURN[i], out=buffer)
        np.multiply(buffer, FACTOR[i], out=buffer)
        least[i] = np.minimum.reduceat(buffer, first)
    uniform = (least.T.astype(np.float64) + 0.5) / 2.0**64
    return np.clip(np.floor(1 - np.log(-np.log1p(-uniform)) / math.log(BASE)) + 1_000, 0, TOP).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One key for each band; bands never share keys on purpose."""
    bands = registers.reshape(len(registers), -1, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2]).copy()
    for i in range(ROWS):
        keys = keys * CHAIN + bands[:, :, i] + np.uint64(1)
    return mixed(keys).view(np.int64)


def cutoff(percent: int) -> float:
    t = percent / 100
    return max(0.0, t - MARGIN * math.sqrt(t * (1 - t) / REGISTERS))


def plausible(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of rows of a and b: whether the similarity may reach the threshold, and equal registers.

    With u and v the shares of the sizes, a register of one set is the larger with probability
    p(u - v J), and of the other with p(v - u J), where p(x) = -log(1 - x (BASE - 1) / BASE) / log(BASE).
    The likelihood has one maximum, which lies above the cut-off if its slope there is positive.
    """
    above = np.zeros((len(a), len(b)), np.int32)
    equal = np.zeros((len(a), len(b)), np.int32)
    step = max(1, (1 << 14) // max(1, len(b)))
    for i in range(0, len(a), step):
        left, right = a[i : i + step, None, :], b[None, :, :]
        above[i : i + step] = (left > right).sum(2)
        equal[i : i + step] = (left == right).sum(2)
    below = REGISTERS - above - equal
    size_a, size_b = na[:, None].astype(np.float64), nb[None, :].astype(np.float64)
    u, v, j = size_a / (size_a + size_b), size_b / (size_a + size_b), cutoff(percent)
    step, scale = (BASE - 1) / BASE, math.log(BASE)
    x, y = np.clip(u - v * j, 1e-12, 1), np.clip(v - u * j, 1e-12, 1)
    px, py = -np.log1p(-x * step) / scale, -np.log1p(-y * step) / scale
    dx, dy = -v * step / (1 - x * step) / scale, -u * step / (1 - y * step) / scale
    slope = above * dx / px + below * dy / py - equal * (dx + dy) / np.maximum(1 - px - py, 1e-12)
    fits = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    return fits & (slope >= 0), equal


class Forest:
    """Joined sets of numbers."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of every key of sorted batches, one key after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).tolist()
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def pairs_of(unit: pa.Table, registers: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Plausible pairs of a unit as positions, those with the most equal registers first.

    A unit of one block has all its pairs, a unit of two blocks those across.
    """
    second = unit["second"].to_numpy().astype(bool)
    left = np.flatnonzero(~second)
    right = np.flatnonzero(second) if second.any() else left
    good, equal = plausible(registers[left], sizes[left], registers[right], sizes[right], percent)
    i, j = np.nonzero(good)
    a, b = left[i], right[j]
    keep = a != b if second.any() else a < b
    order = np.argsort(-equal[i, j][keep], kind="stable")
    return a[keep][order], b[keep][order]


def into_units(members: DataFrame, group: str, size: Column, key: str) -> DataFrame:
    """Members of a group in units: one for each pair of blocks; `second` tells the blocks of a pair apart."""
    parts = F.ceil(size / BLOCK)
    own = F.pmod(F.xxhash64(F.col(key)), parts)
    cut = members.withColumn("_parts", parts).withColumn("_own", own)
    spread = cut.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    # A large group stands once in its unit of equal blocks, else in both orders of the pair.
    unit = F.xxhash64(F.col(group), F.least("_own", "_other"), F.greatest("_own", "_other"))
    return spread.withColumn("unit", unit).withColumn("second", F.col("_own") > F.col("_other")).drop("_parts", "_own", "_other")


def sketched(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Id, n_shingles, two sums that name the set, and registers of every document."""
    arrow_batches(documents.sparkSession)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            sets = shingle_sets(block)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            registers = np.zeros((block.size, REGISTERS), np.uint16)
            registers[full] = sketches([sets[i] for i in full])
            names = [[s.sum(dtype=np.uint64), mixed(s * CHAIN).sum(dtype=np.uint64)] for s in sets]
            names = np.array(names, np.uint64).reshape(-1, 2).view(np.int64)
            packed = [row.tobytes() if n else None for row, n in zip(registers, sizes, strict=True)]
            yield pa.record_batch(
                {"id": block.rows.column(0).cast(pa.int64()), "n": sizes, "s1": names[:, 0].copy(), "s2": names[:, 1].copy(), "registers": pa.array(packed, pa.binary())}
            )

    asked = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return asked.mapInArrow(made, "id long, n long, s1 long, s2 long, registers binary")


def plausible_edges(classes: DataFrame, percent: int, work: str) -> DataFrame:
    """Edges that span the plausible pairs of every bucket."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(x, np.uint16) for x in batch.column(1).to_pylist()]
            if rows:
                keys = band_keys(np.stack(rows))
                yield pa.record_batch({"id": np.repeat(batch.column(0).to_numpy(), keys.shape[1]), "bucket": keys.ravel()})

    keys = stored(classes.select("id", "registers").mapInArrow(keyed, "id long, bucket long"), "buckets", work)
    sizes = keys.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    met = into_units(keys.join(sizes, "bucket"), "bucket", F.col("members"), "id").select("unit", "second", "id")
    units = met.join(classes.select("id", "n", "registers"), "id")

    def spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in grouped(batches, "unit"):
            ids, sizes = unit["id"].to_numpy(), unit["n"].to_numpy()
            registers = np.frombuffer(b"".join(unit["registers"].to_pylist()), np.uint16).reshape(len(ids), REGISTERS)
            forest = Forest(len(ids))
            a, b = pairs_of(unit, registers, sizes, percent)
            edges = [(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if forest.join(i, j)]
            if edges:
                at = np.array(edges)
                yield pa.record_batch({"a": ids[at[:, 0]], "b": ids[at[:, 1]]})

    return units.repartition(F.col("unit")).sortWithinPartitions("unit").mapInArrow(spanned, "a long, b long")


def verified_edges(documents: DataFrame, groups: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """Edges that span the true links within every group (columns id, component)."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            sets = [s.view(np.int64) for s in shingle_sets(block)]
            bounds = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.record_batch({"id": block.rows.column(0).cast(pa.int64()), "shingles": pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))})

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in grouped(batches, "unit"):
            ids = unit["id"].to_numpy()
            lists = unit["shingles"].combine_chunks()
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            sets = [values[p:q] for p, q in zip(bounds[:-1], bounds[1:], strict=True)]
            sizes = np.array([len(s) for s in sets])
            forest, edges = Forest(len(ids)), []
            a, b = pairs_of(unit, sketches(sets), sizes, percent)
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                if forest.root(i) == forest.root(j):
                    continue
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * shared >= percent * (sizes[i] + sizes[j] - shared):
                    forest.join(i, j)
                    edges.append((i, j))
            if edges:
                at = np.array(edges)
                yield pa.record_batch({"a": ids[at[:, 0]], "b": ids[at[:, 1]]})

    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    members = into_units(groups.join(sizes, "component"), "component", F.col("members"), "id").select("unit", "second", "id")
    asked = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    wanted = asked.join(groups.select("id"), "id", "left_semi").dropDuplicates(["id"])
    sets = wanted.mapInArrow(gathered, "id long, shingles array<long>").where(F.size("shingles") > 0)
    units = sets.join(members, "id").repartition(F.col("unit")).sortWithinPartitions("unit")
    return units.mapInArrow(linked, "a long, b long")


def components(edges: DataFrame, work: str, name: str) -> DataFrame:
    """Id and component (its smallest id) of every id in an edge, by alternating stars.

    Each round ties neighbours to the smallest id around them; rounds are tables in the work folder, and
    one replaces that before the last.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = stored(edges.where("a <> b").select(u, v).distinct(), f"{name}-0", work)
    size, turn = signature(now), 0
    while True:
        turn += 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = stored(small.distinct(), f"{name}-{turn % 3}", work)
        before, size = size, signature(now)
        if size == before:
            break
    low = now.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return stored(now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(low), f"{name}-labels", work)


def signature(edges: DataFrame) -> tuple:
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38, 0)"))
    return tuple(edges.agg(F.count("*"), mark).first())


def near_duplicates(documents: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_shingles, component_id and kept (whether it is the component's smallest id) of every document."""
    spark = documents.sparkSession
    work = shared_path(spark, f"near-{uuid.uuid4().hex[:6]}")
    made = stored(sketched(documents, key, text), "sketches", work)
    linkable = made.where("n > 0 AND id IS NOT NULL")
    whole = ["s1", "s2", "n"]
    classes = linkable.groupBy(*whole).agg(F.min("id").alias("id"), F.first("registers").alias("registers"))
    classes = stored(classes, "classes", work)
    plausible_groups = components(plausible_edges(classes, percent, work), work, "plausible")
    linked = components(verified_edges(documents, plausible_groups, key, text, percent), work, "linked")
    named = classes.select(*whole, "id").join(linked, "id", "left").select(*whole, F.coalesce("component", "id").alias("component"))
    alone = made.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component"))
    joined = linkable.join(named, whole).select("id", "n", "component").unionByName(alone)
    return joined.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def deduplicated(documents: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their columns: of each component the one with the smallest id."""
    dropped = near_duplicates(documents, percent, key, text).where(~F.col("kept")).select(key).distinct()
    return documents.join(dropped, key, "left_anti").select(*documents.columns)

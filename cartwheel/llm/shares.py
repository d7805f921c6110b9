"""Mixing sources to target weights: exact quotas of blocks, split among shards by a hypergeometric tree.

Sizes are words. Sources in the order of their names (null last) have weights that repeat; together they get `share`
times all words, no source more than `repeats` times its own, and what one cannot take goes to the others by weight.

Blocks. The documents of a source stand behind each other in the order of a hash of their ids, and every
`BLOCK_WORDS` words of that stream are a block. A pass over a source visits its blocks in an order of its own, by a
permutation that is computed and not stored; a source whose target is 1.4 times its size gets one whole pass and the
first blocks of a second, the last of them in part, so its words meet its target to the word. No word is in a pass
twice, so a document is never taken more often than there are passes.

Splitting tree. The node of a range of shards holds how many draws of each source fall to the range; its left half gets a
multivariate-hypergeometric sample of them, as if all draws had been shuffled, and the rest goes right. A leaf is
a shard of `SHARD_BLOCKS` draws, which continue each source's permuted order where the shards before it end, so shards are
disjoint and together exact. Nodes are seeded by their range: a task goes down the path to its own shards, and a lost
task is simply computed again. Inside a shard the draws are shuffled.

Memory: a row of some numbers for each source passes through the driver and to the tasks (`MAX_SOURCES`, about 60 MB);
more sources are an error. Where a node has more than `MOST` draws, which numpy does not sample, it samples
bundles of draws, and the counts stay exact.

Edge cases: a null text has no words; a document without words is in no block. Null ids and sources are values of their own.
Rows that repeat an id are documents of their own. Without any words all targets are 0. Other columns are not read by
`mixed`. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.functions.scalars import stable_hash
from cartwheel.session import shuffle_partitions, stored

WEIGHTS, SHARE, REPEATS = (3.0, 1.0, 2.0), 1.5, 2
BLOCK_WORDS = 4_096
SHARD_BLOCKS = 1_024
SHARDS_PER_TASK = 16
SEED = 12
MAX_SOURCES = 1_000_000
MOST = 500_000_000

PRIME, FACTOR, ROUNDS = (1 << 31) - 1, 48_271, 4


def words_in(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+`, 0 for null; no list of the words is made."""
    marks = F.regexp_replace(text, r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.coalesce(F.length(F.regexp_replace(marks, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def targets(sizes: np.ndarray, weights: np.ndarray, share: float, repeats: int) -> np.ndarray:
    """Weighted shares of share * all sizes, none above repeats * its size."""
    caps, total = repeats * sizes.astype(float), share * float(sizes.sum())
    if total <= 0:
        return np.zeros(len(sizes))
    order = np.argsort(caps / weights, kind="stable")
    full = np.concatenate([[0.0], np.cumsum(caps[order])[:-1]])
    rest = np.cumsum(weights[order][::-1])[::-1]
    # The level at which the sources from here on share what the full ones before leave.
    levels = np.maximum(total - full, 0.0) / rest
    first = np.argmax(levels * weights[order] <= caps[order])
    return np.minimum(caps, levels[first] * weights)


def halves(x: np.ndarray, n: int, key: int, back: bool) -> np.ndarray:
    """One Feistel network over the numbers below the power of four that holds n, or its inverse."""
    bits = max(1, ((n - 1).bit_length() + 1) // 2)
    low = (1 << bits) - 1
    left, right = x >> bits, x & low
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        at = left if back else right
        mix = (at + key + i) % PRIME * FACTOR % PRIME
        mix = (mix * mix + key) % PRIME & low
        left, right = (right ^ mix, left) if back else (right, left ^ mix)
    return left << bits | right


def permuted(x: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """Where a permutation of 0 to n - 1 takes the numbers x: the network again until they are below n."""
    x = halves(np.asarray(x, np.int64), n, key, back)
    while (out := x >= n).any():
        x[out] = halves(x[out], n, key, back)
    return x


@dataclass(frozen=True)
class Plan:
    """What is drawn from every source, by the place of its name."""

    names: list
    sizes: np.ndarray
    targets: np.ndarray
    block_words: int = BLOCK_WORDS
    shard_blocks: int = SHARD_BLOCKS
    seed: int = SEED

    def key(self, s: int, turn: int) -> int:
        return (self.seed * 1_000_003 + s * 7_919 + turn * 104_729) % PRIME

    def width(self, s: int, block: np.ndarray) -> np.ndarray:
        """Words of the blocks of a source: the last one may be short."""
        return np.minimum(self.sizes[s] - block * self.block_words, self.block_words)

    def blocks(self) -> np.ndarray:
        return -(-self.sizes // self.block_words)

    def words(self) -> np.ndarray:
        """Words to take: the targets, rounded."""
        return np.floor(self.targets + 0.5).astype(np.int64)

    def draws(self) -> tuple[np.ndarray, np.ndarray]:
        """How many blocks are drawn from each source in all its passes, and how many words the last one gives."""
        counts, last = np.zeros(len(self.sizes), np.int64), np.zeros(len(self.sizes), np.int64)
        for s, (size, n, words) in enumerate(zip(self.sizes.tolist(), self.blocks().tolist(), self.words().tolist())):
            if not words:
                continue
            turns, left = divmod(words, size)
            # Where the short block comes in the unfinished pass; the blocks up to there hold less.
            short = int(permuted([n - 1], n, self.key(s, turns), back=True)[0])
            missing = n * self.block_words - size
            held = lambda d: d * self.block_words - missing * (d > short)
            d = -(-left // self.block_words)
            d += held(d) < left
            counts[s] = turns * n + d
            if d:
                last[s] = left - held(d - 1)
            else:
                last[s] = self.width(s, permuted([n - 1], n, self.key(s, turns - 1)))[0]
        return counts, last


def plan(
    rows: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> Plan:
    """Sizes and targets of the sources of rows (source, size)."""
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda row: (row["source"] is None, row["source"] if row["source"] is not None else ""))
    sizes = np.array([row["size"] for row in found], np.int64)
    repeated = np.resize(np.array(weights, float), len(sizes))
    return Plan([row["source"] for row in found], sizes, targets(sizes, repeated, share, repeats), block_words, shard_blocks, seed)


def sample(rng: np.random.Generator, colors: np.ndarray, n: int) -> np.ndarray:
    """Multivariate hypergeometric: how many of n draws without putting back have each color."""
    total = int(colors.sum())
    if total <= MOST:
        return rng.multivariate_hypergeometric(colors, n, method="marginals")
    # Bundles of draws, and what they leave of n from the rests of the colors in their order.
    bundle = -(-total // MOST)
    many = colors // bundle
    got = rng.multivariate_hypergeometric(many, min(n // bundle, int(many.sum())), method="marginals") * bundle
    left, room = n - int(got.sum()), colors - got
    before = np.cumsum(room) - room
    return got + np.clip(left - before, 0, room)


def quotas(draws: np.ndarray, shard_blocks: int, seed: int, first: int, last: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, draws before it, its draws) of every source, for the shards from first to last - 1 of the tree."""

    def below(lo: int, hi: int, before: np.ndarray, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if hi <= first or lo >= last:
            return
        if hi - lo == 1:
            yield lo, before, own
            return
        middle = (lo + hi) // 2
        left = sample(np.random.default_rng((seed, lo, hi)), own, (middle - lo) * shard_blocks)
        yield from below(lo, middle, before, left)
        yield from below(middle, hi, before + left, own - left)

    n_shards = -(-int(draws.sum()) // shard_blocks)
    if n_shards:
        yield from below(0, n_shards, np.zeros_like(draws), draws)


DRAW_FIELDS = "source_place int, block long, turn int, words long, shard long, place long"


def drawn(spark: SparkSession, made: Plan) -> DataFrame:
    """One row for each draw: block and pass of a source, the words taken from its start, shard and place in it."""
    counts, last = made.draws()
    n_shards = -(-int(counts.sum()) // made.shard_blocks)
    n_blocks = made.blocks()

    def shard_rows(shard: int, before: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
        parts = []
        for s in np.flatnonzero(own):
            draw = before[s] + np.arange(own[s])
            turn, block = draw // n_blocks[s], draw % n_blocks[s]
            for t in np.unique(turn):
                block[turn == t] = permuted(block[turn == t], int(n_blocks[s]), made.key(int(s), int(t)))
            words = np.where(draw == counts[s] - 1, last[s], made.width(s, block))
            parts.append((np.full(len(draw), s), block, turn, words))
        columns = [np.concatenate(x) for x in zip(*parts)]
        order = np.random.default_rng((made.seed, shard)).permutation(len(columns[0]))
        columns = [c[order] for c in columns] + [np.full(len(order), shard), np.arange(len(order))]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["source_place", "block", "turn", "words", "shard", "place"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column("id").to_pylist():
                lo = task * SHARDS_PER_TASK
                for shard, before, own in quotas(counts, made.shard_blocks, made.seed, lo, min(lo + SHARDS_PER_TASK, n_shards)):
                    yield shard_rows(shard, before, own)

    n_tasks = -(-n_shards // SHARDS_PER_TASK)
    parts = max(1, min(n_tasks, 4 * shuffle_partitions(spark)))
    return spark.range(0, n_tasks, 1, parts).mapInArrow(tasks, DRAW_FIELDS)


def placed(documents: DataFrame, made: Plan, seed: int = SEED) -> DataFrame:
    """(row, key, mark, source_place, size, start), stored: every document and where it starts in its source's stream.

    `documents` has columns key, mark, source and size. The stream's order is a range partition; each partition adds up its own
    sizes, and sums of whole partitions, one row for each partition and source in it, shift them.
    """
    spark = documents.sparkSession
    names = spark.createDataFrame(list(enumerate(made.names)), f"source_place int, _name {documents.schema['source'].dataType.simpleString()}")
    rows = documents.join(names, F.col("source").eqNullSafe(F.col("_name"))).select("source_place", "key", "mark", "size")
    order = ["source_place", stable_hash(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(seed)), "size", "mark"]
    ranged = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    numbered = ranged.withColumn("row", F.monotonically_increasing_id())
    summed = numbered.mapInArrow(
        running_sums, f"row long, key {documents.schema['key'].dataType.simpleString()}, mark long, source_place int, size long, _before long"
    )
    rows = stored(summed.withColumn("_part", F.shiftright("row", 33)), "stream")
    sums = rows.groupBy("source_place", "_part").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source_place").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("source_place", "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    return rows.join(shifts, ["source_place", "_part"]).select(
        "row", "key", "mark", "source_place", "size", (F.col("_before") + F.col("_shift")).alias("start")
    )


def running_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row the sizes before it, in this partition and of its source."""
    last, total = -1, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        source = batch.column("source_place").to_numpy()
        size = batch.column("size").to_numpy()
        before = np.cumsum(size) - size
        starts = np.flatnonzero(np.diff(source, prepend=source[0] - 1))
        base = np.repeat(before[starts], np.diff(np.append(starts, len(source))))
        before = before - base
        if source[0] == last:
            before[source == last] += total
        last, total = source[-1], int(before[-1] + size[-1])
        columns = [batch.column(c) for c in ("row", "key", "mark", "source_place", "size")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int64())], names=["row", "key", "mark", "source_place", "size", "_before"])


def mixed(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    **settings,
) -> tuple[Plan, DataFrame, DataFrame]:
    """The plan, the placed documents, and the spans of the mix.

    Spans are (row, shard, place, turn, first_word, n_words): words of a document, from its word 0, in one draw. Rows of
    the documents that are equal in id and text are told apart by their number only.
    """
    sized = documents.select(
        F.col(key).alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark"), F.col(source).alias("source"), words_in(F.col(text)).alias("size")
    )
    sized = stored(sized, "sizes")
    made = plan(sized, **settings)
    rows = placed(sized, made, made.seed)
    width = made.block_words
    end = F.col("start") + F.col("size")
    pieces = rows.where("size > 0").select(
        "row",
        "source_place",
        "start",
        end.alias("end"),
        F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((end - 1) / width))).alias("block"),
    )
    # A range of tasks looks small to the optimiser; the draws that it makes are not to be broadcast.
    met = pieces.join(drawn(documents.sparkSession, made).hint("merge"), ["source_place", "block"])
    lo = F.greatest(F.col("start"), F.col("block") * width)
    hi = F.least(F.col("end"), F.col("block") * width + F.col("words"))
    spans = met.select("row", "shard", "place", "turn", (lo - F.col("start")).alias("first_word"), (hi - lo).alias("n_words"))
    return made, rows, spans.where("n_words > 0")


def texts(
    documents: DataFrame, rows: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(shard, place, key, first_word, text): the words of every span with one space between them.

    A shard is read in the order of place and, inside a draw, of the documents' stream (row).
    """
    own = documents.select(F.col(key).alias("_key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_mark"), F.col(text).alias("_text"))
    own = own.dropDuplicates(["_key", "_mark"])
    named = spans.join(rows.select("row", "key", "mark"), "row")
    words = F.slice(F.regexp_extract_all("_text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), F.col("first_word").cast("int") + 1, F.col("n_words").cast("int"))
    return named.join(own, F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark"))).select(
        "shard", "place", "row", "key", "first_word", F.array_join(words, " ").alias("text")
    )

"""Random-hyperplane hashing for cosine neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cartwheel.functions.vectors import as_matrix, hyperplanes, sign_keys, top_products, unit_rows
from cartwheel.operators.meetings import Best, batches_of, list_of, matrix, met, numbers
from cartwheel.session import initial_partitions, shuffle_partitions, stored

BLOCK_ROWS = 12_000
FEW_QUERIES = 200_000  # reach few buckets, which are sent to them
QUERY_ROWS = 250_000  # of a block that meets the packs of the index
MIN_QUERIES = 100_000
PACK_ROWS = 32_768


def with_keys(vectors: DataFrame, planes: np.ndarray) -> DataFrame:
    """Add `keys`, the hash key of the row's vector in every table."""
    return vectors.withColumn("keys", sign_keys(F.col("features"), planes))


def per_table(keyed: DataFrame) -> DataFrame:
    """Every row once per table, with `table_idx` and `hash_key`."""
    others = [c for c in keyed.columns if c != "keys"]
    return keyed.select(*others, F.posexplode("keys").alias("table_idx", "hash_key"))


def build_index(items: DataFrame, n_factors: int, n_tables: int = 5, n_functions: int = 10, seed: int = 42) -> DataFrame:
    """The bucket table: (table_idx, hash_key, item_id, features)."""
    planes = hyperplanes(n_factors, n_tables, n_functions, seed)
    keyed = with_keys(items.select("item_id", "features"), planes)
    return per_table(keyed).select("table_idx", "hash_key", "item_id", "features")


def bucket_sizes(index: DataFrame) -> DataFrame:
    """(table_idx, hash_key, n_items), which a stored index keeps beside it."""
    return index.groupBy("table_idx", "hash_key").agg(F.count("*").alias("n_items"))


def neighbors(
    index: DataFrame,
    queries: DataFrame,
    planes: np.ndarray,
    exclude: DataFrame | None = None,
    key: str = "query_id",
    block_rows: int = BLOCK_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """(key, rank, item_id, score): the `k` best candidates of every query by cosine.

    `queries` is (key, features, k) and may have `excluded`, an array of items that must not be returned;
    `exclude` (key, item_id) gives the same as rows. Candidates share the query's exact bucket in at least one
    table. A bucket is met as matrix products of bounded blocks, in which excluded items are masked, so each
    returns at most k items per query. `sizes` are the index's `bucket_sizes`, where they are known.
    """
    if exclude is not None:
        queries = queries.join(exclude.groupBy(key).agg(F.collect_set("item_id").alias("excluded")), key, "left")
    return neighbors_of_keyed(index, keyed_queries(queries, planes), key, block_rows, sizes)


def keyed_queries(queries: DataFrame, planes: np.ndarray, work: str | None = None) -> DataFrame:
    """Queries with their keys, stored: bucket sizes are counted before the buckets are met."""
    return stored(with_keys(queries, planes), "queries", work)


def neighbors_of_keyed(
    index: DataFrame,
    keyed: DataFrame,
    key: str,
    block_rows: int = BLOCK_ROWS,
    sizes: DataFrame | None = None,
    packs: DataFrame | None = None,
    work: str | None = None,
) -> DataFrame:
    """`neighbors` of queries with their keys. Many queries meet the packs of the whole index (`packs`, where they are stored
    already), few only the buckets that they reach. Tables are stored in the `work` folder."""
    n_queries = keyed.count()
    if packs is not None or n_queries > FEW_QUERIES:
        packs = stored(index_packs(index, sizes), "lsh-packs", work) if packs is None else packs
        return best_candidates(_pack_candidates(packs, index.schema["item_id"], keyed, key, n_queries, work), key)
    excluded = F.col("excluded") if "excluded" in keyed.columns else F.lit(None)
    item_list = T.ArrayType(index.schema["item_id"].dataType)
    probes = per_table(keyed.select(key, "features", "k", excluded.cast(item_list).alias("excluded"), "keys"))
    return best_candidates(_bucket_candidates(index, probes, key, block_rows, sizes), key)


def best_candidates(found: DataFrame, key: str = "query_id") -> DataFrame:
    """The candidates of all tables and blocks, each once, cut at each query's k."""
    # One shuffle by query serves the grouping and the ranking: at most k rows for each table and block.
    merged = (
        found.repartition(key)
        .groupBy(key, "item_id")
        .agg(F.max("score").alias("score"), F.max("k").alias("k"))
    )
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("item_id").asc())
    return (
        merged.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= F.col("k"))
        .select(key, "rank", "item_id", "score")
    )


def index_packs(index: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """The index in rows of about PACK_ROWS items: names of buckets, where the items of each end, the items and their unit vectors."""
    sizes = bucket_sizes(index) if sizes is None else sizes
    n_rows = sizes.agg(F.coalesce(F.sum("n_items"), F.lit(0))).first()[0]
    cuts = F.ceil(F.col("n_items") / PACK_ROWS).cast("int")
    # A large bucket has a pack for each of its cuts, small ones share packs.
    cut = index.join(sizes.select("table_idx", "hash_key", cuts.alias("_cuts")), ["table_idx", "hash_key"]).select(
        F.concat_ws("|", "table_idx", "hash_key").alias("bucket"),
        "item_id",
        "features",
        F.pmod(F.xxhash64("item_id"), F.col("_cuts")).alias("_cut"),
    )
    shard = F.pmod(F.xxhash64("bucket", "_cut"), F.lit(max(1, -(-n_rows // PACK_ROWS))))
    schema = T.StructType(
        [
            T.StructField("buckets", T.ArrayType(T.StringType())),
            T.StructField("ends", T.ArrayType(T.IntegerType())),
            T.StructField("items", T.ArrayType(index.schema["item_id"].dataType)),
            T.StructField("item_vectors", T.BinaryType()),
        ]
    )
    placed = cut.withColumn("shard", shard).drop("_cut")
    return placed.repartition(initial_partitions(index.sparkSession), "shard").groupBy("shard").applyInArrow(_index_pack, schema)


def _index_pack(rows: pa.Table) -> pa.Table:
    rows = rows.take(pc.sort_indices(rows, [("bucket", "ascending"), ("item_id", "ascending")]))
    runs = pc.run_end_encode(rows["bucket"].combine_chunks(), run_end_type=pa.int32())
    vectors = numbers(unit_rows(as_matrix(rows["features"])))
    return pa.table(
        [list_of(runs.values), list_of(runs.run_ends), list_of(rows["item_id"]), pa.array([vectors])], names=["buckets", "ends", "items", "item_vectors"]
    )


def _pack_candidates(packs: DataFrame, item: T.StructField, keyed: DataFrame, key: str, n_queries: int, work: str | None) -> DataFrame:
    """The best candidates of every query: blocks of queries, packed once, meet all packs of the index."""
    tasks = shuffle_partitions(packs.sparkSession)
    n_blocks = max(1, -(-n_queries // QUERY_ROWS), min(tasks, -(-n_queries // MIN_QUERIES)))
    excluded = F.col("excluded") if "excluded" in keyed.columns else F.lit(None)
    queries = keyed.select(
        F.col(key).alias("key"), "features", F.col("k").cast("int").alias("k"), excluded.cast(T.ArrayType(item.dataType)).alias("excluded"), "keys",
        F.pmod(F.monotonically_increasing_id(), F.lit(n_blocks)).cast("int").alias("block"),
    )
    own = keyed.schema[key]
    ints = T.ArrayType(T.IntegerType())
    held = T.StructType(
        [
            T.StructField("block", T.IntegerType()),
            T.StructField("queries", T.ArrayType(own.dataType)),
            T.StructField("limits", ints),
            T.StructField("vectors", T.BinaryType()),
            T.StructField("reached", T.ArrayType(T.StringType())),
            T.StructField("reached_ends", ints),
            T.StructField("reached_by", ints),
            T.StructField("excluded", T.ArrayType(item.dataType)),
            T.StructField("excluded_counts", ints),
        ]
    )
    spread = 4 * n_blocks  # so that few blocks share a task by their hashes
    blocks = stored(queries.repartition(spread, "block").groupBy("block").applyInArrow(_query_block, held), "query-blocks", work)
    schema = T.StructType([own, item, T.StructField("score", T.DoubleType()), T.StructField("k", T.IntegerType())])
    return met(packs, blocks, n_blocks, tasks, lambda: QueryBlock(schema), schema)


def _query_block(rows: pa.Table) -> pa.Table:
    """One row for a block: its queries, and for every bucket that they reach which of them do."""
    lists = rows["keys"].combine_chunks()
    n_tables = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    by = np.repeat(np.arange(len(lists)), n_tables)
    table = np.arange(len(by)) - np.repeat(np.cumsum(n_tables) - n_tables, n_tables)
    names = pc.binary_join_element_wise(pa.array(table).cast(pa.string()), lists.flatten().cast(pa.string()), "|").dictionary_encode()
    codes = names.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    ends = np.cumsum(np.bincount(codes, minlength=len(names.dictionary)))
    excluded = rows["excluded"].combine_chunks()
    counts = pc.fill_null(pc.list_value_length(excluded), 0)
    vectors = numbers(unit_rows(as_matrix(rows["features"])))
    columns = [
        list_of(rows["key"]), list_of(rows["k"]), pa.array([vectors]), list_of(names.dictionary), list_of(pa.array(ends, pa.int32())),
        list_of(pa.array(by[order], pa.int32())), list_of(excluded.flatten()), list_of(counts),
    ]
    named = ["queries", "limits", "vectors", "reached", "reached_ends", "reached_by", "excluded", "excluded_counts"]
    return pa.table([rows["block"].slice(0, 1), *columns], names=["block", *named])


class QueryBlock:
    """The queries of a block, and the best items that they have met."""

    def __init__(self, schema: T.StructType):
        self.schema = to_arrow_schema(schema)

    def hold(self, row: dict[str, pa.Scalar]) -> None:
        ints = lambda name: row[name].values.to_numpy(zero_copy_only=False)
        self.queries, self.limits = row["queries"].values, ints("limits")
        self.vectors = matrix(row["vectors"], len(self.queries))
        ends = ints("reached_ends").tolist()
        self.reached = dict(zip(row["reached"].values.to_pylist(), zip([0, *ends], ends)))
        self.by = ints("reached_by")
        self.excluded, self.counts = row["excluded"].values, ints("excluded_counts").astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.best, self.floor = Best(self.limits, distinct=True), np.full(len(self.queries), -np.inf)

    def meet(self, row: dict[str, pa.Scalar]) -> None:
        items = row["items"].values
        vectors, lo = matrix(row["item_vectors"], len(items)), 0
        for bucket, hi in zip(row["buckets"].values.to_pylist(), row["ends"].values.to_pylist()):
            if bucket in self.reached:
                at = self.by[slice(*self.reached[bucket])]
                own = items.slice(lo, hi - lo)
                limits = self.limits[at]
                rows, col, value = top_products(self.vectors[at], vectors[lo:hi], limits, self.masked(at, own), self.floor[at])
                self.best.add(at[rows].astype(np.int64), own.take(pa.array(col)), value)
                # Items of one bucket differ, so as many as the limit are a floor for the buckets of other tables too.
                least = np.full(len(at), np.inf)
                np.minimum.at(least, rows, value)
                full = (np.bincount(rows, minlength=len(at)) >= limits) & (limits > 0)
                self.floor[at[full]] = np.maximum(self.floor[at[full]], least[full])
            lo = hi

    def masked(self, at: np.ndarray, items: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Places of the queries and of the items that they exclude."""
        counts = self.counts[at]
        if not counts.any():
            return None
        owner = np.repeat(np.arange(len(at)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(self.starts[at], counts)
        col = pc.index_in(self.excluded.take(pa.array(place)), value_set=items)
        here = pc.is_valid(col).to_numpy(zero_copy_only=False)
        return (owner[here], col.drop_null().to_numpy().astype(np.int64)) if here.any() else None

    def found(self) -> Iterator[pa.RecordBatch]:
        rows, ids, scores = self.best.cut()
        yield from batches_of([self.queries.take(pa.array(rows)), ids, pa.array(scores), pa.array(self.limits[rows])], self.schema)


def _bucket_candidates(index: DataFrame, probes: DataFrame, key: str, block_rows: int, known: DataFrame | None) -> DataFrame:
    bucket = ["table_idx", "hash_key"]
    cuts = lambda rows: F.ceil(F.col(rows) / block_rows).cast("int")

    # Only buckets that both sides reach, and into how many blocks each side of one is cut.
    asked = probes.groupBy(*bucket).agg(F.count("*").alias("n_queries"))
    sizes = (bucket_sizes(index) if known is None else known).join(asked, bucket)
    plan = sizes.select(*bucket, cuts("n_items").alias("item_blocks"), cuts("n_queries").alias("query_blocks"))
    # Pieces (one block meeting another) share shards of about block_rows rows, one task call each.
    moved = F.sum(F.col("n_items") * cuts("n_queries") + F.col("n_queries") * cuts("n_items"))
    least = shuffle_partitions(index.sparkSession)
    # Tasks are as many as the input asks for, so one's share does not grow, and a heavy shard delays little.
    parts = initial_partitions(index.sparkSession)
    n_shards = sizes.agg(F.greatest(F.lit(least), F.ceil(F.coalesce(moved, F.lit(0)) / block_rows))).scalar()

    def placed(side: DataFrame, identity: str, own: str, other: str) -> DataFrame:
        cut = side.join(plan, bucket).select(
            *[F.col(c).alias(c) for c in side.columns],  # new columns: queries may be index rows
            F.pmod(F.xxhash64(identity), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block"),
            F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"),
            "item_blocks",
        )
        # Each piece gets the exclusions of its own item block.
        in_block = lambda x: F.pmod(F.xxhash64(x), F.col("item_blocks")).cast("int") == F.col("item_block")
        piece = F.concat_ws("|", "table_idx", "hash_key", "query_block", "item_block")
        return (
            (cut if own == "item" else cut.withColumn("excluded", F.filter("excluded", in_block)))
            .withColumn("piece", piece)
            .withColumn("shard", F.pmod(F.xxhash64("piece"), n_shards))
            .drop(*bucket, "query_block", "item_block", "item_blocks")
            .repartition(parts, "shard")
        )

    schema = T.StructType(
        [
            probes.schema[key],
            index.schema["item_id"],
            T.StructField("score", T.DoubleType()),
            T.StructField("k", T.IntegerType()),
        ]
    )
    left = placed(probes, key, "query", "item")
    right = placed(index, "item_id", "item", "query")
    return left.groupBy("shard").cogroup(right.groupBy("shard")).applyInArrow(_piece_scorer(key), schema)


def _piece_scorer(key: str):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, cols, values = [], [], []
        if len(left) and len(right):
            right = right.take(pc.sort_indices(right["item_id"]))
            pieces = pc.unique(right["piece"])
            queries, items = unit_rows(as_matrix(left["features"])), unit_rows(as_matrix(right["features"]))
            limits = left["k"].to_numpy()
            masked, item_codes, owners = _masked(left["excluded"], right["item_id"])
            by_piece = _rows_by_piece(left["piece"].take(pa.array(owners)), pieces)
            for q, i, m in zip(_rows_by_piece(left["piece"], pieces), _rows_by_piece(right["piece"], pieces), by_piece):
                cells = None
                if len(m):
                    # Both sides of a piece are in order, so places come from searches.
                    at = np.minimum(np.searchsorted(item_codes[i], masked[m]), len(i) - 1)
                    here = item_codes[i][at] == masked[m]
                    cells = np.searchsorted(q, owners[m[here]]), at[here]
                row, col, value = top_products(queries[q], items[i], limits[q], cells)
                rows.append(q[row])
                cols.append(i[col])
                values.append(value)
        row = pa.array(np.concatenate([np.empty(0, np.int64), *rows]))
        col = pa.array(np.concatenate([np.empty(0, np.int64), *cols]))
        value = pa.array(np.concatenate([np.empty(0), *values]))
        return pa.table(
            [left[key].take(row), right["item_id"].take(col), value, left["k"].take(row)],
            names=[key, "item_id", "score", "k"],
        )

    return score


def _masked(excluded: pa.ChunkedArray, items: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Excluded items as codes that ascend with the sorted items, the items' own codes, and the rows that exclude."""
    values = pc.unique(items)
    own = pc.index_in(items, value_set=values).to_numpy()
    lists = excluded.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    codes = pc.fill_null(pc.index_in(lists.flatten(), value_set=values), -1).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists)), sizes)
    known = codes >= 0
    return codes[known], own, rows[known]


def _rows_by_piece(column: pa.ChunkedArray, pieces: pa.Array) -> list[np.ndarray]:
    """Row numbers of every piece, in row order."""
    code = pc.fill_null(pc.index_in(column, value_set=pieces), -1).to_numpy()
    order = np.argsort(code, kind="stable")
    bounds = np.searchsorted(code[order], np.arange(len(pieces) + 1))
    return [order[lo:hi] for lo, hi in zip(bounds, bounds[1:])]

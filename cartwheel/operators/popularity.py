"""Items by popularity, and the first popular items that are not excluded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.vectors import SCORE_DIGITS
from cartwheel.operators.index import dense_index
from cartwheel.session import shuffle_partitions

HEAD = 1_000


def popularity_from_bias(items: DataFrame) -> DataFrame:
    """The item bias stands for popularity, rounded like every score that is ranked."""
    return items.select("item_id", F.round("bias", SCORE_DIGITS).alias("score"))


def ranked_popularity(popularity: DataFrame) -> DataFrame:
    """(pop_rank, item_id, score), rank 1 first, equal scores in item order."""
    indexed = dense_index(
        popularity.select("item_id", "score"), [F.col("score").desc(), F.col("item_id").asc()], "pop_rank", start=1
    )
    return indexed.select("pop_rank", "item_id", "score")


def most_popular(popularity: DataFrame, k: int, exclude: DataFrame | None = None) -> DataFrame:
    """The `k` most popular items outside `exclude` (item_id)."""
    if exclude is not None:
        popularity = popularity.join(exclude.select("item_id"), "item_id", "left_anti")
    return popularity.orderBy(F.col("score").desc(), F.col("item_id").asc()).limit(k)


def with_items(wanted: DataFrame, ranked: DataFrame, spread_by: str) -> DataFrame:
    """Look up the item of every wanted `pop_rank`.

    Nearly all rows want the first few ranks. Those rows are spread over a copy of the head of the list
    for every shuffle partition, so that no rank gathers in one task, whatever the cluster.
    """
    copies_of_head = shuffle_partitions(ranked.sparkSession)
    in_head = F.col("pop_rank") <= HEAD
    salt = F.when(in_head, F.pmod(F.xxhash64(spread_by), F.lit(copies_of_head)).cast("int")).otherwise(F.lit(0))
    salts = F.when(in_head, F.sequence(F.lit(0), F.lit(copies_of_head - 1))).otherwise(F.array(F.lit(0)))
    copies = ranked.select("pop_rank", "item_id", "score", F.explode(salts).alias("_salt"))
    return wanted.withColumn("_salt", salt).join(copies, ["pop_rank", "_salt"]).drop("_salt")


def popular_for_each(keys: DataFrame, ranked: DataFrame, key: str) -> DataFrame:
    """(key, rank, item_id, score): the `k` most popular items for every row of keys (key, k)."""
    wanted = keys.where(F.col("k") > 0).select(
        key, F.explode(F.sequence(F.lit(1).cast("long"), F.col("k").cast("long"))).alias("pop_rank")
    )
    found = with_items(wanted, ranked, key)
    return found.select(key, F.col("pop_rank").cast("int").alias("rank"), "item_id", "score")


def popular_outside(needs: DataFrame, excluded: DataFrame, ranked: DataFrame, key: str) -> DataFrame:
    """(key, rank, item_id, score): for every key its first `missing` popular items.

    `needs` is (key, n_found, missing, n_excluded), and ranks continue after `n_found`. `excluded`
    (key, item_id) may repeat; `n_excluded` is at least its distinct size per key. The excluded
    items of a key cut the popularity ranks into gaps, and the wanted ranks are the first ones in
    those gaps. Only excluded items near the top can matter, so each key handles few rows and
    emits exactly the rows it needs.
    """
    taken = (
        excluded.join(needs, key)
        .join(ranked.select("item_id", "pop_rank"), "item_id")
        .where(F.col("pop_rank") < F.col("missing") + F.col("n_excluded"))
        .select(key, "n_found", "missing", "pop_rank")
        .distinct()
    )
    start = needs.select(key, "n_found", "missing", F.lit(0).cast("long").alias("pop_rank"))
    order = Window.partitionBy(key).orderBy("pop_rank")
    gaps = (
        taken.unionByName(start)
        .withColumn("_free", F.col("pop_rank") - F.row_number().over(order) + 1)  # free ranks before
        .withColumn("_next", F.lead("pop_rank").over(order))
        .where(F.col("_free") < F.col("missing"))
        .withColumn("_first", F.col("pop_rank") + 1)
        .withColumn("_last", F.least(F.col("_next") - 1, F.col("pop_rank") + F.col("missing") - F.col("_free")))
        .where(F.col("_first") <= F.col("_last"))
    )
    rank_shift = F.col("n_found") + F.col("_free") - F.col("_first") + 1
    wanted = gaps.select(key, rank_shift.alias("_shift"), F.explode(F.sequence("_first", "_last")).alias("pop_rank"))
    found = with_items(wanted, ranked, key)
    return found.select(key, (F.col("_shift") + F.col("pop_rank")).cast("int").alias("rank"), "item_id", "score")

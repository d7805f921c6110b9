"""Recommendations for tables of baskets, items and users."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.config import Config
from cartwheel.functions.vectors import hyperplanes, mean_vector
from cartwheel.operators.lsh import bucket_sizes, build_index, index_packs, keyed_queries, neighbors, neighbors_of_keyed
from cartwheel.operators.popularity import (
    popular_for_each,
    popular_outside,
    popularity_from_bias,
    ranked_popularity,
)
from cartwheel.session import shared_path, stored

PASS_LINES = 40_000_000


@dataclass(frozen=True)
class Recommender:
    """Item factors, their bucket table and the popularity list."""

    items: DataFrame  # item_id, features
    index: DataFrame  # table_idx, hash_key, item_id, features
    popularity: DataFrame  # pop_rank, item_id, score
    planes: np.ndarray
    n_factors: int
    sizes: DataFrame | None = None  # table_idx, hash_key, n_items

    @classmethod
    def from_items(cls, items: DataFrame, n_factors: int, config: Config = Config()) -> Recommender:
        """Build from item parameters (item_id, features, bias)."""
        shape = (config.n_hash_tables, config.n_hash_functions, config.lsh_seed)
        index = stored(build_index(items, n_factors, *shape), "lsh-buckets")
        return cls(
            items.select("item_id", "features"),
            index,
            ranked_popularity(popularity_from_bias(items)),
            hyperplanes(n_factors, *shape),
            n_factors,
            stored(bucket_sizes(index), "lsh-sizes"),
        )


def basket_vectors(lines: DataFrame, items: DataFrame, n_factors: int, *also: Column) -> DataFrame:
    """(basket_id, features, n_known, ...): mean factors of the known items of every basket.

    A repeated item counts as often as it occurs; a basket without any known item gets the zero
    vector. Lines with a NULL item only announce their basket. `also` adds aggregates of the lines.
    """
    return (
        lines.join(items.select("item_id", "features"), "item_id", "left")
        .groupBy("basket_id")
        .agg(mean_vector(F.col("features"), n_factors).alias("features"), F.count("features").alias("n_known"), *also)
    )


def basket_lines(requests: DataFrame) -> DataFrame:
    """One line per item of every basket, and one NULL item line for an empty basket."""
    return requests.select("basket_id", "top_k", F.explode_outer("basket").alias("item_id"))


def recommend_for_lines(lines: DataFrame, recommender: Recommender, work: str | None = None) -> DataFrame:
    """(basket_id, rank, item_id, score, source) for lines (basket_id, item_id, top_k).

    Neighbours of the mean vector come first, then popular items fill up to top_k on their own
    scale. Nothing that is in the basket is returned: its known items, a list no longer than the catalogue,
    go along as the mask of its search. `work` is a folder for the tables that are stored on the way.
    Many lines are answered in passes of about PASS_LINES of them, by a hash of their basket: a pass keeps its answers, gives up
    its shuffle files and has its other tables replaced by the next, so what lies on disk at once follows the lines by their
    answers only.
    """
    spark = lines.sparkSession
    passes = -(-lines.count() // PASS_LINES)
    if passes <= 1:
        return _answered(lines, recommender, work)
    work = work or shared_path(spark, "passes")
    packs = stored(index_packs(recommender.index, recommender.sizes), "lsh-packs", work)
    answers = []
    for i in range(passes):
        own = lines.where(F.pmod(F.xxhash64("basket_id"), F.lit(passes)) == i)
        answers.append(stored(_answered(own, recommender, work, packs), f"answers-{i}", work))
    return reduce(DataFrame.unionByName, answers)


def _answered(lines: DataFrame, recommender: Recommender, work: str | None, packs: DataFrame | None = None) -> DataFrame:
    """The recommendations. The neighbours are stored: the fill needs their number and their items besides the result itself."""
    known = F.collect_set(F.when(F.col("features").isNotNull(), F.col("item_id")))
    also = [F.max("top_k").cast("int").alias("k"), F.count("item_id").alias("n_lines"), known.alias("excluded")]
    vectors = basket_vectors(lines, recommender.items, recommender.n_factors, *also)
    queries = keyed_queries(vectors, recommender.planes, work)
    in_basket = lines.where(F.col("item_id").isNotNull()).select("basket_id", "item_id")
    similar = stored(neighbors_of_keyed(recommender.index, queries, "basket_id", sizes=recommender.sizes, packs=packs, work=work), "similar", work)

    found = similar.groupBy("basket_id").agg(F.count("*").alias("n_found"))
    n_found = F.coalesce("n_found", F.lit(0))
    needs = (
        queries.join(found, "basket_id", "left")
        .where(F.col("k") > n_found)
        .select(
            "basket_id",
            n_found.alias("n_found"),
            (F.col("k") - n_found).alias("missing"),
            (F.col("n_lines") + n_found).alias("n_excluded"),
        )
    )
    taken = in_basket.unionByName(similar.select("basket_id", "item_id"))
    fill = popular_outside(stored(needs, "needs", work), taken, recommender.popularity, "basket_id")
    return similar.withColumn("source", F.lit("similarity")).unionByName(
        fill.withColumn("source", F.lit("popularity"))
    )


def numbered(requests: DataFrame, work: str | None = None) -> DataFrame:
    """The requests, stored with a number of their own as `request`: ids may repeat among them."""
    return stored(requests.withColumn("request", F.monotonically_increasing_id()), "requests", work)


def recommend_numbered(requests: DataFrame, recommender: Recommender, work: str | None = None) -> DataFrame:
    """(request, rank, item_id, score, source) for numbered requests that pass `request_error`."""
    valid = requests.where(request_error().isNull())
    asked = valid.select(F.col("request").alias("basket_id"), "basket", "top_k")
    return recommend_for_lines(basket_lines(asked), recommender, work).withColumnRenamed("basket_id", "request")


def recommend_baskets(requests: DataFrame, recommender: Recommender, work: str | None = None) -> DataFrame:
    """Recommendations for requests (basket_id, basket, top_k) that pass `request_error`.

    Every row is a request of its own, also where two have the same id; `request` tells them apart.
    """
    rows = numbered(requests, work)
    return rows.select("basket_id", "request").join(recommend_numbered(rows, recommender, work), "request").select(
        "basket_id", "request", "rank", "item_id", "score", "source"
    )


def request_error() -> Column:
    """Why a request cannot be served, or NULL. An empty basket is a valid request."""
    return (
        F.when(F.col("basket").isNull(), F.lit("basket is missing"))
        .when(F.col("top_k").isNull(), F.lit("top_k is missing"))
        .otherwise(F.lit(None).cast("string"))
    )


def responses(requests: DataFrame, recommender: Recommender) -> DataFrame:
    """(basket_id, response JSON, error): one row per request, failed ones with an error only."""
    rows = numbered(requests)
    # At most top_k recommendations per request.
    listed = recommend_numbered(rows, recommender).groupBy("request").agg(
        F.array_sort(F.collect_list(F.struct("rank", "item_id", "score"))).alias("ranked")
    )
    nothing = F.array().cast(listed.schema["ranked"].dataType)
    answer = F.struct(
        "basket",
        F.transform(
            F.coalesce("ranked", nothing),
            lambda r: F.struct(r["item_id"].alias("item_id"), r["score"].alias("score")),
        ).alias("recommendations"),
    )
    error = request_error()
    return rows.join(listed, "request", "left").select(
        "basket_id", F.when(error.isNull(), F.to_json(answer)).alias("response"), error.alias("error")
    )


def similar_items(queries: DataFrame, recommender: Recommender, key: str = "query_id") -> DataFrame:
    """(key, rank, item_id, score, source) for queries (key, k), where key is an item id.

    A known item gets its neighbours without itself and is never filled up. An unknown item gets
    the most popular items. An item asked for with several k is answered for each.
    """
    items = recommender.items.select(F.col("item_id").alias(key), "features")
    asked = queries.select(key, F.col("k").cast("int").alias("k")).distinct()
    rows = stored(asked.withColumn("request", F.monotonically_increasing_id()), "asked")
    known = rows.join(items, key).withColumn("excluded", F.array(key))
    near = neighbors(recommender.index, known.drop(key), recommender.planes, key="request", sizes=recommender.sizes)
    unknown = rows.join(items.select(key), key, "left_anti")
    popular = popular_for_each(unknown.select("request", "k"), recommender.popularity, "request")
    found = near.withColumn("source", F.lit("similarity")).unionByName(popular.withColumn("source", F.lit("popularity")))
    return found.join(rows.select("request", key), "request").select(key, "rank", "item_id", "score", "source")

"""User-item ratings and indexed training triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.config import Columns


def user_item_ratings(interactions: DataFrame, columns: Columns = Columns()) -> DataFrame:
    """One rating per pair: the plain mean of the per-order means, over the whole frame.

    A pair without any quantity has no rating and is left out.
    """
    return (
        interactions.where(F.col(columns.rating).isNotNull())
        .groupBy(F.col(columns.user).alias("user_id"), F.col(columns.item).alias("item_id"))
        .agg(F.mean(F.col(columns.rating).cast("double")).alias("rating"))
    )


def training_triples(ratings: DataFrame, user_index: DataFrame, item_index: DataFrame) -> DataFrame:
    """(user_idx, item_idx, rating); pairs with an id outside the index are dropped."""
    return (
        ratings.join(user_index, "user_id")
        .join(item_index, "item_id")
        .select("user_idx", "item_idx", "rating")
    )

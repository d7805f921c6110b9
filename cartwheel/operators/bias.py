"""Baseline estimates: global mean, item bias, user bias (shrunken means of residuals)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.session import stored


@dataclass(frozen=True)
class BiasModel:
    mean: DataFrame  # one row: mu
    items: DataFrame  # item_id, bias
    users: DataFrame  # user_id, bias

    @property
    def mu(self) -> Column:
        return F.coalesce(self.mean.scalar(), F.lit(0.0))


def fit_bias(ratings: DataFrame, damping: float, keep: bool = False) -> BiasModel:
    """Three aggregations; sums are partial, so a hot user or item costs one row per task.

    With `keep` every result is stored before the next one reads it; otherwise all are lazy.
    """

    def kept(frame: DataFrame, name: str) -> DataFrame:
        return stored(frame, name) if keep else frame

    def shrunken(residual: Column) -> Column:
        return (F.sum(residual) / (F.count("*") + damping)).alias("bias")

    mean = kept(ratings.agg(F.avg("rating").alias("mu")), "mean")
    mu = mean.scalar()
    items = kept(ratings.groupBy("item_id").agg(shrunken(F.col("rating") - mu)), "item-bias")
    residual = F.col("rating") - mu - F.col("bias")
    users = kept(ratings.join(items, "item_id").groupBy("user_id").agg(shrunken(residual)), "user-bias")
    return BiasModel(mean, items, users)

"""Factor models: parameters as tables, pair prediction, ALS training."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.config import Config
from cartwheel.functions.vectors import as_matrix, dot, zeros
from cartwheel.operators.als import fit_als
from cartwheel.operators.bias import BiasModel, fit_bias
from cartwheel.operators.grid import BLOCK_ROWS, block_of
from cartwheel.operators.ratings import training_triples
from cartwheel.session import shuffle_partitions, stored


@dataclass(frozen=True)
class FactorModel:
    """r = mu + b_u + b_i + p_u . q_i with one row of parameters per user and per item."""

    mean: DataFrame  # one row: mu
    users: DataFrame  # user_id, features, bias
    items: DataFrame  # item_id, features, bias
    n_factors: int

    @property
    def mu(self) -> Column:
        return F.coalesce(self.mean.scalar(), F.lit(0.0))


def with_parameters(ids: DataFrame, key: str, factors: DataFrame, biases: DataFrame, n_factors: int) -> DataFrame:
    """Parameters for every known id: what was not trained is zero."""
    return (
        ids.select(key)
        .join(factors.select(key, "features"), key, "left")
        .join(biases.select(key, "bias"), key, "left")
        .select(
            key,
            F.coalesce("features", zeros(n_factors)).alias("features"),
            F.coalesce("bias", F.lit(0.0)).alias("bias"),
        )
    )


def predict_pairs(pairs: DataFrame, model: FactorModel, how: str = "left") -> DataFrame:
    """Add `prediction`. An unknown user or item adds nothing to the score, or with
    how="inner" leaves the pair out."""
    users = model.users.select("user_id", F.col("features").alias("_p"), F.col("bias").alias("_bu"))
    items = model.items.select("item_id", F.col("features").alias("_q"), F.col("bias").alias("_bi"))
    score = (
        model.mu
        + F.coalesce("_bu", F.lit(0.0))
        + F.coalesce("_bi", F.lit(0.0))
        + F.coalesce(dot(F.col("_p"), F.col("_q"), model.n_factors), F.lit(0.0))
    )
    return (
        pairs.join(users, "user_id", how)
        .join(items, "item_id", how)
        .withColumn("prediction", score)
        .drop("_p", "_q", "_bu", "_bi")
    )


def predict_in_blocks(pairs: DataFrame, model: FactorModel, how: str = "left", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """What `predict_pairs` adds, with one exchange of the pairs instead of one for each side.

    Pairs go to the cell of their user's and their item's block, and meet the parameters of both blocks there. A hot item's
    pairs are spread over the user blocks. For pairs that outweigh the parameters; each of these is sent once for each
    block of the other side.
    """
    spark = pairs.sparkSession
    parts = shuffle_partitions(spark)
    n_users, n_items = (side.count() for side in (model.users, model.items))
    item_blocks = max(1, -(-n_items // block_rows))
    user_blocks = max(-(-n_users // block_rows), -(-parts // item_blocks))
    cell = lambda user, item: (user * F.lit(item_blocks) + item).cast("int").alias("_cell")
    placed = pairs.select("*", cell(block_of(F.col("user_id"), user_blocks), block_of(F.col("item_id"), item_blocks)))

    def sent(side: DataFrame, key: str, kind: str) -> DataFrame:
        own = block_of(F.col(key), user_blocks if kind == "u" else item_blocks)
        others = F.explode(F.sequence(F.lit(0), F.lit((item_blocks if kind == "u" else user_blocks) - 1))).alias("_other")
        rows = side.select(F.col(key).cast("string").alias("id"), F.concat("features", F.array("bias")).alias("w"), own.alias("_own"), others)
        at = cell(F.col("_own"), F.col("_other")) if kind == "u" else cell(F.col("_other"), F.col("_own"))
        return rows.select(F.lit(kind).alias("kind"), "id", "w", at)

    parameters = sent(model.users, "user_id", "u").unionByName(sent(model.items, "item_id", "i"))
    mu = model.mean.first()
    schema = T.StructType([*pairs.schema.fields, T.StructField("prediction", T.DoubleType())])
    return (
        placed.repartition(parts, "_cell")
        .groupBy("_cell")
        .cogroup(parameters.repartition(parts, "_cell").groupBy("_cell"))
        .applyInArrow(_cell_predictor((mu and mu["mu"]) or 0.0, model.n_factors, how, pairs.columns), schema)
    )


def _cell_predictor(mu: float, n_factors: int, how: str, columns: list[str]):
    def predict(pairs: pa.Table, parameters: pa.Table) -> pa.Table:
        both = []
        for kind, key in (("u", "user_id"), ("i", "item_id")):
            own = parameters.filter(pc.equal(parameters["kind"], kind))
            names = pairs[key].cast(pa.string())
            place = pc.index_in(names, value_set=own["id"].combine_chunks()) if len(own) else pa.nulls(len(pairs), pa.int32())
            # One row of zeros behind the others stands for what is not known.
            rows = np.vstack([as_matrix(own["w"]).reshape(-1, n_factors + 1), np.zeros((1, n_factors + 1))])
            both.append(rows[pc.fill_null(place, len(own)).to_numpy()] if len(pairs) else rows[:0])
            if how == "inner":
                known = pc.is_valid(place)
                pairs, both = pairs.filter(known), [x[known.to_numpy()] for x in both]
        p, q = both
        score = mu + p[:, -1] + q[:, -1] + np.einsum("nd,nd->n", p[:, :-1], q[:, :-1])
        return pairs.select(columns).append_column("prediction", pa.array(score, pa.float64()))

    return predict


def _decoded(factors: DataFrame, index: DataFrame, key: str, position: str) -> DataFrame:
    decoded = factors.withColumnRenamed("id", position).join(index, position)
    return decoded.select(key, F.col("features").cast("array<double>").alias("features"))


def fit_factor_model(
    ratings: DataFrame, user_index: DataFrame, item_index: DataFrame, config: Config, max_iter: int | None = None
) -> tuple[FactorModel, BiasModel]:
    """Biases by aggregation, then ALS on what they leave unexplained; the parameters are stored."""
    bias = fit_bias(ratings, config.bias_damping, keep=True)
    residuals = residual_ratings(ratings, bias)
    user_factors, item_factors = fit_als(
        training_triples(residuals, user_index, item_index),
        rank=config.n_factors,
        max_iter=config.epochs if max_iter is None else max_iter,
        reg=config.reg_lambda,
        nonnegative=False,
    )
    n = config.n_factors
    users = _decoded(user_factors, user_index, "user_id", "user_idx")
    items = _decoded(item_factors, item_index, "item_id", "item_idx")
    users = stored(with_parameters(user_index, "user_id", users, bias.users, n), "users")
    items = stored(with_parameters(item_index, "item_id", items, bias.items, n), "items")
    return FactorModel(bias.mean, users, items, n), bias


def als_model(triples: DataFrame, n_factors: int, user_factors: DataFrame, item_factors: DataFrame) -> FactorModel:
    """Factors by index as a plain dot-product model over user_idx and item_idx, which it calls user_id and item_id."""
    bias = F.lit(0.0).alias("bias")
    side = lambda factors, key: factors.select(F.col("id").alias(key), "features", bias)
    mean = triples.sparkSession.range(1).select(F.lit(0.0).alias("mu"))
    return FactorModel(mean, side(user_factors, "user_id"), side(item_factors, "item_id"), n_factors)


def residual_ratings(ratings: DataFrame, bias: BiasModel) -> DataFrame:
    explained = bias.mu + F.col("_bi") + F.col("_bu")
    return (
        ratings.join(bias.items.withColumnRenamed("bias", "_bi"), "item_id")
        .join(bias.users.withColumnRenamed("bias", "_bu"), "user_id")
        .select("user_id", "item_id", (F.col("rating") - explained).alias("rating"))
    )


def embeddings_of(ids: DataFrame, key: str, parameters: DataFrame) -> DataFrame:
    """Factor lookup; an unknown id keeps its row with NULL features."""
    return ids.select(key).join(parameters.select(key, "features"), key, "left")


def without_biases(model: FactorModel) -> FactorModel:
    """The same factors as a plain dot-product model."""
    zero = F.lit(0.0).alias("bias")
    return replace(
        model, users=model.users.select("user_id", "features", zero), items=model.items.select("item_id", "features", zero)
    )

"""The order tables as input of the jobs, and a factor model that SQL can rebuild."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import Config
from cartwheel.functions.scalars import parse_basket
from cartwheel.operators.bias import BiasModel, fit_bias
from cartwheel.operators.extract import interactions
from cartwheel.operators.factors import FactorModel, with_parameters
from cartwheel.operators.index import id_index
from cartwheel.operators.ratings import user_item_ratings
from cartwheel.operators.recommend import Recommender
from cartwheel.operators.split import FOLDER_CHARS, chronological_split
from cartwheel.session import shared_path, stored, stored_bytes, tune
from cartwheel.sources.partitions import read_manifest, read_partitions, write_partitions
from cartwheel.sources.purchases import described_purchases, purchases_from_orders

# The whole order history without a window, and its last year for the jobs that show the date window.
HISTORY = Config(num_days=None)
LAST_YEAR = Config(end_date="2001-08-01", num_days=365)
# The tables that grow most.
SCANNED = ("lineitem", "orders", "events")
TOP_K = 10
BASKET_K = 5
VECTOR_SCALE = 8.0


@dataclass(frozen=True)
class Job:
    """Frames derived from one data folder.

    `history`, `train`, `test`, `users`, `items` and `recommender` write tables when first used, since
    several jobs read them; the other properties are lazy plans.
    """

    spark: SparkSession
    folder: str
    config: Config = HISTORY

    def __post_init__(self):
        tune(self.spark, stored_bytes(self.spark, *(f"{self.folder}/{name}.parquet" for name in SCANNED)))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def purchases(self) -> DataFrame:
        return purchases_from_orders(self.table("lineitem"), self.table("orders"))

    @cached_property
    def described(self) -> DataFrame:
        return described_purchases(self.table("lineitem"), self.table("orders"), self.table("part"))

    @cached_property
    def interactions(self) -> DataFrame:
        return interactions(self.purchases, self.config)

    @cached_property
    def history_path(self) -> str:
        """The interactions as a table in folders by month: everything about the model reads them several times."""
        path = shared_path(self.spark, "interactions")
        write_partitions(self.interactions.withColumn("month", F.substring("date_partition", 1, FOLDER_CHARS)), path, "month")
        return path

    @cached_property
    def history(self) -> DataFrame:
        return read_partitions(self.spark, self.history_path).withColumn("month", F.col("month").cast("string"))

    @cached_property
    def sides(self) -> tuple[DataFrame, DataFrame]:
        """Train and test side; each scans its own months."""
        manifest = read_manifest(self.spark, self.history_path)
        return chronological_split(self.history, self.config.test_fraction, manifest, "month")

    @cached_property
    def train(self) -> DataFrame:
        return stored(user_item_ratings(self.sides[0]), "train")

    @cached_property
    def test(self) -> DataFrame:
        return stored(user_item_ratings(self.sides[1]), "test")

    @cached_property
    def bias(self) -> BiasModel:
        return fit_bias(self.train, self.config.bias_damping)

    def ids(self, column: str, name: str) -> DataFrame:
        """Distinct ids of both sides."""
        return self.history.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct()

    @cached_property
    def indexes(self) -> tuple[DataFrame, DataFrame]:
        """Users and items of both sides by number, from the stored history."""
        return (
            id_index([self.history], "network_userid", "user_id", "user_idx"),
            id_index([self.history], "item_id", "item_id", "item_idx"),
        )

    def given_factors(self, ids: DataFrame, key: str, first: int) -> DataFrame:
        """Factors assembled from two rows of `embeddings`: eight elements of each."""
        vectors = self.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
        n = vectors.agg(F.count("*")).scalar()
        own = F.pmod(F.col(key), n)
        other = F.pmod(F.col(key) * 3 + F.floor(F.col(key) / n), n)
        a = vectors.select(F.col("vec_id").alias("_a"), F.slice("v", first, 8).alias("_va"))
        b = vectors.select(F.col("vec_id").alias("_b"), F.slice("v", first + 8, 8).alias("_vb"))
        scaled = F.transform(F.concat("_va", "_vb"), lambda x: x * F.lit(VECTOR_SCALE))
        return (
            ids.withColumn("_a", own)
            .withColumn("_b", other)
            .join(a, "_a")
            .join(b, "_b")
            .select(key, scaled.alias("features"))
        )

    @cached_property
    def users(self) -> DataFrame:
        """Stored parameters of every user of either side: given factors, trained bias."""
        ids = self.ids("network_userid", "user_id")
        factors = self.given_factors(ids, "user_id", 17)
        return stored(with_parameters(ids, "user_id", factors, self.bias.users, self.config.n_factors), "users")

    @cached_property
    def items(self) -> DataFrame:
        """Stored parameters of every item of either side."""
        ids = self.ids("item_id", "item_id")
        factors = self.given_factors(ids, "item_id", 1)
        return stored(with_parameters(ids, "item_id", factors, self.bias.items, self.config.n_factors), "items")

    @cached_property
    def model(self) -> FactorModel:
        return FactorModel(self.bias.mean, self.users, self.items, self.config.n_factors)

    @cached_property
    def recommender(self) -> Recommender:
        return Recommender.from_items(self.items, self.config.n_factors, self.config)

    def basket_lines(self) -> DataFrame:
        """Every order is a basket. Returned lines carry an id no model knows."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("basket_id"), self.basket_item().alias("item_id"), F.lit(BASKET_K).alias("top_k")
        )

    @staticmethod
    def basket_item() -> Column:
        return F.when(F.col("l_returnflag") == "R", -1 - F.col("l_partkey")).otherwise(F.col("l_partkey"))

    def requests(self) -> DataFrame:
        """Every event asks with the items of its text; some requests cannot be served.

        Sign-ups ask with an empty basket, errors with none, clicks name their item twice, and
        purchases name one that no model knows.
        """
        event, user = F.col("event_type"), F.col("user_id")
        item = F.get_json_object("props", "$.k")
        other = F.when(event == "purchase", -1 - user).otherwise(user).cast("string")
        text = F.concat_ws(" , ", item, F.when(event == "click", item), other)
        basket = parse_basket(text).cast("array<bigint>")
        empty = F.array().cast("array<bigint>")
        return self.table("events").select(
            F.col("event_id").alias("basket_id"),
            F.when(event == "signup", empty).when(event != "error", basket).alias("basket"),
            F.when(event == "view", 3).otherwise(BASKET_K).alias("top_k"),
        )

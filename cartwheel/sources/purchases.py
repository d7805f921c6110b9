"""Purchase events from CSV exports and from order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.config import Columns
from cartwheel.schemas import PURCHASE_EVENTS


def read_purchases_csv(
    spark: SparkSession, path: str, infer: bool = False, schema: T.StructType = PURCHASE_EVENTS, columns: Columns = Columns()
) -> DataFrame:
    """CSV with a header, by the names in it: in any order, with the known columns kept and others left out.

    `columns` names the five columns the pipeline needs; one that is missing is an error. Types are
    declared by the schema and text otherwise; `infer` reads the files once more to guess them. All files
    need the same header, which Spark checks.
    """
    reader = spark.read.option("header", True)
    header = reader.csv(path).columns
    needed = [columns.user, columns.item, columns.rating, columns.order, columns.date]
    missing = [n for n in needed if n not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    if infer:
        frame = reader.option("inferSchema", True).csv(path)
    else:
        types = {f.name: f.dataType for f in schema}
        declared = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header])
        frame = reader.option("enforceSchema", False).schema(declared).csv(path)
    kept = {*schema.fieldNames(), *needed}
    return frame.select(*(F.col(f"`{n}`") for n in header if n in kept))


def purchases_from_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The purchase-event view over order lines: one row per line, dated by its order."""
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("network_userid"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("item_quantity"),
        F.col("o_orderdate").alias("datestamp"),
    )


def described_purchases(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Purchase events with order value, brand and price, and where the event came from."""
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            F.col("o_orderdate").alias("datestamp"),
            F.col("l_orderkey").alias("order_id"),
            F.col("o_totalprice").alias("order_value"),
            F.col("l_partkey").alias("item_id"),
            F.col("p_brand").alias("item_brand"),
            F.col("p_retailprice").alias("item_price"),
            F.col("l_quantity").alias("item_quantity"),
            F.col("o_custkey").alias("network_userid"),
            F.col("l_returnflag").alias("source_id"),
            F.when(F.col("l_linestatus") == "F", "purchase").otherwise("view").alias("commerce_interaction"),
        )
    )

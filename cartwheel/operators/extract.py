"""Purchase events to interactions: window, clean, aggregate, audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cartwheel.config import Config
from cartwheel.functions.scalars import as_date, in_date_window, partition_label, percent


def kept(events: DataFrame, config: Config) -> Column:
    """Rows inside the date window whose user and item are known. The order may be NULL."""
    cols = config.columns
    return (
        in_date_window(events, cols.date, config.end_date, config.num_days)
        & F.col(cols.user).isNotNull()
        & F.col(cols.item).isNotNull()
    )


def cleaned(events: DataFrame, config: Config) -> DataFrame:
    """Kept events with their calendar date and a numeric quantity."""
    cols = config.columns
    return events.where(kept(events, config)).select(
        cols.user,
        cols.order,
        cols.item,
        F.col(cols.rating).try_cast("float").alias(cols.rating),
        as_date(events, cols.date).alias("_date"),
    )


def windowed_purchases(events: DataFrame, config: Config) -> DataFrame:
    """Cleaned events of the window with a date partition label."""
    rows = cleaned(events, config)
    return rows.withColumn("date_partition", partition_label(F.col("_date"))).drop("_date")


def interactions(events: DataFrame, config: Config) -> DataFrame:
    """Mean quantity per user, order, item and day. The day is labelled after the aggregation."""
    cols = config.columns
    return (
        cleaned(events, config)
        .groupBy(cols.user, cols.order, cols.item, "_date")
        .agg(F.mean(cols.rating).alias(cols.rating))
        .select(cols.user, cols.order, cols.item, cols.rating, partition_label(F.col("_date")).alias("date_partition"))
    )


def extraction_audit(events: DataFrame, config: Config) -> DataFrame:
    """One row: events read, events kept, their share, interactions made."""
    cols = config.columns
    group = F.struct(cols.user, cols.order, cols.item, as_date(events, cols.date).alias("day"))
    flags = events.select(kept(events, config).alias("kept"), group.alias("group"))
    counted = flags.agg(
        F.count("*").alias("initial_count"),
        F.count_if("kept").alias("filtered_count"),
        F.count_distinct(F.when(F.col("kept"), F.col("group"))).alias("aggregated_count"),
    )
    return counted.select(
        "initial_count",
        "filtered_count",
        F.round(percent(F.col("filtered_count"), F.col("initial_count")), 6).alias("filtered_pct"),
        "aggregated_count",
    )


def observed_interactions(events: DataFrame, config: Config) -> tuple[DataFrame, Observation, Observation]:
    """Interactions whose audit counts come as a by-product of the one job that writes them."""
    read, made = Observation("events"), Observation("interactions")
    watched = events.withColumn("_kept", kept(events, config)).observe(
        read, F.count("*").alias("initial_count"), F.count_if("_kept").alias("filtered_count")
    )
    frame = interactions(watched.where("_kept").drop("_kept"), config)
    return frame.observe(made, F.count("*").alias("aggregated_count")), read, made


def recent_purchases(
    events: DataFrame, as_of: str, months: int, source_id: str, interaction: str = "purchase"
) -> DataFrame:
    """Distinct purchases of one source over the last months: the upstream extraction query."""
    since = F.add_months(F.lit(as_of).cast("date"), -months)
    date = as_date(events, "datestamp")
    return (
        events.where(
            (F.col("source_id") == source_id) & (F.col("commerce_interaction") == interaction) & (date >= since)
        )
        .select("datestamp", "order_id", "order_value", "item_id", "item_brand", "item_price", "item_quantity")
        .distinct()
    )


def partition_summary(frame: DataFrame) -> DataFrame:
    """Number of date partitions, the first and the last."""
    return frame.agg(
        F.countDistinct("date_partition").alias("n_partitions"),
        F.min("date_partition").alias("first_partition"),
        F.max("date_partition").alias("last_partition"),
        F.count("*").alias("n_rows"),
    )

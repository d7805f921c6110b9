"""Column profiles and exact percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.vectors import sum_of
from cartwheel.session import checkpointed, shuffle_partitions


def null_profile(frame: DataFrame) -> DataFrame:
    """One row: the number of NULLs in every column."""
    return frame.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in frame.columns])


def distinct_profile(frame: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the exact number of distinct values in each of the columns."""
    return frame.agg(*[F.countDistinct(c).alias(f"distinct_{c}") for c in columns])


def percentiles(frame: DataFrame, group: str, value: str, points: dict[str, float]) -> DataFrame:
    """Exact percentiles with linear interpolation, the mean and 1000 / mean, per group.

    Values are first counted, so copies of a value are one row. The counted values are
    range-partitioned by (group, value) and numbered with running counts, so a group may spread
    over any number of tasks. For a point q the values at floor(q(n-1)) and ceil(q(n-1)) are read off.
    """
    spark = frame.sparkSession
    clean = frame.where(F.col(value).isNotNull()).select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"))
    counted = clean.groupBy("_g", "_v").agg(F.count("*").alias("_c"))
    ranged = checkpointed(
        counted.repartitionByRange(shuffle_partitions(spark), "_g", "_v").withColumn("_part", F.spark_partition_id())
    )
    # One small row per group and range partition: rows of the group in earlier partitions.
    sizes = ranged.groupBy("_g", "_part").agg(F.sum("_c").alias("_size"))
    earlier = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_g", "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    running = Window.partitionBy("_g", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.join(offsets, ["_g", "_part"])
        .withColumn("_to", F.col("_offset") + F.sum("_c").over(running) - 1)
        .withColumn("_from", F.col("_to") - F.col("_c") + 1)
    )
    totals = ranged.groupBy("_g").agg(F.sum("_c").alias("n"), F.sum(F.col("_v") * F.col("_c")).alias("_sum"))

    def share(q: float):
        """Weight of a run of equal values in the interpolation at q."""
        at = F.lit(q) * (F.col("n") - 1)
        low, part = F.floor(at), at - F.floor(at)
        covers = lambda x: F.col("_from").cast("double").__le__(x) & (F.col("_to") >= x)
        return sum_of(
            [F.when(covers(low), 1 - part).otherwise(0.0), F.when(covers(low + 1), part).otherwise(0.0)]
        )

    picked = placed.join(totals, "_g").groupBy("_g", "n", "_sum").agg(
        *[F.sum(F.col("_v") * share(q)).alias(name) for name, q in points.items()]
    )
    mean = F.col("_sum") / F.col("n")
    return picked.select(
        F.col("_g").alias(group),
        F.col("n").alias("n_values"),
        mean.alias("mean"),
        (1000 / mean).alias("per_second"),
        *points,
    )

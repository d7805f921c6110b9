"""Dense row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.session import checkpointed, shuffle_partitions


def dense_index(frame: DataFrame, order: list[Column], name: str, start: int = 0) -> DataFrame:
    """Number the rows 0, 1, 2, ... in `order`, which must be total.

    Rows are range-partitioned and sorted inside their partition; a partition's first number is
    the count of rows in earlier partitions. The partitioned rows are materialised first, since
    range bounds are sampled and must not differ between counting and numbering.
    """
    spark = frame.sparkSession
    ranged = frame.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    ranged = checkpointed(ranged.withColumn("_row", F.monotonically_increasing_id()))
    # The id holds the partition in the upper bits and the position in the lower 33.
    part, position = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_size")).collect()
    offsets, total = [], start
    for row in sorted(sizes):  # one row per range partition
        offsets.append((row["_part"], total))
        total += row["_size"]
    firsts = spark.createDataFrame(offsets, "_part long, _first long")
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(firsts), "_part")
        .withColumn(name, F.col("_first") + position)
        .drop("_part", "_row", "_first")
    )


def id_index(sides: list[DataFrame], column: str, out_id: str, out_index: str) -> DataFrame:
    """Contiguous index over the sorted distinct ids of all sides."""
    ids = sides[0].select(F.col(column).alias(out_id))
    for side in sides[1:]:
        ids = ids.union(side.select(F.col(column).alias(out_id)))
    ids = ids.where(F.col(out_id).isNotNull()).distinct()
    indexed = dense_index(ids, [F.col(out_id).asc()], out_index)
    return indexed.withColumn(out_index, F.col(out_index).cast("int"))


def frequency_index(frame: DataFrame, column: str, out_index: str) -> DataFrame:
    """Index distinct values by descending frequency, ties in ascending text order."""
    counted = (
        frame.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias(column))
        .agg(F.count("*").alias("frequency"))
    )
    return dense_index(counted, [F.col("frequency").desc(), F.col(column).asc()], out_index)

"""Train/test splits and user samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import stable_hash

# A folder for each month: the label's year and month.
FOLDER_CHARS = 7


def first_test_partition(labels: DataFrame, test_fraction: float) -> Column:
    """Scalar subquery: the label of the first partition that belongs to the test side.

    Counts partitions that exist, not calendar days, and truncates n * (1 - fraction) in double
    arithmetic. The collected labels are at most one per day of the extraction window.
    """
    listed = F.sort_array(F.collect_set("date_partition"))
    at = F.floor(F.size(listed) * F.lit(1 - test_fraction)).cast("int")
    return labels.agg(F.try_element_at(listed, at + 1)).scalar()


def chronological_split(
    frame: DataFrame, test_fraction: float, manifest: DataFrame | None = None, folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Earlier partitions train, later ones test.

    The cut is a scalar of the run, found from the `manifest` (date_partition, ...) of a written dataset or else from the
    frame. On a dataset that is partitioned by date, or by a `folder` column that holds the beginning of the date, the
    scan of each side lists its own folders only.
    """
    cut = first_test_partition((frame if manifest is None else manifest).select("date_partition"), test_fraction)
    label = F.col("date_partition")
    train, test = label < F.coalesce(cut, F.lit("~")), label >= cut
    if folder:
        start = F.substring(cut, 1, FOLDER_CHARS)
        train, test = train & (F.col(folder) <= F.coalesce(start, F.lit("~"))), test & (F.col(folder) >= start)
    return frame.where(train), frame.where(test)


def partition_sides(frame: DataFrame, test_fraction: float) -> DataFrame:
    """Every date partition with its row count and its side of the split, in one pass."""
    counted = frame.groupBy("date_partition").agg(F.count("*").alias("n_rows"))
    # One array of at most one entry per day of the window.
    listed = counted.agg(F.sort_array(F.collect_list(F.struct("date_partition", "n_rows"))).alias("days"))
    n_train = F.floor(F.size("days") * F.lit(1 - test_fraction))
    placed = listed.select(n_train.alias("n_train"), F.posexplode("days").alias("nr", "day"))
    side = F.when(F.col("nr") < F.col("n_train"), "train").otherwise("test")
    return placed.select("day.date_partition", "day.n_rows", side.alias("side"))


def hash_split(frame: DataFrame, keys: list[str], test_fraction: float, seed: int) -> DataFrame:
    """Random split that is the same on every run: the side depends on the hashed key only."""
    digest = stable_hash(*[F.col(k) for k in keys], F.lit(seed))
    bound = f"{int(test_fraction * 16 ** 8):08x}"
    return frame.withColumn("side", F.when(F.substring(digest, 1, 8) < bound, "test").otherwise("train"))


def sample_users(users: DataFrame, user: str, n: int | None, seed: int) -> DataFrame:
    """`n` distinct users without replacement, or all of them when there are no more than `n`."""
    distinct = users.select(user).distinct()
    if not n:
        return distinct
    return distinct.orderBy(stable_hash(F.col(user), F.lit(seed)), user).limit(n)

"""Date-partitioned Parquet: sink, scan, and materialised train and test sides."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.split import chronological_split

# Spark's scans pass over names that begin with an underscore.
MANIFEST = "_dates"
DATE_FOLDER = "date_partition="


def write_partitions(frame: DataFrame, path: str, folder: str = "date_partition") -> None:
    """Replace the whole dataset at `path`.

    Rebalancing gathers a folder's rows into few files and splits what is too large for one task. Where days are many and
    small, `folder` is a coarser column, such as the month, and a manifest of the dates is left beside the folders.
    """
    (
        frame.hint("rebalance", folder)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(folder)
        .parquet(path)
    )
    if folder != "date_partition":
        dates = frame.sparkSession.read.schema(frame.schema).parquet(path).select("date_partition").distinct()
        dates.coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(date_partition), a row for each date of a dataset: from its manifest, or else the names of its folders."""
    try:
        return read_table(spark, f"{path}/{MANIFEST}")
    except FileNotFoundError:
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        names = [f.getPath().getName() for f in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
        found = [(unquote(n.removeprefix(DATE_FOLDER)),) for n in names if n.startswith(DATE_FOLDER)]
        return spark.createDataFrame(found, "date_partition string")


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Scan the dataset; a filter on its folder column prunes directories."""
    frame = read_table(spark, path)
    if "date_partition" not in frame.columns:
        raise ValueError(f"no date_partition= folders in {path}")
    return frame.withColumn("date_partition", F.col("date_partition").cast("string"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Scan Parquet; a missing path or one without files has an error of its own."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise ValueError(f"no Parquet files in {path}") from error
        raise


def write_split(spark: SparkSession, path: str, base: str, test_fraction: float) -> tuple[str, str]:
    """Write the two sides of the chronological split as datasets of their own.

    Usually not needed: filtering the one dataset by partition gives the same rows without a copy.
    """
    train, test = chronological_split(read_partitions(spark, path), test_fraction, read_manifest(spark, path))
    sides = f"{base}/train_data", f"{base}/test_data"
    for frame, side in zip((train, test), sides):
        write_partitions(frame, side)
    return sides

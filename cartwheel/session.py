"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs count on. A hot join key is split at run time, even where the split
# costs one more shuffle afterwards.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task of a join or an aggregate holds its share in memory at many times the size of its shuffle files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # So does one that scans and aggregates.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.session.timeZone": "UTC",
}
# Shuffles begin with so many partitions at least, which are merged at run time up to the size above: where the session
# has few, their size would follow the input.
LEAST_INITIAL = 64
INITIAL_BYTES = 4 << 20  # of input files for each
# What a task gets of a known input: of order lines, these are a few hundred thousand rows, which sorts and aggregates
# hold at 20 to 40 times the size of their shuffle files.
TASK_BYTES = "4m"


def build_session(app: str = "cartwheel", cores: int | str = "*", shared: str | None = None, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use spark-submit and `tune`.

    `shared` is the folder for intermediate tables and checkpoints.
    """
    if shared:
        settings = {"spark.checkpoint.dir": shared, **settings}
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": "16" if cores == "*" else str(2 * int(cores)),
        **RUNTIME_SETTINGS,
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the run-time settings to a session somebody else made, for an input of so many bytes in its files."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    initial = max(shuffle_partitions(spark), LEAST_INITIAL, -(-input_bytes // INITIAL_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial))
    if input_bytes:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES)
    return spark


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """The bytes of the files at the paths; one that does not exist has none."""
    found = [spark._jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    systems = [path.getFileSystem(spark._jsc.hadoopConfiguration()) for path in found]
    return sum(fs.getContentSummary(path).getLength() for fs, path in zip(systems, found, strict=True) if fs.exists(path))


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local session that names none uses one in its warehouse.

    On any other master it must be named, since nothing else is known to be shared by all executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/cartwheel-work"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one: everything it writes for itself is in here."""
    return f"{shared_dir(spark)}/cartwheel-{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the work folder for a table that one job writes and another reads."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_work(spark: SparkSession) -> None:
    """Delete the application's intermediate tables; frames that read them cannot be used afterwards."""
    remove(spark, work_dir(spark))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the work folder, or all of it; frames that read it cannot be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder, so that lost executors cannot change the rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str, work: str | None = None) -> DataFrame:
    """Write as a Parquet table in the shared folder and scan that from now on.

    With a `work` folder the table replaces the one of that name there, so that a job that runs
    again and again, such as a micro-batch, does not pile up tables. The shuffle files of the writing end with it.
    """
    path = f"{work}/{name}" if work else shared_path(df.sparkSession, name)
    with shuffles_given_up(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of frames that nobody holds any more deleted: Spark does so when the driver collects garbage."""
    spark._jvm.System.gc()


@contextmanager
def shuffles_given_up(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are deleted when it ends, and not only when the driver collects garbage."""
    given_up = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(given_up, "false")
    spark.conf.set(given_up, "true")
    try:
        yield
    finally:
        spark.conf.set(given_up, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def initial_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle begins with; `tune` has them follow the input."""
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(shuffle_partitions(spark))))

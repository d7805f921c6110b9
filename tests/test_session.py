"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cartwheel.session import shared_dir, shuffle_partitions, stored_bytes, tune


def fake(master, **conf):
    """A session of which only the master, the settings and the checkpoint folder are asked."""
    held = {"dir": None}
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: held["dir"], setCheckpointDir=lambda folder: held.update(dir=folder)
    )
    settings = {"spark.sql.warehouse.dir": "file:/work/spark-warehouse", **conf}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)), sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(ValueError):
        shared_dir(fake(master))
    named = fake(master, **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_dir(named) == "hdfs:///shared" == named.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]", "local[4,2]"])
def test_a_local_session_uses_its_warehouse(master):
    assert shared_dir(fake(master)) == "file:/work/spark-warehouse/cartwheel-work"


def test_partitions_of_a_shuffle_follow_its_size(spark):
    """Also beyond the number that the session has set."""
    tune(spark)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        grouped = spark.range(1_000_000).groupBy(F.md5(F.col("id").cast("string")).alias("k")).count()
        used = grouped.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        tune(spark)
    assert used > shuffle_partitions(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_shuffles_of_a_large_input_begin_with_more_partitions(spark, tmp_path):
    """The share of a partition must not grow with the files that are read."""
    (tmp_path / "a.parquet").mkdir()
    (tmp_path / "a.parquet" / "part").write_bytes(bytes(3_000))
    (tmp_path / "b.parquet").write_bytes(bytes(500))
    assert stored_bytes(spark, *(f"{tmp_path}/{name}.parquet" for name in "abc")) == 3_500
    initial = lambda: int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    try:
        tune(spark, 1 << 30)
        large = initial()
        tune(spark, 6 << 30)
        assert (large, initial()) == (256, 1_536)
    finally:
        tune(spark)
    assert initial() == 64


def test_a_task_gets_little_of_a_known_input(spark):
    """Its sorts and aggregates hold that many times over, so partitions are not merged up to the size that others have."""
    used = {}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        for size in (0, 1):
            tune(spark, size)
            grouped = spark.range(1_000_000).groupBy(F.md5(F.col("id").cast("string")).alias("k")).count()
            used[size] = grouped.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
        tune(spark)
    assert used[1] >= 3 * used[0]

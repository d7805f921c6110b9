import re

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.index import dense_index, frequency_index, id_index
from cartwheel.operators.split import chronological_split, hash_split, partition_sides, sample_users
from cartwheel.sources.partitions import read_manifest, read_partitions, write_partitions, write_split


def days(spark, n):
    return spark.range(n).select(
        F.format_string("2025_%02d_%02d", (F.col("id") / 28 + 1).cast("int"), F.col("id") % 28 + 1).alias("date_partition"),
        F.col("id").alias("item_id"),
    )


@pytest.mark.parametrize(
    "n, fraction, expected",
    [(31, 0.2, 24), (10, 0.2, 8), (5, 0.2, 4), (1, 0.2, 0), (10, 0.9, 0), (4, 0.0, 4), (0, 0.2, 0)],
)
def test_split_counts_partitions(spark, n, fraction, expected):
    assert int(n * (1 - fraction)) == expected
    train, test = chronological_split(days(spark, n), fraction)
    assert (train.count(), test.count()) == (expected, n - expected)
    if 0 < expected < n:
        assert train.agg(F.max("date_partition")).first()[0] < test.agg(F.min("date_partition")).first()[0]
    sides = dict(partition_sides(days(spark, n), fraction).groupBy("side").count().collect())
    assert sides.get("train", 0) == expected


def test_written_split(spark, tmp_path):
    write_partitions(days(spark, 10), str(tmp_path / "all"))
    train, test = write_split(spark, str(tmp_path / "all"), str(tmp_path / "sides"), 0.2)
    assert read_partitions(spark, train).count() == 8
    assert read_partitions(spark, test).count() == 2


def test_sides_scan_their_own_folders(spark, tmp_path):
    path, folder = str(tmp_path / "months"), "month"
    write_partitions(days(spark, 200).withColumn(folder, F.substring("date_partition", 1, 7)), path, folder)
    manifest = read_manifest(spark, path)
    assert manifest.count() == 200
    train, test = chronological_split(read_partitions(spark, path), 0.2, manifest, folder)
    folders = lambda side: {r[0] for r in side.select(F.regexp_extract(F.input_file_name(), "month=([0-9_]+)", 1)).distinct().collect()}
    assert folders(train) == {f"2025_{m:02d}" for m in range(1, 7)}
    assert folders(test) == {f"2025_{m:02d}" for m in range(6, 9)}  # the cut lies inside June
    for side, rows in ((train, 160), (test, 40)):
        assert side.count() == rows
        plan = side._jdf.queryExecution().executedPlan().toString()
        filters = re.findall(r"PartitionFilters: (.*?)PushedFilters", plan)
        assert any("month#" in f and "subquery" in f.lower() for f in filters), plan


def test_manifest_of_an_empty_and_of_a_foreign_dataset(spark, tmp_path):
    write_partitions(days(spark, 0), str(tmp_path / "none"))
    assert read_manifest(spark, str(tmp_path / "none")).count() == 0
    days(spark, 5).write.partitionBy("date_partition").parquet(str(tmp_path / "foreign"))
    assert {r[0] for r in read_manifest(spark, str(tmp_path / "foreign")).collect()} == {f"2025_01_{d:02d}" for d in range(1, 6)}


def test_hash_split_is_repeatable_and_near_its_share(spark):
    frame = spark.range(20_000)
    once = hash_split(frame, ["id"], 0.2, 1)
    again = hash_split(frame.repartition(5), ["id"], 0.2, 1)
    assert once.exceptAll(again).isEmpty()
    assert 3_700 < once.where("side = 'test'").count() < 4_300


def test_sample_users(spark):
    users = spark.range(100).union(spark.range(100)).withColumnRenamed("id", "user_id")
    ten = {r[0] for r in sample_users(users, "user_id", 10, 42).collect()}
    assert len(ten) == 10 and ten == {r[0] for r in sample_users(users, "user_id", 10, 42).collect()}
    assert ten != {r[0] for r in sample_users(users, "user_id", 10, 43).collect()}
    assert sample_users(users, "user_id", 1000, 42).count() == 100
    assert sample_users(users, "user_id", None, 42).count() == 100


def test_dense_index_is_contiguous_in_order(spark):
    n = 10_000
    frame = spark.range(n).select((F.col("id") * 7 % n).alias("key")).repartition(13)
    rows = dense_index(frame, [F.col("key").desc()], "pos", start=1).collect()
    assert sorted((r.pos, r.key) for r in rows) == [(i + 1, n - 1 - i) for i in range(n)]


def test_id_index_unions_sides_in_code_point_order(spark):
    train = spark.createDataFrame([("b",), ("Z",), ("b",), (None,)], "network_userid string")
    test = spark.createDataFrame([("é",), ("a",), ("10",), ("9",)], "network_userid string")
    rows = id_index([train, test], "network_userid", "user_id", "user_idx").collect()
    assert {r.user_id: r.user_idx for r in rows} == {v: i for i, v in enumerate(sorted(["b", "Z", "é", "a", "10", "9"]))}


def test_frequency_index(spark):
    frame = spark.createDataFrame([(x,) for x in "ccbbaaad"], "v string")
    rows = frequency_index(frame, "v", "idx").collect()
    assert {r.v: r.idx for r in rows} == {"a": 0, "b": 1, "c": 2, "d": 3}

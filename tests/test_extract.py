import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cartwheel.config import Columns, Config
from cartwheel.functions.scalars import parse_basket
from cartwheel.operators.extract import (
    extraction_audit,
    interactions,
    observed_interactions,
    partition_summary,
    windowed_purchases,
)
from cartwheel.operators.ratings import user_item_ratings
from cartwheel.sources.partitions import read_partitions, write_partitions
from cartwheel.sources.purchases import read_purchases_csv

CONFIG = Config(end_date="2025-09-10", num_days=3)
SCHEMA = "network_userid string, order_id string, item_id string, item_quantity string, datestamp string"
ROWS = [
    ("u1", "o1", "a", "2", "2025-09-08"),  # first day
    ("u1", "o1", "a", "4", "2025-09-08"),  # same line again: mean 3
    ("u1", "o1", "a", "9", "2025-09-09"),  # the order spans two dates
    ("u1", "o2", "a", "x", "2025-09-10"),  # quantity that is no number
    ("u2", None, "b", "5", "2025-09-10 23:59:59"),  # no order, last second of the last day
    ("u2", "o3", "b", None, "2025-09-10"),  # no quantity
    (None, "o4", "b", "1", "2025-09-10"),  # no user
    ("u3", "o5", None, "1", "2025-09-10"),  # no item
    ("u3", "o6", "c", "1", "2025-09-07"),  # day before
    ("u3", "o7", "c", "1", "2025-09-11"),  # day after
    ("u3", "o8", "c", "1", "not a date"),
    ("u3", "o9", "c", "1", None),
]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def made(frame):
    return {
        (r.network_userid, r.order_id, r.item_id, r.date_partition): r.item_quantity for r in frame.collect()
    }


EXPECTED = {
    ("u1", "o1", "a", "2025_09_08"): 3.0,
    ("u1", "o1", "a", "2025_09_09"): 9.0,
    ("u1", "o2", "a", "2025_09_10"): None,
    ("u2", None, "b", "2025_09_10"): 5.0,
    ("u2", "o3", "b", "2025_09_10"): None,
}


def test_interactions_keep_null_orders_and_quantities(events):
    assert made(interactions(events, CONFIG)) == EXPECTED


def test_timestamp_and_string_dates_agree(events):
    stamped = events.withColumn("datestamp", F.try_to_timestamp("datestamp", F.lit("yyyy-MM-dd")))
    expected = {k: v for k, v in EXPECTED.items() if k[1] is not None}
    assert {k: v for k, v in made(interactions(stamped, CONFIG)).items() if k[1] is not None} == expected


def test_quantity_is_a_float_before_the_mean(spark):
    frame = spark.createDataFrame([("u", "o", "i", "0.1", "2025-09-10")], SCHEMA)
    value = interactions(frame, CONFIG).first().item_quantity
    assert value != 0.1 and abs(value - 0.1) < 1e-7
    assert dict(windowed_purchases(frame, CONFIG).dtypes)["item_quantity"] == "float"


def test_ratings_drop_pairs_without_quantity_and_average_order_means(events):
    ratings = {(r.user_id, r.item_id): r.rating for r in user_item_ratings(interactions(events, CONFIG)).collect()}
    assert ratings == {("u1", "a"): 6.0, ("u2", "b"): 5.0}


def test_audit(events, spark):
    row = extraction_audit(events, CONFIG).first()
    assert (row.initial_count, row.filtered_count, row.aggregated_count) == (12, 6, 5)
    assert row.filtered_pct == 50.0
    empty = extraction_audit(spark.createDataFrame([], SCHEMA), CONFIG).first()
    assert (empty.initial_count, empty.filtered_pct, empty.aggregated_count) == (0, 0.0, 0)


def test_csv_to_partitions_in_one_job(spark, events, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    events.write.option("header", True).csv(raw)
    frame, read, made_counts = observed_interactions(read_purchases_csv(spark, raw, schema=events.schema), CONFIG)
    write_partitions(frame, out)
    assert read.get == {"initial_count": 12, "filtered_count": 6}
    assert made_counts.get == {"aggregated_count": 5}
    back = read_partitions(spark, out)
    assert dict(back.dtypes)["date_partition"] == "string"
    assert made(back) == EXPECTED
    assert partition_summary(back).first().asDict() == {
        "n_partitions": 3, "first_partition": "2025_09_08", "last_partition": "2025_09_10", "n_rows": 5,
    }
    write_partitions(frame.where("date_partition = '2025_09_09'"), out)  # overwrite replaces everything
    assert made(read_partitions(spark, out)) == {k: v for k, v in EXPECTED.items() if k[3] == "2025_09_09"}


def test_csv_by_name(spark, tmp_path):
    rows = [("x", "3", "2025-09-10", "i1", "u1", "o1"), ("y", "5", "2025-09-09", "i2", "u2", "o2")]
    names = ["campaign", "item_quantity", "day", "item_id", "network_userid", "order_id"]
    for part, row in enumerate(rows):
        spark.createDataFrame([row], names).coalesce(1).write.mode("append").option("header", True).csv(str(tmp_path / "raw"))
    config = replace(CONFIG, columns=Columns(date="day"))
    for infer in (False, True):
        frame = read_purchases_csv(spark, str(tmp_path / "raw"), infer, columns=config.columns)
        assert "campaign" not in frame.columns
        assert {(r.network_userid, r.item_id, r.order_id, r.item_quantity) for r in interactions(frame, config).collect()} == {
            ("u1", "i1", "o1", 3.0), ("u2", "i2", "o2", 5.0)
        }
    with pytest.raises(ValueError, match="datestamp"):
        read_purchases_csv(spark, str(tmp_path / "raw"))


def test_without_a_window_every_date_counts(spark):
    rows = [("u", "o", "i", "1", d) for d in ("1971-01-02", "2025-09-10", "2099-12-31", "no date", None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert interactions(frame, replace(CONFIG, num_days=None)).count() == 3
    stamped = frame.withColumn("datestamp", F.try_to_timestamp("datestamp", F.lit("yyyy-MM-dd")))
    assert interactions(stamped, replace(CONFIG, num_days=None)).count() == 3


def test_partition_filter_prunes(spark, events, tmp_path):
    out = str(tmp_path / "out")
    write_partitions(interactions(events, CONFIG), out)
    plan = read_partitions(spark, out).where("date_partition = '2025_09_09'")
    assert {f.rsplit("/", 2)[1] for f in plan.inputFiles()} <= {f"date_partition=2025_09_{d:02d}" for d in (8, 9, 10)}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_partition" in text


def test_missing_and_unpartitioned_inputs_fail(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_partitions(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        read_partitions(spark, str(tmp_path / "empty"))
    spark.range(3).write.parquet(str(tmp_path / "flat"))
    with pytest.raises(ValueError):
        read_partitions(spark, str(tmp_path / "flat"))


def test_parse_basket(spark):
    row = spark.createDataFrame([(" a, b ,c ",)], "t string").select(parse_basket(F.col("t")).alias("items")).first()
    assert row["items"] == ["a", "b", "c"]


def test_config_from_ini(tmp_path):
    path = tmp_path / "run.ini"
    path.write_text("[data]\nend_date = 2024-01-31\nnum_days=7\n[model]\nuser_col = who\nreg_lambda = 0.5\n")
    config = Config.from_ini(str(path))
    assert (config.end_date, config.num_days, config.reg_lambda) == ("2024-01-31", 7, 0.5)
    assert (config.columns.user, config.columns.item, config.n_factors) == ("who", "item_id", 16)
    assert dt.date.fromisoformat(Config().end_date)

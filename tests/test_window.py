"""Moved windows against new ones, and what a move reads."""

import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import window
from cartwheel.sources.partitions import write_partitions

SCHEMA = "network_userid long, order_id long, item_id long, item_quantity double, date_partition string"
DAYS = [f"2025_{m:02d}_{d:02d}" for m in (1, 2) for d in range(1, 29)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [
        (rng.randint(1, 4), n, rng.randint(1, 5), rng.choice([None, rng.randint(1, 9) / 3, 1e5 / 7, 0.1]), rng.choice(DAYS))
        for n in range(900)
    ]


@pytest.fixture(scope="module")
def path(spark, rows, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("days") / "all")
    write_partitions(spark.createDataFrame(rows, SCHEMA), where)
    return where


def plain(rows, days):
    found = {}
    for user, _, item, quantity, day in rows:
        if day in days and quantity is not None:
            found.setdefault((user, item), []).append(quantity)
    return {pair: sum(x) / len(x) for pair, x in found.items()}


def test_forty_moves_equal_new_windows(spark, rows, path):
    known = window.days_between(spark, path, DAYS[0], DAYS[-1])
    held = window.open_window(spark, path, known[:10])
    for start in range(1, 41):
        days = known[start : start + 10]
        held = window.move(spark, path, held, days)
        found = {(r.user_id, r.item_id): r.rating for r in window.ratings(held).collect()}
        assert found == pytest.approx(plain(rows, set(days)), abs=1e-9)
    new = window.open_window(spark, path, known[40:50])
    assert held.days == new.days
    assert held.totals.exceptAll(new.totals).isEmpty() and new.totals.exceptAll(held.totals).isEmpty()


def test_a_move_reads_the_changed_folders_only(spark, path):
    held = window.open_window(spark, path, tuple(DAYS[:10]))
    delta = window.changed(spark, path, held, tuple(DAYS[1:11]))
    files = {r[0] for r in delta.sparkSession.read.parquet(path).where(F.col("date_partition").isin(DAYS[0], DAYS[10])).select(F.input_file_name()).distinct().collect()}
    assert len(files) == 2
    delta.collect()
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and DAYS[0] in plan and DAYS[10] in plan and DAYS[5] not in plan


def test_days_may_jump_or_vanish(spark, rows, path):
    held = window.open_window(spark, path, tuple(DAYS[:5]))
    held = window.move(spark, path, held, tuple(DAYS[30:33]))
    found = {(r.user_id, r.item_id): r.rating for r in window.ratings(held).collect()}
    assert found == pytest.approx(plain(rows, set(DAYS[30:33])), abs=1e-9)
    assert window.move(spark, path, held, ()).totals.count() == 0

"""Ratings of a date window that moves: days that enter are added, days that leave are taken off.

A pair's rating is a sum and a count over the days of the window. Sums are kept as decimals, which add and subtract without
rounding, so a window that has moved a thousand times holds exactly what a new one over the same days would. A move
reads the folders of the days that changed and the totals of the window before, not the days that stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import Columns
from cartwheel.session import stored
from cartwheel.sources.partitions import read_manifest, read_partitions

# Twelve decimals of a mean quantity, and room for sums of them.
EXACT, TOTAL = "decimal(26,12)", "decimal(38,12)"


@dataclass(frozen=True)
class Window:
    """The days of a window, as their labels, and its (user_id, item_id, total, n), stored."""

    days: tuple[str, ...]
    totals: DataFrame


def days_between(spark: SparkSession, path: str, first: str, last: str) -> tuple[str, ...]:
    """Labels of the dataset's days from first to last: at most one for each calendar day."""
    labels = read_manifest(spark, path).where(F.col("date_partition").between(first, last))
    return tuple(sorted(row["date_partition"] for row in labels.distinct().collect()))


def totals_of(interactions: DataFrame, columns: Columns = Columns(), sign: Column | None = None) -> DataFrame:
    """(user_id, item_id, total, n) over all rows with a quantity; rows of a negative sign are taken off."""
    sign = F.lit(1) if sign is None else sign
    value = F.col(columns.rating).cast("double").cast(EXACT)
    return (
        interactions.where(F.col(columns.rating).isNotNull())
        .select(F.col(columns.user).alias("user_id"), F.col(columns.item).alias("item_id"), (value * sign).alias("value"), sign.alias("sign"))
        .groupBy("user_id", "item_id")
        .agg(F.sum("value").cast(TOTAL).alias("total"), F.sum("sign").cast("long").alias("n"))
    )


def open_window(spark: SparkSession, path: str, days: tuple[str, ...], columns: Columns = Columns()) -> Window:
    """A window over these days of a date-partitioned dataset, from its folders."""
    rows = read_partitions(spark, path).where(F.col("date_partition").isin(*days))
    return Window(tuple(sorted(days)), stored(totals_of(rows, columns), "window"))


def changed(spark: SparkSession, path: str, window: Window, days: tuple[str, ...], columns: Columns = Columns()) -> DataFrame:
    """What the days that enter add to the totals and those that leave take off them; scans their folders only."""
    enter, leave = set(days) - set(window.days), set(window.days) - set(days)
    label = F.col("date_partition")
    sign = F.when(label.isin(*sorted(enter)), 1).otherwise(-1)
    rows = read_partitions(spark, path).where(label.isin(*sorted(enter | leave)))
    return totals_of(rows, columns, sign)


def move(spark: SparkSession, path: str, window: Window, days: tuple[str, ...], columns: Columns = Columns()) -> Window:
    """The window over other days. Pairs without ratings left are gone."""
    both = window.totals.unionByName(changed(spark, path, window, days, columns))
    summed = both.groupBy("user_id", "item_id").agg(F.sum("total").cast(TOTAL).alias("total"), F.sum("n").alias("n"))
    return Window(tuple(sorted(days)), stored(summed.where("n > 0"), "window"))


def ratings(window: Window) -> DataFrame:
    """(user_id, item_id, rating): the mean of each pair's per-order means in the window."""
    return window.totals.select("user_id", "item_id", (F.col("total").cast("double") / F.col("n")).alias("rating"))

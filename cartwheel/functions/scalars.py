"""Scalar expressions that never fail on raw input: bad values become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(df: DataFrame, name: str) -> Column:
    """The calendar date of a string, date or timestamp column."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_date(F.col(name))
    return F.col(name).cast("date")


def window_start(end_date: str, num_days: int) -> Column:
    return F.date_sub(F.lit(end_date).cast("date"), num_days - 1)


def in_date_window(df: DataFrame, name: str, end_date: str, num_days: int | None) -> Column:
    """The last `num_days` calendar days up to and including `end_date`, or with None every date.

    A timestamp is compared as it is stored, so the range reaches the Parquet scan.
    """
    if num_days is None:
        return as_date(df, name).isNotNull()
    start, end = window_start(end_date, num_days), F.lit(end_date).cast("date")
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return (F.col(name) >= start.cast(kind)) & (F.col(name) < F.date_add(end, 1).cast(kind))
    return as_date(df, name).between(start, end)


def partition_label(date: Column) -> Column:
    return F.date_format(date, "yyyy_MM_dd")


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def parse_basket(text: Column) -> Column:
    """Item ids from a comma-separated list."""
    return F.transform(F.split(text, ","), lambda item: F.trim(item))


def stable_hash(*parts: Column) -> Column:
    """A hash that other engines can reproduce, for seeded samples and splits."""
    return F.md5(F.concat_ws("|", *[part.cast("string") for part in parts]))

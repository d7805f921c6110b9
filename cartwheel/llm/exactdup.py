"""Exact dedup by sorting content, in DataFrame functions alone.

Texts are normalised (runs of white space become one space). Sampled splitters range-partition the rows
by the first SPLIT_CHARS of the normalised text, a hash of all of it, and a salt from the id, so that a
text with a third of all rows is spread over many partitions. An external sort places equal texts next to
each other, and a window, whose groups end where two neighbours differ in any byte, finds the smallest
id. The salted parts of a text then meet as narrow rows under their SHA-256, at most SALTS for a text.

Edge cases: a null text counts as empty. Rows that repeat an id with the same text keep one of them; a
null id is larger than any other, so it stays only where a text has no other. An empty table gives an
empty table. Other columns are not read by `groups`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import shuffle_partitions, stored

SPLIT_CHARS = 32
SALTS = 256

# Any white space that is not already one single space.
UNEVEN = r"[\t-\r][\t-\r ]*| [\t-\r ]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN, " ")


def placed(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Columns `_row` (all columns of the document), `_id`, `_salt`, the normalised `_text` and its `_place`.

    `_place` counts the rows of one text and salt in the order of the ids; `_least` is the first of them.
    """
    rows = (
        documents.select(F.struct(*documents.columns).alias("_row"))
        .withColumn("_id", F.col(f"_row.{key}"))
        .withColumn("_first", F.substring(normalised(F.col(f"_row.{text}")), 1, SPLIT_CHARS))
        .withColumn("_hash", F.xxhash64(normalised(F.col(f"_row.{text}"))))
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_id"), F.lit(SALTS)), F.lit(0)))
    )
    split = rows.repartitionByRange(shuffle_partitions(documents.sparkSession), "_first", "_hash", "_salt")
    full = split.withColumn("_text", normalised(F.col(f"_row.{text}")))
    equal = Window.partitionBy("_first", "_hash", "_salt", "_text").orderBy(F.col("_id").asc_nulls_last())
    return full.withColumns({"_place": F.row_number().over(equal), "_least": F.first("_id").over(equal)})


def ranked(parts: DataFrame) -> DataFrame:
    """For every part (text_sha256, _salt, _least, _n): its text's keep_id and group_size, and whether it keeps."""
    whole = Window.partitionBy("text_sha256")
    first = F.row_number().over(whole.orderBy(F.col("_least").asc_nulls_last(), "_salt")) == 1
    return parts.select(
        "text_sha256",
        "_salt",
        F.min("_least").over(whole).alias("keep_id"),
        F.sum("_n").over(whole).alias("group_size"),
        first.alias("_keeps"),
    )


def groups(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: key, keep_id, group_size, kept, text_sha256."""
    compared = placed(documents.select(key, text), key, text)
    narrow = stored(compared.select("_id", "_salt", "_place", "_least", F.sha2("_text", 256).alias("text_sha256")), "content-order")
    parts = narrow.groupBy("text_sha256", "_salt").agg(F.min("_least").alias("_least"), F.count("*").alias("_n"))
    kept = F.col("_keeps") & (F.col("_place") == 1)
    return narrow.join(ranked(parts), ["text_sha256", "_salt"]).select(
        F.col("_id").alias(key), "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )


def deduplicated(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their columns: of each text one row with the smallest id."""
    firsts = placed(documents, key, text).where("_place = 1")
    candidates = stored(firsts.select("_row", "_salt", "_least", F.sha2("_text", 256).alias("text_sha256")), "first-copies")
    winners = ranked(candidates.select("text_sha256", "_salt", "_least", F.lit(1).alias("_n"))).where("_keeps")
    return candidates.join(winners, ["text_sha256", "_salt"], "left_semi").select("_row.*")

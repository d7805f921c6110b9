"""The corpus pipeline: documents in, clean and encoded documents out.

Every stage takes (spark, docs, sf_dir) and returns a frame, which `run` writes as Parquet in the shared
folder and reads back for the next one. All stages but the last return the columns of their input, whatever
these are; an empty table passes all stages. A stage that meets null or empty texts treats them as its
operator says: they are not toxic, equal to each other for exact dedup, and never near duplicates or leaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import decontam, exactdup, pieces, setsketch, toxicity
from cartwheel.llm.blocks import fold
from cartwheel.llm.lattice import Vocabulary
from cartwheel.session import stored

NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a model of this corpus' labels."""
    weights = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold(F.col("doc_id"), 5) != 0)
    return toxicity.without_toxic(docs, weights)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return exactdup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share NEAR_PERCENT of their shingles, the smallest id."""
    return setsketch.deduplicated(docs, NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the best segmentation, whether they spell the text again, and the scores of the next best."""
    return pieces.encode_and_decode(docs, Vocabulary.load(pieces.MODEL)).select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.coalesce(F.array_size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        "score",
        F.transform("nbest", lambda x: x["score"]).alias("other_scores"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encoded),
]

# Learned weights, sketches and segmentations have no SQL form; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

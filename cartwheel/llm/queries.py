"""The registered queries of the text operators: name to (spark, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import decontam, exactdup, langmix, licenses, mixing, pieces, quality, repair, setsketch, shares, toxicity, variants
from cartwheel.llm.blocks import fold
from cartwheel.llm.lattice import Vocabulary


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    weights = toxicity.fit(documents, table(spark, folder, "labels"), ~held_out)
    scored = toxicity.score(documents.select("doc_id", "text"), weights)
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    )


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_items"),
        F.array_join(F.transform("leaks", lambda x: x["item_id"].cast("string")), ",").alias("item_ids"),
        F.array_min(F.transform("leaks", lambda x: x["errors"])).alias("min_errors"),
    )


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.digest(licenses.scan(documents, licenses.build_index(documents)))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    decoded = pieces.encode_and_decode(documents, Vocabulary.load(pieces.MODEL))
    return decoded.select(
        "doc_id",
        F.coalesce(F.array_size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        "score",
        F.transform("nbest", lambda x: x["score"]).alias("other_scores"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    network = quality.fit(documents, table(spark, folder, "labels"), ~held_out)
    scored = quality.score(documents.select("doc_id", "text"), network)
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("quality").alias("score"), (F.col("quality") >= 0.7).cast("int").alias("predicted")
    )


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.count(documents, Vocabulary.load(pieces.MODEL)).select("doc_id", "n_tokens", "n_pretokens")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 7) == 2
    scored = mixing.scores(documents, ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdup.groups(table(spark, folder, "documents"))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, folder, "documents"), percent=85)


def op10_languages(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    languages = langmix.fit(documents.where(~held_out))
    return langmix.identify(documents, languages).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows, audits = repair.repaired(repair.damaged(conversations, F.crc32(name.cast("binary")) % 20))
    found = audits.join(repair.digests(rows, audits).withColumnRenamed("conv", "_conv"), F.col("conv").eqNullSafe(F.col("_conv")))
    every = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return every.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


def op12_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan, rows, spans = shares.mixed(table(spark, folder, "documents"))
    taken = spans.groupBy("row").agg(F.sum("n_words").alias("taken"))
    sources = list(zip(range(len(plan.names)), plan.sizes.tolist(), plan.targets.tolist()))
    known = spark.createDataFrame(sources, "source_place int, source_size long, target double")
    return rows.join(known, "source_place").join(taken, "row", "left").select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def op13_variants(spark: SparkSession, folder: str) -> DataFrame:
    # Runs of fewer letters can never have enough of them, with or without the one that is taken.
    runs = variants.runs(table(spark, folder, "documents"), min_letters=variants.MIN_LETTERS)
    found = variants.grouped(variants.counted(variants.misspelt(runs)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    q.__name__: q
    for q in (
        op1_toxicity,
        op2_decontamination,
        op3_licenses,
        op4_sentencepiece,
        op5_quality,
        op6_token_counts,
        op7_mixing,
        op8_exact_dedup,
        op9_near_dedup,
        op10_languages,
        op11_repair,
        op12_mix,
        op13_variants,
    )
}

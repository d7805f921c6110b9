"""The registered queries: name to (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import Columns, Config
from cartwheel.functions.vectors import SCORE_DIGITS
from cartwheel.operators import evaluate, extract, factors, index, itemsets, metrics, popularity, profile, runs, split, window
from cartwheel.operators.factors import predict_pairs
from cartwheel.operators.gradient import fit_gradient
from cartwheel.operators.lsh import neighbors
from cartwheel.operators.ratings import training_triples, user_item_ratings
from cartwheel.operators.recommend import basket_vectors, recommend_baskets, recommend_for_lines, responses, similar_items
from cartwheel.operators.score import top_items
from cartwheel.plans.tables import BASKET_K, LAST_YEAR, TOP_K, Job
from cartwheel.session import shared_path
from cartwheel.sources.artifacts import (
    append_metrics,
    champion,
    follow_champion,
    load_recommender,
    promote,
    read_metrics,
    save_evaluation,
    save_model,
)
from cartwheel.sources.partitions import read_partitions, write_partitions, write_split
from cartwheel.sources.purchases import read_purchases_csv
from cartwheel.streaming.requests import parse_requests, read_requests, serve

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = 42
SAMPLE = 500
WINDOWS = (("2001_05_01", "2001_05_31"), ("2001_05_16", "2001_06_15"), ("2001_06_01", "2001_06_30"))


def learning(config: Config) -> dict[str, float]:
    return {
        "n_factors": config.n_factors,
        "learning_rate": config.learning_rate,
        "decay": config.reg_lambda,
        "epochs": config.epochs,
        "batch_size": config.batch_size,
    }


def query(build: Callable[[Job], DataFrame]) -> Callable[[Job], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Job(spark, folder))
    return build


def rounded(frame: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return frame.withColumns({n: F.round(n, digits) for n in names})


def joined(array: Column) -> Column:
    return F.array_join(array.cast("array<string>"), ",")


def vector_text(vector: Column, scale: int = 10**6) -> Column:
    """A vector as rounded whole parts of 1 / scale, so that text compares exactly."""
    return joined(F.transform(vector, lambda x: F.round(x * scale, 0).cast("bigint")))


# Extraction and split


@query
def purchase_extract_distinct(job: Job) -> DataFrame:
    recent = extract.recent_purchases(job.described, as_of="2001-08-01", months=12, source_id="A")
    return recent.withColumn("datestamp", F.date_format("datestamp", "yyyy-MM-dd"))


@query
def purchases_window(job: Job) -> DataFrame:
    return extract.windowed_purchases(job.purchases, LAST_YEAR).withColumn(
        "item_quantity", F.col("item_quantity").cast("double")
    )


@query
def order_item_quantity(job: Job) -> DataFrame:
    return job.interactions


@query
def extraction_audit(job: Job) -> DataFrame:
    return extract.extraction_audit(job.purchases, LAST_YEAR)


@query
def partition_summary(job: Job) -> DataFrame:
    return extract.partition_summary(job.interactions)


@query
def csv_extract(job: Job) -> DataFrame:
    """Purchases to CSV, extracted from there into date partitions, and scanned again."""
    raw, out = shared_path(job.spark, "purchases-csv"), shared_path(job.spark, "interactions")
    # The columns in another order and under other names, with one that nobody asked for.
    shuffled = job.purchases.select(
        F.col("item_quantity").alias("qty"), F.lit("x").alias("campaign"), "item_id", F.col("datestamp").alias("day"),
        F.col("network_userid").alias("who"), "order_id",
    )
    shuffled.write.option("header", True).csv(raw)
    types = job.purchases.select(F.col("network_userid").alias("who"), "order_id", "item_id").schema
    config = replace(LAST_YEAR, columns=Columns(user="who", rating="qty", date="day"))
    events = read_purchases_csv(job.spark, raw, schema=types, columns=config.columns)
    made, _, _ = extract.observed_interactions(events, config)
    write_partitions(made, out)
    return read_partitions(job.spark, out).withColumnsRenamed({"who": "network_userid", "qty": "item_quantity"})


@query
def chrono_split(job: Job) -> DataFrame:
    return split.partition_sides(job.interactions, job.config.test_fraction)


@query
def hash_split(job: Job) -> DataFrame:
    pairs = job.interactions.select("network_userid", "order_id", "item_id")
    return split.hash_split(pairs, ["network_userid", "order_id", "item_id"], 0.2, SEED)


@query
def user_sample(job: Job) -> DataFrame:
    return split.sample_users(job.interactions, "network_userid", SAMPLE, SEED)


# Indexes and ratings


def user_index_of(job: Job) -> DataFrame:
    return index.id_index([extract.cleaned(job.purchases, job.config)], "network_userid", "user_id", "user_idx")


def item_index_of(job: Job) -> DataFrame:
    return index.id_index([extract.cleaned(job.purchases, job.config)], "item_id", "item_id", "item_idx")


@query
def user_index(job: Job) -> DataFrame:
    return user_index_of(job)


@query
def item_index(job: Job) -> DataFrame:
    return item_index_of(job)


@query
def ratings_train(job: Job) -> DataFrame:
    return rounded(training_triples(job.train, *job.indexes), "rating")


@query
def ratings_test(job: Job) -> DataFrame:
    return rounded(training_triples(job.test, *job.indexes), "rating")


@query
def ratings_moved_window(job: Job) -> DataFrame:
    """Ratings of a month of the last year, reached by moving the window of the month before in two steps."""
    path = shared_path(job.spark, "interactions")
    write_partitions(extract.interactions(job.purchases, LAST_YEAR), path)
    held = None
    for first, last in WINDOWS:
        days = window.days_between(job.spark, path, first, last)
        held = window.move(job.spark, path, held, days) if held else window.open_window(job.spark, path, days)
    return rounded(window.ratings(held), "rating")


@query
def frequency_index(job: Job) -> DataFrame:
    return index.frequency_index(job.purchases, "item_id", "item_idx")


@query
def one_hot_brand(job: Job) -> DataFrame:
    parts = job.table("part").select(F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("item_brand"))
    brands = index.frequency_index(parts, "item_brand", "brand_idx").drop("frequency")
    indexed = parts.join(brands, "item_brand")
    encoder = OneHotEncoder(inputCols=["brand_idx"], outputCols=["vector"]).fit(brands)
    vector = vector_to_array("vector").cast("array<int>")
    return encoder.transform(indexed).select("item_id", "item_brand", "brand_idx", joined(vector).alias("brand_vec"))


# Model, errors and ranking


@query
def bias_model(job: Job) -> DataFrame:
    users = job.bias.users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "bias")
    items = job.bias.items.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), "bias")
    mean = job.bias.mean.select(F.lit("mean").alias("kind"), F.lit(-1).cast("long").alias("id"), F.col("mu").alias("bias"))
    return rounded(users.unionByName(items).unionByName(mean), "bias")


@query
def predict_pairs_test(job: Job) -> DataFrame:
    return rounded(predict_pairs(job.test, job.model), "rating", "prediction")


@query
def predict_blocks_test(job: Job) -> DataFrame:
    """The same predictions where blocks of pairs meet blocks of parameters."""
    return rounded(factors.predict_in_blocks(job.test, job.model), "rating", "prediction")


@query
def rmse_test(job: Job) -> DataFrame:
    return rounded(evaluate.heldout_rmse(job.model, job.test), "rmse")


@query
def rmse_by_quantity(job: Job) -> DataFrame:
    """Errors by the quantity of the purchase line, over all lines of the test side."""
    lines = extract.windowed_purchases(job.purchases, job.config)
    _, later = split.chronological_split(lines, job.config.test_fraction)
    pairs = later.select(
        F.col("network_userid").alias("user_id"), "item_id", F.col("item_quantity").cast("double").alias("rating")
    ).where("rating IS NOT NULL")
    by_quantity = metrics.rmse_by(predict_pairs(pairs, job.model), "rating")
    return rounded(by_quantity, "rating", "rmse", "log_count")


@query
def user_topk(job: Job) -> DataFrame:
    return rounded(top_items(job.model, job.users, TOP_K), "score", digits=SCORE_DIGITS)


@query
def user_topk_unseen(job: Job) -> DataFrame:
    return rounded(top_items(job.model, job.users, TOP_K, seen=job.train.select("user_id", "item_id")), "score", digits=SCORE_DIGITS)


@query
def ndcg_per_user(job: Job) -> DataFrame:
    per_user = evaluate.user_metrics(job.model, job.test, TOP_K)
    return rounded(per_user.select("user_id", F.col("ndcg").alias("ndcg_at_10")), "ndcg_at_10")


@query
def precision_recall_per_user(job: Job) -> DataFrame:
    per_user = evaluate.user_metrics(job.model, job.test, TOP_K)
    named = per_user.select(
        "user_id", "n_relevant", "hits", F.col("precision").alias("precision_at_10"), F.col("recall").alias("recall_at_10")
    )
    return rounded(named, "precision_at_10", "recall_at_10")


@query
def evaluation_summary(job: Job) -> DataFrame:
    summary = evaluate.evaluate(job.model, job.test, TOP_K)
    return rounded(summary, "rmse", "ndcg_at_10", "precision_at_10", "recall_at_10")


@query
def evaluation_sampled(job: Job) -> DataFrame:
    summary = evaluate.evaluate(job.model, job.test, TOP_K, users=SAMPLE, seed=SEED)
    return rounded(summary, "rmse", "ndcg_at_10", "precision_at_10", "recall_at_10")


# Similarity, popularity and baskets


@query
def embedding_lookup(job: Job) -> DataFrame:
    asked = job.table("lineitem").select(job.basket_item().alias("item_id")).distinct()
    found = factors.embeddings_of(asked, "item_id", job.items)
    return found.select("item_id", vector_text(F.col("features")).alias("vector"))


@query
def lsh_buckets(job: Job) -> DataFrame:
    return job.recommender.index.select("table_idx", "hash_key", "item_id")


@query
def lsh_neighbors(job: Job) -> DataFrame:
    queries = job.items.select(F.col("item_id").alias("query_id"), "features", F.lit(TOP_K).alias("k"))
    return rounded(neighbors(job.recommender.index, queries, job.recommender.planes), "score", digits=SCORE_DIGITS)


@query
def similar_items_all(job: Job) -> DataFrame:
    asked = job.table("lineitem").select(job.basket_item().alias("query_id"), F.lit(BASKET_K).alias("k"))
    return rounded(similar_items(asked, job.recommender), "score", digits=SCORE_DIGITS)


@query
def basket_embeddings(job: Job) -> DataFrame:
    vectors = basket_vectors(job.basket_lines(), job.items, job.config.n_factors)
    return vectors.select("basket_id", "n_known", vector_text(F.col("features")).alias("vector"))


@query
def popularity_topk(job: Job) -> DataFrame:
    return rounded(popularity.most_popular(popularity.popularity_from_bias(job.items), 100), "score", digits=SCORE_DIGITS)


@query
def popularity_topk_excluding(job: Job) -> DataFrame:
    scores = popularity.popularity_from_bias(job.items)
    exclude = job.table("part").where("p_brand IN ('Brand#1', 'Brand#2')").select(F.col("p_partkey").alias("item_id"))
    return rounded(popularity.most_popular(scores, 100, exclude), "score", digits=SCORE_DIGITS)


@query
def basket_recommendations(job: Job) -> DataFrame:
    return rounded(recommend_for_lines(job.basket_lines(), job.recommender), "score", digits=SCORE_DIGITS)


@query
def basket_responses(job: Job) -> DataFrame:
    """Requests and responses in their JSON form; a request for the usual number names none."""
    asked = job.requests().withColumn("top_k", F.nullif("top_k", F.lit(BASKET_K)))
    texts = asked.select("basket_id", F.to_json(F.struct("basket", "top_k")).alias("value"))
    answered = responses(parse_requests(texts, job.items.schema["item_id"].dataType), job.recommender)
    shape = "struct<basket: array<bigint>, recommendations: array<struct<item_id: bigint, score: double>>>"
    body = F.from_json("response", shape)
    return answered.select(
        "basket_id",
        joined(body["basket"]).alias("basket"),
        joined(body["recommendations"]["item_id"]).alias("items"),
        vector_text(body["recommendations"]["score"], 10**SCORE_DIGITS).alias("scores"),
        "error",
    )


@query
def stream_basket_recommendations(job: Job) -> DataFrame:
    """The requests as a stream of files, answered in micro-batches from a saved model."""
    spark = job.spark
    saved, asked = shared_path(spark, "model"), shared_path(spark, "requests")
    out, progress = shared_path(spark, "answers"), shared_path(spark, "progress")
    save_model(job.model, saved)
    job.requests().write.parquet(asked)
    stream = read_requests(spark, asked, job.items.schema["item_id"].dataType)
    serve(stream, load_recommender(spark, saved, job.config), out, progress).awaitTermination()
    return rounded(spark.read.parquet(f"{out}/recommendations").drop("batch", "request"), "score", digits=SCORE_DIGITS)


@query
def request_recommendations(job: Job) -> DataFrame:
    return rounded(recommend_baskets(job.requests(), job.recommender).drop("request"), "score", digits=SCORE_DIGITS)


# Market baskets


@query
def order_baskets(job: Job) -> DataFrame:
    baskets = itemsets.order_baskets(job.purchases)
    return baskets.select("order_id", F.size("items").alias("n_items"), joined(F.col("items")).alias("items"))


@query
def frequent_itemsets(job: Job) -> DataFrame:
    model = itemsets.mine(itemsets.order_baskets(job.purchases))
    return itemsets.frequent_itemsets(model).withColumn("items", joined(F.col("items")))


@query
def largest_itemsets(job: Job) -> DataFrame:
    model = itemsets.mine(itemsets.order_baskets(job.purchases))
    return itemsets.largest_itemsets(model).withColumn("items", joined(F.col("items")))


@query
def association_rules(job: Job) -> DataFrame:
    model = itemsets.mine(itemsets.order_baskets(job.purchases))
    rules = itemsets.association_rules(model).withColumn("antecedent", joined(F.col("antecedent")))
    return rounded(rules, "confidence", "lift", "support")


# Profiles


@query
def null_profile(job: Job) -> DataFrame:
    outer = job.table("orders").join(job.table("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return profile.null_profile(outer.select("o_orderkey", "o_custkey", "o_orderdate", "l_partkey", "l_quantity"))


@query
def distinct_profile(job: Job) -> DataFrame:
    return profile.distinct_profile(job.described, ["item_id", "item_brand"])


@query
def measure_percentiles(job: Job) -> DataFrame:
    points = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    summary = profile.percentiles(job.table("events"), "event_type", "value", points)
    return rounded(summary, "mean", "per_second", *points)


# Runs


def monthly_runs(job: Job) -> DataFrame:
    """Each calendar month judged as one run of the bias model."""
    bias_only = factors.FactorModel(
        job.bias.mean,
        factors.with_parameters(job.bias.users, "user_id", no_factors(job.bias.users, "user_id"), job.bias.users, 1),
        factors.with_parameters(job.bias.items, "item_id", no_factors(job.bias.items, "item_id"), job.bias.items, 1),
        1,
    )
    monthly = job.interactions.withColumn("run_id", F.substring("date_partition", 1, 7))
    pairs = monthly.select("run_id", F.col("network_userid").alias("user_id"), "item_id", F.col("item_quantity").alias("rating"))
    return metrics.rmse_by(predict_pairs(pairs, bias_only), "run_id")


def no_factors(ids: DataFrame, key: str) -> DataFrame:
    return ids.select(key, F.array(F.lit(0.0)).alias("features"))


@query
def run_metrics_long(job: Job) -> DataFrame:
    judged = monthly_runs(job).withColumn("step", F.lit(1))
    return rounded(runs.metrics_long(judged, "run_id", "step", ["rmse", "n_pairs", "log_count"]), "value")


@query
def champion_runs(job: Job) -> DataFrame:
    judged = rounded(monthly_runs(job), "rmse").withColumn("model", F.lit("bias"))
    return runs.champions(judged, "model", "run_id", "rmse").select("run_id", "rmse", "n_pairs", "is_best", "champion")


# Learned models


@query
def learning_curve(job: Job) -> DataFrame:
    """Loss, error and best flag of every epoch of gradient training with the shipped settings."""
    users, items = job.ids("network_userid", "user_id"), job.ids("item_id", "item_id")
    _, curve = fit_gradient(job.train, job.test, users, items, run_id="gradient", seed=SEED, **learning(job.config))
    return rounded(curve, "train_loss", "test_loss", "train_rmse", "test_rmse")


@query
def als_ratings_rmse(job: Job) -> DataFrame:
    model, _ = factors.fit_factor_model(job.train, *job.indexes, job.config)
    return rounded(evaluate.heldout_rmse(model, job.test), "rmse")


@query
def als_topk(job: Job) -> DataFrame:
    model, _ = factors.fit_factor_model(job.train, *job.indexes, job.config)
    # A learned model carries the rounding errors of all its steps, so fewer digits are compared.
    return rounded(top_items(model, model.users, TOP_K), "score", digits=2)


@query
def als_rmse_by_quantity(job: Job) -> DataFrame:
    """Non-negative ALS on a random split of purchase lines, errors per quantity."""
    users = index.frequency_index(job.purchases, "network_userid", "user_idx")
    items = index.frequency_index(job.purchases, "item_id", "item_idx")
    lines = (
        job.purchases.join(users, job.purchases["network_userid"].cast("string") == users["network_userid"])
        .join(items, job.purchases["item_id"].cast("string") == items["item_id"])
        .select("user_idx", "item_idx", "order_id", F.col("item_quantity").alias("rating"))
    )
    sided = split.hash_split(lines, ["user_idx", "item_idx", "order_id"], 0.2, SEED)
    train = sided.where("side = 'train'")
    model = factors.als_model(train, 5, *factors.fit_als(train, rank=5, max_iter=50, reg=0.01, nonnegative=True))
    test = sided.where("side = 'test'").withColumnsRenamed({"user_idx": "user_id", "item_idx": "item_id"})
    return metrics.rmse_by(predict_pairs(test, model, how="inner"), "rating")


# Sinks: written, read back, and compared like the frames they hold


@query
def split_written(job: Job) -> DataFrame:
    """Both sides of the split as datasets of their own: rows of every date."""
    whole, base = shared_path(job.spark, "interactions"), shared_path(job.spark, "sides")
    write_partitions(job.interactions, whole)
    sides = write_split(job.spark, whole, base, job.config.test_fraction)
    both = [read_partitions(job.spark, path).withColumn("side", F.lit(side)) for path, side in zip(sides, ("train", "test"))]
    return both[0].unionByName(both[1]).groupBy("date_partition", "side").agg(F.count("*").alias("n_rows"))


@query
def metrics_log(job: Job) -> DataFrame:
    """The metrics of all runs, logged twice as after a repeated run."""
    log = shared_path(job.spark, "metrics")
    judged = monthly_runs(job).withColumn("step", F.lit(1))
    rows = rounded(runs.metrics_long(judged, "run_id", "step", ["rmse", "n_pairs", "log_count"]), "value")
    for _ in range(2):
        append_metrics(rows, log)
    return read_metrics(job.spark, log)


@query
def evaluation_saved(job: Job) -> DataFrame:
    """The evaluation as its JSON file gives it back."""
    summary = rounded(evaluate.evaluate(job.model, job.test, TOP_K), "rmse", "ndcg_at_10", "precision_at_10", "recall_at_10")
    path = save_evaluation(summary, 1.5, shared_path(job.spark, "evaluations"), LAST_YEAR.end_date)
    return job.spark.read.json(path)


@query
def served_champion(job: Job) -> DataFrame:
    """Requests answered by the second of two models that were promoted and served in turn."""
    latest = shared_path(job.spark, "latest")
    turned = replace(job.model, items=job.items.withColumns({"features": F.reverse("features"), "bias": -F.col("bias")}))
    for model, error in ((turned, 2.0), (job.model, 1.0)):
        promote(job.spark, model, error, latest)
        served = load_recommender(job.spark, champion(job.spark, latest)[0], job.config)
    return rounded(recommend_baskets(job.requests(), served).drop("request"), "score", digits=SCORE_DIGITS)


@query
def stream_follows_champion(job: Job) -> DataFrame:
    """The requests as two files of a stream; between their batches a second model is promoted."""
    spark, latest = job.spark, shared_path(job.spark, "latest")
    asked, out, progress = (shared_path(spark, name) for name in ("requests", "answers", "progress"))
    turned = replace(job.model, items=job.items.withColumns({"features": F.reverse("features"), "bias": -F.col("bias")}))
    current = follow_champion(spark, latest, job.config)
    for part, (model, error) in enumerate(((turned, 2.0), (job.model, 1.0))):
        promote(spark, model, error, latest, only_better=True)
        job.requests().where(F.pmod("basket_id", F.lit(2)) == part).write.mode("append").parquet(asked)
        stream = read_requests(spark, asked, job.items.schema["item_id"].dataType)
        serve(stream, current, out, progress).awaitTermination()
    answers = spark.read.parquet(f"{out}/recommendations")
    # The first batch's answers are of the first model.
    return rounded(answers.where("batch = 1").drop("batch", "request"), "score", digits=SCORE_DIGITS)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["basket_recommendations"](spark, folder)

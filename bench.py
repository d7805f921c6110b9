"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from cartwheel.operators.evaluate import heldout_rmse
from cartwheel.operators.lsh import neighbors
from cartwheel.operators.recommend import recommend_for_lines
from cartwheel.operators.score import top_items
from cartwheel.plans.queries import QUERIES
from cartwheel.plans.tables import TOP_K, Job
from cartwheel.session import build_session, remove_work

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))

HEADLINE = [
    "purchases_window",
    "order_item_quantity",
    "extraction_audit",
    "chrono_split",
    "user_index",
    "ratings_train",
    "bias_model",
    "rmse_test",
    "user_topk",
    "user_topk_unseen",
    "evaluation_summary",
    "lsh_neighbors",
    "similar_items_all",
    "basket_recommendations",
    "order_baskets",
    "frequent_itemsets",
    "measure_percentiles",
    "learning_curve",
    "als_ratings_rmse",
]


def main() -> None:
    spark = build_session("bench", CPUS, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    # Serving rate: an order is a request; the model and its buckets exist already.
    job = Job(spark, FOLDER)
    served = job.recommender
    baskets = job.table("lineitem").select("l_orderkey").distinct().count()
    start = time.perf_counter()
    recommend_for_lines(job.basket_lines(), served).write.format("noop").mode("overwrite").save()
    rate = baskets / (time.perf_counter() - start)

    # The operators alone, on tables that are stored already.
    queries = job.items.select(F.col("item_id").alias("query_id"), "features", F.lit(TOP_K).alias("k"))
    alone = {
        "user_topk": lambda: top_items(job.model, job.users, TOP_K),
        "user_topk_unseen": lambda: top_items(job.model, job.users, TOP_K, seen=job.train.select("user_id", "item_id")),
        "lsh_neighbors": lambda: neighbors(served.index, queries, served.planes),
        "rmse_test": lambda: heldout_rmse(job.model, job.test),
    }
    job.train, job.test
    on_stored = {}
    for name, build in alone.items():
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        on_stored[name] = round(time.perf_counter() - start, 3)
    remove_work(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "baskets_per_sec": round(rate, 1),
                "on_stored_inputs": on_stored,
            }
        )
    )


if __name__ == "__main__":
    main()

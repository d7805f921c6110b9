"""The stages of a run over files: extract, train, evaluate, select the champion."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cartwheel.config import Config
from cartwheel.operators.evaluate import evaluate, heldout_rmse
from cartwheel.operators.extract import observed_interactions
from cartwheel.operators.factors import FactorModel, fit_factor_model
from cartwheel.operators.gradient import fit_gradient
from cartwheel.operators.index import id_index
from cartwheel.operators.ratings import user_item_ratings
from cartwheel.operators.runs import metrics_long
from cartwheel.operators.split import chronological_split
from cartwheel.session import stored
from cartwheel.sources.artifacts import append_metrics, load_model, promote, save_evaluation, save_model
from cartwheel.sources.partitions import read_manifest, read_partitions, write_partitions
from cartwheel.sources.purchases import read_purchases_csv


@dataclass(frozen=True)
class Trained:
    model: FactorModel
    test: DataFrame
    test_rmse: float
    path: str


def extract_stage(spark: SparkSession, config: Config, events: DataFrame | None = None, infer: bool = False) -> dict[str, int]:
    """CSV (or the given events) to date-partitioned interactions; returns the audit counts."""
    source = read_purchases_csv(spark, config.data_path, infer, columns=config.columns) if events is None else events
    frame, read, made = observed_interactions(source, config)
    write_partitions(frame, config.output_base)
    return {**read.get, **made.get}


def train_stage(spark: SparkSession, config: Config, run_id: str, method: str = "als") -> Trained:
    """Split, index, fit and save one model, and append its metrics to the log."""
    cols = config.columns
    whole = read_partitions(spark, config.output_base)
    train_side, test_side = chronological_split(whole, config.test_fraction, read_manifest(spark, config.output_base))
    if train_side.isEmpty():
        raise ValueError("no date partitions on the train side")
    train = stored(user_item_ratings(train_side, cols), "train")
    test = stored(user_item_ratings(test_side, cols), "test")
    users = id_index([whole], cols.user, "user_id", "user_idx")
    items = id_index([whole], cols.item, "item_id", "item_idx")
    path, log = f"{config.checkpoint_base}/{run_id}", f"{config.checkpoint_base}/run_metrics"
    if method == "gradient":
        fitted, curve = fit_gradient(
            train,
            test,
            users,
            items,
            config.n_factors,
            config.learning_rate,
            config.reg_lambda,
            config.epochs,
            config.batch_size,
            run_id,
        )
        names = ["train_loss", "test_loss", "train_rmse", "test_rmse", "learning_rate"]
        append_metrics(metrics_long(curve, "run_id", "epoch", names), log)
    else:
        fitted, _ = fit_factor_model(train, users, items, config)
    users.write.mode("overwrite").parquet(f"{path}/user_index")
    items.write.mode("overwrite").parquet(f"{path}/item_index")
    save_model(fitted, f"{path}/model")
    model = load_model(spark, f"{path}/model")
    error = heldout_rmse(model, test).first()
    # Without test pairs there are no metrics: the error is infinite and no epoch counts.
    test_rmse, step = (error["rmse"], config.epochs) if error["n_pairs"] else (math.inf, 0)
    row = spark.createDataFrame([(run_id, step, test_rmse)], "run_id string, step int, test_rmse double")
    row.write.mode("overwrite").json(f"{path}/metrics")
    if method != "gradient":  # whose curve has the error of every epoch
        append_metrics(metrics_long(row, "run_id", "step", ["test_rmse"]), log)
    return Trained(model, test, test_rmse, path)


def evaluate_stage(trained: Trained, config: Config) -> tuple[DataFrame, str]:
    """Ranking metrics of all test users, or of a sample if one is configured, written as JSON."""
    summary = evaluate(trained.model, trained.test, config.ndcg_k, users=config.eval_sample_users)
    path = save_evaluation(summary, trained.test_rmse, config.metrics_dir, config.end_date)
    return summary.sparkSession.read.json(path), path


def select_stage(spark: SparkSession, config: Config, trained: Trained) -> bool:
    """Replace the champion when the new test RMSE is strictly lower, or when there is none."""
    return promote(spark, trained.model, trained.test_rmse, config.latest_model_dir, only_better=True) is not None

"""Training: labelled papers to a tuned, measured and stored model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import build_features, get_label
from ..operators.filters import drop_unlabeled
from ..operators.ranking import best_trial
from ..operators.split import stratified_split, train_plus_val
from ..operators.train import SEARCH_SPACE, param_sweep, refit_and_test, scale_pos_weight
from ..session import store
from ..sources.writers import log_run, save_model


def training_table(papers: DataFrame, label: str = "hype_label", key: str = "arxiv_id",
                   seed: int = 42) -> DataFrame:
    """Features, ``label`` and ``split`` of the labelled papers."""
    labeled = drop_unlabeled(papers, label).withColumn("label", get_label(F.col(label)))
    return stratified_split(build_features(labeled, (key, "label")), "label", key, seed)


def train_flow(papers: DataFrame, run_path: str, model_path: str, trials: int = 50,
               space: dict = SEARCH_SPACE, name: str = "paper-hype", version: str = "1") -> dict:
    """Split, sweep, refit, measure, log and save. The split is written once and read by all trials."""
    spark = papers.sparkSession
    split = store(training_table(papers), "split")
    train, val = (split.filter(F.col("split") == s) for s in ("train", "val"))
    settings, runs = param_sweep(train, val, trials, space=space)
    runs.coalesce(1).write.mode("append").parquet(run_path)
    best = best_trial(runs).first()
    number = int(best["run_id"].split("-")[1])
    model, metrics = refit_and_test(split, settings[number])
    log_run(
        spark, run_path, f"{name}-best",
        settings[number] | {f"best_{k}": v for k, v in settings[number].items()} | {
            "trained_on": "train+val", "best_trial": number, "n_trials": trials,
            "scale_pos_weight": scale_pos_weight(train_plus_val(split)), "optimal_threshold": metrics["optimal_threshold"],
        },
        {k: v for k, v in metrics.items() if k != "optimal_threshold"}
        | {"best_val_pr_auc": best["val_pr_auc"]},
        {"job": "hyperparameter_tuning"},
    )
    save_model(spark, model, model_path, name=name, version=version, run_id=f"{name}-best",
               threshold=metrics["optimal_threshold"])
    return metrics

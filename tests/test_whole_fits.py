"""Fits take all labelled rows: more of them than were once fitted."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlens.checks import training as checks
from paperlens.constants import FEATURE_COLS
from paperlens.operators import boosting, train
from paperlens.operators.trees import read_tree_model, score_trees
from paperlens.plans.training import train_flow

ROWS, VALUES = 320_000, 40
WHOLE = {"subsample": 1.0, "colsample_bytree": 1.0}
SPACE = {
    "n_estimators": (30, 30, "int"), "max_depth": (6, 6, "int"), "learning_rate": (0.3, 0.3, "float"), "gamma": (0.0, 0.0, "float"),
} | {k: (v, v, "float") for k, v in WHOLE.items()}


def rows_of_values(spark, n=ROWS):
    """Odd values are positive: a model must have seen every value to know its label."""
    a = F.col("id") % VALUES
    return spark.range(n).select(a.cast("double").alias("a"), (a % 2).cast("int").alias("label"))


def papers_of_values(spark, n=ROWS):
    h = (F.col("id") % VALUES).cast("int")
    return spark.range(n).select(
        F.col("id").cast("string").alias("arxiv_id"), F.lit("A paper").alias("title"), F.lit("x").alias("abstract"),
        F.array(F.lit("cs.LG")).alias("categories"), F.array(F.lit("a")).alias("author_names"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("submitted_at"), h.alias("max_h_index"),
        F.lit(0).alias("total_prior_papers"), (h % 2).alias("hype_label"))


def first_gain(counts):
    """The best first split of rows counted as (value, label, n), whose weights balance the classes, over all of them."""
    a, y, n = (np.array(c, float) for c in zip(*counts))
    weight = n * np.where(y == 1, round(n[y == 0].sum() / n[y == 1].sum(), 2), 1.0)
    g, h = weight * (0.5 - y), weight * 0.25
    worth = lambda k: g[k].sum() ** 2 / (h[k].sum() + 1)
    return max(worth(a < v) + worth(a >= v) - worth(a >= 0) for v in np.unique(a)) / 2


def test_sweep_fits_every_row(spark):
    few = rows_of_values(spark, 4000)
    _, runs = train.param_sweep(rows_of_values(spark), few, trials=2, space=SPACE, features=["a"])
    found = [float(r["value"]) for r in runs.filter("kind = 'objective'").collect()]
    assert found == [1.0, 1.0]


def test_refit_fits_every_row(spark):
    few = rows_of_values(spark, 4000)
    parts = [df.withColumn("split", F.lit(s)) for s, df in (("train", rows_of_values(spark)), ("val", few), ("test", few))]
    split = parts[0].unionByName(parts[1]).unionByName(parts[2])
    params = {k: v[0] for k, v in SPACE.items()}
    model, metrics = train.refit_and_test(split, params, features=["a"])
    assert metrics["test_roc_auc"] == metrics["test_pr_auc"] == metrics["test_f1"] == 1.0
    counts = split.filter("split <> 'test'").groupBy("a", "label").count().collect()
    assert model.trees[0]["gains"][0] == pytest.approx(first_gain(counts))


def test_prefixes_are_of_a_fit_of_every_row(spark, monkeypatch):
    scored_by, score = [], boosting.score_ensembles
    monkeypatch.setattr(checks, "papers", lambda spark, sf: papers_of_values(spark))
    monkeypatch.setattr(boosting, "DEFAULT_TREES", boosting.DEFAULT_TREES | WHOLE | {"max_depth": 1})
    monkeypatch.setattr(boosting, "score_ensembles", lambda df, models, uses: scored_by.extend(models) or score(df, models, uses))
    prefixes = checks.score_prefixes(spark, "rows of this test")
    assert prefixes.groupBy("trees").count().collect() and prefixes.count() == 4 * ROWS
    split = checks.split_table(spark, "rows of this test").filter("split = 'train'")
    counts = split.groupBy("max_h_index", "label").count().collect()
    assert sum(r["count"] for r in counts) > 200_000
    assert scored_by[0].trees[0]["gains"][0] == pytest.approx(first_gain(counts))


def test_flow_fits_every_row(spark, tmp_path):
    runs, model = str(tmp_path / "runs"), str(tmp_path / "model")
    metrics = train_flow(papers_of_values(spark), runs, model, trials=1, space=SPACE)
    assert metrics["test_roc_auc"] == metrics["test_pr_auc"] == 1.0
    known = spark.range(VALUES).select(*[(F.col("id") if c == "max_h_index" else F.lit(1)).alias(c) for c in FEATURE_COLS])
    scored = {r["max_h_index"]: r["hype_score"] for r in score_trees(known, read_tree_model(spark, model)).collect()}
    assert min(scored[k] for k in range(1, VALUES, 2)) > 0.5 > max(scored[k] for k in range(0, VALUES, 2))


@pytest.mark.parametrize("n", [50, 3000])
def test_a_table_is_fitted_as_rows_at_hand(spark, n):
    """Cuts, bins and order made by Spark are those of the same rows in memory, wherever the rows lie."""
    rng = np.random.default_rng(n)
    x = np.column_stack([rng.integers(0, k, n) for k in (90, 2, 3, 900, 65, 64, 1)]).astype(float)
    x[:, 3] /= 7
    for column, value in ((1, np.nan), (2, np.inf), (3, -np.inf), (4, np.nan)):
        x[rng.random(n) < 0.1, column] = value
    x = np.column_stack([x, np.full(n, np.nan)])
    y = ((np.nan_to_num(x[:, 0]) > 40) ^ (rng.random(n) < 0.2)).astype(float)
    names = [f"f {k}" for k in range(x.shape[1])]
    rows = [[*[None if np.isnan(v) else float(v) for v in r], int(label)] for r, label in zip(x, y)]
    df = spark.createDataFrame(rows, ", ".join(f"`{k}` double" for k in names) + ", label int")
    at = np.lexsort(np.column_stack([x, y]).T[::-1])
    known = boosting.Rows(x[at], y[at], np.where(y[at] == 1, 1.7, 1.0))
    settings = [{"n_estimators": 3}, {"n_estimators": 2, "max_depth": 9, "reg_alpha": 0.4}]
    for table in (df, df.repartition(5)):
        models = boosting.collected(boosting.fit_table(table, "label", [f"`{k}`" for k in names], 1.7, settings), names)
        for model, setting in zip(models, settings):
            plain = boosting.fit(known, boosting.DEFAULT_TREES | setting)
            for made, own in zip(model.trees, plain):
                for key in ("left_children", "split_indices", "base_weights"):
                    assert list(made[key]) == own[key]
                assert list(made["gains"]) == [np.float32(gain) for gain in own["gains"]]


def test_rows_are_gone_through_in_blocks(monkeypatch):
    """Small blocks give the same trees as one."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 50, (900, 5)).astype(float)
    y = (x[:, 0] + x[:, 1] > 50).astype(float)
    rows, setting = boosting.Rows(x, y, np.where(y == 1, 1.3, 1.0)), boosting.DEFAULT_TREES | {"n_estimators": 4}
    whole = boosting.fit(rows, setting)
    monkeypatch.setattr(boosting, "FIT_BLOCK", 128)
    assert boosting.fit(rows, setting) == whole

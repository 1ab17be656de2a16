import json

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from paperlens.constants import FEATURE_COLS
from paperlens.operators import boosting, evaluate, train
from paperlens.operators.drift import feature_drift
from paperlens.operators.trees import read_tree_model, score_trees
from paperlens.functions.features import build_features
from paperlens.plans.monitoring import monitor
from paperlens.plans.training import train_flow, training_table
from paperlens.checks.bindings import toy_model

SPACE = train.SEARCH_SPACE | {"n_estimators": (20, 40, "int"), "max_depth": (2, 4, "int")}


def papers(spark, n=1500):
    """The label follows h-index and a title word, with some noise."""
    i = F.col("id").cast("int")
    h = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(60)).cast("int")
    word = F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(5)) == 0
    noise = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(20)) == 0
    return spark.range(n).select(
        F.col("id").cast("string").alias("arxiv_id"),
        F.when(word, "An agent paper").otherwise("A paper").alias("title"),
        F.repeat(F.lit("x"), i % 500).alias("abstract"),
        F.array(F.lit("cs.LG")).alias("categories"),
        F.array_repeat(F.lit("a"), i % 5).alias("author_names"),
        F.when(i % 101 != 0, F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=i)).alias("submitted_at"),
        h.alias("max_h_index"), (h * 7).alias("total_prior_papers"),
        F.when(i % 50 != 0, ((h > 45) & word) | ((h > 55) != noise)).alias("hype_label"),
    )


@pytest.fixture(scope="module")
def split(spark):
    return training_table(papers(spark)).cache()


def auc(model, split):
    scored = train.score_model(model, split.filter("split = 'test'"))
    return evaluate.roc_auc(evaluate.ranking(scored)).first()[0]


def test_table(split):
    assert split.columns == ["arxiv_id", "label", *FEATURE_COLS, "split"]
    assert split.count() == 1470 and split.filter("day_of_week IS NULL").count() > 0


def test_z_scores(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    rows = train.standardize(df, df.filter("a IS NOT NULL"), ["a", "b"]).collect()
    assert [(r["z_a"], r["z_b"]) for r in rows] == [(-1.0, 0.0), (1.0, 0.0), (0.0, 0.0)]


def test_logreg(split):
    model = train.train_logreg(split.filter("split = 'train'"))
    assert auc(model, split) > 0.7


def test_logreg_after_a_table_was_observed(spark, split):
    counts = Observation()
    spark.range(3).observe(counts, F.count("*").alias("n")).collect()
    assert counts.get["n"] == 3
    assert auc(train.train_logreg(split.filter("split = 'train'")), split) > 0.7


def test_logreg_solves_the_weighted_problem(spark):
    """Against Newton steps on 0.5*|w|^2 + C * sum(weight * log loss), intercept free."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2)) * [3.0, 0.5] + [1.0, -2.0]
    y = (x @ [0.4, 1.5] + rng.normal(size=300) > 0.5).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, label int")
    model = train.train_logreg(df, features=["a", "b"], c=0.7).stages[-1]

    z = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(300)])
    weight = np.where(y == 1, 300 / (2 * y.sum()), 300 / (2 * (300 - y.sum())))
    w, ridge = np.zeros(3), np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        gradient = ridge @ w + 0.7 * z.T @ (weight * (p - y))
        w -= np.linalg.solve(ridge + 0.7 * z.T @ (z * (weight * p * (1 - p))[:, None]), gradient)
    assert [*model.coefficients, model.intercept] == pytest.approx(list(w), abs=1e-3)


def test_trees(spark, split):
    model = train.train_gbt(split.filter("split = 'train'"))
    assert len(model.trees) == 300 and auc(model, split) > 0.75
    importance = train.feature_importance(model)
    assert list(importance) == FEATURE_COLS and sum(importance.values()) == pytest.approx(1.0)
    top = train.top_model_features(spark, model).collect()
    assert len(top) == 5 and {"max_h_index", "total_prior_papers"} & {r["feature"] for r in top[:3]}


def test_draws_are_repeatable_and_in_range():
    first = train.draw_params(20)
    assert first == train.draw_params(20) and len(first) == 20
    for p in first:
        assert 100 <= p["n_estimators"] <= 600 and 0.01 <= p["learning_rate"] <= 0.3 and 0.6 <= p["subsample"] <= 1


def test_spark_trees_over_all_rows(split):
    model = train.train_ml_gbt(split.filter("split = 'train'"), params={"maxIter": 8, "maxDepth": 3})
    assert auc(model, split) > 0.7 and sum(train.feature_importance(model).values()) == pytest.approx(1.0)


def rows_of(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 30, (n, 4)).astype(float)
    x[rng.random(n) < 0.1, 1] = np.nan
    y = ((x[:, 0] > 12) ^ (rng.random(n) < 0.1)).astype(float)
    return boosting.Rows(x, y, np.where(y == 1, 2.0, 1.0))


def plain_split(x, g, h, ridge):
    """The best split of one node by trying every value of every feature: (gain, feature, value)."""
    worth = lambda a, b: a * a / (b + ridge)
    found = []
    for f in range(x.shape[1]):
        for value in np.unique(x[np.isfinite(x[:, f]), f]):
            low = x[:, f] < value
            if h[low].sum() >= 1 and h[~low].sum() >= 1:
                gain = worth(g[low].sum(), h[low].sum()) + worth(g[~low].sum(), h[~low].sum()) - worth(g.sum(), h.sum())
                found.append((gain / 2, f, value))
    return max(found)


def test_first_split_and_leaves_by_brute_force():
    rows = rows_of()
    setting = boosting.DEFAULT_TREES | {"n_estimators": 1, "max_depth": 1, "subsample": 1.0, "colsample_bytree": 1.0}
    tree = boosting.fit(rows, setting)[0]
    g, h = rows.weight * (0.5 - rows.y), rows.weight * 0.25
    gain, feature, value = plain_split(rows.x, g, h, 1.0)
    assert (tree["split_indices"][0], tree["split_conditions"][0]) == (feature, value)
    assert tree["gains"][0] == pytest.approx(gain)
    low = rows.x[:, feature] < value
    for node, side in ((1, low), (2, ~low)):
        assert tree["base_weights"][node] == pytest.approx(-0.05 * g[side].sum() / (h[side].sum() + 1), rel=1e-5)


def test_what_is_fitted_is_what_is_scored(spark):
    """Margins that boosting keeps while it fits are those that scoring walks to, for every prefix."""
    rows = rows_of()
    settings = [{"n_estimators": n, "max_depth": d, "reg_alpha": 0.1} for n, d in ((30, 3), (7, 3), (12, 5))]
    fits, uses = boosting.shared_fits([boosting.DEFAULT_TREES | s for s in settings])
    assert len(fits) == 2 and uses == [(0, 30), (0, 7), (1, 12)]
    names = list("abcd")
    models = boosting.collected(boosting.fit_many(spark, rows, fits), names)
    df = spark.createDataFrame(
        [(k, *[None if np.isnan(v) else float(v) for v in r]) for k, r in enumerate(rows.x)],
        "id int, a double, b double, c double, d double")
    together = {(r["id"], r["model"]): r["score"] for r in boosting.score_ensembles(df, models, uses).collect()}
    assert len(together) == 400 * 3
    for place, (m, n) in enumerate(uses):
        part = boosting.first_trees(models[m], n)
        alone = boosting.fit(rows, fits[m] | {"n_estimators": n})
        assert [t["base_weights"] for t in alone] == [t["base_weights"] for t in part.trees]
        for native in (False, n == 7):
            for r in score_trees(df, part, native).collect():
                assert together[r["id"], place] == pytest.approx(r["hype_score"], abs=1e-9)


def test_fitting_takes_a_bounded_share(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 2).alias("label"))
    taken = boosting.bounded_rows(df, "label", ["a"], 1.0, 500)
    assert 350 < len(taken.y) < 650
    assert (taken.x == boosting.bounded_rows(df.repartition(7), "label", ["a"], 1.0, 500).x).all()
    with pytest.raises(ValueError):
        train.train_gbt(df.filter("label = 0"), features=["a"])


def test_metrics_of_many_models_are_those_of_each(spark):
    rng = np.random.default_rng(4)
    rows = [(m, float(rng.integers(0, 20)) / 20, int(rng.random() < 0.4)) for m in range(5) for _ in range(200)]
    df = spark.createDataFrame(rows, "model int, score double, label int")
    by = ("model",)
    together = {r["model"]: r for r in evaluate.metric_bundle(evaluate.ranking(df, by=by), "v", by=by).collect()}
    best = {r["model"]: r["threshold"] for r in evaluate.best_f1_threshold(evaluate.ranking(df, by=by), by).collect()}
    reports = evaluate.classification_report(evaluate.score_counts(df, by=by), by=by).collect()
    assert len(together) == 5 and len(reports) == 25
    for m in range(5):
        alone = evaluate.ranking(df.filter(F.col("model") == m))
        row = evaluate.metric_bundle(alone, "v").first()
        assert [row[c] for c in ("v_roc_auc", "v_pr_auc", "v_f1")] == [together[m][c] for c in ("v_roc_auc", "v_pr_auc", "v_f1")]
        assert evaluate.best_f1_threshold(alone).first()[0] == best[m]


def test_flow(spark, tmp_path):
    runs, model = str(tmp_path / "runs"), str(tmp_path / "model")
    metrics = train_flow(papers(spark), runs, model, trials=3, space=SPACE)
    assert set(metrics) == {"test_roc_auc", "test_pr_auc", "test_f1", "optimal_threshold"}
    assert metrics["test_roc_auc"] > 0.7
    logged = spark.read.parquet(runs)
    assert logged.select("run_id").distinct().count() == 4
    meta = json.loads(spark.read.text(f"{model}/meta").first()[0])
    assert meta["feature_cols"] == FEATURE_COLS and meta["threshold"] == metrics["optimal_threshold"]
    stored = read_tree_model(spark, model)
    assert stored.threshold == metrics["optimal_threshold"]
    scored = train.score_model(stored, build_features(papers(spark), ("arxiv_id",)))
    assert scored.filter("score BETWEEN 0 AND 1").count() == 1500


def test_monitor(spark, tmp_path):
    reports, metrics = str(tmp_path / "reports"), str(tmp_path / "metrics")
    df = papers(spark)
    run = lambda as_of, **kw: monitor(df, df, as_of, reports, metrics, toy_model(), **kw)
    assert run("2024-03-03 00:00:00", reference_rows=400)
    assert run("2024-02-20 00:00:00", reference_rows=400)
    assert not run("2030-01-01 00:00:00")
    assert not run("2024-02-20 00:00:00", min_rows=10**6)
    rows = spark.read.parquet(reports)
    assert rows.groupBy("report_date").count().filter(f"count = {len(FEATURE_COLS)}").count() == 2
    names = {r["name"] for r in spark.read.parquet(metrics).select("name").distinct().collect()}
    assert names == {"current_papers_count", "drift_share", "drift_detected", "feature_drift_score", "mean_hype_score"}


def test_same_table_does_not_drift(spark):
    matrix = build_features(papers(spark))
    for family in ("distance", "p_value"):
        assert feature_drift(matrix, matrix, family).filter("detected").count() == 0


def test_levels_below_the_first_by_brute_force():
    """Joint bins and what smaller children leave give every node's own sums."""
    rng = np.random.default_rng(6)
    n = 3000
    x = np.column_stack([rng.integers(0, k, n) for k in (90, 2, 2, 3, 2, 12, 2, 2, 2, 1)]).astype(float)
    x[rng.random(n) < 0.1, 3] = np.nan
    y = ((x[:, 0] > 40) ^ (x[:, 2] == 1) ^ (rng.random(n) < 0.2)).astype(float)
    rows = boosting.Rows(x, y, np.where(y == 1, 1.7, 1.0))
    setting = boosting.DEFAULT_TREES | {"n_estimators": 1, "max_depth": 5, "subsample": 1.0, "colsample_bytree": 1.0}
    tree = boosting.fit(rows, setting)[0]
    g, h = rows.weight * (0.5 - y), rows.weight * 0.25
    cuts = [boosting.cut_points(x[:, f]) for f in range(x.shape[1])]
    inside, splits = {0: np.ones(n, bool)}, 0
    for node, low in enumerate(tree["left_children"]):
        here = inside[node]
        total = g[here].sum() ** 2 / (h[here].sum() + 1)
        if low >= 0:
            splits += 1
            below = here & (x[:, tree["split_indices"][node]] < tree["split_conditions"][node])
            inside[low], inside[low + 1] = below, here & ~below
            gains = []
            for f, values in enumerate(cuts):
                for value in values:
                    a = here & (x[:, f] < value)
                    b = here & ~a
                    if h[a].sum() >= 1 and h[b].sum() >= 1:
                        gains.append((g[a].sum() ** 2 / (h[a].sum() + 1) + g[b].sum() ** 2 / (h[b].sum() + 1) - total) / 2)
            assert tree["gains"][node] == pytest.approx(max(gains))
        else:
            assert tree["base_weights"][node] == pytest.approx(-0.05 * g[here].sum() / (h[here].sum() + 1), rel=1e-5)
    assert splits > 20


def test_cost_of_a_fit():
    """Features of few bins share histograms, and only the smaller child of each node is counted."""
    x = np.random.default_rng(3).integers(0, 2, (500, 24)).astype(float)
    x[:, 0] = np.arange(500)
    bins = boosting.binned(x)
    assert len(bins.joint) == 5 and max(len(m) for m in bins.left_of) <= boosting.PACK_BINS
    counted = []
    real = boosting.histograms

    def noted(rows, at, *rest):
        counted.append(len(at))
        return real(rows, at, *rest)

    y = (x[:, 0] > 250).astype(float)
    boosting.histograms = noted
    try:
        boosting.fit(boosting.Rows(x, y, np.ones(500)), boosting.DEFAULT_TREES | {"n_estimators": 3, "subsample": 1.0})
    finally:
        boosting.histograms = real
    whole = [k for k, size in enumerate(counted) if size == 500]
    assert len(whole) == 3 and all(size <= 250 for k, size in enumerate(counted) if k not in whole)


def test_trees_are_made_once(spark):
    """Reading the trees of a fit does not make them a second time."""
    made = spark.sparkContext.accumulator(0)

    def trees(batches):
        for batch in batches:
            made.add(1)
            batch["tree"] = batch["id"]
            yield batch.assign(fit=0)[["fit", "tree"]]

    table = spark.range(0, 2, 1, 2).mapInPandas(trees, "fit int, tree int")
    table = table.selectExpr("fit", "tree", "array(-1) AS left_children")
    assert len(boosting.collected(table)[0].trees) == 2 and made.value == 2

"""Fitting, tuning and applying classifiers at their published size.

Scores have no SQL: rows, bounds, drawn settings and ranks better than chance are checked. All queries
over one folder share one fit of 300 trees of depth 6.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..constants import DEFAULT_THRESHOLD, FEATURE_COLS
from ..functions.features import build_features
from ..operators import boosting, evaluate, ranking, train
from ..operators.trees import TreeModel, read_tree_model
from ..plans.training import training_table
from ..session import store, work_dir
from ..sources.writers import load_model_meta
from ..sources.writers import save_model as store_model
from . import check
from .bindings import PF, papers, rounded, table

SCALED = ["num_authors", "abstract_length", "title_length", "day_of_week", "max_h_index", "total_prior_papers"]
TRIALS = 50
_fits: dict[tuple[str, str], TreeModel] = {}


def split_table(spark, sf):
    return store(training_table(papers(spark, sf)), "split")


def fitted(spark, sf, split) -> TreeModel:
    """The default fit on the train part, made once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _fits:
        _fits[key] = train.train_gbt(split.filter("split = 'train'"))
    return _fits[key]


@check(PF + "SELECT arxiv_id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS z_{c}" for c in SCALED
) + " FROM features")
def standardize(spark, sf):
    matrix = build_features(papers(spark, sf), ("arxiv_id",))
    scaled = train.standardize(matrix, matrix, SCALED)
    return rounded(scaled.select("arxiv_id", *[f"z_{c}" for c in SCALED]), *[f"z_{c}" for c in SCALED])


def valid(column="score"):
    return F.col(column).between(0, 1).alias("valid")


def better(scored):
    """Whether labelled rows are ranked better than by chance."""
    return F.lit(evaluate.roc_auc(evaluate.ranking(scored)).first()[0] > 0.5).alias("better")


LABELED_SCORES = PF + """SELECT arxiv_id, cast(hype_label AS INT) AS label, true AS valid, true AS better
FROM features WHERE hype_label IS NOT NULL"""


@check(LABELED_SCORES)
def train_logreg(spark, sf):
    split = split_table(spark, sf)
    scored = train.score_spark_model(train.train_logreg(split.filter("split = 'train'")), split)
    return scored.select("arxiv_id", F.col("label").cast("int").alias("label"), valid(), better(scored))


@check(LABELED_SCORES)
def train_gbt(spark, sf):
    """300 trees of depth 6 score every labelled paper."""
    split = split_table(spark, sf)
    scored = train.score_model(fitted(spark, sf, split), split)
    return scored.select("arxiv_id", F.col("label").cast("int").alias("label"), valid(), better(scored))


@check(PF + """SELECT arxiv_id, cast(n AS INT) AS trees, true AS valid FROM features, (VALUES (1), (50), (100), (300)) v(n)""")
def score_prefixes(spark, sf):
    """The first trees of the fit as smaller ensembles, all of them in one pass over the papers."""
    model = fitted(spark, sf, split_table(spark, sf))
    sizes = [1, 50, 100, 300]
    scored = boosting.score_ensembles(build_features(papers(spark, sf), ("arxiv_id",)), [model], [(0, n) for n in sizes])
    trees = F.get(F.array(*map(F.lit, sizes)), F.col("model")).alias("trees")
    return scored.select("arxiv_id", trees, valid())


@check(PF + "SELECT arxiv_id, true AS valid FROM features")
def score_spark_model(spark, sf):
    """A pipeline fit on the labelled papers scores all of them."""
    model = train.train_logreg(split_table(spark, sf).filter("split = 'train'"))
    matrix = build_features(papers(spark, sf), ("arxiv_id",))
    return train.score_spark_model(model, matrix).select("arxiv_id", valid())


@check("SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURE_COLS) + "]) AS feature, true AS valid, 1.0::DOUBLE AS total")
def feature_importance(spark, sf):
    shares = train.feature_importance(fitted(spark, sf, split_table(spark, sf)))
    rows = spark.createDataFrame(list(shares.items()), "feature string, importance double")
    total = F.round(F.sum("importance").over(Window.partitionBy()), 6).alias("total")
    return rows.select("feature", valid("importance"), total)


@check("""
SELECT event_type AS feature, round(max(value), 4) AS importance FROM events
GROUP BY event_type ORDER BY importance DESC, feature LIMIT 5
""")
def top_features(spark, sf):
    """Event types stand for features, their largest value for an importance."""
    rows = table(spark, sf, "events").groupBy("event_type").agg(F.max("value").alias("value")).collect()
    return ranking.top_features(spark, {r["event_type"]: r["value"] for r in rows})


def _drawn() -> str:
    drawn = [(train.trial_name(n), "param", k, str(v)) for n, s in enumerate(train.draw_params(TRIALS)) for k, v in s.items()]
    drawn += [(train.trial_name(n), "tag", "trial_number", str(n)) for n in range(TRIALS)]
    drawn += [(train.trial_name(n), kind, key, "valid") for n in range(TRIALS) for kind, key in (
        ("param", "scale_pos_weight"), ("metric", "val_roc_auc"), ("metric", "val_pr_auc"), ("objective", "val_pr_auc"))]
    return "SELECT * FROM (VALUES " + ", ".join(map(str, drawn)) + ") v(run_id, kind, key, value)"


@check(_drawn())
def param_sweep(spark, sf):
    """50 trials in the published space; what was drawn is compared, what was measured lies in its bounds."""
    split = split_table(spark, sf)
    parts = [split.filter(F.col("split") == s) for s in ("train", "val")]
    _, runs = train.param_sweep(*parts, trials=TRIALS)
    number = F.col("value").cast("double")
    measured = F.col("kind").isin("metric", "objective") & number.between(0, 1)
    weight = (F.col("key") == "scale_pos_weight") & (F.expr("try_cast(value AS double)") > 0)
    return runs.withColumn("value", F.when(measured | weight, "valid").otherwise(F.col("value")))


@check("""
SELECT concat('run-', cast(user_id AS VARCHAR)) AS run_id, max(value) AS val_pr_auc FROM events
GROUP BY user_id ORDER BY val_pr_auc DESC, run_id LIMIT 1
""")
def best_trial(spark, sf):
    """Users stand for runs, their largest event for the objective."""
    best = table(spark, sf, "events").groupBy("user_id").agg(F.max("value").alias("value"))
    runs = best.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"), F.lit("objective").alias("kind"),
        F.lit("val_pr_auc").alias("key"), F.col("value").cast("string").alias("value"),
    )
    return ranking.best_trial(runs)


@check("SELECT unnest(['test_roc_auc', 'test_pr_auc', 'test_f1', 'optimal_threshold']) AS metric, true AS valid")
def refit_and_test(spark, sf):
    """Threshold, refit and test of the default setting."""
    _, metrics = train.refit_and_test(split_table(spark, sf), {})
    return spark.createDataFrame(list(metrics.items()), "metric string, value double").select("metric", valid("value"))


@check(f"""
SELECT 'paper-hype' AS model_name, cast({DEFAULT_THRESHOLD} AS DOUBLE) AS threshold, {len(FEATURE_COLS)} AS num_features,
  cast(i - 1 AS INT) AS pos, f[i] AS feature, true AS alike
FROM (SELECT [{", ".join(f"'{c}'" for c in FEATURE_COLS)}] AS f), range(1, {len(FEATURE_COLS)} + 1) r(i)
""")
def save_model(spark, sf):
    """A stored model's metadata, one row per feature in contract order; what is read back scores alike."""
    split = split_table(spark, sf)
    model = fitted(spark, sf, split)
    path = work_dir(spark, "model")
    store_model(spark, model, path, name="paper-hype", version="1", run_id="run-1")
    stored = read_tree_model(spark, path)
    both = train.score_model(stored, train.score_model(model, split, "first"), "second")
    alike = both.filter(F.abs(F.col("first") - F.col("second")) > 1e-12).isEmpty()
    meta = load_model_meta(spark, path)
    return meta.select("model_name", "threshold", "num_features", F.posexplode("feature_cols").alias("pos", "feature"),
                       F.lit(alike).alias("alike"))

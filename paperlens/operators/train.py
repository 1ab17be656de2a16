"""Standardising, fitting, tuning and testing classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FEATURE_COLS
from ..functions.scores import round4
from ..schemas import RUN_LOG
from ..session import store, work_dir
from . import boosting
from .boosting import DEFAULT_TREES, SEED
from .evaluate import best_f1_threshold, metric_bundle, ranking
from .ranking import top_features
from .trees import TreeModel, score_trees

# The published search space, (low, high, kind).
SEARCH_SPACE = {
    "n_estimators": (100, 600, "int"),
    "max_depth": (3, 9, "int"),
    "learning_rate": (0.01, 0.3, "log"),
    "subsample": (0.6, 1.0, "float"),
    "colsample_bytree": (0.6, 1.0, "float"),
    "min_child_weight": (1, 10, "int"),
    "gamma": (0.0, 5.0, "float"),
    "reg_alpha": (0.0, 5.0, "float"),
    "reg_lambda": (0.0, 5.0, "float"),
}
# The same size of ensemble for Spark's own boosted trees, which fit all rows of a table.
ML_TREES = {
    "maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
}


def column_moments(train: DataFrame, features: list[str] = FEATURE_COLS) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature: one pass, two numbers per feature."""
    row = train.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in features],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in features],
    ).first()
    return {c: (row[f"{c}_mean"] or 0.0, row[f"{c}_std"] or 1.0) for c in features}


def standardize_sql(moments: dict[str, tuple[float, float]]) -> str:
    """Statement adding ``z_<feature>``; a missing value becomes the mean."""
    scaled = [
        f"coalesce((`{c}` - {mean!r}D) / {std!r}D, 0D) AS `z_{c}`" for c, (mean, std) in moments.items()
    ]
    return f"SELECT *, {', '.join(scaled)} FROM __THIS__"


def standardize(df: DataFrame, train: DataFrame, features: list[str] = FEATURE_COLS) -> DataFrame:
    """``df`` with z-scores by the mean and population deviation of ``train``; constants are only centred."""
    statement = standardize_sql(column_moments(train, features))
    return SQLTransformer(statement=statement).transform(df)


def label_counts(df: DataFrame, label: str = "label") -> tuple[int, int]:
    """(negative, positive) rows; a table without one of the classes is an error."""
    row = df.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("int")).alias("p")).first()
    positive = row["p"] or 0
    if not 0 < positive < row["n"]:
        raise ValueError(f"both classes are needed: {positive} of {row['n']} rows are positive")
    return row["n"] - positive, positive


def scale_pos_weight(df: DataFrame, label: str = "label") -> float:
    """Negatives per positive, to two digits."""
    negative, positive = label_counts(df, label)
    return round(negative / positive, 2)


def train_logreg(train: DataFrame, label: str = "label", c: float = 1.0, max_iter: int = 1000,
                 features: list[str] = FEATURE_COLS) -> PipelineModel:
    """Scaled logistic regression, L2 of strength 1/C, classes weighted to equal totals."""
    negative, positive = label_counts(train, label)
    total = negative + positive
    scaler = SQLTransformer(statement=standardize_sql(column_moments(train, features)))
    vector = VectorAssembler(inputCols=[f"z_{f}" for f in features], outputCol="features")
    weighted = train.withColumn(
        "_weight",
        F.when(F.col(label) == 1, total / (2.0 * positive)).otherwise(total / (2.0 * negative)),
    )
    ready = vector.transform(scaler.transform(weighted)).select("features", label, "_weight")
    model = LogisticRegression(
        labelCol=label, weightCol="_weight", maxIter=max_iter, regParam=1.0 / (c * total),
        elasticNetParam=0.0, standardization=False, threshold=0.5,
    ).fit(ready)
    # The training summary holds the session, which cannot be sent to tasks once a table was observed in it.
    model._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
    return PipelineModel([scaler, vector, model])


def _tree_stages(features: list[str]):
    # Trees split a missing value off as -1: all features are zero or more.
    filled = ", ".join(f"coalesce(cast(`{f}` AS double), -1D) AS `t_{f}`" for f in features)
    fill = SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")
    return fill, VectorAssembler(inputCols=[f"t_{f}" for f in features], outputCol="features")


def _tree_input(train: DataFrame, label: str, features: list[str]) -> DataFrame:
    fill, vector = _tree_stages(features)
    weight = F.when(F.col(label) == 1, F.lit(scale_pos_weight(train, label))).otherwise(1.0)
    ready = vector.transform(fill.transform(train)).withColumn("_weight", weight)
    return ready.select("features", F.col(label).cast("double").alias("_label"), "_weight")


def _estimator(spark: SparkSession, params: dict) -> GBTClassifier:
    # Boosting grows the lineage by a stage per tree: cut it in the shared folder.
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(work_dir(spark, "boosting"))
    return GBTClassifier(
        labelCol="_label", weightCol="_weight", seed=SEED, checkpointInterval=10,
        **(ML_TREES | params),
    )


def train_ml_gbt(train: DataFrame, label: str = "label", params: dict | None = None,
                 features: list[str] = FEATURE_COLS) -> PipelineModel:
    """Spark's boosted trees over all rows, positives weighted by the class ratio: some jobs for each level."""
    ready = _tree_input(train, label, features)
    model = _estimator(train.sparkSession, params or {}).fit(ready)
    return PipelineModel([*_tree_stages(features), model])


def train_gbt(train: DataFrame, label: str = "label", params: dict | None = None,
              features: list[str] = FEATURE_COLS) -> TreeModel:
    """Boosted trees of the published size (300 of depth 6) over all rows, positives weighted by the class ratio."""
    return boosting.train_gbt(train, scale_pos_weight(train, label), label, params, features)


def score_model(model: PipelineModel | TreeModel, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of the positive class, whichever kind of model it is."""
    if isinstance(model, TreeModel):
        return score_trees(df, model).withColumnRenamed("hype_score", out)
    return score_spark_model(model, df, out)


def score_spark_model(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of the positive class by a fitted Spark ML pipeline."""
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


def feature_importance(model: PipelineModel | TreeModel, features: list[str] = FEATURE_COLS) -> dict[str, float]:
    """Shares of the features in what the splits gained."""
    if isinstance(model, TreeModel):
        return boosting.importance(model)
    values = model.stages[-1].featureImportances.toArray()
    return {f: float(v) for f, v in zip(features, values)}


def top_model_features(spark: SparkSession, model: PipelineModel | TreeModel, k: int = 5) -> DataFrame:
    return top_features(spark, feature_importance(model), k)


def draw_params(trials: int, space: dict = SEARCH_SPACE, seed: int = SEED) -> list[dict]:
    """Random settings, the same for the same seed."""
    random = np.random.RandomState(seed)

    def draw(low, high, kind):
        if kind == "int":
            return int(random.randint(low, high + 1))
        if kind == "log":
            return float(np.exp(random.uniform(np.log(low), np.log(high))))
        return float(random.uniform(low, high))

    return [{name: draw(*bounds) for name, bounds in space.items()} for _ in range(trials)]


def trial_name(number: int) -> str:
    return f"trial-{number:03d}"


def param_sweep(train: DataFrame, val: DataFrame, trials: int = 50, label: str = "label",
                space: dict = SEARCH_SPACE, seed: int = SEED, features: list[str] = FEATURE_COLS) -> tuple[list[dict], DataFrame]:
    """Fit one model per drawn setting on all rows of ``train`` and score it on ``val``.

    Returns the settings and the run table ``(run_id, kind, key, value)``, one run per trial; its rows
    of kind ``objective`` hold the compared metric in full, those of kind ``metric`` four digits.
    Fits are tasks side by side, and those that differ in the number of trees alone are one. ``val`` is
    read once: every row walks all trees, and all trials are ranked together by the metrics' ``by``.
    """
    spark = train.sparkSession
    settings = draw_params(trials, space, seed)
    weight = scale_pos_weight(train, label)
    fits, uses = boosting.shared_fits([boosting.DEFAULT_TREES | s for s in settings])
    trees = store(boosting.fit_table(train, label, features, weight, fits, seed), "trees")
    models = boosting.collected(trees, features)
    scored = boosting.score_ensembles(val.select(label, *features), models, uses)
    ranked = ranking(scored, "score", label, ("model",))
    measured = metric_bundle(ranked, "val", exact=True, by=("model",))

    def run(kind: str, key: str, value):
        return F.struct(F.format_string("trial-%03d", "model").alias("run_id"), F.lit(kind).alias("kind"),
                        F.lit(key).alias("key"), value.cast("string").alias("value"))

    results = measured.select(F.inline(F.array(
        run("metric", "val_roc_auc", round4(F.col("val_roc_auc"))),
        run("metric", "val_pr_auc", round4(F.col("val_pr_auc"))),
        run("objective", "val_pr_auc", F.col("val_pr_auc")))))
    drawn = [(trial_name(n), "param", k, str(v)) for n, s in enumerate(settings)
             for k, v in (s | {"scale_pos_weight": weight}).items()]
    drawn += [(trial_name(n), "tag", "trial_number", str(n)) for n in range(trials)]
    return settings, spark.createDataFrame(drawn, RUN_LOG).unionByName(store(results, "trials"))


def refit_and_test(split: DataFrame, params: dict, label: str = "label",
                   features: list[str] = FEATURE_COLS) -> tuple[TreeModel, dict]:
    """Threshold from a model fit on train only, then refit on train and val, measured on test."""
    train, val, test = (split.filter(F.col("split") == s) for s in ("train", "val", "test"))
    probe = train_gbt(train, label, params, features)
    threshold = best_f1_threshold(
        ranking(score_model(probe, val), "score", label)
    ).first()["threshold"]
    model = train_gbt(train.unionByName(val), label, params, features)
    ranked = ranking(score_model(model, test), "score", label)
    metrics = metric_bundle(ranked, "test", threshold).first().asDict()
    return model, metrics | {"optimal_threshold": threshold}

"""Scoring with a tree ensemble stored as JSON."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..constants import DEFAULT_THRESHOLD, FEATURE_COLS
from ..functions.features import feature_columns
from ..functions.scores import hype_tier, logit, sigmoid



@dataclass
class TreeModel:
    """Trees as parallel node lists; a left child of -1 marks a leaf."""

    trees: list[dict]
    base_score: float = 0.5
    threshold: float = DEFAULT_THRESHOLD
    feature_cols: list[str] = field(default_factory=lambda: list(FEATURE_COLS))
    version: str = ""
    # A model is one file read on the driver and sent to every executor.
    max_nodes: int = 5_000_000

    def __post_init__(self):
        if self.nodes > self.max_nodes:
            raise ValueError(f"model of {self.nodes} nodes is too large to send to every executor")

    @property
    def nodes(self) -> int:
        return sum(len(t["left_children"]) for t in self.trees)


def read_tree_model(spark: SparkSession, path: str) -> TreeModel:
    """Model and metadata JSON of a directory. The base score is text, possibly in brackets."""
    read = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    learner = read.schema(schemas.TREE_MODEL).json(f"{path}/xgb_model.json").first()["learner"]
    meta = read.schema(schemas.MODEL_META).json(f"{path}/model_meta.json").first()
    base = (learner["learner_model_param"]["base_score"] or "").strip("[] \t")
    if not base:
        raise ValueError("the model has no base_score")
    trees = learner["gradient_booster"]["model"]["trees"]
    return TreeModel(
        [t.asDict() for t in trees], float(base), meta["threshold"], meta["feature_cols"],
        meta["version"],
    )


def _as_expression(model: TreeModel, features: list[Column]) -> Column:
    def value(number: float) -> Column:
        return F.lit(float(np.float32(number)))

    def node(tree: dict, i: int) -> Column:
        left, right = tree["left_children"][i], tree["right_children"][i]
        if left == -1:
            return value(tree["base_weights"][i])
        feature = tree["split_indices"][i]
        if feature >= len(features):
            return node(tree, right)
        below = features[feature].cast("double") < value(tree["split_conditions"][i])
        return F.when(below, node(tree, left)).otherwise(node(tree, right))

    margin = F.lit(float(np.log(model.base_score / (1 - model.base_score))))
    for tree in model.trees:
        margin = margin + node(tree, 0)
    return margin


def flat_trees(model: TreeModel, features: int) -> dict:
    """All trees as flat arrays, what ``leaf_weights`` walks; a model is checked to be small enough to send."""

    def flat(name: str, kind) -> np.ndarray:
        return np.concatenate([np.asarray(t[name], dtype=kind) for t in model.trees])

    sizes = [len(t["left_children"]) for t in model.trees]
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int32)
    offset = np.repeat(roots, sizes)
    left, right = flat("left_children", np.int32), flat("right_children", np.int32)
    leaf = left == -1
    own = np.arange(len(left), dtype=np.int32)
    left, right = np.where(leaf, own, left + offset), np.where(leaf, own, right + offset)
    levels, reached = 0, roots[~leaf[roots]]
    while len(reached):
        reached = np.concatenate([left[reached], right[reached]])
        reached = reached[~leaf[reached]]
        levels += 1
    return {
        "roots": roots, "levels": levels, "width": features + 1,
        # Place 2n holds where node n goes when the feature is not below the split, 2n+1 when it is.
        "next": np.stack([right, left], axis=1).ravel().astype(np.int32),
        # Features the row does not have read the NaN column behind the last one.
        "feature": np.minimum(flat("split_indices", np.int32), features),
        "split": flat("split_conditions", np.float32).astype(np.float64),
        "weight": flat("base_weights", np.float32).astype(np.float64),
        "base": float(np.log(model.base_score / (1 - model.base_score))),
    }


def leaf_weights(m: dict, columns, block: int = 128):
    """Leaf weights (rows by trees) of blocks of rows: a level at a time, blocks small enough to stay in cache."""
    rows = len(columns[0])
    x = np.full((rows, m["width"]), np.nan)
    for i, column in enumerate(columns):
        x[:, i] = column.to_numpy(dtype=np.float64, na_value=np.nan)
    for start in range(0, rows, block):
        part = x[start : start + block].ravel()
        first = np.arange(0, len(part), m["width"], dtype=np.int32)[:, None]
        at = np.broadcast_to(m["roots"], (len(first), len(m["roots"])))
        for _ in range(m["levels"]):
            below = part.take(first + m["feature"].take(at)) < m["split"].take(at)
            at = m["next"].take(2 * at + below)
        yield m["weight"].take(at)


def _as_batches(model: TreeModel, features: list[Column], spark: SparkSession) -> Column:
    shared = spark.sparkContext.broadcast(flat_trees(model, len(features)))

    @F.pandas_udf(T.DoubleType())
    def margin(*columns: pd.Series) -> pd.Series:
        out = [np.zeros(0)]
        for weights in leaf_weights(shared.value, columns):
            total = np.full(len(weights), shared.value["base"])
            # Tree by tree, so that the sum is the one of a row-wise scorer.
            for tree in range(weights.shape[1]):
                total += weights[:, tree]
            out.append(total)
        return pd.Series(np.concatenate(out))

    return margin(*[f.cast("double") for f in features])


def tree_score(model: TreeModel, features: list[Column], spark: SparkSession,
               native: bool = False) -> Column:
    """Probability from the summed leaf weights.

    A row goes left where its feature is below the split; a missing, NaN or unknown feature goes
    right. Trees are walked in batches, at a cost that does not depend on their number of nodes for
    the planner; with ``native`` they become one expression in generated code, which suits a few
    hundred nodes.
    """
    if not model.trees:
        return sigmoid(logit(F.lit(model.base_score)))
    if native:
        return sigmoid(_as_expression(model, features))
    return sigmoid(_as_batches(model, features, spark))


def score_trees(df: DataFrame, model: TreeModel, native: bool = False) -> DataFrame:
    """Add ``hype_score`` to a feature matrix."""
    features = [F.col(c) for c in model.feature_cols]
    return df.withColumn("hype_score", tree_score(model, features, df.sparkSession, native))


def score_papers(papers: DataFrame, model: TreeModel, text_unit: str = "chars",
                 native: bool = False) -> DataFrame:
    """Papers with ``hype_score`` and ``hype_tier``; the features exist only inside the expression."""
    by_name = dict(zip(FEATURE_COLS, feature_columns(papers, text_unit)))
    features = [by_name[c] for c in model.feature_cols]
    scored = papers.withColumn("hype_score", tree_score(model, features, papers.sparkSession, native))
    return scored.withColumn("hype_tier", hype_tier(F.col("hype_score"), model.threshold))

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlens.operators.trees import TreeModel, read_tree_model, tree_score

LEAF = {
    "left_children": [-1], "right_children": [-1], "split_indices": [0], "split_conditions": [0.0],
    "base_weights": [-0.375],
}
# A root on the first feature at -2, and on its right side a second split at 11.
SPLIT = {
    "left_children": [1, -1, 3, -1, -1], "right_children": [2, -1, 4, -1, -1], "split_indices": [0, 0, 0, 0, 0],
    "split_conditions": [-2.0, 0.0, 11.0, 0.0, 0.0], "base_weights": [0.0, 1.25, 0.0, -0.7, 0.05],
}


def margin(p):
    return math.log(p / (1 - p))


def score(spark, model, value, native):
    df = spark.createDataFrame([(value, 1.0)], "a double, b double")
    return df.select(tree_score(model, [F.col("a"), F.col("b")], spark, native)).first()[0]


@pytest.mark.parametrize("native", [True, False])
@pytest.mark.parametrize("tree, value, weight", [
    (LEAF, 1.0, -0.375), (SPLIT, -2.5, 1.25), (SPLIT, -2.0, -0.7), (SPLIT, 10.9, -0.7), (SPLIT, 11.0, 0.05), (SPLIT, None, 0.05),
    (SPLIT, float("nan"), 0.05), (SPLIT | {"split_indices": [9, 0, 0, 0, 0]}, -9.0, -0.7),
])
def test_walk(spark, native, tree, value, weight):
    found = score(spark, TreeModel([tree]), value, native)
    assert margin(found) == pytest.approx(float(np.float32(weight)), abs=1e-12)


def test_empty_ensemble(spark):
    assert score(spark, TreeModel([]), 1.0, False) == 0.5
    assert score(spark, TreeModel([], base_score=0.3), 1.0, False) == pytest.approx(0.3)


def random_tree(rng, features, depth):
    tree = {k: [] for k in ("left_children", "right_children", "split_indices", "split_conditions", "base_weights")}

    def node(level):
        i = len(tree["left_children"])
        for name, value in [("left_children", -1), ("right_children", -1), ("split_indices", int(rng.integers(features))),
                            ("split_conditions", float(rng.normal())), ("base_weights", float(rng.normal()))]:
            tree[name].append(value)
        if level < depth and rng.random() < 0.8:
            tree["left_children"][i] = node(level + 1)
            tree["right_children"][i] = node(level + 1)
        return i

    node(0)
    return tree


def walk(tree, row):
    i = 0
    while tree["left_children"][i] != -1:
        below = row[tree["split_indices"][i]] < float(np.float32(tree["split_conditions"][i]))
        i = tree["left_children"][i] if below else tree["right_children"][i]
    return float(np.float32(tree["base_weights"][i]))


def test_both_ways_equal_a_plain_walk(spark):
    rng = np.random.default_rng(3)
    model = TreeModel([random_tree(rng, 4, 5) for _ in range(12)], base_score=0.2)
    rows = [tuple(float(v) if rng.random() > 0.1 else float("nan") for v in r) for r in rng.normal(size=(200, 4))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    features = [F.col(c) for c in "abcd"]
    found = df.select(
        "*", tree_score(model, features, spark, True).alias("n"), tree_score(model, features, spark, False).alias("p")
    ).collect()
    for r in found:
        m = margin(0.2) + sum(walk(t, r[:4]) for t in model.trees)
        assert r["n"] == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-12)
        assert r["p"] == pytest.approx(r["n"], abs=1e-12)


def write_model(path, base):
    learner = {"learner_model_param": {"base_score": base}, "gradient_booster": {"model": {"trees": [SPLIT]}}}
    (path / "xgb_model.json").write_text(json.dumps({"learner": learner}, indent=1))
    meta = {"model_name": "m", "alias": "champion", "version": "6", "run_id": "r", "feature_cols": ["a", "b"],
            "num_features": 2, "threshold": 0.8837, "feature_version": "v1"}
    (path / "model_meta.json").write_text(json.dumps(meta, indent=2))


@pytest.mark.parametrize("base", ["3E-1", "[3E-1]", " [0.3]\t"])
def test_read(spark, tmp_path, base):
    write_model(tmp_path, base)
    model = read_tree_model(spark, str(tmp_path))
    assert (model.base_score, model.threshold, model.feature_cols, model.version) == (0.3, 0.8837, ["a", "b"], "6")
    assert margin(score(spark, model, -3.0, False)) == pytest.approx(margin(0.3) + float(np.float32(1.25)))


@pytest.mark.parametrize("base", ["", "[]"])
def test_read_without_base_score(spark, tmp_path, base):
    write_model(tmp_path, base)
    with pytest.raises(ValueError, match="base_score"):
        read_tree_model(spark, str(tmp_path))

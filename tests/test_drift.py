import math
import random

import pytest
from pyspark.sql import functions as F

from paperlens.functions import pvalues
from paperlens.operators import drift as ops
from paperlens.operators.quality import dataset_summary, quality_summary


def tail_p_value(spark, d, m, n):
    df = spark.createDataFrame([(d, m, n)], "d double, m long, n long")
    return df.select(pvalues.ks_p_value(F.col("d"), F.col("m"), F.col("n"))).first()[0]


@pytest.mark.parametrize("m, n", [(5, 5), (30, 1700), (20_000, 20_000)])
@pytest.mark.parametrize("d", [0.0, 0.01, 0.3, 1.0])
def test_ks_series(spark, m, n, d):
    x = d * math.sqrt(m * n / (m + n))
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 2001))
    expected = 1.0 if x < 0.2 else min(1.0, max(0.0, series))
    assert tail_p_value(spark, d, m, n) == pytest.approx(expected, abs=1e-9)


def test_ks_does_not_jump_with_the_size(spark):
    near = [tail_p_value(spark, 0.3, 30, n) for n in (9_999, 10_000, 10_001)]
    assert max(near) - min(near) < 1e-5
    assert tail_p_value(spark, 0.3, 0, 5) is None


@pytest.mark.parametrize("dof", [2, 3, 4])
def test_chi2_tail(spark, dof):
    """Against the integral of the density."""
    x = 3.7
    norm = 2 ** (dof / 2) * math.gamma(dof / 2)
    steps = 400_000
    width = 60 / steps
    tail = sum(
        (t ** (dof / 2 - 1)) * math.exp(-t / 2) for t in (x + (i + 0.5) * width for i in range(steps))
    ) * width / norm
    df = spark.createDataFrame([(x, dof)], "x double, d int")
    assert df.select(pvalues.chi2_p_value(F.col("x"), F.col("d"))).first()[0] == pytest.approx(tail, abs=1e-6)


def test_z_tail(spark):
    df = spark.createDataFrame([(1.959963985,), (-1.959963985,), (0.0,)], "z double")
    found = [r[0] for r in df.select(pvalues.z_p_value(F.col("z"))).collect()]
    assert found == pytest.approx([0.05, 0.05, 1.0], abs=1e-7)


def samples():
    rng = random.Random(5)
    ref = [(rng.gauss(0, 3), rng.randrange(4), int(rng.random() < 0.3), 1) for _ in range(400)]
    cur = [(rng.gauss(0.4, 3), rng.choice([0, 0, 1, 2, 3]), int(rng.random() < 0.5), 1) for _ in range(300)]
    return ref, cur


def tables(spark):
    names = "a double, b int, c int, d int"
    ref, cur = samples()
    return spark.createDataFrame(ref, names), spark.createDataFrame(cur, names)


def cdf(values, x):
    return sum(v <= x for v in values) / len(values)


def test_statistics_against_brute_force(spark):
    ref, cur = samples()
    found = {r["feature"]: r for r in ops.drift_statistics(*tables(spark), list("abcd")).collect()}
    for i, name in enumerate("abcd"):
        x, y = [r[i] for r in ref], [r[i] for r in cur]
        points = sorted(set(x) | set(y))
        gaps = [abs(cdf(x, p) - cdf(y, p)) for p in points]
        mean = sum(x) / len(x)
        std = math.sqrt(sum((v - mean) ** 2 for v in x) / len(x))
        moved = sum(g * (points[k + 1] - points[k]) for k, g in enumerate(gaps[:-1]))
        assert found[name]["ks"] == pytest.approx(max(gaps), abs=1e-12)
        assert found[name]["wasserstein"] == pytest.approx(moved / max(std, 0.001), abs=1e-9)
        p, q = ([v.count(t) / len(v) for t in points] for v in (x, y))
        js = sum(
            (a * math.log(2 * a / (a + b)) if a else 0) + (b * math.log(2 * b / (a + b)) if b else 0)
            for a, b in zip(p, q)
        ) / 2
        assert found[name]["js"] == pytest.approx(math.sqrt(max(js, 0)), abs=1e-9)
        if name == "b":
            expected = [x.count(t) * len(y) / len(x) for t in points]
            chi2 = sum((y.count(t) - e) ** 2 / e for t, e in zip(points, expected))
            assert found[name]["chi2"] == pytest.approx(chi2, abs=1e-9)
        if name == "c":
            p1, p2 = sum(x) / len(x), sum(y) / len(y)
            pool = (sum(x) + sum(y)) / (len(x) + len(y))
            z = (p1 - p2) / math.sqrt(pool * (1 - pool) * (1 / len(x) + 1 / len(y)))
            assert found[name]["z"] == pytest.approx(z, abs=1e-9)


def test_methods_and_verdicts(spark):
    ref, cur = tables(spark)
    small = {r["feature"]: r for r in ops.feature_drift(ref, cur, "p_value", list("abcd")).collect()}
    assert [small[f]["method"] for f in "abcd"] == ["ks", "chi2", "z", "z"]
    assert small["c"]["detected"] and not small["d"]["detected"] and small["d"]["score"] == 1.0
    large = {r["feature"]: r for r in ops.feature_drift(ref, cur, "distance", list("abcd")).collect()}
    assert [large[f]["method"] for f in "abcd"] == ["wasserstein", "js", "js", "js"]
    assert large["d"]["score"] == 0.0
    many = ref.crossJoin(spark.range(3)).drop("id")
    assert ops.feature_drift(many, cur, "p_value", ["a"]).first()["method"] == "ks"
    with pytest.raises(ValueError):
        ops.feature_drift(ref, cur, "either")


def test_values_missing_on_one_side(spark):
    names = "b int"
    ref = spark.createDataFrame([(i % 3,) for i in range(90)], names)
    cur = spark.createDataFrame([(i % 3 + 1,) for i in range(90)], names)
    row = ops.feature_drift(ref, cur, "p_value", ["b"]).first()
    assert (row["method"], row["score"], row["detected"]) == ("chi2", 0.0, True)


def test_nulls_and_infinities_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    ref = spark.createDataFrame([(1.0,), (nan,), (inf,), (None,)], "a double")
    cur = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    row = ops.drift_statistics(ref, cur, ["a"]).first()
    assert (row["n_ref"], row["n_cur"], row["distinct_values"]) == (1, 2, 2)


def test_dataset_drift_reports_the_true_share(spark):
    rows = [("a", True), ("b", False), ("c", False), ("d", True)]
    df = spark.createDataFrame(rows, "feature string, detected boolean")
    assert tuple(ops.dataset_drift(df).first()) == (4, 0.5, True)
    assert tuple(ops.dataset_drift(df.filter("not detected")).first()) == (2, 0.0, False)


def test_metric_rows(spark):
    drift = spark.createDataFrame([("a", 0.3, True), ("b", None, None)], "feature string, score double, detected boolean")
    size = spark.createDataFrame([(40,)], "papers long")
    mean = spark.createDataFrame([(0.25,)], "mean_score double")
    rows = ops.drift_metrics(drift, size, "2024-01-01 00:00:00", mean).collect()
    found = {(r["name"], r["labels"].get("feature")): r["value"] for r in rows}
    assert found == {
        ("current_papers_count", None): 40.0, ("drift_share", None): 0.5, ("drift_detected", None): 1.0,
        ("feature_drift_score", "a"): 0.3, ("feature_drift_score", "b"): 0.0, ("mean_hype_score", None): 0.25,
    }


def test_profile(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (2, None), (10, 7)], "a int, b int")
    rows = {r["feature"]: r.asDict() for r in quality_summary(df, ["a", "b"]).collect()}
    a = rows["a"]
    assert (a["count"], a["nulls"], a["distinct_values"], a["min"], a["max"], a["most_common"]) == (4, 0, 3, 1.0, 10.0, 2.0)
    assert (a["mean"], a["p25"], a["p50"], a["p75"]) == (3.75, 1.75, 2.0, 4.0)
    assert a["std"] == pytest.approx(4.193248541803041)
    assert (rows["b"]["nulls"], rows["b"]["most_common"]) == (1, 5.0)
    assert tuple(dataset_summary(df, ["a", "b"]).first()) == (4, 2, 1)

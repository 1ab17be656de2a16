import random

import pytest
from pyspark.sql import functions as F

from paperlens.operators import evaluate as ops
from paperlens.operators.aggregates import class_balance, scale_pos_weight
from paperlens.operators.cumulative import running_sums, store_ranges


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "score double, label int")


def brute_ap(pairs):
    total = sum(y for _, y in pairs)
    found = previous = 0.0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        hit = [y for s, y in pairs if s >= t]
        recall = sum(hit) / total
        found += (recall - previous) * sum(hit) / len(hit)
        previous = recall
    return found


def brute_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_threshold(pairs):
    total = sum(y for _, y in pairs)
    best = (-1.0, 0.0)
    for t in sorted({s for s, _ in pairs}):
        hit = [y for s, y in pairs if s >= t]
        p, r = sum(hit) / len(hit), sum(hit) / total
        best = max(best, (2 * p * r / (p + r + 1e-9), -t))
    return round(-best[1], 4)


@pytest.mark.parametrize("distinct", [3, 40, 100_000])
def test_against_brute_force(spark, distinct):
    rng = random.Random(distinct)
    pairs = [(rng.randrange(distinct) / distinct, int(rng.random() < 0.2)) for _ in range(400)]
    ranked = ops.ranking(scored(spark, pairs).repartition(5))
    assert ops.average_precision(ranked).first()[0] == pytest.approx(brute_ap(pairs), abs=1e-12)
    assert ops.roc_auc(ranked).first()[0] == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert ops.best_f1_threshold(ranked).first()[0] == brute_threshold(pairs)
    curve = {r["threshold"]: r["precision"] for r in ops.pr_curve(ranked).collect()}
    assert len(curve) == len({s for s, _ in pairs})
    lowest = min(curve)
    assert curve[lowest] == pytest.approx(sum(y for _, y in pairs) / len(pairs))


def test_many_ranges_give_the_same_sums(spark):
    """Ranges are an arrangement of the work: the sums do not depend on them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [("a", float(v), v % 7 + 1) for v in range(500)] + [("b", float(v), 2) for v in range(9)]
        groups = spark.createDataFrame(rows, "g string, v double, n long")
        stored = store_ranges(groups, "v", ("g",))
        assert stored.select("_range").distinct().count() > 3
        found = {
            (r["g"], r["v"]): (r["cum_n"], r["all_n"], r["next_value"])
            for r in running_sums(stored, "v", ["n"], ("g",)).collect()
        }
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for g in "ab":
        own = sorted((v, n) for h, v, n in rows if h == g)
        total = 0
        for i, (v, n) in enumerate(own):
            total += n
            following = own[i + 1][0] if i + 1 < len(own) else None
            assert found[g, v] == (total, sum(n for _, n in own), following)


def test_perfect_score(spark):
    ranked = ops.ranking(scored(spark, [(0.9, 1)] * 10 + [(0.1, 0)] * 90))
    row = ops.metric_bundle(ranked, "val").first().asDict()
    assert row == {"val_roc_auc": 1.0, "val_pr_auc": 1.0, "val_f1": 1.0}


def test_constant_score_below_threshold(spark):
    counts = ops.score_counts(scored(spark, [(0.7, 1)] * 10 + [(0.7, 0)] * 90))
    assert ops.f1_at_threshold(counts, 0.8).first()[0] == 0.0
    report = {r["class"]: r for r in ops.classification_report(counts, 0.8).collect()}
    assert report["hype"]["precision"] == 0.0 and report["hype"]["support"] == 10
    assert report["accuracy"]["f1"] == pytest.approx(0.9)


def test_threshold_is_rounded_and_stable(spark):
    labels = [1, 0, 1, 0, 0, 1, 0, 0, 0, 0]
    df = scored(spark, [(0.8 if i % 2 == 0 else 0.2, y) for i, y in enumerate(labels)])
    first, second = (ops.best_f1_threshold(ops.ranking(df)).first()[0] for _ in range(2))
    assert first == second and 0 <= first <= 1 and round(first, 4) == first


def test_metrics_are_rounded(spark):
    ranked = ops.ranking(scored(spark, [(i / 7 % 1, int(i % 3 == 0)) for i in range(50)]))
    for value in ops.metric_bundle(ranked, "test", 0.3).first():
        assert round(value, 4) == value


def test_lift(spark):
    row = ops.lift_over_base(ops.ranking(scored(spark, [(0.9, 1), (0.1, 0), (0.1, 0), (0.1, 0)]))).first()
    assert (row["average_precision"], row["base_rate"], row["lift"]) == (1.0, 0.25, 4.0)


def test_null_scores_and_labels_are_left_out(spark):
    df = scored(spark, [(0.9, 1), (None, 1), (0.5, None), (0.2, 0)])
    assert ops.score_counts(df).agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == 2


def test_one_class_and_no_rows(spark):
    negatives = ops.ranking(scored(spark, [(0.9, 0), (0.1, 0)]))
    assert ops.roc_auc(negatives).first()[0] is None
    assert ops.average_precision(negatives).first()[0] == 0.0
    assert ops.best_f1_threshold(negatives).first()[0] == 0.1
    assert {r["recall"] for r in ops.pr_curve(negatives).collect()} == {1.0}
    empty = ops.ranking(scored(spark, []))
    assert ops.pr_curve(empty).count() == 0
    assert tuple(ops.metric_bundle(empty, "val").first()) == (None, 0.0, 0.0)
    assert class_balance(spark.createDataFrame([], "label int")).first()["positive_pct"] is None
    assert scale_pos_weight(spark.createDataFrame([(0,)], "label int")).first()[0] is None

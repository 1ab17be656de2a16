"""Splits and ranking metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ops
from ..operators.split import reference_sample as sample
from ..operators.split import stratified_split as split_rows
from ..operators.split import train_plus_val as join_splits
from . import check
from .bindings import P, R, papers, rounded, scored_labels, table

QUOTAS = """counts AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality),
t AS (SELECT *, sum(n) OVER () AS total FROM counts),
t1 AS (SELECT *, cast(ceil(cast(0.2 AS DOUBLE) * total) AS BIGINT) AS test FROM t),
t2 AS (SELECT *, n * cast(total - test AS DOUBLE) / total AS exact FROM t1),
t3 AS (SELECT *, floor(exact) + cast(row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
    <= total - test - sum(floor(exact)) OVER () AS INT) AS train FROM t2),
t4 AS (SELECT *, n - train AS rest, test - cast(ceil(test * 0.5) AS BIGINT) AS val_total FROM t3),
t5 AS (SELECT *, rest * cast(val_total AS DOUBLE) / sum(rest) OVER () AS exact2 FROM t4),
t6 AS (SELECT *, floor(exact2) + cast(row_number() OVER (ORDER BY exact2 - floor(exact2) DESC, label)
    <= val_total - sum(floor(exact2)) OVER () AS INT) AS val FROM t5),
quotas AS (SELECT label, 'train' AS split, cast(train AS BIGINT) AS n FROM t6
  UNION ALL SELECT label, 'val', cast(val AS BIGINT) FROM t6
  UNION ALL SELECT label, 'test', cast(rest - val AS BIGINT) FROM t6)"""


def label_split(spark, sf):
    return split_rows(table(spark, sf, "labels").withColumnRenamed("quality", "label"), "label", "doc_id")


@check(f"WITH {QUOTAS} SELECT label, split, n FROM quotas")
def stratified_split(spark, sf):
    return label_split(spark, sf).groupBy("label", "split").agg(F.count("*").alias("n"))


@check(f"""
WITH {QUOTAS} SELECT label, cast(sum(n) AS BIGINT) AS n FROM quotas WHERE split <> 'test' GROUP BY label
""")
def train_plus_val(spark, sf):
    return join_splits(label_split(spark, sf)).groupBy("label").agg(F.count("*").alias("n"))


@check(P + """,
e AS (SELECT hype_label, count(*) AS n FROM papers WHERE max_h_index > 0 GROUP BY hype_label),
q AS (SELECT hype_label, round_even(least(100, sum(n) OVER ()) / sum(n) OVER () * n, 0) AS n FROM e)
SELECT hype_label, cast(n AS BIGINT) AS n FROM q WHERE hype_label IS NOT NULL
""".lstrip(" "))
def reference_sample(spark, sf):
    rows = papers(spark, sf)
    drawn = sample(rows, 100).select("arxiv_id")
    return rows.join(drawn, "arxiv_id", "left_semi").groupBy("hype_label").agg(F.count("*").alias("n"))


def ranked(spark, sf):
    return ops.ranking(scored_labels(spark, sf))


AUC = "1 - sum(pos * (fp - neg / 2)) / (sum(pos) * sum(neg))"
AP = "sum(pos * tp / (tp + fp)) / sum(pos)"


def f1(t):
    return f"2 * sum(pos) FILTER (score >= {t}) / (sum(pos + neg) FILTER (score >= {t}) + sum(pos))"


@check(R + f"SELECT round({AUC}, 6) AS roc_auc FROM ranked")
def roc_auc(spark, sf):
    return rounded(ops.roc_auc(ranked(spark, sf)), "roc_auc")


@check(R + f"SELECT round({AP}, 6) AS average_precision FROM ranked")
def average_precision(spark, sf):
    return rounded(ops.average_precision(ranked(spark, sf)), "average_precision")


@check(R + f"SELECT round({f1(0.4)}, 6) AS f1 FROM ranked")
def f1_at_threshold(spark, sf):
    return rounded(ops.f1_at_threshold(ops.score_counts(scored_labels(spark, sf)), 0.4), "f1")


@check(R + """, c AS (SELECT score, tp / (tp + fp) AS p, tp / all_pos AS r FROM ranked),
f AS (SELECT score, 2 * p * r / (p + r + 1e-9) AS f1 FROM c)
SELECT round(min(score), 4) AS threshold FROM f WHERE f1 = (SELECT max(f1) FROM f)
""")
def best_f1_threshold(spark, sf):
    return ops.best_f1_threshold(ranked(spark, sf))


@check(R + """
SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision,
  round(tp / all_pos, 6) AS recall FROM ranked
""")
def pr_curve(spark, sf):
    return rounded(ops.pr_curve(ranked(spark, sf)), "threshold", "precision", "recall")


REPORT = """, cells AS (
  SELECT coalesce(sum(pos) FILTER (score >= 0.4), 0) AS tp, coalesce(sum(pos) FILTER (score < 0.4), 0) AS fn,
    coalesce(sum(neg) FILTER (score >= 0.4), 0) AS fp, coalesce(sum(neg) FILTER (score < 0.4), 0) AS tn
  FROM ranked),
m AS (SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0, tn + fp AS n0,
    tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fn + fp) AS f1, tp + fn AS n1,
    (tp + tn) / (tp + tn + fp + fn) AS acc FROM cells),
report AS (
  SELECT 'not-hype' AS class, p0 AS precision, r0 AS recall, f0 AS f1, n0 AS support FROM m
  UNION ALL SELECT 'hype', p1, r1, f1, n1 FROM m
  UNION ALL SELECT 'accuracy', acc, acc, acc, n0 + n1 FROM m
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM m
  UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1),
    (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM m)
"""


@check(R + REPORT.strip() + """
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  cast(support AS BIGINT) AS support FROM report
""")
def classification_report(spark, sf):
    report = ops.classification_report(ops.score_counts(scored_labels(spark, sf)), 0.4)
    return rounded(report, "precision", "recall", "f1")


@check(R + f"""
SELECT round({AUC}, 4) AS val_roc_auc, round({AP}, 4) AS val_pr_auc, round({f1(0.4)}, 4) AS val_f1 FROM ranked
""")
def metric_bundle(spark, sf):
    return ops.metric_bundle(ranked(spark, sf), "val", 0.4)


@check(R + f"""
SELECT round({AP}, 6) AS average_precision, round(sum(pos) / sum(pos + neg), 6) AS base_rate,
  round({AP} / (sum(pos) / sum(pos + neg)), 6) AS lift FROM ranked
""")
def lift_over_base(spark, sf):
    return rounded(ops.lift_over_base(ranked(spark, sf)), "average_precision", "base_rate", "lift")


GROUPED = """WITH labeled AS (
  SELECT cast(d.n_chars % (13 + 10 * m.model) AS DOUBLE) / 97 AS score, l.quality AS label, m.model
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id, (SELECT unnest(range(0, 9))::INT AS model) m),
counts AS (
  SELECT model, score, cast(sum(label) AS DOUBLE) AS pos, cast(sum(1 - label) AS DOUBLE) AS neg
  FROM labeled GROUP BY model, score),
ranked AS (
  SELECT model, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    sum(pos) OVER (PARTITION BY model) AS all_pos, sum(neg) OVER (PARTITION BY model) AS all_neg
  FROM counts WINDOW w AS (PARTITION BY model ORDER BY score DESC))
"""


def scored_models(spark, sf):
    """Nine scores of every labelled document, told apart by ``model``."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    models = F.explode(F.sequence(F.lit(0), F.lit(8)))
    rows = d.select("doc_id", "n_chars", models.alias("model"))
    score = (F.col("n_chars") % (13 + 10 * F.col("model"))).cast("double") / 97
    return rows.withColumn("score", score).join(l.select("doc_id", F.col("quality").alias("label")), "doc_id")


@check(GROUPED + """
SELECT model, round(1 - sum(pos * (fp - neg / 2)) / (max(all_pos) * max(all_neg)), 4) AS val_roc_auc,
  round(sum(pos * tp / (tp + fp)) / sum(pos), 4) AS val_pr_auc,
  round(2 * sum(CASE WHEN score >= 0.5 THEN pos ELSE 0 END)
    / (sum(CASE WHEN score >= 0.5 THEN pos + neg ELSE 0 END) + sum(pos)), 4) AS val_f1
FROM ranked GROUP BY model
""")
def metric_bundle_by_model(spark, sf):
    """The reported metrics of all models in one pass over their scores."""
    ranked = ops.ranking(scored_models(spark, sf), by=("model",))
    return ops.metric_bundle(ranked, "val", by=("model",))


@check(GROUPED + """
SELECT model, round(max_by(score, struct_pack(f := f1, s := -score)), 4) AS threshold
FROM (SELECT *, 2 * (tp / (tp + fp)) * (tp / all_pos) / (tp / (tp + fp) + tp / all_pos + 1e-9) AS f1 FROM ranked)
GROUP BY model
""")
def best_f1_threshold_by_model(spark, sf):
    """The best threshold of every model, found together."""
    ranked = ops.ranking(scored_models(spark, sf), by=("model",))
    return ops.best_f1_threshold(ranked, by=("model",))

"""Drift, quality and metric series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import FEATURE_COLS
from ..functions.features import build_features
from ..functions.pvalues import ERFC_FIT
from ..operators import drift as ops
from ..operators import quality
from . import check
from .bindings import PF, SERIES, papers, rounded, series

LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, cast({c} AS DOUBLE) AS value, cast(hype_label IS NULL AS INT) AS side FROM features"
    for c in FEATURE_COLS
) + ")"

STATS = PF.rstrip() + f""", {LONG},
v AS (SELECT feature, value, cast(count(*) FILTER (side = 0) AS DOUBLE) AS r,
    cast(count(*) FILTER (side = 1) AS DOUBLE) AS c FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
w AS (SELECT *, sum(r) OVER f AS nr, sum(c) OVER f AS nc, count(*) OVER f AS u,
    sum(r) OVER o AS cr, sum(c) OVER o AS cc, lead(value) OVER o AS nxt,
    sum(r * value) OVER f / sum(r) OVER f AS mean, min(value) OVER f AS low FROM v
  WINDOW f AS (PARTITION BY feature), o AS (PARTITION BY feature ORDER BY value)),
s AS (SELECT feature, max(nr) AS nr, max(nc) AS nc, max(u) AS u,
    sum(abs(cr / nr - cc / nc) * coalesce(nxt - value, 0)) AS moved,
    sqrt(sum(r * (value - mean) * (value - mean)) / max(nr)) AS std,
    sqrt(greatest(0, sum(
      CASE WHEN r > 0 THEN r / nr * ln((r / nr) / ((r / nr + c / nc) / 2)) ELSE 0 END
      + CASE WHEN c > 0 THEN c / nc * ln((c / nc) / ((r / nr + c / nc) / 2)) ELSE 0 END) / 2)) AS js,
    max(abs(cr / nr - cc / nc)) AS ks,
    sum(CASE WHEN r > 0 THEN (c - r * nc / nr) * (c - r * nc / nr) / (r * nc / nr) ELSE 1e300 END) AS chi2,
    1 - sum(r) FILTER (value = low) / max(nr) AS p1, 1 - sum(c) FILTER (value = low) / max(nc) AS p2
  FROM w GROUP BY feature),
z AS (SELECT *, (p1 * nr + p2 * nc) / (nr + nc) AS pool FROM s),
stats AS (SELECT *, moved / greatest(std, 0.001) AS wasserstein, CASE WHEN u = 1 THEN 0 ELSE
    (p1 - p2) / sqrt(pool * (1 - pool) * (1 / nr + 1 / nc)) END AS z FROM z),
distance AS (SELECT feature, CASE WHEN u > 5 THEN 'wasserstein' ELSE 'js' END AS method,
    CASE WHEN u > 5 THEN wasserstein ELSE js END AS score FROM stats)
"""


def halves(spark, sf):
    """The labelled papers as reference, the others as current."""
    rows = papers(spark, sf)
    return [build_features(rows.filter(side)) for side in ("has_code", "NOT has_code")]


@check(STATS + """
SELECT feature, cast(nr AS BIGINT) AS n_ref, cast(nc AS BIGINT) AS n_cur, cast(u AS BIGINT) AS distinct_values,
  round(wasserstein, 6) AS wasserstein, round(js, 6) AS js, round(ks, 6) AS ks,
  CASE WHEN u <= 5 AND chi2 < 1e299 THEN round(chi2, 6) END AS chi2, CASE WHEN u <= 2 THEN round(z, 6) END AS z
FROM stats
""")
def drift_statistics(spark, sf):
    stats = ops.drift_statistics(*halves(spark, sf))
    stats = stats.withColumns({
        "chi2": F.when((F.col("distinct_values") <= 5) & (F.col("chi2") < 1e299), F.col("chi2")),
        "z": F.when(F.col("distinct_values") <= 2, F.col("z")),
    })
    return rounded(stats, "wasserstein", "js", "ks", "chi2", "z")


@check(STATS + """
SELECT feature, method, round(score, 6) AS score, score >= 0.1 AS detected FROM distance
""")
def feature_drift(spark, sf):
    return rounded(ops.feature_drift(*halves(spark, sf), "distance"), "score")


def erfc(x: str) -> str:
    t, fit = f"(1 / (1 + {x} / 2))", str(ERFC_FIT[-1])
    for coefficient in reversed(ERFC_FIT[:-1]):
        fit = f"({fit} * {t} + {coefficient})"
    return f"({t} * exp({fit} - {x} * {x}))"


TESTS = STATS.rstrip() + f""",
x AS (SELECT *, ks * sqrt(nr / (nr + nc) * nc) AS x, sqrt(chi2 / 2) AS h, abs(z) / sqrt(2) AS a FROM stats),
tests AS (SELECT feature, CASE WHEN u > 5 THEN 'ks' WHEN u > 2 THEN 'chi2' ELSE 'z' END AS method,
  CASE WHEN u > 5 THEN CASE WHEN x < 0.2 THEN 1 ELSE least(greatest(2 * list_sum(list_transform(
      range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * k * k * x * x))), 0), 1) END
    WHEN u > 2 AND chi2 > 1e299 THEN 0 WHEN u = 3 THEN exp(-h * h)
    WHEN u = 4 THEN {erfc('h')} + sqrt(4 * h * h / pi()) * exp(-h * h)
    WHEN u = 5 THEN exp(-h * h) * (1 + h * h) WHEN z = 0 THEN 1 ELSE {erfc('a')} END AS score FROM x)
"""


@check(TESTS + "SELECT feature, method, round(score, 6) AS score, score < 0.05 AS detected FROM tests")
def feature_drift_tests(spark, sf):
    return rounded(ops.feature_drift(*halves(spark, sf), "p_value"), "score")


@check(STATS + """
SELECT count(*) AS features, round(avg(cast(score >= 0.1 AS INT)), 6) AS share,
  avg(cast(score >= 0.1 AS INT)) >= 0.5 AS detected FROM distance
""")
def dataset_drift(spark, sf):
    return rounded(ops.dataset_drift(ops.feature_drift(*halves(spark, sf), "distance")), "share")


@check(STATS + """
SELECT 'current_papers_count' AS name, '' AS feature, cast(count(*) AS DOUBLE) AS value
  FROM papers WHERE NOT has_code
UNION ALL SELECT 'drift_share', '', round(avg(cast(score >= 0.1 AS INT)), 6) FROM distance
UNION ALL SELECT 'drift_detected', '', cast(avg(cast(score >= 0.1 AS INT)) >= 0.5 AS DOUBLE) FROM distance
UNION ALL SELECT 'feature_drift_score', feature, round(score, 6) FROM distance
""")
def drift_metrics(spark, sf):
    reference, current = halves(spark, sf)
    size = current.agg(F.count("*").alias("papers"))
    rows = ops.drift_metrics(
        ops.feature_drift(reference, current, "distance"), size, "2024-02-12 00:00:00"
    )
    feature = F.coalesce(F.element_at("labels", "feature"), F.lit("")).alias("feature")
    return rounded(rows.select("name", feature, "value"), "value")


@check(PF.rstrip() + f""", {LONG},
m AS (SELECT feature, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
top AS (SELECT feature, value AS most_common FROM (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rk FROM m) x WHERE rk = 1)
SELECT l.feature, count(*) - count(value) AS nulls, count(value) AS count,
  count(DISTINCT value) AS distinct_values, min(value) AS min, max(value) AS max,
  round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.75), 6) AS p75, max(most_common) AS most_common
FROM long l JOIN top t ON l.feature = t.feature GROUP BY l.feature
""")
def quality_summary(spark, sf):
    summary = quality.quality_summary(build_features(papers(spark, sf)))
    return rounded(summary, "mean", "std", "p25", "p50", "p75")


@check(PF + """
SELECT count(*) AS rows, 27 AS columns, cast(0 AS BIGINT) AS nulls FROM features
""")
def dataset_summary(spark, sf):
    return quality.dataset_summary(build_features(papers(spark, sf)))


@check(f"""
WITH {SERIES} SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, name,
  max_by(value, ts) AS latest, round(avg(value), 6) AS mean, count(*) AS samples
FROM series GROUP BY 1, 2
""")
def trend(spark, sf):
    weekly = ops.trend(series(spark, sf), keys=("name",))
    return rounded(weekly.withColumn("week", F.date_format("week", "yyyy-MM-dd")), "mean")

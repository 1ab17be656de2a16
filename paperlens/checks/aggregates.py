"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import FEATURE_COLS
from ..functions.features import build_features
from ..operators import aggregates as ops
from ..operators.filters import official_links
from ..operators.ranking import chunk_requests as chunks
from ..operators.ranking import drift_rank as rank_drift
from ..operators.ranking import head_pending as head
from ..operators.ranking import topk_per_time as topk
from ..operators.trees import score_papers
from . import check
from .bindings import PF, PS, P, SERIES, papers, rounded, series, stamp, table, toy_model
from .filters import half_starred, links
from .joins import CATEGORY_EVENTS, LINKED, author_pairs, author_stats, category_events


@check(f"WITH {LINKED} SELECT arxiv_id, hf_github_repo FROM one")
def links_per_paper(spark, sf):
    return ops.links_per_paper(official_links(links(spark, sf)))


@check(P + """
SELECT count(*) AS total, count(*) FILTER (has_code) AS positive,
  count(*) FILTER (NOT has_code) AS negative,
  round(count(*) FILTER (has_code) / count(*), 6) AS positive_rate,
  round(1 - count(*) FILTER (has_code) / count(*), 6) AS negative_rate FROM papers
""")
def seed_summary(spark, sf):
    return rounded(ops.seed_summary(papers(spark, sf), "has_code"), "positive_rate", "negative_rate")


@check("""
SELECT count(*) AS total, cast(sum(quality) AS BIGINT) AS positive,
  cast(count(*) - sum(quality) AS BIGINT) AS negative,
  round(100.0 * sum(quality) / count(*), 6) AS positive_pct, sum(quality) / count(*) < 0.1 AS imbalanced,
  round(100 - 100.0 * sum(quality) / count(*), 6) AS negative_pct FROM labels
""")
def class_balance(spark, sf):
    return rounded(ops.class_balance(table(spark, sf, "labels"), "quality"), "positive_pct", "negative_pct")


@check("""
SELECT l_orderkey AS paper_id, cast(max(l_suppkey % 60) AS INT) AS max_h_index,
  cast(sum(coalesce(CASE WHEN l_linenumber > 2 THEN l_partkey % 300 END, 0)) AS INT) AS total_prior_papers
FROM lineitem GROUP BY l_orderkey
""")
def author_signals_agg(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("paper_id"), (F.col("l_suppkey") % 60).alias("h_index"),
        F.when(F.col("l_linenumber") > 2, F.col("l_partkey") % 300).alias("paper_count"),
    )
    return ops.author_signals_agg(pairs)


@check("""
SELECT DISTINCT cast(l_suppkey AS VARCHAR) AS author_id FROM lineitem WHERE l_linenumber > 1
""")
def distinct_authors(spark, sf):
    author = F.when(F.col("l_linenumber") > 1, F.col("l_suppkey").cast("string")).otherwise("")
    rows = table(spark, sf, "lineitem").select(F.array(author, author).alias("author_ids"))
    return ops.distinct_authors(rows)


@check(f"""
WITH {CATEGORY_EVENTS} SELECT event_id, min_by(source, rank) AS source,
  cast(min(rank) AS INT) AS category_rank FROM u GROUP BY event_id
""")
def dedup_first(spark, sf):
    return ops.dedup_first(category_events(spark, sf), "event_id", "category_rank")


@check(f"""
WITH {CATEGORY_EVENTS} SELECT event_id, max_by(source, rank) AS source,
  cast(max(rank) AS INT) AS category_rank FROM u GROUP BY event_id
""")
def dedup_last(spark, sf):
    return ops.dedup_last(category_events(spark, sf), "event_id", "category_rank")


STARRED = """starred AS (
  SELECT arxiv_id, has_code, max_h_index, total_prior_papers,
    CASE WHEN doc_id % 2 = 1 THEN github_stars_t60 END AS stars FROM papers)"""


@check(P.rstrip() + f""", {STARRED}
SELECT count(*) FILTER (has_code AND stars IS NOT NULL) AS already_labeled,
  count(*) FILTER (has_code AND stars IS NULL) AS pending, count(*) FILTER (NOT has_code) AS no_repo,
  count(stars) AS labeled, count(*) FILTER (stars > 100) AS positive,
  count(*) FILTER (stars <= 100) AS negative,
  count(*) FILTER (has_code AND stars IS NULL) AS proxy_labeled FROM starred
""")
def backfill_summary(spark, sf):
    return ops.label_backfill_summary(half_starred(spark, sf))


@check(P.rstrip() + f""", {STARRED}
SELECT count(stars) AS labeled, count(*) FILTER (stars IS NOT NULL AND max_h_index IS NOT NULL) AS already_enriched,
  count(*) FILTER (stars IS NOT NULL AND max_h_index IS NULL) AS pending, count(max_h_index) AS enriched,
  round(quantile_cont(cast(max_h_index AS DOUBLE), 0.5), 6) AS h_index_p50,
  round(quantile_cont(cast(max_h_index AS DOUBLE), 0.9), 6) AS h_index_p90,
  round(quantile_cont(cast(total_prior_papers AS DOUBLE), 0.5), 6) AS prior_papers_p50,
  round(quantile_cont(cast(total_prior_papers AS DOUBLE), 0.9), 6) AS prior_papers_p90 FROM starred
""")
def backfill_summary_authors(spark, sf):
    return rounded(
        ops.author_backfill_summary(half_starred(spark, sf)),
        "h_index_p50", "h_index_p90", "prior_papers_p50", "prior_papers_p90",
    )


@check("SELECT round(sum(1 - quality) / sum(quality), 2) AS scale_pos_weight FROM labels")
def scale_pos_weight(spark, sf):
    return ops.scale_pos_weight(table(spark, sf, "labels"), "quality")


@check(PS + "SELECT round(avg(hype_score), 6) AS mean_score FROM scored")
def mean_score(spark, sf):
    return rounded(ops.mean_score(score_papers(papers(spark, sf), toy_model())), "mean_score")


@check(P + """
SELECT category, count(*) AS papers FROM (SELECT unnest(categories) AS category FROM papers) x GROUP BY 1
UNION ALL SELECT 'total', count(DISTINCT arxiv_id) FROM papers
""")
def ingest_counts(spark, sf):
    return ops.ingest_counts(papers(spark, sf))


@check(P + """
SELECT 'max_h_index' AS feature, count(*) - count(max_h_index) AS nulls FROM papers
UNION ALL SELECT 'total_prior_papers', count(*) - count(total_prior_papers) FROM papers
UNION ALL SELECT 'hf_paper_id', count(*) - count(hf_paper_id) FROM papers
UNION ALL SELECT 'hype_label', count(*) - count(hype_label) FROM papers
UNION ALL SELECT 'title', count(*) - count(title) FROM papers
""")
def null_report(spark, sf):
    columns = ["max_h_index", "total_prior_papers", "hf_paper_id", "hype_label", "title"]
    return ops.null_report(papers(spark, sf), columns)


@check(PF + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS nulls FROM features" for c in FEATURE_COLS
))
def null_report_features(spark, sf):
    return ops.null_report(build_features(papers(spark, sf)), FEATURE_COLS)


@check(f"""
WITH {SERIES} SELECT name, feature, max_by(value, ts) AS value,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts FROM series
WHERE ts > TIMESTAMP '2024-01-12 00:00:00' AND ts <= TIMESTAMP '2024-01-26 00:00:00' GROUP BY name, feature
""")
def latest_sample(spark, sf):
    latest = ops.latest_sample(series(spark, sf), "2024-01-26 00:00:00", ["name", "feature"])
    return latest.select("name", "feature", "value", stamp("ts"))


@check("SELECT count(DISTINCT quality) AS labels, count(DISTINCT quality) > 1 AS stratify FROM labels")
def label_cardinality(spark, sf):
    return ops.label_cardinality(table(spark, sf, "labels"), "quality")


@check(f"""
WITH {SERIES} SELECT feature, max_by(value, ts) AS value, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts
FROM series WHERE ts > TIMESTAMP '2024-01-12 00:00:00' AND ts <= TIMESTAMP '2024-01-26 00:00:00'
GROUP BY feature
""")
def drift_rank(spark, sf):
    ranked = rank_drift(series(spark, sf), "2024-01-26 00:00:00")
    return ranked.select("feature", "value", stamp("ts"))


@check(f"""
WITH {SERIES}, daily AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, feature, max(value) AS value FROM series GROUP BY 1, 2)
SELECT day, feature, value FROM (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY value DESC, feature) AS rk FROM daily) r WHERE rk <= 8
""")
def topk_per_time(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    daily = series(spark, sf).groupBy(day, "feature").agg(F.max("value").alias("value"))
    return topk(daily, ts="day")


@check(P + """
SELECT arxiv_id FROM papers WHERE has_code AND (github_stars_t60 IS NULL OR doc_id % 2 = 0)
ORDER BY arxiv_id LIMIT 100
""")
def head_pending(spark, sf):
    from ..operators.filters import pending_stars

    return head(pending_stars(half_starred(spark, sf)), 100).select("arxiv_id")


@check("""
SELECT (row_number() OVER (ORDER BY id) - 1) // 500 AS chunk, id
FROM (SELECT DISTINCT cast(l_orderkey AS VARCHAR) AS id FROM lineitem) x
""")
def chunk_requests(spark, sf):
    ids = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("arxiv_id"))
    return chunks(ids, 500).select("chunk", F.explode("ids").alias("id"))

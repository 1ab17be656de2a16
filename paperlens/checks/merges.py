"""Upserts and updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge as ops
from ..session import work_dir
from . import check
from .bindings import SI, stamp, stored_incoming

MERGED = """
SELECT coalesce(s.arxiv_id, i.arxiv_id) AS arxiv_id,
  CASE WHEN i.arxiv_id IS NOT NULL THEN i.title ELSE s.title END AS title,
  strftime(CASE WHEN s.arxiv_id IS NULL THEN i.submitted_at ELSE s.submitted_at END, '%Y-%m-%d %H:%M:%S')
    AS submitted_at,
  coalesce(i.citation_count, s.citation_count) AS citation_count,
  coalesce(nullif(i.hf_paper_id, ''), s.hf_paper_id) AS hf_paper_id,
  coalesce(i.has_code, s.has_code) AS has_code,
  coalesce(s.github_stars_t60, i.github_stars_t60) AS github_stars_t60,
  {label} AS hype_label
FROM s FULL OUTER JOIN i ON s.arxiv_id = i.arxiv_id
"""


def after_earlier(changes):
    """Every change twice: an earlier row with another title and nothing else known comes first."""
    earlier = changes.select(*[
        F.col(c) if c in ("arxiv_id", "submitted_at") else F.lit("earlier").alias(c) if c == "title"
        else F.lit(None).cast(t).alias(c) for c, t in changes.dtypes
    ])
    return earlier.withColumn("pos", F.lit(0)).unionByName(changes.withColumn("pos", F.lit(1)))


def merged(spark, sf, **options):
    stored, incoming = stored_incoming(spark, sf)
    result = ops.upsert_papers(stored, after_earlier(incoming), "pos", **options)
    return result.withColumn("submitted_at", stamp("submitted_at"))


@check(SI + MERGED.format(label="coalesce(i.hype_label, s.hype_label)"))
def upsert_papers(spark, sf):
    return merged(spark, sf)


@check(SI + MERGED.format(
    label="CASE WHEN s.github_stars_t60 IS NOT NULL THEN s.hype_label ELSE coalesce(i.hype_label, s.hype_label) END"
))
def upsert_papers_protected(spark, sf):
    return merged(spark, sf, protect_t60=True)


@check(SI + """
SELECT s.arxiv_id, s.title, CASE WHEN i.arxiv_id IS NOT NULL THEN i.hf_paper_id ELSE s.hf_paper_id END AS hf_paper_id,
  CASE WHEN i.arxiv_id IS NOT NULL THEN i.citation_count END AS hf_upvotes,
  CASE WHEN i.arxiv_id IS NOT NULL THEN i.title END AS hf_github_repo,
  CASE WHEN i.arxiv_id IS NOT NULL THEN i.has_code ELSE s.has_code END AS has_code,
  CASE WHEN i.arxiv_id IS NOT NULL THEN i.hype_label ELSE s.hype_label END AS hype_label
FROM s LEFT JOIN i ON s.arxiv_id = i.arxiv_id
""")
def update_lookup_fields(spark, sf):
    stored, incoming = stored_incoming(spark, sf)
    outcomes = incoming.select(
        "arxiv_id", "hf_paper_id", F.col("citation_count").alias("hf_upvotes"),
        F.col("title").alias("hf_github_repo"), "has_code", "hype_label",
    )
    columns = ["arxiv_id", "title", "hf_paper_id", "has_code", "hype_label"]
    return ops.update_lookup_fields(stored.select(*columns), after_earlier(outcomes), "pos")


@check(SI + """
SELECT s.arxiv_id, s.title,
  CASE WHEN i.arxiv_id IS NOT NULL THEN i.github_stars_t60 ELSE s.github_stars_t60 END AS github_stars_t60,
  CASE WHEN i.arxiv_id IS NOT NULL THEN i.hype_label ELSE s.hype_label END AS hype_label
FROM s LEFT JOIN i ON s.arxiv_id = i.arxiv_id
""")
def update_labels(spark, sf):
    stored, incoming = stored_incoming(spark, sf)
    rows = stored.select("arxiv_id", "title", "github_stars_t60", "hype_label")
    return ops.update_labels(rows, after_earlier(incoming), "pos")


@check(SI + """
SELECT s.arxiv_id, s.title,
  CASE WHEN i.arxiv_id IS NOT NULL THEN i.github_stars_t60 ELSE s.github_stars_t60 END AS github_stars_t60
FROM s LEFT JOIN i ON s.arxiv_id = i.arxiv_id
""")
def apply_label_update(spark, sf):
    stored, incoming = stored_incoming(spark, sf)
    rows = stored.select("arxiv_id", "title", "github_stars_t60", "hype_label")
    return ops.update_labels(rows, after_earlier(incoming), "pos").drop("hype_label")


@check(SI + """
SELECT s.arxiv_id, s.title, s.has_code, i.citation_count AS max_h_index, i.github_stars_t60 AS total_prior_papers
FROM s LEFT JOIN i ON s.arxiv_id = i.arxiv_id
""")
def backfill_columns(spark, sf):
    stored, incoming = stored_incoming(spark, sf)
    values = incoming.select(
        "arxiv_id", F.col("citation_count").alias("max_h_index"),
        F.col("github_stars_t60").alias("total_prior_papers"),
    )
    return ops.backfill_columns(stored.select("arxiv_id", "title", "has_code"), after_earlier(values), "pos")


@check(SI + """
SELECT unnest(['upserted', 'inserted', 'updated', 'failed']) AS outcome, unnest([
  (SELECT count(*) FROM i), (SELECT count(*) FROM i WHERE arxiv_id NOT IN (SELECT arxiv_id FROM s)),
  (SELECT count(*) FROM i WHERE arxiv_id IN (SELECT arxiv_id FROM s)),
  (SELECT count(*) FROM i WHERE arxiv_id::BIGINT % 9 = 0)]) AS papers
""")
def upsert_counts(spark, sf):
    """What came of a batch, counted while the merged table is written; some rows come a second time without an id."""
    stored, incoming = stored_incoming(spark, sf)
    blank = incoming.filter(F.col("arxiv_id").cast("long") % 9 == 0).withColumn("arxiv_id", F.lit(" "))
    batch = incoming.unionByName(blank).withColumn("pos", F.lit(0))
    path = work_dir(spark, "merged")
    counts = ops.ingest(stored, batch, "pos", lambda merged: merged.write.parquet(path))
    return spark.createDataFrame(list(counts.items()), "outcome string, papers long")

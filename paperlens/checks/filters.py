"""Row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as ops
from ..operators.trees import score_papers
from ..sources.readers import read_papers_window as window
from . import check
from .bindings import AS_OF, P, PS, papers, stamp, table, toy_model


@check(P + """
SELECT arxiv_id FROM papers WHERE submitted_at >= TIMESTAMP '2024-01-05 00:00:00'
  AND (list_contains(categories, 'cs.LG') OR list_contains(categories, 'cs.AI')
    OR list_contains(categories, 'cs.CV') OR list_contains(categories, 'cs.CL'))
""")
def target_filter(spark, sf):
    return ops.target_filter(papers(spark, sf), "2024-01-05").select("arxiv_id")


def links(spark, sf):
    """Several links per paper, some unofficial, some without an id."""
    key = F.col("l_orderkey")
    return table(spark, sf, "lineitem").select(
        F.when(key % 10 == 0, None).when(key % 10 == 1, "").otherwise(key.cast("string"))
        .alias("paper_arxiv_id"),
        F.concat(F.lit("https://github.com/o/r"), F.col("l_partkey").cast("string")).alias("repo_url"),
        (F.col("l_linenumber") <= 3).alias("is_official"),
    )


LINKS = """links AS (
  SELECT CASE WHEN l_orderkey % 10 = 0 THEN NULL WHEN l_orderkey % 10 = 1 THEN ''
              ELSE cast(l_orderkey AS VARCHAR) END AS paper_arxiv_id,
    concat('https://github.com/o/r', cast(l_partkey AS VARCHAR)) AS repo_url,
    l_linenumber <= 3 AS is_official FROM lineitem)"""


@check(f"""
WITH {LINKS} SELECT paper_arxiv_id, repo_url FROM links
WHERE is_official AND paper_arxiv_id IS NOT NULL AND paper_arxiv_id <> ''
""")
def official_links(spark, sf):
    return ops.official_links(links(spark, sf)).select("paper_arxiv_id", "repo_url")


@check(P + "SELECT arxiv_id, hype_label FROM papers WHERE hype_label IS NOT NULL")
def drop_unlabeled(spark, sf):
    return ops.drop_unlabeled(papers(spark, sf)).select("arxiv_id", "hype_label")


@check(P + "SELECT arxiv_id FROM papers WHERE submitted_at >= TIMESTAMP '2024-01-28 00:00:00'")
def recent_window(spark, sf):
    return ops.recent_window(papers(spark, sf), AS_OF, 15).select("arxiv_id")


@check(P + """
SELECT arxiv_id, max_h_index IS NOT NULL AS has_author_enrichment FROM papers
WHERE submitted_at >= TIMESTAMP '2024-01-13 00:00:00'
""")
def read_papers_window(spark, sf):
    return window(papers(spark, sf), AS_OF, 30).select("arxiv_id", "has_author_enrichment")


@check(P + "SELECT arxiv_id, title FROM papers WHERE arxiv_id = '2401.000042' LIMIT 1")
def paper_by_id(spark, sf):
    return ops.paper_by_id(papers(spark, sf), "2401.000042").select("arxiv_id", "title")


@check("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-19 00:00:00'")
def since_cutoff(spark, sf):
    return ops.since_cutoff(table(spark, sf, "events"), "2024-01-20 15:30:00", "ts").select("event_id")


@check("SELECT event_id FROM events WHERE cast(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'")
def date_range(spark, sf):
    return ops.date_range(table(spark, sf, "events"), "2024-01-05", "2024-01-09", "ts").select("event_id")


@check(P + """
SELECT arxiv_id, strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at FROM papers
WHERE hf_paper_id IS NULL AND submitted_at > TIMESTAMP '2024-02-05 00:00:00'
""")
def unhydrated(spark, sf):
    return ops.unhydrated(papers(spark, sf), AS_OF).select("arxiv_id", stamp("submitted_at"))


@check(P + """
SELECT arxiv_id FROM papers WHERE NOT (
  (hf_paper_id IS NOT NULL AND hf_paper_id <> 'checked_none')
  OR (coalesce(hf_paper_id, '') = 'checked_none' AND submitted_at < TIMESTAMP '2024-02-05 00:00:00'))
""")
def skip_lookup(spark, sf):
    return ops.lookup_candidates(papers(spark, sf), AS_OF).select("arxiv_id")


def half_starred(spark, sf):
    """Papers whose even documents have no star count yet."""
    return papers(spark, sf).withColumn(
        "github_stars_t60", F.when(F.col("doc_id") % 2 == 1, F.col("github_stars_t60"))
    )


@check(P + """
SELECT arxiv_id, 'stars' AS missing FROM papers
  WHERE has_code AND (github_stars_t60 IS NULL OR doc_id % 2 = 0)
UNION ALL
SELECT arxiv_id, 'authors' FROM papers
  WHERE github_stars_t60 IS NOT NULL AND doc_id % 2 = 1 AND max_h_index IS NULL
""")
def pending_rows(spark, sf):
    rows = half_starred(spark, sf)
    stars = ops.pending_stars(rows).select("arxiv_id", F.lit("stars").alias("missing"))
    return stars.unionByName(
        ops.pending_authors(rows).select("arxiv_id", F.lit("authors").alias("missing"))
    )


@check(P + """
SELECT arxiv_id FROM papers
WHERE has_code AND (github_stars_t60 IS NULL OR doc_id % 2 = 0)
  AND submitted_at < TIMESTAMP '2024-01-23 00:00:00'
""")
def label_eligible(spark, sf):
    return ops.label_eligible(half_starred(spark, sf), "2024-03-23 00:00:00").select("arxiv_id")


@check(P + "SELECT arxiv_id, max_h_index FROM papers WHERE max_h_index > 0")
def enriched_only(spark, sf):
    return ops.enriched_only(papers(spark, sf)).select("arxiv_id", "max_h_index")


@check(PS + "SELECT arxiv_id FROM scored WHERE hype_tier = 'likely'")
def tier_filter(spark, sf):
    scored = score_papers(papers(spark, sf), toy_model())
    return ops.tier_filter(scored, "likely").select("arxiv_id")


@check(P + """
SELECT arxiv_id FROM papers
WHERE contains(lower(title), 'ation') OR contains(lower(array_to_string(author_names, chr(31))), 'ation')
""")
def feed_search(spark, sf):
    return ops.feed_search(papers(spark, sf), "  ATION ").select("arxiv_id")


@check(P + """
SELECT 15 AS days, count(*) >= 30 AS enough FROM papers WHERE submitted_at >= TIMESTAMP '2024-01-28 00:00:00'
UNION ALL
SELECT 1, count(*) >= 30 FROM papers WHERE submitted_at >= TIMESTAMP '2024-02-11 00:00:00'
  AND submitted_at < TIMESTAMP '2024-02-12 00:00:00'
""")
def min_rows_guard(spark, sf):
    rows = papers(spark, sf)
    day = ops.recent_window(rows, AS_OF, 1).filter(F.col("submitted_at") < F.lit(AS_OF).cast("timestamp"))
    found = [(15, ops.has_min_rows(ops.recent_window(rows, AS_OF, 15))), (1, ops.has_min_rows(day))]
    return spark.createDataFrame(found, "days int, enough boolean")


@check("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def drop_blank_ids(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    rows = table(spark, sf, "orders").select("o_orderkey", status.alias("id"))
    return ops.drop_blank_ids(rows, "id").select("o_orderkey")


@check("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def is_in_ids(spark, sf):
    wanted = table(spark, sf, "lineitem").filter(F.col("l_quantity") > 45)
    return ops.is_in_ids(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        wanted.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey",
    )

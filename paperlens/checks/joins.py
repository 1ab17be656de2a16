"""Joins and author enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, joins
from ..operators.filters import official_links
from ..operators.joins import author_aggregate_join as aggregate_join
from ..plans.curate import curate as curate_plan
from . import check
from .bindings import P, first_line, papers, stamp, table
from .filters import LINKS, links

LINKED = f"""{LINKS},
one AS (SELECT paper_arxiv_id AS arxiv_id, min(repo_url) AS hf_github_repo FROM links
  WHERE is_official AND paper_arxiv_id <> '' GROUP BY 1)"""


@check(f"""
WITH {LINKED}, o AS (SELECT cast(o_orderkey AS VARCHAR) AS arxiv_id FROM orders)
SELECT o.arxiv_id, one.arxiv_id IS NOT NULL AS has_code, hf_github_repo,
  one.arxiv_id IS NOT NULL AS hype_label FROM o LEFT JOIN one ON o.arxiv_id = one.arxiv_id
""")
def attach_code_links(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("arxiv_id"))
    return joins.attach_code_links(rows, aggregates.links_per_paper(official_links(links(spark, sf))))


@check(f"""
WITH {LINKED}, o AS (SELECT cast(o_orderkey AS VARCHAR) AS arxiv_id FROM orders)
SELECT arxiv_id, arxiv_id IN (SELECT arxiv_id FROM one) AS has_code FROM o
""")
def code_flags(spark, sf):
    return attach_code_links(spark, sf).select("arxiv_id", "has_code")


def dump(spark, sf):
    """Documents as rows of the metadata dump; some of its dates and categories are out of range."""
    d = table(spark, sf, "documents")
    doc = F.col("doc_id")
    start = F.lit("2023-12-15 08:30:00").cast("timestamp")
    submitted = start + F.make_interval(hours=doc.cast("int"))
    created = F.date_format(submitted, "EEE, d MMM yyyy HH:mm:ss 'GMT'")
    return d.select(
        F.concat(doc.cast("string"), F.lit("v"), (doc % 4 + 1).cast("string")).alias("id"),
        F.concat(F.lit("  "), first_line()).alias("title"),
        F.concat(F.col("text"), F.lit("  ")).alias("abstract"),
        F.when(doc % 3 == 0, " cs.LG stat.ML").when(doc % 3 == 1, "math.ST").otherwise("cs.CL")
        .alias("categories"),
        F.date_format(submitted, "yyyy-MM-dd").alias("update_date"),
        F.array(
            F.struct(F.when(doc % 50 != 7, created).alias("created")),
            F.struct(F.lit("n/a").alias("created")),
        ).alias("versions"),
        F.array(F.array(F.col("source"), F.col("lang"), F.lit(""))).alias("authors_parsed"),
    )


CURATED = f"""
WITH {LINKED},
a AS (SELECT cast(doc_id AS VARCHAR) AS arxiv_id, trim(string_split(text, chr(10))[1]) AS title,
    trim(text) AS abstract, CASE doc_id % 3 WHEN 0 THEN 'cs.LG|stat.ML' WHEN 1 THEN 'math.ST'
      ELSE 'cs.CL' END AS categories,
    CASE WHEN doc_id % 50 <> 7 THEN TIMESTAMP '2023-12-15 08:30:00' + doc_id * INTERVAL '1' HOUR END AS ts,
    TIMESTAMP '2023-12-15 08:30:00' + doc_id * INTERVAL '1' HOUR AS updated,
    trim(lang) || ' ' || trim(source) AS authors
  FROM documents)
SELECT a.arxiv_id, title, abstract, categories, strftime(ts, '%Y-%m-%d %H:%M:%S') AS submitted_at,
  strftime(updated, '%Y-%m-%d 00:00:00') AS updated_at_api, authors,
  one.arxiv_id IS NOT NULL AS has_code, hf_github_repo, one.arxiv_id IS NOT NULL AS hype_label
FROM a LEFT JOIN one ON a.arxiv_id = one.arxiv_id WHERE ts >= TIMESTAMP '2024-01-01 00:00:00'
  AND categories <> 'math.ST'
"""


def curated_view(made):
    return made.withColumns({
        "categories": F.array_join("categories", "|"),
        "authors": F.array_join("authors.name", "|"),
    }).select(
        "arxiv_id", "title", "abstract", "categories", stamp("submitted_at"), stamp("updated_at_api"),
        "authors", "has_code", "hf_github_repo", "hype_label",
    )


@check(CURATED)
def curate(spark, sf):
    return curated_view(curate_plan(dump(spark, sf), links(spark, sf)))


def paper_batches(spark, sf):
    """Orders in batches of 100, parallel to their ids; every seventh paper is unknown."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(
            F.struct("l_linenumber", F.when(F.col("l_suppkey") % 11 == 0, "")
                     .otherwise(F.col("l_suppkey").cast("string")).alias("authorId"))
        )).alias("lines")
    )
    key = F.col("l_orderkey")
    response = F.when(key % 7 != 0, F.struct(
        F.concat(F.lit("ss"), key.cast("string")).alias("paperId"),
        (key % 100).cast("int").alias("citationCount"),
        F.transform("lines", lambda x: F.struct(x["authorId"].alias("authorId"))).alias("authors"),
    ))
    pair = F.struct(key.alias("k"), response.alias("response"))
    batches = lines.groupBy(F.floor(key / 100)).agg(F.sort_array(F.collect_list(pair)).alias("b"))
    return batches.select(
        F.transform("b", lambda x: F.concat(F.lit("arXiv:"), x["k"].cast("string"))).alias("ids"),
        F.col("b.response").alias("response"),
    )


def author_batches(spark, sf):
    key = F.col("s_suppkey")
    response = F.when(key % 5 != 0, F.struct(
        (key % 60).cast("int").alias("hIndex"), (key % 300).cast("int").alias("paperCount")
    ))
    pair = F.struct(key.alias("k"), response.alias("response"))
    batches = table(spark, sf, "supplier").groupBy(F.floor(key / 1000)).agg(
        F.sort_array(F.collect_list(pair)).alias("b")
    )
    return batches.select(
        F.transform("b", lambda x: x["k"].cast("string")).alias("ids"), F.col("b.response").alias("response")
    )


PAIRS = """pairs AS (
  SELECT cast(l_orderkey AS VARCHAR) AS arxiv_id, l_suppkey AS a FROM lineitem
  WHERE l_orderkey % 7 <> 0 AND l_suppkey % 11 <> 0),
stats AS (SELECT s_suppkey AS a, cast(s_suppkey % 60 AS INT) AS h, cast(s_suppkey % 300 AS INT) AS n
  FROM supplier WHERE s_suppkey % 5 <> 0),
answered AS (SELECT DISTINCT cast(l_orderkey AS VARCHAR) AS arxiv_id,
  concat('ss', cast(l_orderkey AS VARCHAR)) AS ss_paper_id, cast(l_orderkey % 100 AS INT) AS citation_count
  FROM lineitem WHERE l_orderkey % 7 <> 0)"""


@check(f"""
WITH {PAIRS}
SELECT b.arxiv_id, ss_paper_id, citation_count, cast(count(p.a) AS INT) AS authors
FROM answered b LEFT JOIN pairs p ON b.arxiv_id = p.arxiv_id GROUP BY ALL
""")
def zip_batch(spark, sf):
    return joins.paper_responses(paper_batches(spark, sf)).select(
        "arxiv_id", "ss_paper_id", "citation_count", F.size("author_ids").alias("authors")
    )


@check(f"""
WITH {PAIRS}
SELECT b.arxiv_id, ss_paper_id, citation_count,
  CASE WHEN count(p.a) > 0 THEN cast(max(coalesce(h, 0)) AS INT) END AS max_h_index,
  CASE WHEN count(p.a) > 0 THEN cast(sum(coalesce(n, 0)) AS INT) END AS total_prior_papers,
  count(p.a) > 0 AS has_author_enrichment
FROM answered b LEFT JOIN pairs p ON b.arxiv_id = p.arxiv_id LEFT JOIN stats s ON p.a = s.a
GROUP BY b.arxiv_id, ss_paper_id, citation_count
""")
def enrich_authors(spark, sf):
    answers = joins.paper_responses(paper_batches(spark, sf))
    stats = joins.author_responses(author_batches(spark, sf))
    return joins.enrich_authors(answers, stats).drop("author_ids")


def author_pairs(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("paper_id"), F.col("l_suppkey").alias("author_id")
    )


def author_stats(spark, sf):
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").filter(key % 7 != 0).select(
        key.alias("author_id"), (key % 60).alias("h_index"), (key % 300).alias("paper_count")
    )


ENRICHED = """
SELECT a.paper_id, cast(max(coalesce(s.h, 0)) AS INT) AS max_h_index,
  cast(sum(coalesce(s.n, 0)) AS INT) AS total_prior_papers
FROM (SELECT l_orderkey AS paper_id, l_suppkey AS author_id FROM lineitem) a
LEFT JOIN (SELECT s_suppkey AS author_id, s_suppkey % 60 AS h, s_suppkey % 300 AS n
           FROM supplier WHERE s_suppkey % 7 <> 0) s ON a.author_id = s.author_id
GROUP BY a.paper_id
"""


@check(ENRICHED)
def author_aggregate_join(spark, sf):
    return aggregate_join(author_pairs(spark, sf), author_stats(spark, sf))


@check("""
SELECT paper_id, cast(max(coalesce(s.h, 0)) AS INT) AS max_h_index,
  cast(sum(coalesce(s.n, 0)) AS INT) AS total_prior_papers
FROM (SELECT l_orderkey AS paper_id,
        CASE WHEN l_linenumber <= 3 THEN 1 ELSE l_suppkey END AS author_id FROM lineitem) a
LEFT JOIN (SELECT s_suppkey AS author_id, s_suppkey % 60 AS h, s_suppkey % 300 AS n
           FROM supplier WHERE s_suppkey % 7 <> 0) s ON a.author_id = s.author_id
GROUP BY paper_id
""")
def author_aggregate_join_hot(spark, sf):
    """One author on about half of all pairs, found and joined apart."""
    lines = table(spark, sf, "lineitem")
    author = F.when(F.col("l_linenumber") <= 3, F.lit(1)).otherwise(F.col("l_suppkey")).cast("long")
    pairs = lines.select(F.col("l_orderkey").alias("paper_id"), author.alias("author_id"))
    return aggregate_join(pairs, author_stats(spark, sf))


DAILY = """daily AS (SELECT arxiv_id, doc_id % 11 AS upvotes,
  CASE WHEN doc_id % 2 = 0 THEN 'https://github.com/o/r' ELSE '' END AS repo FROM papers WHERE has_code)"""


@check(P.rstrip() + f""", {DAILY}
SELECT p.arxiv_id, CASE WHEN d.arxiv_id IS NOT NULL THEN d.arxiv_id ELSE p.hf_paper_id END AS hf_paper_id,
  cast(CASE WHEN d.arxiv_id IS NOT NULL THEN d.upvotes ELSE p.hf_upvotes END AS INT) AS hf_upvotes,
  CASE WHEN d.arxiv_id IS NOT NULL THEN nullif(d.repo, '') END AS hf_github_repo,
  CASE WHEN d.arxiv_id IS NOT NULL THEN d.repo <> '' ELSE p.has_code END AS has_code,
  CASE WHEN d.arxiv_id IS NOT NULL THEN d.upvotes > 5 ELSE p.hype_label = 1 END AS hype_label
FROM papers p LEFT JOIN daily d ON p.arxiv_id = d.arxiv_id
""")
def hydrate_from_daily(spark, sf):
    rows = papers(spark, sf).select(
        "arxiv_id", "doc_id", "hf_paper_id", "hf_upvotes", F.lit(None).cast("string").alias("hf_github_repo"),
        "has_code", (F.col("hype_label") == 1).alias("hype_label"),
    )
    featured = rows.filter("has_code")
    last = featured.select(
        "arxiv_id", (F.col("doc_id") % 11).cast("int").alias("upvotes"),
        F.when(F.col("doc_id") % 2 == 0, "https://github.com/o/r").otherwise("").alias("github_repo"),
        F.lit(2).alias("pos"),
    )
    earlier = last.withColumns({"upvotes": F.lit(99), "pos": F.lit(1)})
    return joins.hydrate_from_daily(rows.drop("doc_id"), earlier.unionByName(last))


@check(P + """
SELECT arxiv_id, hf_paper_id FROM papers WHERE hf_paper_id IS NOT NULL AND has_code
""")
def known_lookups(spark, sf):
    rows = papers(spark, sf)
    return joins.known_lookups(rows, rows.filter("has_code"))


CATEGORY_EVENTS = """u AS (
  SELECT event_id, 'first' AS source, 0 AS rank FROM events WHERE event_type IN ('click', 'view')
  UNION ALL SELECT event_id, 'second', 1 FROM events WHERE event_type IN ('click', 'error')
  UNION ALL SELECT event_id, 'third', 2 FROM events)"""


def category_events(spark, sf):
    e = table(spark, sf, "events")
    return joins.union_categories(
        e.filter(F.col("event_type").isin("click", "view")).select("event_id", F.lit("first").alias("source")),
        e.filter(F.col("event_type").isin("click", "error")).select("event_id", F.lit("second").alias("source")),
        e.select("event_id", F.lit("third").alias("source")),
    )


@check(f"WITH {CATEGORY_EVENTS} SELECT event_id, source, cast(rank AS INT) AS category_rank FROM u")
def union_categories(spark, sf):
    return category_events(spark, sf)

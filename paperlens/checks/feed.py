"""Scoring and serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.features import build_features
from ..operators import ranking
from ..operators.trees import score_papers as score
from ..operators.trees import score_trees as walk
from ..plans.feed import feed_screen as screen
from ..plans.feed import paper_detail as detail
from . import check
from .bindings import AS_OF, MARGIN, P, PF, PS, papers, rounded, stamp, toy_model

RECENT = "SELECT * FROM {table} WHERE submitted_at >= TIMESTAMP '{since} 00:00:00' ORDER BY submitted_at DESC, arxiv_id LIMIT {limit}"


@check(P + f"""
SELECT arxiv_id, strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at
FROM ({RECENT.format(table='papers', since='2024-01-13', limit=50)}) x
""")
def recent_topn(spark, sf):
    return ranking.recent_topn(papers(spark, sf), AS_OF).select("arxiv_id", stamp("submitted_at"))


@check(PS + f"""
SELECT arxiv_id, round(hype_score, 6) AS hype_score, hype_tier
FROM ({RECENT.format(table='scored', since='2023-12-14', limit=200)}) x
""")
def ranked_feed(spark, sf):
    feed = ranking.ranked_feed(papers(spark, sf), toy_model(), AS_OF, days=60, limit=1000)
    return rounded(feed.select("arxiv_id", "hype_score", "hype_tier"), "hype_score")


@check(PS + f"""
SELECT arxiv_id, round(hype_score, 6) AS hype_score
FROM ({RECENT.format(table='scored', since='2023-11-14', limit=100)}) x WHERE hype_tier = 'hype'
""")
def client_feed_args(spark, sf):
    args = ranking.client_feed_args(365, "hype")
    feed = ranking.ranked_feed(papers(spark, sf), toy_model(), AS_OF, **args)
    return rounded(feed.select("arxiv_id", "hype_score"), "hype_score")


FEED = f"""feed AS (SELECT * FROM ({RECENT.format(table='scored', since='2024-01-13', limit=100)}) x),
placed AS (SELECT *, row_number() OVER (ORDER BY hype_score DESC, arxiv_id) AS position,
  greatest(1, ceil(count(*) OVER () / 10)) AS pages FROM feed {{where}})"""


@check(PS.rstrip() + ", " + FEED.format(where="") + """
SELECT arxiv_id, cast(position AS INT) AS position, cast(pages AS INT) AS pages, 2 AS page FROM placed
WHERE ceil(position / 10) = 2
""")
def feed_page(spark, sf):
    feed = ranking.ranked_feed(papers(spark, sf), toy_model(), AS_OF, limit=100)
    return ranking.feed_page(feed, 2).select("arxiv_id", "position", "pages", "page")


@check(PS.rstrip() + ", " + FEED.format(
    where="WHERE contains(lower(title), 'en') OR contains(lower(array_to_string(author_names, chr(31))), 'en')"
) + """
SELECT arxiv_id, title, cast(floor(hype_score * 100 + 0.5) AS INT) AS score_percent,
  upper(hype_tier) AS tier_badge, cast(position AS INT) AS position FROM placed
WHERE ceil(position / 10) = pages
""")
def feed_screen(spark, sf):
    shown = screen(papers(spark, sf), toy_model(), AS_OF, tier="unknown", search="EN", page=99)
    return shown.select("arxiv_id", "title", "score_percent", "tier_badge", "position")


@check(PF + f"SELECT f.arxiv_id, round(1 / (1 + exp(-({MARGIN}))), 6) AS hype_score FROM features f")
def score_trees(spark, sf):
    matrix = build_features(papers(spark, sf), ("arxiv_id",))
    return rounded(walk(matrix, toy_model()).select("arxiv_id", "hype_score"), "hype_score")


@check(PF + f"SELECT f.arxiv_id, round(1 / (1 + exp(-({MARGIN}))), 6) AS hype_score FROM features f")
def score_trees_batched(spark, sf):
    matrix = build_features(papers(spark, sf), ("arxiv_id",))
    walked = walk(matrix, toy_model(), native=False)
    return rounded(walked.select("arxiv_id", "hype_score"), "hype_score")


@check(PS + "SELECT arxiv_id, round(hype_score, 6) AS hype_score, hype_tier FROM scored")
def score_papers(spark, sf):
    scored = score(papers(spark, sf), toy_model())
    return rounded(scored.select("arxiv_id", "hype_score", "hype_tier"), "hype_score")


@check(PS + """
SELECT arxiv_id, title, array_to_string(author_names, '|') AS author_names,
  array_to_string(categories, '|') AS categories, abstract,
  strftime(submitted_at, '%Y-%m-%dT%H:%M:%SZ') AS submitted_at, has_code,
  round(hype_score, 6) AS hype_score, hype_tier, max_h_index, total_prior_papers, hf_upvotes
FROM scored WHERE arxiv_id = '2401.000042'
""")
def paper_detail(spark, sf):
    shown = detail(papers(spark, sf), toy_model(), "2401.000042")
    return rounded(shown, "hype_score").withColumns({
        "author_names": F.array_join("author_names", "|"), "categories": F.array_join("categories", "|"),
    })

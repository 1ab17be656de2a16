"""The feed as the dashboard shows it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_timestamp
from ..functions.text import (
    author_line,
    category_line,
    date_label,
    score_bar,
    score_percent,
    tier_badge,
)
from ..operators.filters import feed_search, paper_by_id
from ..operators.ranking import client_feed_args, feed_page, ranked_feed
from ..operators.trees import TreeModel, score_papers


def serving_view(scored: DataFrame) -> DataFrame:
    """Fields of a served paper; unknown numbers stay NULL."""
    optional = [
        (F.col(c) if c in scored.columns else F.lit(None)).cast("int").alias(c)
        for c in ("max_h_index", "total_prior_papers", "hf_upvotes")
    ]
    return scored.select(
        "arxiv_id", "title", "author_names", "categories", "abstract",
        iso_timestamp(F.col("submitted_at")).alias("submitted_at"),
        F.coalesce("has_code", F.lit(False)).alias("has_code"),
        "hype_score", "hype_tier", *optional,
    )


def paper_detail(papers: DataFrame, model: TreeModel, arxiv_id: str, text_unit: str = "chars") -> DataFrame:
    """One paper with its score; no row when the id is unknown."""
    return serving_view(score_papers(paper_by_id(papers, arxiv_id), model, text_unit))


def card_view(scored: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Display texts of a paper card, followed by the ``keep`` columns."""
    return scored.select(
        "arxiv_id", "title",
        author_line(F.col("author_names")).alias("author_line"),
        category_line(F.col("categories")).alias("category_line"),
        date_label(F.col("submitted_at")).alias("date_label"),
        score_percent(F.col("hype_score")).alias("score_percent"),
        score_bar(F.col("hype_score")).alias("score_bar"),
        tier_badge(F.col("hype_tier")).alias("tier_badge"),
        *keep,
    )


def feed_screen(papers: DataFrame, model: TreeModel, as_of, days: int | None = None,
                tier: str | None = None, search: str = "", page: int = 1) -> DataFrame:
    """Arguments, window, scores, tier, search and page in one plan."""
    args = client_feed_args(days, tier)
    feed = ranked_feed(papers, model, as_of, args["days"], args["limit"], args["tier"])
    return card_view(feed_page(feed_search(feed, search), page), ("position", "page", "pages"))

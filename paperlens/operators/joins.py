"""Links, enrichment batches, author statistics and daily features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import ENRICHMENT_PREFIX
from ..functions.labels import has_code_from_repo, prelim_label
from ..functions.text import empty_to_null
from .aggregates import author_signals_agg, dedup_last
from .skew import heavy_left_join, salted_left_join


def attach_code_links(papers: DataFrame, links: DataFrame) -> DataFrame:
    """Papers with their repository, ``has_code`` and the proxy label; ``links`` has one row per id.

    Both sides are unique by id, so no key is frequent; the adaptive planner broadcasts the links
    when their measured size allows it and sorts and merges otherwise.
    """
    joined = papers.join(links.withColumn("_linked", F.lit(True)), "arxiv_id", "left")
    linked = F.coalesce("_linked", F.lit(False))
    return joined.select(
        *papers.columns, linked.alias("has_code"), "hf_github_repo", linked.alias("hype_label")
    )


def zip_batch(batches: DataFrame) -> DataFrame:
    """``(id, response)`` of batches whose responses are parallel to their ids.

    A NULL response means unknown to the service and is skipped, as is a response without an id.
    """
    pairs = F.explode(F.arrays_zip("ids", "response"))
    return batches.select(pairs.alias("pair")).select(
        F.col("pair.ids").alias("id"), F.col("pair.response").alias("response")
    ).filter(F.col("id").isNotNull() & F.col("response").isNotNull())


def paper_responses(batches: DataFrame) -> DataFrame:
    """Per paper: service id, citations and the non-empty author ids, one answer each."""
    answer = F.struct(
        F.coalesce("response.citationCount", F.lit(0)).alias("citation_count"),
        empty_to_null(F.col("response.paperId")).alias("ss_paper_id"),
        F.filter(
            F.coalesce("response.authors.authorId", F.array().cast("array<string>")),
            lambda a: a != "",
        ).alias("author_ids"),
    )
    arxiv_id = F.substr(F.col("id"), F.lit(len(ENRICHMENT_PREFIX) + 1))
    return zip_batch(batches).groupBy(arxiv_id.alias("arxiv_id")).agg(
        F.max(answer).alias("answer")
    ).select("arxiv_id", "answer.*")


def author_responses(batches: DataFrame) -> DataFrame:
    """Statistics per author; an author answered in several batches is taken once."""
    return zip_batch(batches).groupBy(F.col("id").alias("author_id")).agg(
        F.max(F.coalesce("response.hIndex", F.lit(0))).alias("h_index"),
        F.max(F.coalesce("response.paperCount", F.lit(0))).alias("paper_count"),
    )


def author_aggregate_join(pairs: DataFrame, stats: DataFrame, paper: str = "paper_id",
                          salts: int | None = None) -> DataFrame:
    """Per paper, over its ``(paper, author_id)`` pairs: highest h-index and summed paper counts.

    Authors that many pairs name are found by a sketch and joined apart; ``salts`` spreads all alike instead.
    """
    stats, pairs = stats.select("author_id", "h_index", "paper_count"), pairs.select(paper, "author_id")
    if salts is None:
        joined = heavy_left_join(pairs, stats, "author_id")
    else:
        joined = salted_left_join(pairs, stats, "author_id", salts)
    return author_signals_agg(joined, paper)


def enrich_authors(papers: DataFrame, stats: DataFrame, no_authors: str = "null",
                   salts: int | None = None) -> DataFrame:
    """Author signals for answered papers ``(arxiv_id, author_ids, ...)``.

    A paper without author ids gets NULLs (``no_authors="null"``) or zeros (``"zero"``). ``papers``
    is read twice (pairs, result): pass a stored table where making it is dear.
    """
    if no_authors not in ("null", "zero"):
        raise ValueError("no_authors must be 'null' or 'zero'")
    pairs = papers.select("arxiv_id", F.explode("author_ids").alias("author_id"))
    signals = author_aggregate_join(pairs, stats, "arxiv_id", salts)
    joined = papers.join(signals, "arxiv_id", "left")
    if no_authors == "zero":
        joined = joined.fillna(0, ["max_h_index", "total_prior_papers"])
    return joined.withColumn("has_author_enrichment", F.col("max_h_index").isNotNull())


def hydrate_from_daily(papers: DataFrame, daily: DataFrame) -> DataFrame:
    """Featured papers take id, upvotes, repository, code flag and early label; others stay.

    ``daily`` is ``(arxiv_id, upvotes, github_repo, pos)``: of several entries the last one counts.
    """
    new = daily.select(
        "arxiv_id",
        F.struct(
            F.col("arxiv_id").alias("hf_paper_id"),
            F.col("upvotes").alias("hf_upvotes"),
            empty_to_null(F.col("github_repo")).alias("hf_github_repo"),
            has_code_from_repo(F.col("github_repo")).alias("has_code"),
            prelim_label(F.col("upvotes")).alias("hype_label"),
        ).alias("_new"),
        "pos",
    )
    return replace_matched(
        papers, new, ["hf_paper_id", "hf_upvotes", "hf_github_repo", "has_code", "hype_label"], "pos"
    )


def replace_matched(papers: DataFrame, new: DataFrame, columns: list[str], order: str,
                    key: str = "arxiv_id") -> DataFrame:
    """Take ``columns`` from ``new._new`` for matching keys, NULLs included; add missing columns.

    Of several rows of a key in ``new`` the one with the largest ``order`` counts.
    """
    joined = papers.join(dedup_last(new, key, order).select(key, "_new"), key, "left")
    matched = F.col("_new").isNotNull()
    replaced = {
        c: F.when(matched, F.col("_new")[c]).otherwise(F.col(c) if c in papers.columns else None)
        for c in columns
    }
    return joined.withColumns(replaced).drop("_new")


def known_lookups(stored: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored lookup ids of the incoming papers that have one."""
    known = stored.select("arxiv_id", "hf_paper_id").filter(F.col("hf_paper_id").isNotNull())
    return known.join(ids.select("arxiv_id"), "arxiv_id", "left_semi")


def union_categories(*fetches: DataFrame) -> DataFrame:
    """All per-category fetches, each with its priority as ``category_rank``."""
    ranked = [f.withColumn("category_rank", F.lit(i)) for i, f in enumerate(fetches)]
    union = ranked[0]
    for fetch in ranked[1:]:
        union = union.unionByName(fetch)
    return union

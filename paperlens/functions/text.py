"""Identifiers, titles, links and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ENRICHMENT_PREFIX, TIERS, URL_WHITE_SPACE, WHITE_SPACE


def strip_version(paper_id: Column) -> Column:
    """``2401.12345v2`` -> ``2401.12345``."""
    return F.regexp_replace(paper_id, r"v[0-9]+\z", "")


def extract_paper_id(url: Column) -> Column:
    """Identifier behind the only ``/abs/`` of a URL; empty string when there is not exactly one."""
    parts = F.split(url, "/abs/")
    return F.when(F.size(parts) == 2, clean_text(strip_version(F.get(parts, F.lit(1))), True)).otherwise("")


def clean_text(text: Column, all_whitespace: bool = False) -> Column:
    """Trim spaces only (bulk dump), or every Unicode whitespace character (feed)."""
    return F.btrim(text, F.lit(WHITE_SPACE)) if all_whitespace else F.trim(text)


def split_categories(categories: Column) -> Column:
    """Space-separated list to array; empty tokens are kept."""
    return F.split(F.trim(categories), " ")


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def enrichment_key(paper_id: Column) -> Column:
    return F.concat(F.lit(ENRICHMENT_PREFIX), paper_id)


def parse_repo_url(url: Column, trim: bool = True) -> Column:
    """``struct(owner, repo)`` of a repository link, NULL when it is not one.

    Trailing slashes, one ``.git`` suffix and deeper paths are ignored.
    """
    text = F.btrim(url, F.lit(URL_WHITE_SPACE)) if trim else url
    text = F.regexp_replace(F.rtrim(text, F.lit("/")), r"\.git\z", "")
    pattern = r"\Ahttps://github\.com/([^/]+)/([^/]+)"
    return F.when(
        text.rlike(pattern),
        F.struct(
            F.regexp_extract(text, pattern, 1).alias("owner"),
            F.regexp_extract(text, pattern, 2).alias("repo"),
        ),
    )


def author_line(names: Column) -> Column:
    """Up to three names, then how many more."""
    shown = F.array_join(F.slice(names, 1, 3), " · ")
    more = F.size(names) - 3
    return F.when(more > 0, F.concat(shown, F.lit(" +"), more.cast("string"))).otherwise(shown)


def category_line(categories: Column) -> Column:
    return F.array_join(F.slice(categories, 1, 3), " · ")


def date_label(ts: Column) -> Column:
    """``Mar 5, 2024``."""
    return F.date_format(ts, "MMM d, yyyy")


def score_percent(score: Column) -> Column:
    return F.floor(score * 100 + 0.5).cast("int")


def score_bar(score: Column) -> Column:
    """Twelve cells, filled in proportion to the score."""
    filled = F.floor(score * 12 + 0.5).cast("int")
    return F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(12) - filled))


def tier_badge(tier: Column) -> Column:
    return F.when(tier.isin(TIERS), F.upper(tier)).otherwise("LOW")

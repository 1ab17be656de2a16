"""Bulk curation: metadata dump and code links to the labelled paper table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.authors import author_structs
from ..functions.dates import cast_updated_at, parse_submitted_at
from ..functions.text import clean_text, split_categories, strip_version
from ..operators.aggregates import links_per_paper
from ..operators.filters import official_links, target_filter
from ..operators.joins import attach_code_links


def dump_papers(dump: DataFrame) -> DataFrame:
    return dump.select(
        strip_version(F.col("id")).alias("arxiv_id"),
        clean_text(F.col("title")).alias("title"),
        clean_text(F.col("abstract")).alias("abstract"),
        split_categories(F.col("categories")).alias("categories"),
        parse_submitted_at(F.col("versions")).alias("submitted_at"),
        cast_updated_at(F.col("update_date")).alias("updated_at_api"),
        author_structs(F.col("authors_parsed")).alias("authors"),
    )


def curate(dump: DataFrame, links: DataFrame) -> DataFrame:
    """Target papers with repository and proxy label.

    The filters run in the scan stage. The only shuffle is that of the links, counted down to one
    row per paper first; the join needs another one only when the links are too large to broadcast.
    """
    return attach_code_links(
        target_filter(dump_papers(dump)), links_per_paper(official_links(links))
    )

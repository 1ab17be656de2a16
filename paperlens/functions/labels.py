"""Labels and lookup outcomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import CHECKED_NONE, STAR_THRESHOLD, UPVOTE_THRESHOLD
from .text import empty_to_null


def prelim_label(upvotes: Column) -> Column:
    """Early label from upvotes; NULL while the count is unknown."""
    return upvotes > UPVOTE_THRESHOLD


def star_label(stars: Column, label: Column) -> Column:
    """Ground truth where the star count is known, else the label as it was."""
    return F.when(stars.isNotNull(), stars > STAR_THRESHOLD).otherwise(label)


def has_code_from_repo(repo: Column) -> Column:
    return empty_to_null(repo).isNotNull()


def repo_stars(status: Column, stars: Column) -> Column:
    """Stars of a repository lookup: a missing repository has 0, any other failure is unknown."""
    return F.when(status == 200, F.coalesce(stars, F.lit(0))).when(status == 404, F.lit(0))


def paper_lookup(status: Column, paper_id: Column, upvotes: Column, repo: Column) -> Column:
    """Outcome of a paper lookup, NULL when it failed and the row must stay as it is."""
    found = status == 200
    repo = F.when(found, empty_to_null(repo))
    outcome = F.struct(
        F.when(found, paper_id).otherwise(CHECKED_NONE).alias("hf_paper_id"),
        F.when(found, F.coalesce(upvotes, F.lit(0))).alias("hf_upvotes"),
        repo.alias("hf_github_repo"),
        repo.isNotNull().alias("has_code"),
        F.when(found, prelim_label(F.coalesce(upvotes, F.lit(0)))).alias("hype_label"),
    )
    return F.when(status.isin(200, 404), outcome)

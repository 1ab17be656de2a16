"""Row filters. All are plain predicates, so they reach the parquet scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CHECKED_NONE,
    CURATION_START,
    LABEL_LAG_DAYS,
    MIN_CURRENT_ROWS,
    RECHECK_DAYS,
    TARGET_CATEGORIES,
)
from ..functions.dates import days_before
from ..functions.text import empty_to_null


def moment(as_of: str | datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def target_filter(df: DataFrame, start: str = CURATION_START) -> DataFrame:
    """Submitted since ``start`` in any target category; a NULL date drops the row."""
    wanted = F.array(*[F.lit(c) for c in TARGET_CATEGORIES])
    return df.filter(F.col("submitted_at") >= moment(start)).filter(
        F.arrays_overlap("categories", wanted)
    )


def official_links(links: DataFrame) -> DataFrame:
    return links.filter(F.col("is_official") & (F.col("paper_arxiv_id") != ""))


def drop_unlabeled(df: DataFrame, label: str = "hype_label") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def recent_window(df: DataFrame, as_of, days: int, column: str = "submitted_at") -> DataFrame:
    return df.filter(F.col(column) >= days_before(moment(as_of), days))


def paper_by_id(df: DataFrame, arxiv_id: str) -> DataFrame:
    return df.filter(F.col("arxiv_id") == arxiv_id).limit(1)


def since_cutoff(df: DataFrame, as_of, column: str = "submitted_at") -> DataFrame:
    """Rows since the start of the day before ``as_of``."""
    return df.filter(F.col(column) >= days_before(F.date_trunc("day", moment(as_of)), 1))


def date_range(df: DataFrame, first: str, last: str, column: str = "submitted_at") -> DataFrame:
    """Both days included. A half-open timestamp range, so the scan can prune on it."""
    end = moment(last) + F.make_interval(days=F.lit(1))
    return df.filter((F.col(column) >= moment(first)) & (F.col(column) < end))


def unhydrated(df: DataFrame, as_of, days: int = RECHECK_DAYS) -> DataFrame:
    """Recent papers never looked up, newest first."""
    recent = F.col("submitted_at") > days_before(moment(as_of), days)
    return df.filter(F.col("hf_paper_id").isNull() & recent).orderBy(
        F.desc("submitted_at"), "arxiv_id"
    )


def skip_lookup(df: DataFrame, as_of, days: int = RECHECK_DAYS) -> Column:
    """True where a lookup is pointless: already found, or absent and too old to appear."""
    known = empty_to_null(F.col("hf_paper_id"))
    found = known.isNotNull() & (known != CHECKED_NONE)
    too_old = known.eqNullSafe(CHECKED_NONE) & (F.col("submitted_at") < days_before(moment(as_of), days))
    return F.coalesce(found | too_old, F.lit(False))


def lookup_candidates(df: DataFrame, as_of, days: int = RECHECK_DAYS) -> DataFrame:
    return df.filter(~skip_lookup(df, as_of, days))


def pending_stars(df: DataFrame) -> DataFrame:
    """Papers with code whose star count is unknown."""
    return df.filter(F.col("has_code") & F.col("github_stars_t60").isNull())


def pending_authors(df: DataFrame) -> DataFrame:
    """Labelled papers whose author signals are unknown."""
    return df.filter(F.col("github_stars_t60").isNotNull() & F.col("max_h_index").isNull())


def label_eligible(df: DataFrame, as_of, days: int = LABEL_LAG_DAYS) -> DataFrame:
    """Papers with code, old enough for the ground-truth label and without it, newest first."""
    old = F.col("submitted_at") < days_before(moment(as_of), days)
    return pending_stars(df).filter(old).orderBy(F.desc("submitted_at"), "arxiv_id")


def enriched_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("max_h_index") > 0)


def tier_filter(df: DataFrame, tier: str | None) -> DataFrame:
    """Exact tier; none or empty keeps all, an unknown one keeps nothing."""
    return df.filter(F.col("hype_tier") == tier) if tier else df


def feed_search(df: DataFrame, query: str, names: str = "author_names") -> DataFrame:
    """Literal, case-insensitive substring of the title or of any author; blank keeps all."""
    wanted = query.strip().lower()
    if not wanted:
        return df
    in_title = F.contains(F.lower("title"), F.lit(wanted))
    in_author = F.exists(names, lambda a: F.contains(F.lower(a), F.lit(wanted)))
    return df.filter(in_title | in_author)


def has_min_rows(df: DataFrame, rows: int = MIN_CURRENT_ROWS) -> bool:
    """Whether there are at least ``rows`` rows; reads no more than that many."""
    return df.limit(rows).count() >= rows


def drop_blank_ids(df: DataFrame, column: str = "arxiv_id") -> DataFrame:
    return df.filter(empty_to_null(F.col(column)).isNotNull())


def is_in_ids(df: DataFrame, ids: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """Rows whose key is listed; the list is a DataFrame of any size."""
    return df.join(ids.select(key), key, "left_semi")

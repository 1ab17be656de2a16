"""Upserts and updates by key, one policy per column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import empty_to_null
from .joins import replace_matched

# What a conflict does with a column. Everything else keeps the stored value.
OVERWRITE = ["title", "abstract", "categories", "authors", "updated_at_api"]
NEW_ELSE_OLD = [
    "ss_paper_id", "citation_count", "max_h_index", "total_prior_papers", "has_code",
    "hf_paper_id", "hf_upvotes", "hf_github_repo", "hype_label", "enriched_at",
]
OLD_ELSE_NEW = ["github_stars_t60"]
EMPTY_IS_NULL = ["ss_paper_id", "hf_paper_id", "hf_github_repo"]


def one_row_per_key(incoming: DataFrame, key: str, order: str, overwrite=(), new_else_old=()) -> DataFrame:
    """What the rows of a key come to when they are applied one after the other in ``order``.

    An overwritten column has its last value, a new-else-old one its last known value, any other its
    first known value. Equal orders are told apart by a hash of the row.
    """
    at = F.struct(F.col(order), F.xxhash64(*incoming.columns))

    def value(name: str) -> Column:
        known = F.when(F.col(name).isNotNull(), at)
        if name in overwrite:
            return F.max_by(name, at)
        return F.max_by(name, known) if name in new_else_old else F.min_by(name, known)

    columns = [c for c in incoming.columns if c not in (key, order)]
    return incoming.groupBy(key).agg(*[value(c).alias(c) for c in columns])


def upsert(stored: DataFrame, incoming: DataFrame, key: str, order: str, overwrite=(), new_else_old=(),
           old_else_new=(), special: dict[str, Column] | None = None,
           counts: Observation | None = None) -> DataFrame:
    """Insert new keys, resolve known ones column by column. The stored side has one row per key.

    Incoming rows of the same key are first made one, in the order of their ``order`` column.
    Known keys are a left join from the stored side, so its wide rows stay where they are when the
    batch is small enough to broadcast; new keys are an anti join against the stored keys alone.
    Keys are unique on both sides, so none is frequent. Columns the incoming side lacks count as
    NULL. ``special`` columns refer to the sides as ``s`` and ``i``. ``counts`` observes the result as it is
    written: rows ``updated`` and ``inserted``, one for each key of the batch.
    """
    incoming = one_row_per_key(incoming, key, order, overwrite, new_else_old)
    matched = F.col(f"i.{key}").isNotNull()

    def resolve(name: str) -> Column:
        old = F.col(f"s.{name}")
        if special and name in special:
            return special[name]
        if name not in incoming.columns or name == key:
            return old
        new = F.col(f"i.{name}")
        if name in overwrite:
            return F.when(matched, new).otherwise(old)
        if name in new_else_old:
            return F.coalesce(new, old)
        if name in old_else_new:
            return F.coalesce(old, new)
        return old

    def typed(name: str, value: Column) -> Column:
        return value.cast(stored.schema[name].dataType).alias(name)

    known = stored.alias("s").join(
        incoming.alias("i"), F.col(f"s.{key}") == F.col(f"i.{key}"), "left"
    ).select(*[typed(c, resolve(c)) for c in stored.columns], matched.alias("_updated"))
    added = incoming.join(stored.select(key), key, "left_anti").select(
        *[typed(c, F.col(c) if c in incoming.columns else F.lit(None)) for c in stored.columns],
        F.lit(None).cast("boolean").alias("_updated"),
    )
    merged = known.unionByName(added)
    if counts is not None:
        merged = merged.observe(
            counts, F.count_if("_updated").alias("updated"), F.count_if(F.col("_updated").isNull()).alias("inserted"))
    return merged.drop("_updated")


def upsert_papers(stored: DataFrame, incoming: DataFrame, order: str, as_of: Column | None = None,
                  protect_t60: bool = False, counts: Observation | None = None) -> DataFrame:
    """Daily ingest into the paper table. Applying the same batch twice changes nothing.

    ``order`` names the incoming column by which copies of a paper are applied one after the other.
    New rows get ``as_of`` as their ``ingested_at``. With ``protect_t60`` a label that comes from
    a known star count is not replaced by the early label of a later ingest.
    """
    incoming = incoming.withColumns(
        {c: empty_to_null(F.col(c)) for c in EMPTY_IS_NULL if c in incoming.columns}
    )
    if as_of is not None and "ingested_at" in stored.columns:
        incoming = incoming.withColumn("ingested_at", as_of)
    special = {}
    if protect_t60 and "hype_label" in incoming.columns:
        special["hype_label"] = F.when(
            F.col("s.github_stars_t60").isNotNull(), F.col("s.hype_label")
        ).otherwise(F.coalesce("i.hype_label", "s.hype_label"))
    return upsert(stored, incoming, "arxiv_id", order, OVERWRITE, NEW_ELSE_OLD, OLD_ELSE_NEW, special, counts)


def ingest(stored: DataFrame, incoming: DataFrame, order: str, write: Callable[[DataFrame], None],
           as_of: Column | None = None, protect_t60: bool = False) -> dict[str, int]:
    """``write`` the merged table and return what came of the batch, counted in the same pass.

    Rows without an id fail and are left out; ``upserted`` are the papers ``inserted`` and ``updated``.
    """
    usable = F.coalesce(F.trim("arxiv_id") != "", F.lit(False))
    counts, failed = Observation(), Observation()
    kept = incoming.observe(failed, F.count_if(~usable).alias("failed")).filter(usable)
    write(upsert_papers(stored, kept, order, as_of, protect_t60, counts))
    made = counts.get
    return {"upserted": made["updated"] + made["inserted"], **made, "failed": failed.get["failed"]}


def _update(papers: DataFrame, changes: DataFrame, columns: list[str], order: str, key: str) -> DataFrame:
    new = changes.select(key, F.struct(*columns).alias("_new"), F.col(order).alias("_order"))
    return replace_matched(papers, new, columns, "_order", key)


def update_lookup_fields(papers: DataFrame, outcomes: DataFrame, order: str) -> DataFrame:
    """Set the five lookup columns of the listed papers, NULLs included; the last outcome counts."""
    columns = ["hf_paper_id", "hf_upvotes", "hf_github_repo", "has_code", "hype_label"]
    return _update(papers, outcomes, columns, order, "arxiv_id")


def update_labels(papers: DataFrame, labels: DataFrame, order: str) -> DataFrame:
    """Set star count and label of the listed papers; the last label counts."""
    return _update(papers, labels, ["github_stars_t60", "hype_label"], order, "arxiv_id")


def backfill_columns(papers: DataFrame, values: DataFrame, order: str, key: str = "arxiv_id") -> DataFrame:
    """Add the columns of ``values`` the papers lack, as NULL, then fill the listed keys with the last values."""
    return _update(papers, values, [c for c in values.columns if c not in (key, order)], order, key)

"""Structured Streaming jobs over landed files.

Each job takes a streaming DataFrame, applies one of the merge operators to every micro-batch and
replaces the touched months of the paper table. Merges are idempotent, so a replayed batch does no
harm. Empty batches, which a watermark produces, are skipped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..constants import INGEST_PRIORITY
from ..functions.dates import submitted_month
from ..functions.labels import paper_lookup, repo_stars, star_label
from ..operators.aggregates import dedup_first, dedup_last
from ..operators.merge import update_labels, update_lookup_fields, upsert_papers
from ..sources.readers import feed_papers
from ..sources.snapshots import PaperTable


def stream_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of feed pages as they land."""
    return (
        spark.readStream.format("xml").schema(schemas.FEED_ENTRY)
        .option("rowTag", "entry").option("mode", "FAILFAST").load(path)
    )


def stream_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).json(path)


def stream_dedup(papers: DataFrame, key: str = "arxiv_id", landed: str = "landed_at",
                 delay: str = "7 days") -> DataFrame:
    """Each key once among what lands within ``delay``; the state of a key is dropped after that.

    The watermark runs on the time of arrival: a back-fill of old papers is as new as anything else.
    """
    return papers.withWatermark(landed, delay).dropDuplicatesWithinWatermark([key])


def stream_preferred(papers: DataFrame, rank: Column, key: str = "arxiv_id", landed: str = "landed_at",
                     delay: str = "1 hour") -> DataFrame:
    """Of the copies of a key that land less than ``delay`` after one another, that of the lowest ``rank``.

    Copies may come in different micro-batches: what is kept of a key is its best copy so far, and it
    comes out when ``delay`` has passed without another. Equal ranks go by arrival, a NULL rank is the last.

    Rows go to the partition of their key as they are: sessions are made by sorting, so a task sorts the rows
    of one partition and not, before the shuffle, those of a whole input split.
    """
    order = F.struct(rank.isNull().alias("unranked"), rank.alias("rank"), F.col(landed).alias("at"))
    best = F.min_by(F.struct(*papers.columns), order)
    return (
        papers.withWatermark(landed, delay).repartition(key).groupBy(F.session_window(landed, delay), key)
        .agg(best.alias("_best")).select("_best.*")
    )


def category_rank(column: str = "fetch_category") -> Column:
    """Place of a category in fetch order; NULL for others."""
    return F.nullif(F.array_position(F.array(*map(F.lit, INGEST_PRIORITY)), F.col(column)), F.lit(0))


def _run(changes: DataFrame, checkpoint: str, name: str,
         apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        changes.writeStream.queryName(name).foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _publish(table: PaperTable, batch: DataFrame,
             merge: Callable[[DataFrame, DataFrame], DataFrame], inserts: bool) -> None:
    batch = batch.persist()
    try:
        if batch.isEmpty():
            return
        months = set(table.touched_months(batch))
        if inserts:
            new = batch.select(submitted_month(F.col("submitted_at"))).distinct().collect()
            months |= {r[0] for r in new}
        if months:
            stored = table.read(sorted(months)).drop("submitted_month")
            table.replace_months(merge(stored, batch), batch)
    finally:
        batch.unpersist()


def ingest_stream(papers: DataFrame, table: PaperTable, checkpoint: str,
                  enrich: Callable[[DataFrame], DataFrame] | None = None,
                  name: str = "ingest", protect_t60: bool = False, as_of: str | None = None) -> StreamingQuery:
    """Paper rows into the table. Of several copies that of the first category in fetch order counts.

    The category a row was fetched for is in ``fetch_category``; rows without one, or of another
    category, come after the listed ones. Copies in one micro-batch are compared here; pass the stream
    through ``stream_preferred`` first where they may come in several. ``as_of`` is the time of ingest, by default the present one.
    """
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()

    def apply(batch: DataFrame, number: int) -> None:
        order = category_rank() if "fetch_category" in batch.columns else F.lit(None).cast("long")
        once = dedup_first(batch.withColumn("_order", order), "arxiv_id", "_order")
        once = once.drop("_order", "fetch_category")
        once = enrich(once) if enrich else once
        if "enriched_at" not in once.columns:
            once = once.withColumn("enriched_at", now)

        def merge(stored, incoming):
            return upsert_papers(stored, incoming.withColumn("_pos", F.lit(0)), "_pos", now, protect_t60)

        _publish(table, once, merge, True)

    return _run(papers, checkpoint, name, apply)


def ingest_feed(spark: SparkSession, path: str, table: PaperTable, checkpoint: str,
                enrich: Callable[[DataFrame], DataFrame] | None = None, as_of: str | None = None) -> StreamingQuery:
    """Landed feed pages into the table; pages of a category lie in a folder of its name.

    A page outside such a folder counts for the first category of each entry that the ingest lists.
    """
    entries = stream_feed(spark, path)
    wanted = F.array(*map(F.lit, INGEST_PRIORITY))
    folder = F.get(F.filter(
        wanted, lambda c: F.contains(F.col("_metadata.file_path"), F.concat(F.lit("/"), c, F.lit("/")))), F.lit(0))
    papers = feed_papers(entries.withColumn("fetch_category", folder), ("fetch_category",))
    listed = F.get(F.array_intersect(wanted, F.col("categories")), F.lit(0))
    papers = papers.withColumn("fetch_category", F.coalesce("fetch_category", listed))
    return ingest_stream(papers, table, checkpoint, enrich, as_of=as_of)


def lookup_outcomes(lookups: DataFrame) -> DataFrame:
    """Usable paper lookups, the best answer per paper; failures leave the row as it is."""
    outcome = paper_lookup(
        F.col("status"), F.col("arxiv_id"), F.col("body.upvotes"), F.col("body.githubRepo")
    )
    usable = lookups.select("arxiv_id", "status", outcome.alias("o")).filter(F.col("o").isNotNull())
    return dedup_first(usable, "arxiv_id", "status").select("arxiv_id", "o.*")


def label_outcomes(lookups: DataFrame) -> DataFrame:
    """Star counts and labels of usable repository lookups, the highest count per paper."""
    stars = repo_stars(F.col("status"), F.col("body.stargazers_count"))
    usable = lookups.select("arxiv_id", stars.alias("github_stars_t60")).filter(
        F.col("github_stars_t60").isNotNull()
    )
    once = dedup_last(usable, "arxiv_id", "github_stars_t60")
    label = star_label(F.col("github_stars_t60"), F.lit(None).cast("boolean"))
    return once.withColumn("hype_label", label)


def _in_order(update: Callable[[DataFrame, DataFrame, str], DataFrame]):
    """Outcomes have one row per paper already: any order will do."""
    return lambda stored, changes: update(stored, changes, "_pos")


def backfill_stream(lookups: DataFrame, table: PaperTable, checkpoint: str,
                    name: str = "backfill") -> StreamingQuery:
    """Paper lookups into the lookup columns."""

    def apply(batch: DataFrame, number: int) -> None:
        _publish(table, lookup_outcomes(batch).withColumn("_pos", F.lit(0)), _in_order(update_lookup_fields), False)

    return _run(lookups, checkpoint, name, apply)


def label_stream(lookups: DataFrame, table: PaperTable, checkpoint: str,
                 name: str = "labels") -> StreamingQuery:
    """Repository lookups into star counts and ground-truth labels."""

    def apply(batch: DataFrame, number: int) -> None:
        _publish(table, label_outcomes(batch).withColumn("_pos", F.lit(0)), _in_order(update_labels), False)

    return _run(lookups, checkpoint, name, apply)

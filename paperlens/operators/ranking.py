"""Ordering, limits, pages and request batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import (
    CLIENT_LIMIT,
    CLIENT_MAX_DAYS,
    FEED_DAYS,
    FEED_LIMIT,
    FEED_MAX_LIMIT,
    PAGE_SIZE,
    TIERS,
)
from ..session import store
from .aggregates import latest_sample
from .filters import recent_window, tier_filter
from .trees import TreeModel, score_papers


def recent_topn(papers: DataFrame, as_of, days: int | None = None, limit: int | None = None) -> DataFrame:
    """Newest papers of the window. Each task keeps ``limit`` rows; nothing is sorted as a whole.

    The result is one partition anyway. Saying so keeps the planner from moving later projections
    below the limit, where they would run on every row and turn the top-n into a full sort.
    """
    days = days if days and days > 0 else FEED_DAYS
    limit = min(limit, FEED_MAX_LIMIT) if limit and limit > 0 else FEED_LIMIT
    recent = recent_window(papers, as_of, days)
    return recent.orderBy(F.desc("submitted_at"), "arxiv_id").limit(limit).coalesce(1)


def ranked_feed(papers: DataFrame, model: TreeModel, as_of, days: int | None = None,
                limit: int | None = None, tier: str | None = None, text_unit: str = "chars") -> DataFrame:
    """Newest papers, scored, then filtered by tier, best first: a tier may leave fewer than ``limit``."""
    scored = score_papers(recent_topn(papers, as_of, days, limit), model, text_unit)
    return tier_filter(scored, tier).orderBy(F.desc("hype_score"), "arxiv_id")


def feed_page(feed: DataFrame, page: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """One page of a ranked feed, which its limit keeps at 200 rows or fewer; late pages clamp."""
    order = Window.orderBy(F.desc("hype_score"), "arxiv_id")
    placed = feed.withColumn("position", F.row_number().over(order)).withColumn(
        "pages", F.greatest(F.lit(1), F.ceil(F.count("*").over(Window.partitionBy()) / size)).cast("int")
    )
    wanted = F.least(F.lit(page), F.col("pages"))
    return placed.filter(F.ceil(F.col("position") / size) == wanted).withColumn("page", wanted)


def client_feed_args(days: int | None = None, tier: str | None = None) -> dict:
    """Arguments as the feed page sends them: at most 90 days, 100 rows, unknown tiers mean all."""
    return {
        "days": min(days or FEED_DAYS, CLIENT_MAX_DAYS),
        "limit": CLIENT_LIMIT,
        "tier": tier if tier in TIERS else None,
    }


def drift_rank(series: DataFrame, as_of, days: int = 14, feature: str = "feature",
               ts: str = "ts", value: str = "value") -> DataFrame:
    """Latest drift of every feature, highest first."""
    latest = latest_sample(series, as_of, [feature], days, ts, value)
    return latest.orderBy(F.desc("value"), feature)


def topk_per_time(series: DataFrame, k: int = 8, ts: str = "ts", feature: str = "feature",
                  value: str = "value") -> DataFrame:
    """The ``k`` largest series at every time. Tasks keep ``k`` rows per time before the shuffle."""
    order = Window.partitionBy(ts).orderBy(F.desc(value), feature)
    return series.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).drop("_rank")


def head_pending(pending: DataFrame, n: int, key: str = "arxiv_id") -> DataFrame:
    """The first ``n`` rows by key: a page of a request queue, which its limit keeps small."""
    return pending.orderBy(key).limit(n)


def chunk_requests(ids: DataFrame, size: int, key: str = "arxiv_id", chunks_a_bucket: int = 64) -> DataFrame:
    """Distinct ids in request batches of exactly ``size``, in the order of the ids, the last one smaller: ``(chunk, ids)``.

    Ids lie in ranges, some batches large each, which are stored with their numbers. Each range is numbered
    through from the number of ids in those before it: no task sees more than a range. ``chunk`` counts from 0.
    """
    distinct = ids.select(F.col(key).alias("id")).filter(F.col("id").isNotNull()).distinct()
    # The number of ranges follows the number of ids, which the sketch behind it bounds to a few percent.
    about = ids.agg(F.approx_count_distinct(key)).first()[0]
    buckets = max(1, about // (size * chunks_a_bucket))
    ranged = distinct.repartitionByRange(buckets, "id").withColumn("bucket", F.spark_partition_id())
    held = store(ranged, "buckets")
    # One narrow row for each range.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.groupBy("bucket").agg(F.count("*").alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.col("first") + F.row_number().over(Window.partitionBy("bucket").orderBy("id")) - 1
    placed = held.join(F.broadcast(starts), "bucket").select(F.floor(place / size).alias("chunk"), "id")
    return placed.groupBy("chunk").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def best_trial(runs: DataFrame, metric: str = "val_pr_auc") -> DataFrame:
    """The run with the highest objective ``metric``, compared in full; the first of equals."""
    values = runs.filter((F.col("kind") == "objective") & (F.col("key") == metric)).select(
        "run_id", F.col("value").cast("double").alias("value")
    )
    return values.agg(
        F.min_by("run_id", F.struct(-F.col("value"), F.col("run_id"))).alias("run_id"),
        F.max("value").alias(metric),
    )


def top_features(spark: SparkSession, importances: dict[str, float], k: int = 5) -> DataFrame:
    """The ``k`` most important features, to four digits."""
    rows = spark.createDataFrame(list(importances.items()), "feature string, importance double")
    return rows.select("feature", F.round("importance", 4).alias("importance")).orderBy(
        F.desc("importance"), "feature"
    ).limit(k)

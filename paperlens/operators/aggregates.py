"""Grouped results. Every aggregate combines map-side, so a frequent key costs one row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import STAR_THRESHOLD
from ..functions.dates import days_before
from .cumulative import quantiles
from .filters import moment


def links_per_paper(links: DataFrame) -> DataFrame:
    """One repository per paper: the smallest URL, so that reruns agree."""
    return links.groupBy(F.col("paper_arxiv_id").alias("arxiv_id")).agg(
        F.min("repo_url").alias("hf_github_repo")
    )


def seed_summary(papers: DataFrame, label: str = "hype_label") -> DataFrame:
    positive = F.coalesce(F.sum(F.col(label).cast("int")), F.lit(0))
    return papers.agg(F.count("*").alias("total"), positive.alias("positive")).select(
        "total",
        "positive",
        (F.col("total") - F.col("positive")).alias("negative"),
        F.try_divide("positive", "total").alias("positive_rate"),
    ).withColumn("negative_rate", 1 - F.col("positive_rate"))


def class_balance(labeled: DataFrame, label: str = "label") -> DataFrame:
    """Class counts, shares in percent, and whether the positives are fewer than a tenth."""
    return labeled.agg(
        F.count("*").alias("total"),
        F.coalesce(F.sum(F.col(label).cast("int")), F.lit(0)).alias("positive"),
    ).select(
        "total",
        "positive",
        (F.col("total") - F.col("positive")).alias("negative"),
        (100 * F.try_divide("positive", "total")).alias("positive_pct"),
        (F.try_divide("positive", "total") < 0.10).alias("imbalanced"),
    ).withColumn("negative_pct", 100 - F.col("positive_pct"))


def author_signals_agg(pairs: DataFrame, paper: str = "paper_id") -> DataFrame:
    """Per paper: highest h-index and summed paper counts; unknown authors count 0, repeats count."""
    return pairs.groupBy(paper).agg(
        F.max(F.coalesce("h_index", F.lit(0))).cast("int").alias("max_h_index"),
        F.sum(F.coalesce("paper_count", F.lit(0))).cast("int").alias("total_prior_papers"),
    )


def distinct_authors(papers: DataFrame, ids: str = "author_ids") -> DataFrame:
    """Author ids over all papers, once each, empty ones left out."""
    return papers.select(F.explode(ids).alias("author_id")).filter(
        F.col("author_id") != ""
    ).distinct()


def _one_per_key(df: DataFrame, key: str, order) -> DataFrame:
    """The first row of each key by ``order``; equal orders are told apart by a hash of the row.

    Every task keeps one row of a key before the shuffle, so a frequent key costs one row per task.
    """
    ranked = Window.partitionBy(key).orderBy(order, F.xxhash64(*df.columns))
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def dedup_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the smallest ``order`` of each key; NULL orders come last."""
    return _one_per_key(df, key, F.asc_nulls_last(order))


def dedup_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the largest ``order`` of each key; NULL orders come last."""
    return _one_per_key(df, key, F.desc_nulls_last(order))


def label_backfill_summary(papers: DataFrame) -> DataFrame:
    """Progress and outcome of the star back-fill."""
    stars, code = F.col("github_stars_t60"), F.col("has_code")
    return papers.agg(
        F.count_if(code & stars.isNotNull()).alias("already_labeled"),
        F.count_if(code & stars.isNull()).alias("pending"),
        F.count_if(~code).alias("no_repo"),
        F.count_if(stars.isNotNull()).alias("labeled"),
        F.count_if(stars > STAR_THRESHOLD).alias("positive"),
        F.count_if(stars <= STAR_THRESHOLD).alias("negative"),
        F.count_if(stars.isNull() & code).alias("proxy_labeled"),
    )


def author_backfill_summary(papers: DataFrame) -> DataFrame:
    """Progress of the author back-fill, with median and 90th percentile of the enriched rows.

    The percentiles are exact with linear interpolation and made from stored counts of values.
    """
    labeled = F.col("github_stars_t60").isNotNull()
    enriched = F.col("max_h_index").isNotNull()
    counts = papers.agg(
        F.count_if(labeled).alias("labeled"),
        F.count_if(labeled & enriched).alias("already_enriched"),
        F.count_if(labeled & ~enriched).alias("pending"),
        F.count_if(enriched).alias("enriched"),
    )
    found = quantiles(papers.filter(enriched), ["max_h_index", "total_prior_papers"], [0.5, 0.9])

    def value(feature: str, place: int):
        return F.max(F.when(F.col("feature") == feature, F.get("q", F.lit(place))))

    shown = found.agg(F.struct(
        value("max_h_index", 0).alias("h_index_p50"), value("max_h_index", 1).alias("h_index_p90"),
        value("total_prior_papers", 0).alias("prior_papers_p50"), value("total_prior_papers", 1).alias("prior_papers_p90"),
    ))
    return counts.withColumn("_q", shown.scalar()).select(*counts.columns, "_q.*")


def scale_pos_weight(labeled: DataFrame, label: str = "label") -> DataFrame:
    """Negatives per positive, to two digits; NULL without a positive."""
    positive = F.sum(F.col(label).cast("int"))
    return labeled.agg(
        F.round(F.try_divide(F.count("*") - positive, positive), 2).alias("scale_pos_weight")
    )


def mean_score(scored: DataFrame, score: str = "hype_score") -> DataFrame:
    return scored.agg(F.avg(score).alias("mean_score"))


def ingest_counts(papers: DataFrame) -> DataFrame:
    """Rows per category, and the number of distinct papers as category ``total``.

    One scan: every paper gives a row for each category, and one with its id and no category. Ids are
    made unique by a shuffle on the id, never in one task.
    """
    entry = F.struct(F.lit(False).alias("whole"), F.lit(None).cast("string").alias("category"))
    listed = F.transform(
        F.coalesce("categories", F.array().cast("array<string>")),
        lambda c: F.struct(F.lit(False).alias("whole"), c.alias("category")),
    )
    rows = papers.select("arxiv_id", F.explode(F.concat(listed, F.array(entry.withField("whole", F.lit(True))))).alias("e"))
    rows = rows.select("e.*", F.when(F.col("e.whole"), F.col("arxiv_id")).alias("id"))
    counts = rows.groupBy("whole", "category", "id").agg(F.count("*").alias("rows"))
    return counts.groupBy("whole", "category").agg(
        F.sum(F.when(F.col("whole"), 1).otherwise(F.col("rows"))).alias("papers")
    ).select(F.when(F.col("whole"), "total").otherwise(F.col("category")).alias("category"), "papers")


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, one row each: a single pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "feature", "nulls")


def latest_sample(series: DataFrame, as_of, keys: list[str], days: int = 14,
                  ts: str = "ts", value: str = "value") -> DataFrame:
    """Newest value of each series within the last ``days`` days."""
    now = moment(as_of)
    recent = series.filter((F.col(ts) > days_before(now, days)) & (F.col(ts) <= now))
    return recent.groupBy(*keys).agg(
        F.max_by(value, ts).alias("value"), F.max(ts).alias("ts")
    )


def label_cardinality(df: DataFrame, label: str = "label") -> DataFrame:
    """Number of distinct labels, and whether sampling by label makes sense."""
    return df.agg(F.count_distinct(label).alias("labels")).withColumn(
        "stratify", F.col("labels") > 1
    )

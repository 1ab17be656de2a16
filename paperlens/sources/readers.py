"""Sources. Schemas are explicit, so scans prune columns and never infer."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.authors import struct_names
from ..functions.dates import days_before, submitted_month
from ..functions.text import clean_text, empty_to_null, extract_paper_id


def read_metadata_dump(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """NDJSON dump. A malformed line becomes an all-NULL row; ``corrupt`` names a column for its text."""
    schema = schemas.METADATA_DUMP + (f", {corrupt} string" if corrupt else "")
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.json(path)


def read_code_links(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CODE_LINKS).parquet(path)


def read_papers(spark: SparkSession, *paths: str) -> DataFrame:
    """Curated or labelled papers; the columns are those of the files."""
    return spark.read.parquet(*paths)


def read_papers_window(papers: DataFrame, as_of, days: int) -> DataFrame:
    """Papers of the last ``days`` days with the enrichment flag derived.

    On a table partitioned by ``submitted_month`` only the months of the window are listed.
    """
    since = days_before(F.lit(as_of).cast("timestamp"), days)
    if "submitted_month" in papers.columns:
        papers = papers.filter(F.col("submitted_month") >= submitted_month(since))
    return papers.filter(F.col("submitted_at") >= since).withColumn(
        "has_author_enrichment", F.col("max_h_index").isNotNull()
    )


def day_predicates(as_of: datetime, days: int) -> list[str]:
    """One condition per day of the window, the last one open, in standard SQL."""
    starts = [as_of - timedelta(days=days - i) for i in range(days)]
    texts = [s.strftime("TIMESTAMP '%Y-%m-%d %H:%M:%S'") for s in starts]
    closed = [f"submitted_at >= {a} AND submitted_at < {b}" for a, b in zip(texts, texts[1:])]
    return [*closed, f"submitted_at >= {texts[-1]}"]


def read_papers_jdbc(spark: SparkSession, url: str, table: str, as_of: datetime, days: int,
                     **properties: str) -> DataFrame:
    """The same window from a database, read by one task per day."""
    rows = spark.read.jdbc(url, table, predicates=day_predicates(as_of, days), properties=properties)
    return rows.withColumn("has_author_enrichment", F.col("max_h_index").isNotNull())


def feed_papers(entries: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feed entries to paper rows; entries without a usable identifier are skipped. ``keep`` names more columns."""
    return entries.select(
        *keep,
        extract_paper_id(F.col("id")).alias("arxiv_id"),
        clean_text(F.col("title"), True).alias("title"),
        clean_text(F.col("summary"), True).alias("abstract"),
        F.coalesce(F.col("category._term"), F.array().cast("array<string>")).alias("categories"),
        F.coalesce(
            F.transform(
                "author", lambda a: F.struct(clean_text(a.getField("name"), True).alias("name"))
            ),
            F.array().cast("array<struct<name: string>>"),
        ).alias("authors"),
        F.col("published").cast("timestamp").alias("submitted_at"),
        F.col("updated").cast("timestamp").alias("updated_at_api"),
    ).filter(empty_to_null(F.col("arxiv_id")).isNotNull())


def read_feed_entries(spark: SparkSession, path: str) -> DataFrame:
    """Raw entries of landed feed pages; malformed XML is an error."""
    return (
        spark.read.format("xml").schema(schemas.FEED_ENTRY)
        .option("rowTag", "entry").option("mode", "FAILFAST").load(path)
    )


def read_atom_pages(spark: SparkSession, path: str) -> DataFrame:
    return feed_papers(read_feed_entries(spark, path))


def read_feed_totals(spark: SparkSession, path: str) -> DataFrame:
    """``total_results`` announced by each feed page."""
    return (
        spark.read.format("xml").schema("totalResults int")
        .option("rowTag", "feed").option("ignoreNamespace", "true").option("mode", "FAILFAST")
        .load(path).select(F.col("totalResults").alias("total_results"))
    )


def read_paper_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAPER_BATCH).json(path)


def read_author_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.AUTHOR_BATCH).json(path)


def daily_papers(entries: DataFrame) -> DataFrame:
    """Featured papers with their place ``pos``; entries without an id are dropped, missing counts are 0."""
    return entries.select(
        "pos",
        F.col("paper.id").alias("arxiv_id"),
        F.coalesce(F.col("paper.upvotes"), F.lit(0)).alias("upvotes"),
        F.coalesce(F.col("paper.githubRepo"), F.lit("")).alias("github_repo"),
    ).filter(empty_to_null(F.col("arxiv_id")).isNotNull())


def read_daily_feed(spark: SparkSession, path: str) -> DataFrame:
    """Featured papers; ``pos`` orders entries by file, then by their place in it."""
    entries = spark.read.schema(schemas.DAILY_ENTRY).json(path)
    file = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"))
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return daily_papers(entries.withColumn("pos", F.struct(file.alias("file"), place.alias("place"))))


def read_paper_lookups(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAPER_LOOKUP).json(path)


def read_repo_lookups(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REPO_LOOKUP).json(path)


def read_metric_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METRICS).parquet(path)


def with_author_names(papers: DataFrame) -> DataFrame:
    """Serving rows carry plain author names."""
    return papers.withColumn("author_names", struct_names(F.col("authors"))).drop("authors")

"""Streaming jobs, run to the end of what has landed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import INGEST_PRIORITY
from ..session import work_dir
from ..sources.snapshots import PaperTable
from ..streaming import jobs
from . import check
from .bindings import SI, stamp, stored_incoming, table
from .files import lookup_rows
from .merges import MERGED

COLUMNS = ["arxiv_id", "title", "citation_count", "hf_paper_id", "has_code", "github_stars_t60", "hype_label"]


@check("SELECT event_id, event_type, user_id FROM events")
def stream_dedup(spark, sf):
    """Events in three micro-batches, the newest first, some of them twice: each comes out once."""
    stored = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    landed, out = work_dir(spark, "landed"), work_dir(spark, "once")
    cuts = stored.agg(F.expr("percentile(unix_micros(ts), array(0.33, 0.66))")).first()[0]
    age = F.when(F.unix_micros("ts") > cuts[1], 0).when(F.unix_micros("ts") > cuts[0], 1).otherwise(2)
    for part in range(3):
        some = stored.filter((age == part) | ((F.col("value") > 50) & (age < part)))
        some.coalesce(1).write.mode("append").parquet(landed)
    arriving = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    arriving = arriving.withColumn("landed_at", F.col("_metadata.file_modification_time"))
    once = jobs.stream_dedup(arriving, "event_id")
    query = (
        once.writeStream.format("parquet").option("checkpointLocation", work_dir(spark, "checkpoint"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return spark.read.schema(once.schema).parquet(out).select("event_id", "event_type", "user_id")


FIRST_CATEGORY = """WITH copies AS (
  SELECT event_id AS arxiv_id, user_id % 4 AS place, CASE user_id % 4 WHEN 0 THEN 'cs.LG' WHEN 1 THEN 'cs.CL'
    WHEN 2 THEN 'cs.CV' ELSE 'math.CO' END AS fetch_category, value FROM events
  UNION ALL
  SELECT event_id, (user_id + 1) % 4, CASE (user_id + 1) % 4 WHEN 0 THEN 'cs.LG' WHEN 1 THEN 'cs.CL'
    WHEN 2 THEN 'cs.CV' ELSE 'math.CO' END, value + 1000 FROM events WHERE event_id % 3 = 0),
"""


@check(FIRST_CATEGORY + """ranked AS (
  SELECT *, CASE fetch_category {places} END AS rank FROM copies)
SELECT arxiv_id, fetch_category, value FROM ranked
QUALIFY row_number() OVER (PARTITION BY arxiv_id ORDER BY rank NULLS LAST) = 1
""".replace("{places}", " ".join(f"WHEN '{c}' THEN {n}" for n, c in enumerate(INGEST_PRIORITY, 1))))
def stream_preferred(spark, sf):
    """Papers fetched for two categories in two micro-batches, half an hour apart: the first category counts."""
    events = table(spark, sf, "events")
    names = F.array(*map(F.lit, ["cs.LG", "cs.CL", "cs.CV", "math.CO"]))
    landed = work_dir(spark, "landed")

    def land(rows, turn, shift, at):
        rows.select(
            F.col("event_id").alias("arxiv_id"), F.get(names, ((F.col("user_id") + turn) % 4).cast("int")).alias("fetch_category"),
            (F.col("value") + shift).alias("value"), F.lit(at).cast("timestamp").alias("landed_at"),
        ).coalesce(1).write.mode("append").parquet(landed)

    land(events, 0, 0, "2024-03-01 10:00:00")
    land(events.filter("event_id % 3 = 0"), 1, 1000, "2024-03-01 10:30:00")
    # A later arrival moves the time on, so that what came before is complete.
    land(events.limit(1).withColumn("event_id", F.lit(-1).cast("long")), 0, 0, "2024-03-02 10:00:00")
    schema = "arxiv_id long, fetch_category string, value double, landed_at timestamp"
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    best = jobs.stream_preferred(arriving, jobs.category_rank())
    out = work_dir(spark, "preferred")
    best.writeStream.format("parquet").option("checkpointLocation", work_dir(spark, "checkpoint")).trigger(
        availableNow=True).start(out).awaitTermination()
    return spark.read.schema(schema).parquet(out).filter("arxiv_id >= 0").drop("landed_at")


def stored_table(spark, sf) -> PaperTable:
    held = PaperTable(spark, work_dir(spark, "papers"))
    held.replace_months(stored_incoming(spark, sf)[0])
    return held


@check(SI + MERGED.format(label="coalesce(i.hype_label, s.hype_label)"))
def ingest_stream(spark, sf):
    held = stored_table(spark, sf)
    landed = work_dir(spark, "landed")
    batch = stored_incoming(spark, sf)[1]
    batch.write.parquet(landed)
    arriving = spark.readStream.schema(batch.schema).parquet(landed)
    jobs.ingest_stream(arriving, held, work_dir(spark, "checkpoint")).awaitTermination()
    return held.read().select(*COLUMNS, stamp("submitted_at"))


def land(spark, sf, body: str) -> str:
    path = work_dir(spark, "landed")
    lookup_rows(spark, sf).select("arxiv_id", "status", F.col(body).alias("body")).write.json(path)
    return path


@check(SI + """, l AS (SELECT cast(o_orderkey AS VARCHAR) AS arxiv_id, o_orderkey % 3 AS k, o_custkey, o_orderstatus FROM orders)
SELECT s.arxiv_id, s.title, s.citation_count,
  CASE k WHEN 0 THEN l.arxiv_id WHEN 1 THEN 'checked_none' ELSE s.hf_paper_id END AS hf_paper_id,
  CASE WHEN k = 0 THEN cast(o_custkey % 12 AS INT) END AS hf_upvotes,
  CASE k WHEN 0 THEN o_orderstatus <> 'F' WHEN 1 THEN false ELSE s.has_code END AS has_code,
  s.github_stars_t60,
  CASE k WHEN 0 THEN o_custkey % 12 > 5 WHEN 1 THEN NULL ELSE s.hype_label END AS hype_label
FROM s JOIN l ON s.arxiv_id = l.arxiv_id
""")
def backfill_stream(spark, sf):
    from ..schemas import PAPER_LOOKUP

    held = stored_table(spark, sf)
    arriving = jobs.stream_json(spark, land(spark, sf, "paper"), PAPER_LOOKUP)
    jobs.backfill_stream(arriving, held, work_dir(spark, "checkpoint")).awaitTermination()
    return held.read().select(*COLUMNS, "hf_upvotes")


@check(SI + """, l AS (SELECT cast(o_orderkey AS VARCHAR) AS arxiv_id, o_orderkey % 3 AS k, o_custkey FROM orders)
SELECT s.arxiv_id, s.title, s.citation_count, s.hf_paper_id, s.has_code,
  CASE k WHEN 0 THEN cast(o_custkey % 300 AS INT) WHEN 1 THEN 0 ELSE s.github_stars_t60 END AS github_stars_t60,
  CASE k WHEN 0 THEN o_custkey % 300 > 100 WHEN 1 THEN false ELSE s.hype_label END AS hype_label
FROM s JOIN l ON s.arxiv_id = l.arxiv_id
""")
def label_stream(spark, sf):
    from ..schemas import REPO_LOOKUP

    held = stored_table(spark, sf)
    arriving = jobs.stream_json(spark, land(spark, sf, "repo"), REPO_LOOKUP)
    jobs.label_stream(arriving, held, work_dir(spark, "checkpoint")).awaitTermination()
    return held.read().select(*COLUMNS)

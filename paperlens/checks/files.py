"""Sources and sinks: tables written to the shared work folder in a landed form and read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators.trees import read_tree_model as load_trees
from ..operators.trees import score_papers
from ..session import work_dir
from ..sources import readers, writers
from . import check
from .bindings import FEATURE_LIST, PF, PS, SERIES, P, papers, rounded, series, stamp, table, toy_model
from .filters import LINKS, links
from .joins import PAIRS, author_batches, dump, paper_batches


@check("""
SELECT CASE WHEN doc_id % 40 <> 3 THEN concat(cast(doc_id AS VARCHAR), 'v', cast(doc_id % 4 + 1 AS VARCHAR)) END AS id,
  CASE WHEN doc_id % 40 <> 3 THEN concat('  ', string_split(text, chr(10))[1]) END AS title,
  CASE WHEN doc_id % 40 <> 3 THEN concat(text, '  ') END AS abstract,
  doc_id % 40 = 3 AS malformed
FROM documents
""")
def read_metadata_dump(spark, sf):
    rows = dump(spark, sf)
    broken = F.split("id", "v")[0].cast("long") % 40 == 3
    line = F.to_json(F.struct(*rows.columns))
    path = work_dir(spark, "dump")
    # A broken line loses its second half.
    cut = F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))
    rows.select(F.when(broken, cut).otherwise(line)).write.text(path)
    read = readers.read_metadata_dump(spark, path, "corrupt")
    return read.select("id", "title", "abstract", F.col("corrupt").isNotNull().alias("malformed"))


@check(f"WITH {LINKS} SELECT paper_arxiv_id, repo_url, is_official FROM links")
def read_code_links(spark, sf):
    path = work_dir(spark, "links")
    links(spark, sf).write.parquet(path)
    return readers.read_code_links(spark, path)


PAPER_ROWS = """SELECT arxiv_id, title, abstract, strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at,
  strftime(submitted_at, '%Y-%m') AS submitted_month, github_stars_t60 FROM papers"""


def seed_rows(spark, path):
    return readers.read_papers(spark, path).select(
        "arxiv_id", "title", "abstract", stamp("submitted_at"),
        F.col("submitted_month").cast("string").alias("submitted_month"), "github_stars_t60",
    )


@check(P + PAPER_ROWS)
def write_seed(spark, sf):
    path = work_dir(spark, "seed")
    writers.write_seed(papers(spark, sf), path)
    return seed_rows(spark, path)


@check(P + PAPER_ROWS)
def read_papers(spark, sf):
    return write_seed(spark, sf)


@check(P + """
SELECT arxiv_id, CASE WHEN has_code AND doc_id % 2 = 0 THEN cast(doc_id % 150 AS INT)
  ELSE CASE WHEN doc_id % 2 = 1 THEN github_stars_t60 END END AS github_stars_t60,
  strftime(submitted_at, '%Y-%m') AS submitted_month FROM papers
""")
def write_backfill(spark, sf):
    """Pending rows get a star count, and the result is a new snapshot beside the one read."""
    from ..operators.filters import pending_stars
    from ..operators.merge import backfill_columns
    from .filters import half_starred

    first, second = work_dir(spark, "snapshot"), work_dir(spark, "snapshot")
    writers.write_seed(half_starred(spark, sf), first)
    stored = readers.read_papers(spark, first)
    stars = pending_stars(stored).select(
        "arxiv_id", (F.col("doc_id") % 150).cast("int").alias("github_stars_t60"), F.lit(0).alias("pos")
    )
    writers.write_backfill(backfill_columns(stored, stars, "pos"), second)
    return readers.read_papers(spark, second).select(
        "arxiv_id", "github_stars_t60", F.col("submitted_month").cast("string").alias("submitted_month")
    )


@check(P + """
SELECT arxiv_id, CASE WHEN has_code AND doc_id % 2 = 0 THEN cast(doc_id % 150 AS INT)
  ELSE CASE WHEN doc_id % 2 = 1 THEN github_stars_t60 END END AS github_stars_t60, '3, 5, 0' AS chunks_by_run FROM papers
""")
def write_backfill_resumed(spark, sf):
    """A run that may do three of eight chunks, one that does the rest, and one that finds nothing to do."""
    from ..operators.filters import pending_stars
    from ..operators.merge import backfill_columns
    from .filters import half_starred

    first, second = work_dir(spark, "snapshot"), work_dir(spark, "snapshot")
    writers.write_seed(half_starred(spark, sf), first)

    def fill(part):
        stars = pending_stars(part).select(
            "arxiv_id", (F.col("doc_id") % 150).cast("int").alias("github_stars_t60"), F.lit(0).alias("pos"))
        return backfill_columns(part, stars, "pos")

    stored = readers.read_papers(spark, first)
    done = [len(writers.backfill_in_chunks(stored, fill, second, 8, most)) for most in (3, None, None)]
    if not writers.backfill_done(spark, second, 8):
        raise ValueError("the snapshot is not whole")
    return spark.read.parquet(second).select(
        "arxiv_id", "github_stars_t60", F.lit(", ".join(map(str, done))).alias("chunks_by_run"))


def feed_files(spark, sf):
    """Documents as feed pages with padded titles and versioned ids; some ids are unusable."""
    doc = F.col("doc_id")
    rows = papers(spark, sf)
    url = F.when(F.col("max_h_index") < 6, F.concat(F.lit("http://host/pdf/"), "arxiv_id")).otherwise(
        F.concat(F.lit("http://host/abs/"), F.col("arxiv_id"), F.lit("v"), (doc % 12 + 1).cast("string"))
    )
    words = F.regexp_replace("title", r"[^\p{L}\p{N} .,]+", " ")
    path = work_dir(spark, "feed")
    rows.select(
        url.alias("id"),
        F.concat(F.lit("  "), words, F.lit("  ")).alias("title"),
        F.concat(F.lit(" "), F.regexp_replace("abstract", r"[^\p{L}\p{N} .,]+", " "), F.lit("  ")).alias("summary"),
        F.date_format("submitted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"),
        F.date_format("submitted_at", "yyyy-MM-dd'T'00:00:00'Z'").alias("updated"),
        F.array(F.struct(F.concat(F.lit("  "), "arxiv_id").alias("name")), F.struct(F.lit("Second Name ").alias("name"))).alias("author"),
        F.transform("categories", lambda c: F.struct(c.alias("_term"), F.lit("s").alias("_scheme"))).alias("category"),
    ).write.format("xml").option("rootTag", "feed").option("rowTag", "entry").save(path)
    return path


@check(P + r"""
SELECT arxiv_id, trim(regexp_replace(title, '[^\p{L}\p{N} .,]+', ' ', 'g')) AS title,
  trim(regexp_replace(abstract, '[^\p{L}\p{N} .,]+', ' ', 'g')) AS abstract,
  array_to_string(categories, '|') AS categories, concat(arxiv_id, '|Second Name') AS authors,
  strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at,
  strftime(submitted_at, '%Y-%m-%d 00:00:00') AS updated_at_api
FROM papers WHERE coalesce(max_h_index, 99) >= 6
""")
def read_atom_pages(spark, sf):
    read = readers.read_atom_pages(spark, feed_files(spark, sf))
    return read.select(
        "arxiv_id", "title", "abstract", F.array_join("categories", "|").alias("categories"),
        F.array_join("authors.name", "|").alias("authors"), stamp("submitted_at"), stamp("updated_at_api"),
    )


@check(f"""
WITH {PAIRS}, l AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT concat('arXiv:', cast(l_orderkey AS VARCHAR)) AS id, ss_paper_id, citation_count
FROM l LEFT JOIN answered a ON cast(l_orderkey AS VARCHAR) = a.arxiv_id
""")
def read_ss_batches(spark, sf):
    path = work_dir(spark, "batches")
    paper_batches(spark, sf).write.option("ignoreNullFields", "false").json(path)
    read = readers.read_paper_batches(spark, path)
    pair = F.explode(F.arrays_zip("ids", "response")).alias("pair")
    return read.select(pair).select(
        F.col("pair.ids").alias("id"), F.col("pair.response.paperId").alias("ss_paper_id"),
        F.col("pair.response.citationCount").alias("citation_count"),
    )


@check("""
SELECT cast(s_suppkey AS VARCHAR) AS author_id, cast(s_suppkey % 60 AS INT) AS h_index,
  cast(s_suppkey % 300 AS INT) AS paper_count FROM supplier WHERE s_suppkey % 5 <> 0
""")
def read_ss_author_batches(spark, sf):
    from ..operators.joins import author_responses

    path = work_dir(spark, "batches")
    author_batches(spark, sf).write.option("ignoreNullFields", "false").json(path)
    return author_responses(readers.read_author_batches(spark, path))


@check("""
SELECT cast(o_orderkey AS VARCHAR) AS arxiv_id,
  cast(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_custkey END AS INT) AS upvotes,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'https://github.com/o/r' END AS github_repo
FROM orders WHERE o_orderstatus <> 'F'
""")
def read_daily_feed(spark, sf):
    key = F.col("o_orderkey")
    path = work_dir(spark, "daily")
    table(spark, sf, "orders").select(F.struct(
        F.when(F.col("o_orderstatus") == "F", "").otherwise(key.cast("string")).alias("id"),
        F.when(key % 5 != 0, F.col("o_custkey")).alias("upvotes"),
        F.when(key % 3 != 0, "https://github.com/o/r").alias("githubRepo"),
    ).alias("paper")).write.json(path)
    return readers.read_daily_feed(spark, path).drop("pos")


def lookup_rows(spark, sf):
    """Paper and repository lookups per order: found, absent, or failed."""
    key = F.col("o_orderkey")
    status = F.when(key % 3 == 0, 200).when(key % 3 == 1, 404).otherwise(503)
    found = key % 3 == 0
    rows = table(spark, sf, "orders").select(
        key.cast("string").alias("arxiv_id"), status.alias("status"),
        F.when(found, F.struct(
            key.cast("string").alias("id"), (F.col("o_custkey") % 12).cast("int").alias("upvotes"),
            F.when(F.col("o_orderstatus") == "F", "").otherwise("https://github.com/o/r").alias("githubRepo"),
        )).alias("paper"),
        F.when(found, F.struct((F.col("o_custkey") % 300).cast("int").alias("stargazers_count"))).alias("repo"),
    )
    return rows


@check("""
SELECT cast(o_orderkey AS VARCHAR) AS arxiv_id, CASE o_orderkey % 3 WHEN 0 THEN 200 WHEN 1 THEN 404 ELSE 503 END AS status,
  CASE WHEN o_orderkey % 3 = 0 THEN cast(o_custkey % 12 AS INT) END AS upvotes FROM orders
""")
def read_paper_lookups(spark, sf):
    path = work_dir(spark, "lookups")
    lookup_rows(spark, sf).select("arxiv_id", "status", F.col("paper").alias("body")).write.json(path)
    read = readers.read_paper_lookups(spark, path)
    return read.select("arxiv_id", "status", F.col("body.upvotes").alias("upvotes"))


@check("""
SELECT cast(o_orderkey AS VARCHAR) AS arxiv_id, CASE o_orderkey % 3 WHEN 0 THEN 200 WHEN 1 THEN 404 ELSE 503 END AS status,
  CASE WHEN o_orderkey % 3 = 0 THEN cast(o_custkey % 300 AS INT) END AS stars FROM orders
""")
def read_repo_lookups(spark, sf):
    path = work_dir(spark, "lookups")
    lookup_rows(spark, sf).select("arxiv_id", "status", F.col("repo").alias("body")).write.json(path)
    read = readers.read_repo_lookups(spark, path)
    return read.select("arxiv_id", "status", F.col("body.stargazers_count").alias("stars"))


@check(PS + "SELECT arxiv_id, round(hype_score, 6) AS hype_score, hype_tier FROM scored")
def read_tree_model(spark, sf):
    """The toy ensemble as stored JSON, read back and applied to all papers."""
    model = toy_model()
    path = work_dir(spark, "model")
    stored = {"learner": {
        "learner_model_param": {"base_score": f"[{model.base_score:.6E}]"},
        "gradient_booster": {"model": {"trees": model.trees}},
    }}
    meta = {"threshold": model.threshold, "feature_cols": model.feature_cols, "version": "1"}
    for name, content in (("xgb_model.json", stored), ("model_meta.json", meta)):
        spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(f"{path}/{name}")
    scored = score_papers(papers(spark, sf), load_trees(spark, path))
    return rounded(scored.select("arxiv_id", "hype_score", "hype_tier"), "hype_score")


METRIC_ROWS = f"""WITH {SERIES}
SELECT name, cast(feature AS VARCHAR) AS feature, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM series"""


@check(METRIC_ROWS)
def append_metrics(spark, sf):
    """Two appends, one per half of the value range, read as one series."""
    path = work_dir(spark, "metrics")
    rows = series(spark, sf).withColumn(
        "labels", F.create_map(F.lit("feature"), F.col("feature").cast("string"))
    )
    writers.append_metrics(rows.filter("value < 50"), path)
    writers.append_metrics(rows.filter("value >= 50"), path)
    read = readers.read_metric_series(spark, path)
    return read.select("name", F.element_at("labels", "feature").alias("feature"), "value", stamp("ts"))


@check(METRIC_ROWS)
def read_metric_series(spark, sf):
    return append_metrics(spark, sf)


@check("""SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS report_date FROM events""")
def write_drift_report(spark, sf):
    """A report per event day; the index lists the days."""
    path = work_dir(spark, "reports")
    day = F.date_format("ts", "yyyy-MM-dd").alias("report_date")
    daily = table(spark, sf, "events").groupBy(day).agg(F.count("*").alias("events"))
    daily.write.partitionBy("report_date").parquet(path)
    # The newest day once more: it replaces itself.
    last = daily.agg(F.max("report_date")).first()[0]
    rerun = daily.filter(F.col("report_date") == last).drop("report_date")
    writers.write_drift_report(rerun, path, last)
    return writers.report_index(spark, path)


@check("""
SELECT 'run-1' AS run_id, 'metric' AS kind, 'mean_value' AS key, round(avg(value), 4) AS value FROM events
UNION ALL SELECT 'run-1', 'metric', 'rows', cast(count(*) AS DOUBLE) FROM events
""")
def log_run(spark, sf):
    path = work_dir(spark, "runs")
    row = table(spark, sf, "events").agg(F.avg("value").alias("mean_value"), F.count("*").alias("rows")).first()
    writers.log_run(spark, path, "run-1", {"maxDepth": 3}, row.asDict(), {"job": "test"})
    read = spark.read.parquet(path).filter(F.col("kind") == "metric")
    return read.withColumn("value", F.col("value").cast("double"))


@check(PF + f"SELECT arxiv_id, {FEATURE_LIST} FROM features")
def store(spark, sf):
    from ..functions.features import build_features
    from ..session import store as store

    return store(build_features(papers(spark, sf), ("arxiv_id",)), "features")

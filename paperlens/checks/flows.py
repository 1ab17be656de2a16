"""Whole jobs over landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import FEATURE_COLS
from ..operators.trees import read_tree_model, score_papers
from ..plans.curate import curate as curate_plan
from ..plans.monitoring import monitor as monitor_plan
from ..plans.training import train_flow as train_plan
from ..session import work_dir
from ..sources import readers, writers
from . import check
from .bindings import P, papers, toy_model
from .filters import links
from .joins import CURATED, curated_view, dump

FEATURES_IN_ORDER = ", ".join(f"'{c}'" for c in FEATURE_COLS)


@check(CURATED)
def curate_flow(spark, sf):
    """Bulk curation from landed NDJSON and link files to month directories, read back."""
    landed, linked, seed = work_dir(spark, "dump"), work_dir(spark, "links"), work_dir(spark, "seed")
    rows = dump(spark, sf)
    rows.select(F.to_json(F.struct(*rows.columns))).write.text(landed)
    links(spark, sf).write.parquet(linked)
    made = curate_plan(readers.read_metadata_dump(spark, landed), readers.read_code_links(spark, linked))
    writers.write_seed(made, seed)
    # The schema is given: from the first hours of the smallest table no paper is kept.
    return curated_view(spark.read.schema(made.schema).parquet(seed))


@check(P + f"""
SELECT unnest(['current_papers_count', 'drift_share', 'drift_detected', 'mean_hype_score']) AS name, '' AS feature,
  (SELECT count(*) FROM papers WHERE NOT has_code) AS papers, 27 AS report_rows
UNION ALL SELECT 'feature_drift_score', unnest([{FEATURES_IN_ORDER}]),
  (SELECT count(*) FROM papers WHERE NOT has_code), 27
""")
def monitor_flow(spark, sf):
    """A weekly run: the unlabelled papers against the labelled ones, report and metrics read back."""
    rows = papers(spark, sf).drop("doc_id")
    report, metrics = work_dir(spark, "report"), work_dir(spark, "metrics")
    made = monitor_plan(rows.filter("has_code"), rows.filter("NOT has_code"), "2024-02-12 00:00:00", report, metrics,
                        toy_model(), days=60)
    assert made
    found = readers.read_metric_series(spark, metrics)
    size = found.filter("name = 'current_papers_count'").agg(F.max("value")).scalar().cast("long")
    lines = spark.read.parquet(report).agg(F.count("*")).scalar().cast("int")
    feature = F.coalesce(F.element_at("labels", "feature"), F.lit(""))
    return found.select("name", feature.alias("feature"), size.alias("papers"), lines.alias("report_rows"))


@check("""
SELECT printf('trial-%03d', i) AS run_id, kind, n::BIGINT AS n
FROM range(50) t(i), (VALUES ('param', 10), ('metric', 2), ('objective', 1), ('tag', 1)) v(kind, n)
UNION ALL SELECT 'paper-hype-best', kind, n::BIGINT FROM (VALUES ('param', 23), ('metric', 4), ('tag', 1)) v(kind, n)
""")
def train_flow(spark, sf):
    """Split, 50 trials, refit, test, log and save: what the run table holds; the stored model is read back and scores."""
    runs, model = work_dir(spark, "runs"), work_dir(spark, "model")
    rows = papers(spark, sf).drop("doc_id")
    metrics = train_plan(rows, runs, model)
    stored = read_tree_model(spark, model)
    if stored.threshold != metrics["optimal_threshold"]:
        raise ValueError("the stored threshold is not the one that was found")
    if not score_papers(rows, stored).filter("hype_score IS NULL OR hype_score NOT BETWEEN 0 AND 1").isEmpty():
        raise ValueError("scores of the stored model are out of bounds")
    return spark.read.parquet(runs).groupBy("run_id", "kind").agg(F.count("*").alias("n"))

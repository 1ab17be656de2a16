"""Sinks. Nothing overwrites a path that is being read; repeated runs append or write anew."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..constants import DEFAULT_THRESHOLD, FEATURE_COLS
from ..functions.dates import submitted_month
from ..operators.trees import TreeModel


def write_seed(papers: DataFrame, path: str) -> None:
    """Curated papers, one directory per submitted month.

    The rebalance hint lets the adaptive planner split a month that holds most of the rows and
    merge small ones, so neither one task nor thousands of tiny files result.
    """
    (
        papers.withColumn("submitted_month", submitted_month(F.col("submitted_at")))
        .hint("rebalance", "submitted_month")
        .write.partitionBy("submitted_month").parquet(path)
    )


def write_backfill(papers: DataFrame, path: str) -> None:
    """A new snapshot of back-filled papers; the next run starts from its pending rows."""
    write_seed(papers.drop("submitted_month"), path)


def _finished(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def backfill_in_chunks(papers: DataFrame, fill: Callable[[DataFrame], DataFrame], path: str, chunks: int = 32,
                       most: int | None = None, key: str = "arxiv_id") -> list[int]:
    """A back-fill that goes on where a run before it ended; the chunks this run has done.

    Papers are told apart by a hash of their key. ``fill`` makes the snapshot rows of one chunk, which are
    written to a folder of their own; the mark that ends a write is the ledger entry of the chunk. A run
    that is killed loses the chunk it was at and nothing else. ``most`` bounds the chunks of a run. The
    number of chunks stays the same over all runs on a path, and a row has the same key in all of them.
    """
    spark, done = papers.sparkSession, []
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(chunks))
    for chunk in range(chunks):
        folder = f"{path}/chunk={chunk}"
        if _finished(spark, folder):
            continue
        if most is not None and len(done) >= most:
            break
        fill(papers.filter(place == chunk)).write.mode("overwrite").parquet(folder)
        done.append(chunk)
    return done


def backfill_done(spark: SparkSession, path: str, chunks: int = 32) -> bool:
    """Whether every chunk has its ledger entry: the snapshot under ``path`` is whole."""
    return all(_finished(spark, f"{path}/chunk={chunk}") for chunk in range(chunks))


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append metric samples ``(name, labels, value, ts)``; labels are stored by label name, in sink order."""
    ordered = F.map_from_entries(F.sort_array(F.map_entries("labels")))
    metrics.select("name", ordered.alias("labels"), "value", "ts").write.mode("append").parquet(path)


def label_list(name, labels):
    """Labels in sink order: ``__name__`` first, then by label name."""
    own = F.array(F.struct(F.lit("__name__").alias("key"), name.alias("value")))
    return F.concat(own, F.sort_array(F.map_entries(labels)))


def write_drift_report(report: DataFrame, path: str, report_date: str) -> None:
    """Append the rows of one run; a rerun of the same day replaces that day only."""
    (
        report.withColumn("report_date", F.lit(report_date))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_date").parquet(path)
    )


def report_index(spark: SparkSession, path: str) -> DataFrame:
    """Dates of all reports, newest first. Reads partition names only."""
    reports = spark.read.parquet(path)
    return (
        reports.select(F.col("report_date").cast("string").alias("report_date"))
        .distinct().orderBy(F.desc("report_date"))
    )


def run_rows(spark: SparkSession, run_id: str, params=None, metrics=None, tags=None) -> DataFrame:
    """One run as ``(run_id, kind, key, value)``; metrics rounded to four digits."""
    rows = [(run_id, "param", k, str(v)) for k, v in (params or {}).items()]
    rows += [(run_id, "metric", k, str(round(float(v), 4))) for k, v in (metrics or {}).items()]
    rows += [(run_id, "tag", k, str(v)) for k, v in (tags or {}).items()]
    return spark.createDataFrame(rows, schemas.RUN_LOG)


def log_run(spark: SparkSession, path: str, run_id: str, params=None, metrics=None, tags=None) -> None:
    run_rows(spark, run_id, params, metrics, tags).coalesce(1).write.mode("append").parquet(path)


def save_model(spark: SparkSession, model: PipelineModel | TreeModel, path: str, *, name: str, version: str,
               run_id: str, threshold: float | None = None, feature_version: str = "v3",
               alias: str = "champion") -> None:
    """Model and a one-row JSON of what is needed to serve it.

    A tree ensemble is stored as the files that ``read_tree_model`` takes, a pipeline as Spark ML does.
    """
    def text(content, folder: str) -> None:
        row = spark.createDataFrame([(json.dumps(content),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/{folder}")

    features = model.feature_cols if isinstance(model, TreeModel) else FEATURE_COLS
    meta = {
        "model_name": name, "alias": alias, "version": version, "run_id": run_id,
        "feature_cols": features, "num_features": len(features),
        "threshold": DEFAULT_THRESHOLD if threshold is None else threshold,
        "feature_version": feature_version,
    }
    if isinstance(model, TreeModel):
        text({"learner": {
            "learner_model_param": {"base_score": repr(model.base_score)},
            "gradient_booster": {"model": {"trees": model.trees}},
        }}, "xgb_model.json")
        text(meta, "model_meta.json")
    else:
        model.write().overwrite().save(f"{path}/model")
    text(meta, "meta")


def load_model_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MODEL_META).json(f"{path}/meta")

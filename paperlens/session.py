"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, Row, SparkSession

SETTINGS = {
    # Timestamps are UTC wall clock everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: broadcast by measured size, split skewed partitions, coalesce small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows of whole texts go to Python in batches of some megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session, once."""
    if not getattr(spark, "_paperlens_configured", False):
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        spark._paperlens_configured = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else the context's checkpoint folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return shared.rstrip("/")


def prepare_local(spark: SparkSession) -> None:
    """For tests, timings and trials on a local master; a cluster is left as it was set up.

    Sets a temporary checkpoint folder where none is set, and lets Python workers find this package
    whatever folder they were started in (on a cluster it is shipped with the job).
    """
    context = spark.sparkContext
    if context.master.partition("[")[0] != "local":
        return
    if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``store`` for large tables: the shuffle files behind the written one are of no more use and let go."""
    spark, stored = df.sparkSession, store(df, name)
    # As long as the plan has a name here, its shuffle files stay.
    del df
    release(spark)
    return stored


def release(spark: SparkSession) -> None:
    """Have the driver notice plans that are done, so that their shuffle files are deleted on all executors.

    What a plan refers to is only seen to be free once the plan itself is gone, hence the second round.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def remove(df: DataFrame) -> None:
    """Delete the files of a table made by ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    shared = shared_folder(spark).split(":", 1)[-1].lstrip("/")
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if folder.split(":", 1)[-1].lstrip("/").startswith(shared):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_rows(df: DataFrame, limit: int, what: str) -> list[Row]:
    """All rows of a table that must be small; an error, not a cut, when it is not."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}")
    return rows

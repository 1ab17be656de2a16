"""The paper table: plain parquet in month directories.

A change rewrites only the months it touches. The new rows of these months are first written to the
shared folder, because the rows they come from lie in the directories to be replaced; then exactly
those directories are overwritten. Merges are idempotent, so a batch that is applied again after a
failure leaves the table as one that was applied once. There is one writer at a time: jobs on one
table run one after the other.

Beside the table lies an index of its keys: (key, month) in directories by a hash of the key. A batch
reads the directories its keys fall in, not every key of the table. Entries are written before the rows
they stand for and never taken back, so the index names all months of a key and at worst one too many,
which is then rewritten as it is.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import submitted_month
from ..schemas import PAPERS
from ..session import store, remove


class PaperTable:
    """``buckets`` is how many directories the index has; it may not change while the index lives."""

    def __init__(self, spark: SparkSession, path: str, schema: str = PAPERS, key: str = "arxiv_id",
                 buckets: int = 64):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema, self.buckets = schema, buckets
        self.index_path = self.path + "-keys"

    def read(self, months: list[str] | None = None) -> DataFrame:
        """Rows with their ``submitted_month``; ``months`` lists only those directories."""
        schema = self.schema + ", submitted_month string"
        try:
            rows = self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        return rows if months is None else rows.filter(F.col("submitted_month").isin(months))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def index(self, keys: DataFrame | None = None) -> DataFrame:
        """Entries (key, submitted_month); with ``keys`` only from the directories these fall in."""
        schema = f"{self.key} string, submitted_month string, bucket int"
        try:
            entries = self.spark.read.schema(schema).parquet(self.index_path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            entries = self.reindex()
        if keys is not None:
            wanted = [r[0] for r in keys.select(self._bucket().alias("bucket")).distinct().collect()]
            entries = entries.filter(F.col("bucket").isin(wanted))
        return entries.drop("bucket")

    def _add_entries(self, entries: DataFrame, mode: str) -> None:
        (
            entries.select(F.col(self.key).cast("string").alias(self.key), "submitted_month", self._bucket().alias("bucket"))
            .hint("rebalance", "bucket").write.mode(mode).partitionBy("bucket").parquet(self.index_path)
        )

    def reindex(self) -> DataFrame:
        """Write the index anew from the table's key column: where there is none, and to join its small files."""
        self._add_entries(self.read().select(self.key, "submitted_month").distinct(), "overwrite")
        schema = f"{self.key} string, submitted_month string, bucket int"
        return self.spark.read.schema(schema).parquet(self.index_path)

    def touched_months(self, changes: DataFrame) -> list[str]:
        """Months holding a row for any key of ``changes``, from the directories of the index they fall in."""
        keys = changes.select(F.col(self.key).cast("string").alias(self.key)).distinct()
        hit = self.index(keys).join(keys, self.key, "left_semi")
        return [r[0] for r in hit.select("submitted_month").distinct().collect()]

    def replace_months(self, rows: DataFrame, changes: DataFrame | None = None) -> None:
        """Write ``rows`` as the whole content of the months they fall in.

        ``changes`` holds the keys that may be new; without it every key of ``rows`` is looked up.
        """
        placed = rows.withColumn("submitted_month", submitted_month(F.col("submitted_at")))
        staged = store(placed, "months")
        entries = staged.select(F.col(self.key).cast("string").alias(self.key), "submitted_month")
        if changes is not None:
            keys = changes.select(F.col(self.key).cast("string").alias(self.key)).distinct()
            entries = entries.join(keys, self.key, "left_semi")
        known = self.index(entries if changes is None else keys)
        new = store(entries.distinct().join(known, [self.key, "submitted_month"], "left_anti"), "keys")
        if not new.isEmpty():
            self._add_entries(new, "append")
        (
            staged.hint("rebalance", "submitted_month").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("submitted_month").parquet(self.path)
        )
        remove(staged)

"""Secret scans through a ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. A blob is scanned once for each
version of the rules, whatever number of paths and versions hold it; findings are kept in a ledger
(Parquet in a folder all executors reach), and joined back to all paths by address.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "rules string, blob string, kinds array<string>, starts array<int>, ends array<int>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost matches that do not overlap, kept if a group is long enough."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.finditer(self.pattern, text, re.ASCII | (re.IGNORECASE if self.any_case else 0))
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


# The base kinds, in the order in which spans that start together are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # A run of 24 or more: the runs below that length are those that the length drops.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Added kinds: key files and tokens with a published prefix.
ADDED = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + ADDED


def version_of(rules: tuple[Rule, ...]) -> str:
    """Changes whenever a rule does."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def find_spans(text: str, rules: tuple[Rule, ...]) -> list[tuple[int, int, int]]:
    """(start, end, index of the rule) in code points, by start and then by rule."""
    return sorted((a, k, b) for k, rule in enumerate(rules) for a, b in rule.spans(text))


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def ledger_rows(spark: SparkSession, folder: str, rules: tuple[Rule, ...]) -> DataFrame:
    """One row for each blob scanned under these rules; an address scanned twice has equal findings."""
    try:
        rows = spark.read.schema(LEDGER).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    return rows.filter(F.col("rules") == version_of(rules)).dropDuplicates(["blob"])


def scanned_rows(spark: SparkSession, folder: str) -> int:
    """How many scans the ledger holds, of all rule versions."""
    return spark.read.schema(LEDGER).parquet(folder).count()


def scan_unseen(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES,
                path_column: str = "doc_id", text_column: str = "text") -> None:
    """Scan the blobs of ``versions`` that the ledger lacks under these rules, and append them to it.

    ``versions`` has a row for each version of each path; a null text is the empty blob. Of the rows
    that share a blob only one is scanned. Appending is idempotent: findings depend on blob and rules
    alone, so a job that is run again adds the same rows.
    """
    spark = versions.sparkSession
    blobs = versions.select(F.col(path_column).alias("path"), F.col(text_column).alias("text"), address(F.col(text_column)).alias("blob"))
    seen = ledger_rows(spark, folder, rules).select("blob")
    # One path for each unseen blob: narrow rows, combined before the shuffle.
    chosen = blobs.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left_anti")
    same = blobs["path"].eqNullSafe(chosen["path"]) & (blobs["blob"] == chosen["blob"])
    texts = blobs.join(chosen, same, "left_semi").select("blob", "text")
    version = version_of(rules)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t or "", rules) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([version] * len(found)), batch.column(0),
                pa.array([[rules[k].kind for _, k, _ in f] for f in found], pa.list_(pa.string())),
                pa.array([[a for a, _, _ in f] for f in found], pa.list_(pa.int32())),
                pa.array([[b for _, _, b in f] for f in found], pa.list_(pa.int32())),
            ], names=["rules", "blob", "kinds", "starts", "ends"])

    texts.mapInArrow(run, LEDGER).write.mode("append").parquet(folder)


def findings(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
    """``versions`` with the spans of their blobs: ``secrets`` array<struct<kind, start, end>>, by start.

    Rows keep all their columns (one named ``secrets`` is replaced); every row of ``versions`` stays,
    also repeated ones. Blobs must have been scanned. The addresses of the findings alone are shuffled
    with the versions, and a blob shared by many rows is split by the adaptive join.
    """
    spark = versions.sparkSession
    spans = F.arrays_zip(F.col("kinds").alias("kind"), F.col("starts").alias("start"), F.col("ends").alias("end"))
    held = ledger_rows(spark, folder, rules).filter(F.size("kinds") > 0)
    held = held.select(F.col("blob").alias("_blob"), spans.alias("secrets"))
    rows = versions.drop("secrets").withColumn("_blob", address(F.col(text_column)))
    nothing = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return rows.join(held, "_blob", "left").drop("_blob").withColumn("secrets", F.coalesce("secrets", nothing))


def span_text(secrets: Column) -> Column:
    """The spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, folder: str) -> DataFrame:
    """One row for each document: counts of the base kinds, digest of the base spans, all spans.

    Positions are code points, ends exclusive. A document without findings has zero counts, the digest
    of the empty text and empty ``spans``.
    """
    scan_unseen(docs, folder)
    kinds = [rule.kind for rule in BASE]
    narrow = findings(docs.select("doc_id", "text"), folder).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return narrow.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans"),
    )


def redacted(text: Column, secrets: Column) -> Column:
    """The text with every found span replaced by its kind in brackets; spans that overlap become one."""
    begin = F.struct(F.lit(1).alias("at"), F.lit("").alias("done"))

    def step(state: Column, s: Column) -> Column:
        start, end = s["start"] + 1, s["end"] + 1
        gap = F.substr(text, state["at"], F.greatest(start - state["at"], F.lit(0)))
        mark = F.when(start >= state["at"], F.concat(gap, F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.greatest(state["at"], end).alias("at"), F.concat(state["done"], mark).alias("done"))

    return F.aggregate(secrets, begin, step, lambda state: F.concat(state["done"], F.substr(text, state["at"], F.length(text))))


def without_secrets(docs: DataFrame, folder: str) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by their kind, and ``n_chars`` counted again there.

    All rows stay, and all other columns as they are; texts without findings are not touched.
    """
    scan_unseen(docs, folder)
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    rows = findings(packed, folder)
    found = F.size("secrets") > 0
    rows = rows.withColumn("text", F.when(found, redacted(F.col("text"), F.col("secrets"))).otherwise(F.col("text")))
    changed = {"text": F.col("text"), "n_chars": F.when(found, F.length("text").cast("long")).otherwise(F.col("_row")["n_chars"])}
    return rows.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])

"""Exact, repeatable quotas per label: train/validation/test split and reference sample."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import REFERENCE_ROWS
from ..session import small_rows
from .filters import enriched_only

BUCKET_BITS = 14


def row_position(key: str, seed: int) -> Column:
    """Place of a row in a fixed random order: a hash of its key, then the key."""
    return F.struct(F.xxhash64(F.lit(seed), F.col(key)).alias("h"), F.col(key).alias("k"))


def label_totals(df: DataFrame, label: Column, max_labels: int = 100) -> dict:
    """Rows per label; labels are few, and more than ``max_labels`` are an error."""
    counts = df.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    rows = small_rows(counts, max_labels, "labels")
    return {r["label"]: r["n"] for r in rows}


def hash_cuts(df: DataFrame, label: Column, key: str, seed: int, quotas: dict) -> DataFrame:
    """Per label, the last position inside each cumulative quota; NULL for a quota of 0.

    ``quotas`` maps a label to ``{cut: rows}``. Instead of one sort per label there are two passes
    over key and label: counts per hash range, then the exact place inside the one range that holds
    the quota, where copies of a key are one counted row. The result has one row per label, at most
    ``max_labels`` of ``label_totals``, and is broadcast. Copies of a key fall on the same side.
    """
    spark = df.sparkSession
    rows = df.select(label.alias("label"), row_position(key, seed).alias("at")).filter(
        F.col("label").isNotNull()
    ).withColumn("bucket", F.shiftright("at.h", 64 - BUCKET_BITS))
    kind = rows.schema["label"].dataType.simpleString()
    wanted = [(lab, cut, n) for lab, cuts in quotas.items() for cut, n in cuts.items() if n > 0]
    quota_table = spark.createDataFrame(wanted, f"label {kind}, cut string, quota long")
    upto = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = rows.groupBy("label", "bucket").agg(F.count("*").alias("n"))
    boundary = (
        counts.withColumn("upto", F.sum("n").over(upto)).join(F.broadcast(quota_table), "label")
        .filter((F.col("quota") <= F.col("upto")) & (F.col("quota") > F.col("upto") - F.col("n")))
        .select("label", "cut", "bucket", (F.col("quota") - F.col("upto") + F.col("n")).alias("rank"))
    )
    places = spark.createDataFrame(
        small_rows(boundary, len(wanted), "boundaries"), boundary.schema
    )
    keys = rows.join(F.broadcast(places), ["label", "bucket"]).groupBy("label", "cut", "rank", "at").agg(
        F.count("*").alias("n")
    )
    within = Window.partitionBy("label", "cut").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    reached = keys.withColumn("reached", F.sum("n").over(within)).filter(
        F.col("reached") >= F.col("rank")
    )
    cuts = sorted({cut for c in quotas.values() for cut in c})
    found = reached.groupBy("label").agg(
        *[F.min(F.when(F.col("cut") == c, F.col("at"))).alias(f"_{c}") for c in cuts]
    ).withColumnRenamed("label", "_label")
    return F.broadcast(
        spark.createDataFrame(small_rows(found, max(len(quotas), 1), "labels"), found.schema)
    )


def allocate(counts: dict, total: int) -> dict:
    """``total`` shared out in proportion to ``counts``, largest remainders first."""
    whole = sum(counts.values())
    exact = {k: n * float(total) / whole if whole else 0.0 for k, n in counts.items()}
    shares = {k: math.floor(x) for k, x in exact.items()}
    order = sorted(counts, key=lambda k: (shares[k] - exact[k], k))
    for k in order[: total - sum(shares.values())]:
        shares[k] += 1
    return shares


def split_quotas(counts: dict) -> dict:
    """Rows per label for ``train``, ``val`` and ``test``: 80/10/10 overall and per label."""
    total = sum(counts.values())
    held_out = math.ceil(0.2 * total)
    train = allocate(counts, total - held_out)
    rest = {k: n - train[k] for k, n in counts.items()}
    val = allocate(rest, held_out - math.ceil(0.5 * held_out))
    return {
        k: {"train": train[k], "val": val[k], "test": rest[k] - val[k]} for k in counts
    }


def stratified_split(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Add ``split``: train, val or test, 80/10/10 with each label in proportion.

    Membership depends on seed and key alone. The rows themselves are not shuffled: they are
    compared with the cuts of their label. Rows without a label are dropped.
    """
    labeled = df.filter(F.col(label).isNotNull())
    quotas = split_quotas(label_totals(labeled, F.col(label)))
    upto = {k: {"train": q["train"], "val": q["train"] + q["val"]} for k, q in quotas.items()}
    cuts = hash_cuts(labeled, F.col(label), key, seed, upto)
    place = row_position(key, seed)
    split = F.when(place <= F.col("_train"), "train").when(place <= F.col("_val"), "val")
    joined = labeled.join(cuts, F.col(label) == F.col("_label"), "left")
    return joined.withColumn("split", split.otherwise("test")).drop("_label", "_train", "_val")


def reference_sample(papers: DataFrame, n: int = REFERENCE_ROWS, seed: int = 42,
                     label: str = "hype_label", key: str = "arxiv_id") -> DataFrame:
    """About ``n`` enriched papers, each label in proportion, without the label column.

    The size per label is rounded, halves to even, and rows without a label drop out; with fewer
    than two labels exactly ``n`` rows are drawn from all.
    """
    rows = enriched_only(papers)
    totals = label_totals(rows, F.col(label)) if label in rows.columns else {}
    known = {k: count for k, count in totals.items() if k is not None}
    by_label = len(known) > 1
    stratum = F.col(label) if by_label else F.lit(0)
    if not by_label:
        totals = known = {0: sum(totals.values()) if totals else rows.count()}
    total = sum(totals.values())
    share = min(n, total) / total if total else 0.0
    quotas = {k: {"quota": round(share * count)} for k, count in known.items()}
    cuts = hash_cuts(rows, stratum, key, seed, quotas)
    drawn = rows.join(cuts, stratum == F.col("_label")).filter(
        row_position(key, seed) <= F.col("_quota")
    ).drop("_label", "_quota")
    return drawn.drop(label) if by_label else drawn


def train_plus_val(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split").isin("train", "val"))

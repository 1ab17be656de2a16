"""Quality rules: base rules, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Words and pairs of words are hashed into ``BUCKETS`` places. The counts of the trusted documents and of
all documents make two multinomials; a document's score is the mean over its n-grams of the log ratio
of their probabilities, and it is kept from a fixed threshold on. Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
WHITE = "[ \\t-\\r]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: without(line, WHITE_CHARS) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def windows(hashes: Column, n: int) -> Column:
    """A hash of the n items from each position on."""
    count = F.size(hashes) - n
    at = F.when(count >= 0, F.sequence(F.lit(0), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(n)]))


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, the measures of the base rules, base_failed and word hashes.

    Each step is a projection of its own, so that no array is made twice. The windows of a text are
    sorted only where two of them are equal.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", text.alias("text")).withColumn("_words", words_of(F.col("text")))
    out = out.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"),
        F.length(without(F.col("text"), WHITE_CHARS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    out = out.withColumn("_windows", windows(F.col("_hashes"), 5))
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    out = out.withColumn("_sorted", F.when(again, F.sort_array(placed))).drop("_windows")

    def twice(s: Column, k: Column) -> Column:
        near = [F.get("_sorted", k - 1)["w"], F.get("_sorted", k + 1)["w"]]
        return F.when((s["w"] == near[0]) | (s["w"] == near[1]), s["i"])

    starts = F.sort_array(F.filter(F.transform("_sorted", twice), lambda i: i.isNotNull()))
    out = out.withColumn("_starts", starts).drop("_sorted")
    covered = F.transform("_starts", lambda p, k: F.coalesce(F.least(F.lit(5), F.get("_starts", k + 1) - p), F.lit(5)))
    repeats = F.aggregate(covered, F.lit(0), lambda total, c: total + c).cast("long")
    out = out.withColumn("n_repeat_words", F.coalesce(repeats, F.lit(0).cast("long"))).drop("_starts")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def places(hashes: Column) -> Column:
    """The buckets of a text's words and pairs of words."""
    both = F.concat(F.transform(hashes, lambda h: F.xxhash64(h)), windows(hashes, 2))
    return F.transform(both, lambda h: F.shiftrightunsigned(h, 48).cast("int"))


def bucket_counts(docs: DataFrame, out: str) -> DataFrame:
    """bucket and ``out``, the n-grams of ``docs`` in it: summed within each task first."""
    hashes = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    rows = docs.select(hashes.alias("_hashes")).select(F.explode(places(F.col("_hashes"))).alias("bucket"))
    return rows.groupBy("bucket").agg(F.count("*").alias(out))


def of_trusted(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is trusted, however many ids there are.

    Both sides are dealt out by id: a table of ids grows with the labels and is not broadcast. A task
    holds the ids of its share, and the texts stream past them unsorted.
    """
    return docs.join(trusted.select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")


def log_ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row, one column ``ratios``: log of trusted over raw probability of every bucket, in order.

    One is added to every count. The array has BUCKETS entries whatever the input.
    """
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(bucket_counts(docs, "n"), "bucket", "left").join(bucket_counts(of_trusted(docs, trusted), "t"), "bucket", "left")
    both = both.select("bucket", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("t", F.lit(0)).alias("t"))
    rows = both.agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "t"))).alias("rows"), F.sum("n").alias("all_n"), F.sum("t").alias("all_t"))
    ratio = F.transform("rows", lambda r: F.log((r["t"] + 1) / (F.col("all_t") + BUCKETS)) - F.log((r["n"] + 1) / (F.col("all_n") + BUCKETS)))
    return rows.select(ratio.alias("ratios"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids labelled good; an id counts once, and null ids do not."""
    good = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_quality")).filter(F.col("_quality") == 1)
    return good.select("doc_id")


def trusted_sample(labels: DataFrame, fit_rows: int = 50_000) -> DataFrame:
    """At most ``fit_rows`` of the trusted ids, those of least hash, for trials; the query takes all."""
    return trusted_ids(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)


def rules_report(docs: DataFrame, trusted: DataFrame, threshold: float = -0.15) -> DataFrame:
    """One row for each document: the base measures, ``llr`` and whether the document is kept.

    ``kept`` is false where ``base_failed`` is; else it says whether the mean log ratio of the n-grams
    reaches ``threshold``. A null text counts as empty; a text without words has ``llr`` 0 and fails the
    base rules. Repeated rows are judged each; other columns are ignored. Without trusted documents the
    target is uniform over the buckets. ``trusted`` has the ids of the trusted documents, any number of
    them; the raw counts cover all documents.
    """
    columns = docs.select("doc_id", "text")
    ratios = log_ratios(columns, trusted).scalar()
    out = with_base(columns).withColumn("_places", places(F.col("_hashes"))).drop("_hashes")
    out = out.select("*", ratios.alias("_ratios"))
    total = F.aggregate("_places", F.lit(0.0), lambda sum_, b: sum_ + F.get("_ratios", b))
    llr = F.when(F.size("_places") > 0, total / F.size("_places")).otherwise(0.0)
    out = out.withColumn("llr", llr).drop("_places", "_ratios")
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
    # A filter on the measures is not pushed below a generator; in the projections it would repeat all their steps.
    measures = out.columns[1:]
    return out.select("doc_id", F.stack(F.lit(1), *measures).alias(*measures))

"""Ranking metrics of a scored, labelled table, exact under ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import round4
from .cumulative import running_sums, store_ranges


def score_counts(scored: DataFrame, score: str = "score", label: str = "label",
                 by: tuple[str, ...] = ()) -> DataFrame:
    """Positives and negatives per distinct score, of each group of ``by``. All metrics start from this table."""
    positive = F.col(label).cast("bigint")
    return scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(
        *by, F.col(score).cast("double").alias("score")
    ).agg(
        F.sum(positive).alias("pos"),
        F.sum(1 - positive).alias("neg"),
    )


def ranking(scored: DataFrame, score: str = "score", label: str = "label",
            by: tuple[str, ...] = ()) -> DataFrame:
    """Score counts with running sums from the highest score down, in each group of ``by``.

    With ``by`` (the model a score is of, for instance) all groups are ranked in the same passes; the
    metrics below take the same ``by`` and return a row for each group. Its columns hold no nulls.

    The scored rows are read once: their counts are stored, and everything else starts from them.
    """
    ranges = store_ranges(score_counts(scored, score, label, by), "score", by)
    return running_sums(ranges, "score", ["pos", "neg"], by, descending=True)


def _auc() -> Column:
    lost = F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return 1 - F.try_divide(F.sum(lost), pairs)


def _average_precision() -> Column:
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return F.coalesce(F.try_divide(F.sum(F.col("pos") * precision), F.sum("pos")), F.lit(0.0))


def _f1(threshold: float) -> Column:
    hit = F.col("score") >= F.lit(float(threshold))
    tp = F.sum(F.when(hit, F.col("pos")).otherwise(0))
    fp = F.sum(F.when(hit, F.col("neg")).otherwise(0))
    return F.when(tp > 0, 2 * tp / (tp + fp + F.sum("pos"))).otherwise(0.0)


def roc_auc(ranked: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half; NULL for one class."""
    return ranked.groupBy(*by).agg(_auc().alias("roc_auc"))


def average_precision(ranked: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision summed over recall steps, one step per distinct score; 0 without a positive."""
    return ranked.groupBy(*by).agg(_average_precision().alias("average_precision"))


def f1_at_threshold(counts: DataFrame, threshold: float, by: tuple[str, ...] = ()) -> DataFrame:
    """F1 of ``score >= threshold``; 0 without a true positive."""
    return counts.groupBy(*by).agg(_f1(threshold).alias("f1"))


def pr_curve(ranked: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision and recall at every distinct score; recall is 1 without a positive."""
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    return ranked.select(
        *by, F.col("score").alias("threshold"),
        (tp / (tp + fp)).alias("precision"),
        F.coalesce(F.try_divide(tp, F.col("all_pos")), F.lit(1.0)).alias("recall"),
    )


def best_f1_threshold(ranked: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The score with the highest F1, the lowest of equals, to four digits."""
    p, r = F.col("precision"), F.col("recall")
    f1 = 2 * p * r / (p + r + 1e-9)
    best = F.max_by("threshold", F.struct(f1, -F.col("threshold")))
    return pr_curve(ranked, by).groupBy(*by).agg(round4(best).alias("threshold"))


def classification_report(counts: DataFrame, threshold: float = 0.5,
                          names: tuple[str, str] = ("not-hype", "hype"), by: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means.

    The accuracy row carries the accuracy in all three columns. Empty ratios are 0.
    """
    hit = F.col("score") >= F.lit(float(threshold))
    cells = counts.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.when(side, F.col(c))), F.lit(0)).cast("double").alias(name)
            for name, c, side in [
                ("tp", "pos", hit), ("fn", "pos", ~hit), ("fp", "neg", hit), ("tn", "neg", ~hit),
            ]
        ]
    )
    tp, fn, fp, tn = (F.col(c) for c in ("tp", "fn", "fp", "tn"))

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0.0)), F.lit(0.0))

    measures = cells.select(
        *by,
        ratio(tn, tn + fn).alias("p0"), ratio(tn, tn + fp).alias("r0"),
        ratio(2 * tn, 2 * tn + fn + fp).alias("f0"), (tn + fp).alias("n0"),
        ratio(tp, tp + fp).alias("p1"), ratio(tp, tp + fn).alias("r1"),
        ratio(2 * tp, 2 * tp + fn + fp).alias("f1"), (tp + fn).alias("n1"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )
    total = F.col("n0") + F.col("n1")

    def row(name: str, values: list[Column], support: Column) -> Column:
        labels = ("precision", "recall", "f1")
        return F.struct(
            F.lit(name).alias("class"),
            *[v.alias(label) for v, label in zip(values, labels)],
            support.cast("bigint").alias("support"),
        )

    def pair(c: str, weights: tuple[Column, Column]) -> Column:
        return ratio(F.col(c + "0") * weights[0] + F.col(c + "1") * weights[1], weights[0] + weights[1])

    even = (F.lit(1.0), F.lit(1.0))
    by_support = (F.col("n0"), F.col("n1"))
    rows = F.array(
        row(names[0], [F.col("p0"), F.col("r0"), F.col("f0")], F.col("n0")),
        row(names[1], [F.col("p1"), F.col("r1"), F.col("f1")], F.col("n1")),
        row("accuracy", [F.col("accuracy")] * 3, total),
        row("macro avg", [pair(c, even) for c in "prf"], total),
        row("weighted avg", [pair(c, by_support) for c in "prf"], total),
    )
    return measures.select(*by, F.inline(rows))


def metric_bundle(ranked: DataFrame, prefix: str, threshold: float = 0.5, exact: bool = False,
                  by: tuple[str, ...] = ()) -> DataFrame:
    """The three reported metrics in one pass, prefixed and rounded to four digits unless ``exact``."""
    shown = (lambda value: value) if exact else round4
    return ranked.groupBy(*by).agg(
        shown(_auc()).alias(f"{prefix}_roc_auc"),
        shown(_average_precision()).alias(f"{prefix}_pr_auc"),
        shown(_f1(threshold)).alias(f"{prefix}_f1"),
    )


def lift_over_base(ranked: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Average precision against the positive rate a random ranking would reach."""
    base = F.try_divide(F.sum("pos"), F.sum("pos") + F.sum("neg"))
    return ranked.groupBy(*by).agg(
        _average_precision().alias("average_precision"),
        base.alias("base_rate"),
        F.try_divide(_average_precision(), base).alias("lift"),
    )

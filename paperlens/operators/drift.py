"""Feature drift between a reference and a current table, and the metric rows made of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import FEATURE_COLS
from ..functions.pvalues import chi2_p_value, ks_p_value, z_p_value
from .cumulative import running_sums, store_ranges

DISTANCE_LIMIT = 0.1
P_VALUE_LIMIT = 0.05
DRIFT_SHARE_LIMIT = 0.5


def value_counts(sides: dict[str, DataFrame], features: list[str]) -> DataFrame:
    """Rows per feature and value, one count column per side; NULL and non-finite values are left out.

    The tables are unpivoted and counted in one pass; counting combines map-side, so the shuffle
    carries distinct values, not rows.
    """
    names = list(sides)
    parts = [
        df.select(
            *[F.col(f).cast("double").alias(f) for f in features],
            *[F.lit(int(name == other)).alias(other) for other in names],
        )
        for name, df in sides.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    long = rows.unpivot(names, features, "feature", "value")
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf"))
    return long.filter(finite).groupBy("feature", "value").agg(
        *[F.sum(F.col(n).cast("bigint")).alias(n) for n in names]
    )


def drift_statistics(reference: DataFrame, current: DataFrame,
                     features: list[str] = FEATURE_COLS) -> DataFrame:
    """All statistics per feature: sizes, distinct values, and the five distances and test values."""
    counts = value_counts({"ref": reference, "cur": current}, features)
    counts = store_ranges(counts, "value", ("feature",))
    means = counts.groupBy("feature").agg(
        (F.sum(F.col("ref") * F.col("value")) / F.nullif(F.sum("ref"), F.lit(0))).alias("mean_ref")
    )
    ranked = running_sums(counts, "value", ["ref", "cur"], by=("feature",))
    # One row per feature, and the features are named by the caller.
    ranked = ranked.join(F.broadcast(means), "feature")
    n_ref = F.nullif(F.col("all_ref"), F.lit(0))
    n_cur = F.nullif(F.col("all_cur"), F.lit(0))
    gap = F.abs(F.col("cum_ref") / n_ref - F.col("cum_cur") / n_cur)
    p, q = F.col("ref") / n_ref, F.col("cur") / n_cur
    middle = (p + q) / 2

    def divergence(share):
        return F.when(share > 0, share * F.ln(share / middle)).otherwise(F.lit(0.0))

    expected = F.col("ref") * n_cur / n_ref
    excess = F.when(expected > 0, (F.col("cur") - expected) ** 2 / expected).otherwise(
        F.lit(float("inf"))
    )
    spread = F.sum(F.col("ref") * (F.col("value") - F.col("mean_ref")) ** 2)
    totals = ranked.groupBy("feature").agg(
        F.max("all_ref").alias("n_ref"),
        F.max("all_cur").alias("n_cur"),
        F.count("*").alias("distinct_values"),
        F.sum(gap * F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))).alias("_moved"),
        F.sqrt(spread / F.nullif(F.max("all_ref"), F.lit(0))).alias("std_ref"),
        F.max(gap).alias("ks"),
        F.sqrt(F.greatest(F.sum((divergence(p) + divergence(q)) / 2), F.lit(0.0))).alias("js"),
        F.sum(excess).alias("chi2"),
        F.min_by("ref", "value").alias("_low_ref"),
        F.min_by("cur", "value").alias("_low_cur"),
    )
    share_ref = 1 - F.col("_low_ref") / F.nullif("n_ref", F.lit(0))
    share_cur = 1 - F.col("_low_cur") / F.nullif("n_cur", F.lit(0))
    pooled = (share_ref * F.col("n_ref") + share_cur * F.col("n_cur")) / (F.col("n_ref") + F.col("n_cur"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n_ref") + 1 / F.col("n_cur")))
    z = F.when(F.col("distinct_values") == 1, F.lit(0.0)).otherwise(
        (share_ref - share_cur) / F.nullif(error, F.lit(0.0))
    )
    return totals.select(
        "feature", "n_ref", "n_cur", "distinct_values",
        (F.col("_moved") / F.greatest("std_ref", F.lit(0.001))).alias("wasserstein"),
        "js", "ks", "chi2", z.alias("z"),
    )


def feature_drift(reference: DataFrame, current: DataFrame, family: str,
                  features: list[str] = FEATURE_COLS) -> DataFrame:
    """Method, score and verdict per feature; the caller names the family of methods.

    With ``"p_value"`` tests decide (drift below .05): Kolmogorov-Smirnov above five distinct values,
    chi-square for three to five, a z-test of proportions below. With ``"distance"`` distances decide
    (drift from .1): Wasserstein over the reference deviation above five distinct values,
    Jensen-Shannon up to five. The number of distinct values tells kinds of columns apart; the
    number of rows plays no part.
    """
    if family not in ("p_value", "distance"):
        raise ValueError("family must be 'p_value' or 'distance'")
    stats = drift_statistics(reference, current, features)
    distinct = F.col("distinct_values")
    if family == "p_value":
        method = F.when(distinct > 5, "ks").when(distinct > 2, "chi2").otherwise("z")
        score = (
            F.when(distinct > 5, ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur")))
            .when(distinct > 2, chi2_p_value(F.col("chi2"), distinct - 1)).otherwise(z_p_value(F.col("z")))
        )
        detected = F.col("score") < P_VALUE_LIMIT
    else:
        method = F.when(distinct > 5, "wasserstein").otherwise("js")
        score = F.when(distinct > 5, F.col("wasserstein")).otherwise(F.col("js"))
        detected = F.col("score") >= DISTANCE_LIMIT
    return stats.select("feature", method.alias("method"), score.alias("score")).withColumn("detected", detected)


def dataset_drift(drift: DataFrame) -> DataFrame:
    """Share of drifted features, and whether it reaches one half."""
    share = F.avg(F.coalesce("detected", F.lit(False)).cast("double"))
    return drift.agg(
        F.count("*").alias("features"), share.alias("share")
    ).withColumn("detected", F.col("share") >= DRIFT_SHARE_LIMIT)


def drift_metrics(drift: DataFrame, current_rows: DataFrame, ts, mean: DataFrame | None = None) -> DataFrame:
    """Metric samples of a run: paper count, drift share and flag, a score per feature, mean score.

    ``current_rows`` and ``mean`` are one-row tables ``(papers)`` and ``(mean_score)``.
    """
    none = F.create_map().cast("map<string,string>")

    def samples(df: DataFrame, name: str, value, labels=none) -> DataFrame:
        return df.select(
            F.lit(name).alias("name"), labels.alias("labels"),
            value.cast("double").alias("value"), F.lit(ts).cast("timestamp").alias("ts"),
        )

    whole = dataset_drift(drift)
    rows = samples(current_rows, "current_papers_count", F.col("papers"))
    rows = rows.unionByName(samples(whole, "drift_share", F.col("share")))
    rows = rows.unionByName(samples(whole, "drift_detected", F.col("detected").cast("int")))
    by_feature = F.create_map(F.lit("feature"), F.col("feature"))
    rows = rows.unionByName(
        samples(drift, "feature_drift_score", F.coalesce("score", F.lit(0.0)), by_feature)
    )
    if mean is not None:
        rows = rows.unionByName(
            samples(mean.filter(F.col("mean_score").isNotNull()), "mean_hype_score", F.col("mean_score"))
        )
    return rows


def trend(series: DataFrame, ts: str = "ts", value: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """Latest, mean and number of samples per week, weeks starting on Monday."""
    week = F.date_trunc("week", F.col(ts)).alias("week")
    return series.groupBy(week, *keys).agg(
        F.max_by(value, ts).alias("latest"),
        F.avg(value).alias("mean"),
        F.count("*").alias("samples"),
    )

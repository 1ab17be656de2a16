"""Column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FEATURE_COLS
from .aggregates import null_report
from .cumulative import running_sums, store_ranges
from .drift import value_counts


def _quantile(share: float) -> Column:
    """Linear interpolation between the two rows around the position, from running counts."""
    place = F.max("all_rows") - 1
    # Positions per row: the aggregate below sees `all_rows` as a constant of the group.
    at = F.lit(share) * (F.col("all_rows") - 1)
    low = F.min(F.when(F.col("cum_rows") > F.floor(at), F.col("value")))
    high = F.min(F.when(F.col("cum_rows") > F.ceil(at), F.col("value")))
    part = F.lit(share) * place - F.floor(F.lit(share) * place)
    return low + (high - low) * part


def quality_summary(df: DataFrame, features: list[str] = FEATURE_COLS) -> DataFrame:
    """Per column: values, nulls, distinct values, extremes, mean, deviation, quartiles, mode.

    Everything but the nulls comes from counted distinct values.
    """
    counts = store_ranges(value_counts({"rows": df}, features), "value", ("feature",))
    means = counts.groupBy("feature").agg(
        (F.sum(F.col("rows") * F.col("value")) / F.sum("rows")).alias("mean")
    )
    ranked = running_sums(counts, "value", ["rows"], by=("feature",))
    ranked = ranked.join(F.broadcast(means), "feature")
    squares = F.sum(F.col("rows") * (F.col("value") - F.col("mean")) ** 2)
    profile = ranked.groupBy("feature").agg(
        F.max("all_rows").alias("count"),
        F.count("*").alias("distinct_values"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.max("mean").alias("mean"),
        F.sqrt(squares / F.nullif(F.max("all_rows") - 1, F.lit(0))).alias("std"),
        _quantile(0.25).alias("p25"),
        _quantile(0.5).alias("p50"),
        _quantile(0.75).alias("p75"),
        F.min_by("value", F.struct(-F.col("rows"), F.col("value"))).alias("most_common"),
    )
    # Both sides have one row per feature.
    nulls = null_report(df, features)
    return nulls.join(F.broadcast(profile), "feature", "left")


def dataset_summary(df: DataFrame, features: list[str] = FEATURE_COLS) -> DataFrame:
    """Rows, columns and NULL cells of the whole table."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in features), F.lit(0))
    return df.agg(
        F.count("*").alias("rows"), F.lit(len(features)).alias("columns"), nulls.alias("nulls")
    )

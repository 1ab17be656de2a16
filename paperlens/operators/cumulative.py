"""Exact running sums over a sorted column without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store


def store_ranges(groups: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``groups`` once, range-partitioned by ``by`` and ``value``, with the range as ``_range``.

    ``groups`` has one row per ``by`` and ``value`` (no NULL values), so no range is overfull. The
    adaptive planner chooses how many ranges there are, up to ``spark.sql.shuffle.partitions``.
    Because the range number is stored, every later step sees the same ranges, and none of them
    goes back to the rows behind ``groups``.
    """
    ranged = groups.repartitionByRange(*by, value).withColumn("_range", F.spark_partition_id())
    return store(ranged, "ranges")


def running_sums(ranges: DataFrame, value: str, sums: list[str], by: tuple[str, ...] = (),
                 descending: bool = False) -> DataFrame:
    """Add ``cum_x`` and ``all_x`` for every ``x`` in ``sums``, and ``next_value``.

    ``ranges`` comes from ``store_ranges``. ``cum_x`` sums ``x`` up to and including the row in
    value order, ``all_x`` over the whole group, ``next_value`` is the following value. The range
    totals, one row per group and range, are summed up in a small window and broadcast back as
    offsets; only rows of one range share a task.
    """

    def ordered(column: str):
        return F.desc(column) if descending else F.asc(column)

    first = F.max if descending else F.min
    totals = ranges.groupBy(*by, "_range").agg(
        *[F.sum(s).alias(f"_sum_{s}") for s in sums], first(value).alias("_first")
    )
    over = Window.partitionBy(*by).orderBy(ordered("_range"))
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_range",
        F.lead("_first").over(over).alias("_next_first"),
        *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(Window.partitionBy(*by)).alias(f"all_{s}") for s in sums],
    )
    within = Window.partitionBy(*by, "_range").orderBy(ordered(value))
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # At most spark.sql.shuffle.partitions ranges, each shared by neighbouring groups at its ends.
    joined = ranges.join(F.broadcast(offsets), [*by, "_range"])
    return joined.select(
        *[c for c in ranges.columns if c != "_range"],
        *[(F.sum(s).over(upto) + F.col(f"_before_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"all_{s}" for s in sums],
        F.coalesce(F.lead(value).over(within), F.col("_next_first")).alias("next_value"),
    )


def quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per column: ``(feature, q)`` with an array in order of ``shares``.

    Values are counted map-side, the counts stored in ranges and summed up; no task sees all values of
    a column. NULLs are left out; a column without values has no row.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "feature", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count("*").alias("n"))
    ranked = running_sums(store_ranges(counts, "value", ("feature",)), "value", ["n"], ("feature",))

    def at(rank: Column) -> Column:
        # The value with that many values before it.
        return F.min(F.when(F.col("cum_n") > rank, F.col("value")))

    def quantile(share: float) -> Column:
        place = (F.col("all_n") - 1) * F.lit(float(share))
        low = at(F.floor(place))
        high = F.coalesce(at(F.floor(place) + 1), low)
        return low + (high - low) * F.max(place - F.floor(place))

    return ranked.groupBy("feature").agg(F.array(*map(quantile, shares)).alias("q"))

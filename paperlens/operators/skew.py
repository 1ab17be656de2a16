"""Joins on keys of which one may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_left_join(facts: DataFrame, lookup: DataFrame, key: str, salts: int = 1) -> DataFrame:
    """``facts`` left join ``lookup`` (one row per key), each key spread over ``salts`` parts.

    ``salts`` is chosen by the caller and treats all keys alike: ``lookup`` is repeated that many
    times, and a row of ``facts`` takes the part that its hash names, so that a recomputed task places
    its rows as before. With one part the adaptive planner alone splits what is skewed.
    """
    if salts == 1:
        return facts.join(lookup, key, "left")
    spread = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [key, "_salt"], "left").drop("_salt")


# How many keys are looked at as frequent, and the share of all rows from which a key is one.
MOST_HEAVY, HEAVY_SHARE = 200, 0.002


def heavy_keys(facts: DataFrame, key: str, most: int = MOST_HEAVY, share: float = HEAVY_SHARE) -> list:
    """Keys that hold at least ``share`` of the rows, by a mergeable top-k sketch; at most ``most``."""
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {most * 50})")
    row = facts.filter(F.col(key).isNotNull()).agg(F.count("*").alias("n"), sketch.alias("top")).first()
    return [item["item"] for item in row["top"] or [] if item["count"] >= share * row["n"]]


def heavy_left_join(facts: DataFrame, lookup: DataFrame, key: str, most: int = MOST_HEAVY,
                    share: float = HEAVY_SHARE) -> DataFrame:
    """``facts`` left join ``lookup`` (one row per key), frequent keys apart from the others.

    Rows of frequent keys stay where they are and meet the few rows of ``lookup`` that they need, which
    are sent to every task (at most ``most``); rows without a key meet nothing. All others are joined as
    they are, and none of their keys is frequent. ``facts`` is read once more for the sketch.
    """
    heavy = heavy_keys(facts, key, most, share)
    apart = F.col(key).isNull() | F.col(key).isin(heavy)
    few = lookup.filter(F.col(key).isin(heavy))
    rest = facts.filter(~F.coalesce(apart, F.lit(True))).join(lookup, key, "left")
    return facts.filter(apart).join(F.broadcast(few), key, "left").unionByName(rest)

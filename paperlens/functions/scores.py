"""Scores, tiers, bands and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BANDS


def logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def hype_tier(score: Column, threshold: float) -> Column:
    return (
        F.when(score >= threshold, "hype").when(score >= threshold / 2, "likely").otherwise("low")
    )


def threshold_band(value: Column, kind: str) -> Column:
    """Colour of a dashboard value: the last step it reaches."""
    steps = BANDS[kind]
    band = F.lit(steps[0][1])
    for bound, colour in steps[1:]:
        band = F.when(value >= bound, colour).otherwise(band)
    return band


def drift_text(flag: Column) -> Column:
    return F.when(flag == 0, "No drift").when(flag == 1, "DRIFT")


def round4(value: Column) -> Column:
    return F.round(value, 4)

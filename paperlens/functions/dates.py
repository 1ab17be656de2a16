"""Timestamps and calendar parts. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_submitted_at(versions: Column) -> Column:
    """Date of the first version, with or without a weekday; NULL when it is neither form."""
    created = F.get(versions, F.lit(0)).getField("created")
    without_weekday = F.regexp_replace(created, r"\A(?i:mon|tue|wed|thu|fri|sat|sun), ", "")
    return F.try_to_timestamp(without_weekday, F.lit("d MMM yyyy HH:mm:ss z"))


def cast_updated_at(date: Column) -> Column:
    """Strict cast: a malformed date is an error."""
    return date.cast("timestamp")


def day_of_week(ts: Column) -> Column:
    """Monday 0 to Sunday 6; NULL when the value is no timestamp."""
    return F.weekday(ts.try_cast("timestamp"))


def month_of_year(ts: Column) -> Column:
    return F.month(ts.try_cast("timestamp"))


def iso_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def submitted_month(ts: Column) -> Column:
    """Partition value of the paper table."""
    return F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit("unknown"))


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_interval(days=F.lit(days))

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paperlens.constants import FEATURE_COLS
from paperlens.functions import features as ops

SCHEMA = """authors array<struct<name: string>>, abstract string, title string,
    categories array<string>, submitted_at string, hype_label int"""
ROW = {
    "authors": [("M. Okoro",)], "abstract": "Trees, maps and what lies between.", "title": "Maps of trees",
    "categories": ["cs.DS"], "submitted_at": "2019-07-02T06:30:00Z", "hype_label": 0,
}


def built(spark, extra_schema="", **changes):
    row = ROW | changes
    df = spark.createDataFrame([tuple(row.values())], SCHEMA + extra_schema)
    return ops.build_features(df).first().asDict()


def test_columns_are_the_contract(spark):
    assert list(built(spark)) == FEATURE_COLS
    assert len(FEATURE_COLS) == 27
    assert None not in built(spark).values()


@pytest.mark.parametrize("authors, n", [([("a",), ("b",), ("c",), ("a",)], 4), (None, 0), ([], 0)])
def test_author_count(spark, authors, n):
    assert built(spark, authors=authors)["num_authors"] == n


def test_lengths(spark):
    row = built(spark, abstract="né en été", title=" x ")
    assert (row["abstract_length"], row["title_length"]) == (9, 3)
    row = built(spark, abstract=None, title=None)
    assert (row["abstract_length"], row["title_length"]) == (0, 0)


def test_length_units(spark):
    df = spark.createDataFrame([("naïve 😀",)], "t string")
    row = df.select(ops.text_len(F.col("t")), ops.text_len(F.col("t"), "bytes")).first()
    assert tuple(row) == (7, 11)


@pytest.mark.parametrize("categories, flags", [
    (["cs.LG"], (1, 0, 0, 0)), (["cs.LG", "cs.CL"], (1, 0, 0, 1)), (None, (0, 0, 0, 0)),
    ([None, "cs.CV"], (0, 0, 1, 0)),
])
def test_category_flags(spark, categories, flags):
    row = built(spark, categories=categories)
    assert tuple(row[c] for c in ("cat_cs_LG", "cat_cs_AI", "cat_cs_CV", "cat_cs_CL")) == flags


@pytest.mark.parametrize("title, hits", [
    ("TransFormers see: revisions of computer-vision", {"buzz_transformer", "buzz_vision"}),
    ("heat diffusion", {"buzz_diffusion"}),
    ("Medieval roads", {"buzz_eval"}),
    ("Maps of trees", set()),
    (None, set()),
])
def test_buzzwords(spark, title, hits):
    row = built(spark, title=title)
    assert {k for k, v in row.items() if k.startswith("buzz_") and v} == hits


@pytest.mark.parametrize("ts, weekday, month", [
    ("2019-07-02T06:30:00Z", 1, 7), ("2020-02-29T00:00:00Z", 5, 2), ("2018-12-31T23:59:59Z", 0, 12),
    ("1999-01-03T12:00:00Z", 6, 1), ("2018-12-31T23:30:00-05:00", 1, 1), ("soon", None, None),
    (None, None, None),
])
def test_calendar(spark, ts, weekday, month):
    row = built(spark, submitted_at=ts)
    assert (row["day_of_week"], row["month"]) == (weekday, month)


def signals(row):
    return row["max_h_index"], row["total_prior_papers"], row["has_author_enrichment"]


def test_author_signals(spark):
    extra = ", max_h_index int, total_prior_papers int, has_author_enrichment boolean"
    row = built(spark, extra, max_h_index=20, total_prior_papers=50, has_author_enrichment=True)
    assert signals(row) == (20, 50, 1)
    row = built(spark, extra, max_h_index=20, total_prior_papers=None, has_author_enrichment=None)
    assert signals(row) == (20, 0, 0)
    assert signals(built(spark)) == (0, 0, 0)
    assert signals(built(spark, ", max_h_index int", max_h_index=0)) == (0, 0, 1)
    assert signals(built(spark, ", max_h_index int", max_h_index=None)) == (0, 0, 0)


@pytest.mark.parametrize("kind, value, expected", [
    ("string", "12.9", 12), ("string", " 7 ", 7), ("string", "-3.5e1", -35), ("string", "1d", 0),
    ("string", "n/a", 0), ("string", "", 0), ("string", None, 0), ("double", float("nan"), 0),
    ("double", -2.9, -2), ("float", 4.5, 4), ("bigint", 2**40, 2**40), ("int", None, 0),
])
def test_whole_number(spark, kind, value, expected):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert df.select(ops.whole_number(F.col("v"), df.schema["v"].dataType)).first()[0] == expected


def test_timestamp_column(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 14, 23, 59),)], "ts timestamp_ntz")
    row = df.select(F.weekday("ts"), *[f(F.col("ts")) for f in (ops.day_of_week, ops.month_of_year)]).first()
    assert tuple(row) == (6, 6, 1)

import pytest
from pyspark.sql import functions as F

from paperlens.functions import authors, dates, labels, scores, text


def one(spark, value, kind, function):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(function(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("url, expected", [
    (None, ""), ("https://papers.test/abs/hep-th/9901001", "hep-th/9901001"), ("no address", ""),
    ("https://papers.test/abs/1907.00042v37", "1907.00042"), ("https://papers.test/html/1907.00042v1", ""),
    ("abs/7", ""), ("/abs/7v7", "7"), ("", ""), ("a/abs/b/abs/c", ""), ("x/abs/ 2401.1 ", "2401.1"), ("x/abs/2401.1v", "2401.1v"),
    ("x/abs/2401.1v2\n", "2401.1v2"),
])
def test_extract_paper_id(spark, url, expected):
    assert one(spark, url, "string", text.extract_paper_id) == expected


@pytest.mark.parametrize("value, spaces, everything", [
    ("  a b  ", "a b", "a b"), ("\n a\t", "\n a\t", "a"), (" a ", " a ", "a"), ("", "", ""),
])
def test_clean_text(spark, value, spaces, everything):
    assert one(spark, value, "string", text.clean_text) == spaces
    assert one(spark, value, "string", lambda c: text.clean_text(c, True)) == everything


@pytest.mark.parametrize("url, expected", [
    ("https://github.com/o/r", ("o", "r")), ("https://github.com/o/r/", ("o", "r")),
    ("https://github.com/o/r//", ("o", "r")), ("https://github.com/o/r.git", ("o", "r")),
    ("https://github.com/o/r.git/", ("o", "r")), (" https://github.com/o/r \n", ("o", "r")),
    ("https://github.com/o/r/tree/main", ("o", "r")), ("https://github.com/o/r.git.git", ("o", "r.git")),
    ("https://gitlab.com/o/r", None), ("http://github.com/o/r", None), ("https://github.com/o", None),
    ("https://github.com//r", None), ("https://github.com/o//x", None), ("", None), (None, None),
])
def test_parse_repo_url(spark, url, expected):
    found = one(spark, url, "string", text.parse_repo_url)
    assert (tuple(found) if found else None) == expected


@pytest.mark.parametrize("created, expected", [
    ("Mon, 2 Apr 2007 19:18:42 GMT", "2007-04-02T19:18:42Z"), ("2 Apr 2007 19:18:42 GMT", "2007-04-02T19:18:42Z"),
    ("Tue, 02 Jan 2024 03:04:05 GMT", "2024-01-02T03:04:05Z"), ("2024-01-02", None), ("Xyz, 2 Apr 2007 19:18:42 GMT", None),
])
def test_parse_submitted_at(spark, created, expected):
    versions = [(created,), ("Sat, 1 Jan 2028 00:00:00 GMT",)]
    parse = lambda c: dates.iso_timestamp(dates.parse_submitted_at(c))
    assert one(spark, versions, "array<struct<created: string>>", parse) == expected


@pytest.mark.parametrize("versions", [None, []])
def test_parse_submitted_at_without_versions(spark, versions):
    assert one(spark, versions, "array<struct<created: string>>", dates.parse_submitted_at) is None


def test_author_structs(spark):
    parsed = [["Doe", "Jane", ""], [" Solo ", "  "], ["Only"], []]
    found = one(spark, parsed, "array<array<string>>", authors.author_structs)
    assert [a["name"] for a in found] == ["Jane Doe", "Solo", None, None]
    assert one(spark, None, "array<array<string>>", authors.author_structs) == []


@pytest.mark.parametrize("raw, expected", [
    ('[{"name": "A"}, {"name": "B", "x": 1}]', ["A", "B"]), ("[]", []), ('[{"x": 1}]', [""]),
    ("", None), ("nonsense", None), (None, None),
])
def test_author_names(spark, raw, expected):
    assert one(spark, raw, "string", authors.author_names) == expected


@pytest.mark.parametrize("names, line", [
    ([], ""), (["a"], "a"), (["a", "b", "c"], "a · b · c"), (["a", "b", "c", "d", "e"], "a · b · c +2"),
])
def test_author_line(spark, names, line):
    assert one(spark, names, "array<string>", text.author_line) == line


@pytest.mark.parametrize("score, percent, filled", [(0.0, 0, 0), (0.125, 13, 2), (0.5, 50, 6), (1.0, 100, 12)])
def test_score_texts(spark, score, percent, filled):
    assert one(spark, score, "double", text.score_percent) == percent
    assert one(spark, score, "double", text.score_bar) == "█" * filled + "░" * (12 - filled)


@pytest.mark.parametrize("tier, badge", [("hype", "HYPE"), ("likely", "LIKELY"), ("low", "LOW"), ("odd", "LOW"), (None, "LOW")])
def test_tier_badge(spark, tier, badge):
    assert one(spark, tier, "string", text.tier_badge) == badge


@pytest.mark.parametrize("score, threshold, tier", [
    (0.31, 0.3, "hype"), (0.3, 0.3, "hype"), (0.299, 0.3, "likely"), (0.15, 0.3, "likely"), (0.149, 0.3, "low"), (0.0, 0.3, "low"),
])
def test_hype_tier(spark, score, threshold, tier):
    assert one(spark, score, "double", lambda c: scores.hype_tier(c, threshold)) == tier


@pytest.mark.parametrize("x, expected", [(0.0, 0.5), (100.0, 1.0), (-100.0, 0.0), (-1000.0, 0.0)])
def test_sigmoid(spark, x, expected):
    assert one(spark, x, "double", scores.sigmoid) == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("status, upvotes, repo, expected", [
    (200, 6, "https://code.test/a", ("2401.1", 6, "https://code.test/a", True, True)),
    (200, 5, "", ("2401.1", 5, None, False, False)),
    (200, None, None, ("2401.1", 0, None, False, False)),
    (404, None, None, ("checked_none", None, None, False, None)),
    (503, None, None, None),
])
def test_paper_lookup(spark, status, upvotes, repo, expected):
    df = spark.createDataFrame([(status, "2401.1", upvotes, repo)], "s int, id string, u int, r string")
    found = df.select(labels.paper_lookup(*map(F.col, ("s", "id", "u", "r"))).alias("o")).first()["o"]
    assert (tuple(found) if found else None) == expected


@pytest.mark.parametrize("status, stars, expected", [(200, 7, 7), (404, None, 0), (403, None, None), (500, 3, None)])
def test_repo_stars(spark, status, stars, expected):
    df = spark.createDataFrame([(status, stars)], "s int, n int")
    assert df.select(labels.repo_stars(F.col("s"), F.col("n"))).first()[0] == expected


def test_star_label(spark):
    df = spark.createDataFrame([(101, None), (100, True), (None, True), (None, None)], "s int, l boolean")
    rows = df.select(labels.star_label(F.col("s"), F.col("l")).alias("r")).collect()
    assert [r["r"] for r in rows] == [True, False, True, None]


@pytest.mark.parametrize("value, kind, band", [
    (0.05, "mean_score", "blue"), (0.1, "mean_score", "green"), (0.3, "mean_score", "orange"),
    (0.5, "drift_share", "red"), (0.2, "drift_share", "yellow"), (0.09, "feature_drift", "green"),
])
def test_threshold_band(spark, value, kind, band):
    assert one(spark, value, "double", lambda c: scores.threshold_band(c, kind)) == band

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paperlens.functions.dates import iso_timestamp
from paperlens.operators.filters import since_cutoff, target_filter
from paperlens.plans.curate import curate, dump_papers
from paperlens.sources import readers, writers

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom" xmlns:os="http://a9.com/-/spec/opensearch/1.1/">
  <os:totalResults>731</os:totalResults>
  {entries}
</feed>"""
ENTRY = """<entry><id>{id}</id><title>{title}</title><summary>{summary}</summary>
  <published>{published}</published><updated>{published}</updated>{more}</entry>"""


def entry(number, day, title="On sorting", summary="We sort.", folder="abs", names=("Ito",), terms=("q-bio.GN",)):
    more = "".join(f"<author><name>{n}</name></author>" for n in names) + "".join(f'<category term="{t}"/>' for t in terms)
    return ENTRY.format(id=f"https://papers.test/{folder}/{number}", title=title, summary=summary, published=f"{day}T06:30:00Z", more=more)


def page(tmp_path, *entries, name="page.xml"):
    (tmp_path / name).write_text(FEED.format(entries="\n".join(entries)))
    return str(tmp_path)


def test_feed_page(spark, tmp_path):
    path = page(
        tmp_path,
        entry("1907.00042v3", "2019-07-02", "\n  Maps &lt;and&gt; trees ", " Trees &amp;\n maps.  ", names=("  M. Okoro", "Lu  ", "Ana P."), terms=("cs.DS", "cs.DM", "math.CO")),
        entry("1812.10101", "2018-12-24"),
        entry("hep-th/9901001v2", "1999-01-01"),
    )
    rows = {r["arxiv_id"]: r for r in readers.read_atom_pages(spark, path).withColumn(
        "at", iso_timestamp(F.col("submitted_at"))).collect()}
    assert set(rows) == {"1907.00042", "1812.10101", "hep-th/9901001"}
    first = rows["1907.00042"]
    assert (first["title"], first["abstract"]) == ("Maps <and> trees", "Trees &\n maps.")
    assert [a["name"] for a in first["authors"]] == ["M. Okoro", "Lu", "Ana P."]
    assert (first["categories"], first["at"]) == (["cs.DS", "cs.DM", "math.CO"], "2019-07-02T06:30:00Z")
    assert readers.read_feed_totals(spark, path).first()["total_results"] == 731


def test_feed_entry_without_usable_id(spark, tmp_path):
    rows = readers.read_atom_pages(spark, page(tmp_path, entry("1", "2020-01-01", folder="html"), entry("2", "2020-01-01")))
    assert [r["arxiv_id"] for r in rows.collect()] == ["2"]


def test_malformed_feed(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_atom_pages(spark, page(tmp_path, entry("5", "2020-01-01").replace("</title>", ""))).collect()


@pytest.mark.parametrize("now, n", [("2021-05-08 06:30:00", 2), ("2021-05-04 00:00:00", 3), ("2021-05-19 00:00:00", 0)])
def test_since_cutoff(spark, tmp_path, now, n):
    path = page(tmp_path, *[entry(str(k), f"2021-05-0{k}") for k in (3, 7, 8)])
    assert since_cutoff(readers.read_atom_pages(spark, path), now).count() == n


def dump_line(**changes):
    row = {
        "id": "2401.00001v3", "title": " T ", "abstract": " A\n", "categories": " cs.LG  stat.ML ",
        "update_date": "2024-02-03", "versions": [{"created": "Mon, 8 Jan 2024 10:00:00 GMT", "version": "v1"}],
        "authors_parsed": [["Doe", "Jane", ""]], "license": None,
    }
    return json.dumps(row | changes)


def test_dump_and_links(spark, tmp_path):
    lines = [
        dump_line(),
        dump_line(id="2401.00002", versions=[{"created": "9 Jan 2024 10:00:00 GMT"}]),
        dump_line(id="2312.00003", versions=[{"created": "Sun, 31 Dec 2023 23:59:59 GMT"}]),
        dump_line(id="2401.00004", categories="math.ST"),
        dump_line(id="2401.00005", versions=[{"created": "unknown"}]),
        '{"id": "2401.0000',
        "",
    ]
    (tmp_path / "dump.json").write_text("\n".join(lines))
    raw = readers.read_metadata_dump(spark, str(tmp_path / "dump.json"))
    papers = dump_papers(raw)
    first = papers.filter("arxiv_id = '2401.00001'").first()
    assert (first["title"], first["abstract"]) == ("T", "A\n")
    assert first["categories"] == ["cs.LG", "", "stat.ML"]
    assert first["updated_at_api"] == datetime(2024, 2, 3)
    assert {r[0] for r in target_filter(papers).select("arxiv_id").collect()} == {"2401.00001", "2401.00002"}

    links = spark.createDataFrame([
        ("2401.00001", "https://github.com/b/b", True), ("2401.00001", "https://github.com/a/a", True),
        ("2401.00002", "https://github.com/c/c", False), ("", "x", True), (None, "x", True),
    ], "paper_arxiv_id string, repo_url string, is_official boolean")
    links.write.parquet(str(tmp_path / "links"))
    made = curate(raw, readers.read_code_links(spark, str(tmp_path / "links")))
    rows = {r["arxiv_id"]: (r["has_code"], r["hf_github_repo"], r["hype_label"]) for r in made.collect()}
    assert rows == {
        "2401.00001": (True, "https://github.com/a/a", True), "2401.00002": (False, None, False),
    }


def test_bad_update_date_is_an_error(spark):
    df = spark.createDataFrame([("soon",)], "update_date string")
    from paperlens.functions.dates import cast_updated_at
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(cast_updated_at(F.col("update_date"))).collect()


def test_daily_feed(spark, tmp_path):
    entries = [{"paper": {"id": "1", "upvotes": 3, "githubRepo": "r"}}, {"paper": {"id": "", "upvotes": 9}},
               {"paper": {"id": "2"}}, {"title": "no paper"}, {"paper": {"id": "1", "upvotes": 8}}]
    (tmp_path / "daily.json").write_text("\n".join(map(json.dumps, entries)))
    rows = readers.read_daily_feed(spark, str(tmp_path)).orderBy("pos").drop("pos").collect()
    assert list(map(tuple, rows)) == [("1", 3, "r"), ("2", 0, ""), ("1", 8, "")]


def test_window_reads_only_its_months(spark, tmp_path):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    papers = spark.range(2400).select(
        F.col("id").cast("string").alias("arxiv_id"), F.lit(1).alias("max_h_index"),
        (start + F.make_interval(hours=F.col("id").cast("int"))).alias("submitted_at"),
    )
    path = str(tmp_path / "seed")
    writers.write_seed(papers, path)
    window = readers.read_papers_window(readers.read_papers(spark, path), "2024-03-20 00:00:00", 10)
    assert window.count() == 24 * 10 + (2400 - 24 * 79)
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(submitted_month" in plan and "2024-03" in plan


def test_reports_and_runs(spark, tmp_path):
    path = str(tmp_path / "reports")
    rows = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "feature string, score double")
    for day in ("2024-01-01", "2024-01-08", "2024-01-08"):
        writers.write_drift_report(rows, path, day)
    assert [r[0] for r in writers.report_index(spark, path).collect()] == ["2024-01-08", "2024-01-01"]
    assert spark.read.parquet(path).count() == 4
    runs = str(tmp_path / "runs")
    writers.log_run(spark, runs, "r1", {"depth": 3}, {"auc": 0.123456}, {"job": "x"})
    writers.log_run(spark, runs, "r2", metrics={"auc": 0.5})
    found = {(r["run_id"], r["kind"], r["key"]): r["value"] for r in spark.read.parquet(runs).collect()}
    assert found[("r1", "metric", "auc")] == "0.1235" and found[("r1", "param", "depth")] == "3" and len(found) == 4


def test_metric_labels_in_order(spark):
    df = spark.createDataFrame([("m", {"z": "1", "a": "2"})], "name string, labels map<string,string>")
    found = df.select(writers.label_list(F.col("name"), F.col("labels")).alias("l")).first()["l"]
    assert [(x["key"], x["value"]) for x in found] == [("__name__", "m"), ("a", "2"), ("z", "1")]


def test_database_window_has_a_task_per_day():
    found = readers.day_predicates(datetime(2024, 3, 2, 6), 3)
    assert found == [
        "submitted_at >= TIMESTAMP '2024-02-28 06:00:00' AND submitted_at < TIMESTAMP '2024-02-29 06:00:00'",
        "submitted_at >= TIMESTAMP '2024-02-29 06:00:00' AND submitted_at < TIMESTAMP '2024-03-01 06:00:00'",
        "submitted_at >= TIMESTAMP '2024-03-01 06:00:00'",
    ]

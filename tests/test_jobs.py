import json
from datetime import datetime

from pyspark.sql import functions as F

from paperlens import schemas
from paperlens.constants import INGEST_PRIORITY
from paperlens.operators.joins import hydrate_from_daily
from paperlens.sources.snapshots import PaperTable
from paperlens.streaming import jobs
from test_enrich_merge import FULL, paper
from test_sources import FEED, entry


def land(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows))


def table(spark, tmp_path):
    held = PaperTable(spark, str(tmp_path / "papers"))
    rows = [paper(**FULL), paper(**FULL | {"arxiv_id": "2", "submitted_at": datetime(2024, 3, 5)}),
            paper(**FULL | {"arxiv_id": "3", "submitted_at": datetime(2024, 6, 5)})]
    held.replace_months(spark.createDataFrame(rows, schemas.PAPERS))
    return held


def current(held):
    return {r["arxiv_id"]: r for r in held.read().collect()}


def files_of(held):
    return {f.split("submitted_month=")[1] for f in held.read().inputFiles()}


def test_table_rewrites_only_touched_months(spark, tmp_path):
    held = table(spark, tmp_path)
    before = files_of(held)
    march = held.read(["2024-03"]).drop("submitted_month")
    held.replace_months(march.withColumn("title", F.lit("changed")))
    assert {f[:7] for f in before - files_of(held)} == {"2024-03"} == {f[:7] for f in files_of(held) - before}
    assert {k: r["title"] for k, r in current(held).items()} == {"1": "Title", "2": "changed", "3": "Title"}
    keys = spark.createDataFrame([("2",), ("9",)], "arxiv_id string")
    assert held.touched_months(keys) == ["2024-03"]


def test_no_table_yet(spark, tmp_path):
    held = PaperTable(spark, str(tmp_path / "none"))
    assert held.read().count() == 0 and held.touched_months(spark.createDataFrame([("1",)], "arxiv_id string")) == []


def feed_of(*entries):
    return FEED.format(entries="\n".join(entries))


def test_feed_files_arrive_in_two_rounds(spark, tmp_path):
    held, feed, checkpoint = PaperTable(spark, str(tmp_path / "papers")), tmp_path / "feed", str(tmp_path / "cp")
    feed.mkdir()
    (feed / "one.xml").write_text(feed_of(entry("1907.00042v1", "2019-07-02"), entry("1906.00001v1", "2019-06-30")))
    daily = spark.createDataFrame([("1907.00042", 1, "", 0), ("1907.00042", 8, "https://code.test/a", 1)],
                                  "arxiv_id string, upvotes int, github_repo string, pos int")

    def enrich(papers):
        empty = {c: F.lit(None).cast(t) for c, t in [("hf_paper_id", "string"), ("hf_upvotes", "int"), ("hf_github_repo", "string"), ("hype_label", "boolean")]}
        return hydrate_from_daily(papers.withColumns(empty).withColumn("has_code", F.lit(False)), daily)

    jobs.ingest_feed(spark, str(feed), held, checkpoint, enrich, as_of="2019-07-03 00:00:00").awaitTermination()
    rows = current(held)
    assert set(rows) == {"1907.00042", "1906.00001"}
    assert (rows["1907.00042"]["hf_upvotes"], rows["1907.00042"]["hype_label"]) == (8, True)
    assert rows["1906.00001"]["hf_paper_id"] is None and rows["1906.00001"]["ingested_at"] == datetime(2019, 7, 3)

    (feed / "two.xml").write_text(feed_of(entry("1907.00042v2", "2019-07-02", title="Second version"), entry("1908.7v1", "2019-08-01")))
    jobs.ingest_feed(spark, str(feed), held, checkpoint).awaitTermination()
    rows = current(held)
    assert set(rows) == {"1907.00042", "1906.00001", "1908.7"}
    assert rows["1907.00042"]["title"] == "Second version" and rows["1907.00042"]["hf_upvotes"] == 8
    # Nothing new has landed; then the checkpoint is lost and everything comes again.
    for again in (checkpoint, str(tmp_path / "cp2")):
        jobs.ingest_feed(spark, str(feed), held, again).awaitTermination()
        assert {k: (r["title"], r["ingested_at"]) for k, r in current(held).items()} == {k: (r["title"], r["ingested_at"]) for k, r in rows.items()}


def test_first_category_in_fetch_order_counts(spark, tmp_path):
    held, feed = PaperTable(spark, str(tmp_path / "papers")), tmp_path / "feed"
    for place, category in enumerate(reversed(INGEST_PRIORITY)):
        (feed / category).mkdir(parents=True)
        (feed / category / "page.xml").write_text(feed_of(entry("1907.00042v1", "2019-07-02", title=f"From {category}", terms=(category,))))
    jobs.ingest_feed(spark, str(feed) + "/*", held, str(tmp_path / "cp")).awaitTermination()
    assert current(held)["1907.00042"]["title"] == f"From {INGEST_PRIORITY[0]}"


def test_replayed_batch_changes_nothing(spark, tmp_path):
    held, landed = table(spark, tmp_path), tmp_path / "landed"
    land(landed, "a.json", [{"arxiv_id": "1", "status": 200, "body": {"stargazers_count": 7}}])

    def run(checkpoint):
        jobs.label_stream(jobs.stream_json(spark, str(landed), schemas.REPO_LOOKUP), held, str(tmp_path / checkpoint)).awaitTermination()
        return sorted(map(repr, held.read().collect()))

    once = run("cp1")
    assert current(held)["1"]["github_stars_t60"] == 7
    assert run("cp2") == once  # the checkpoint is lost: batch 0 comes again


def test_lookups_and_labels(spark, tmp_path):
    held, found, stars = table(spark, tmp_path), tmp_path / "found", tmp_path / "stars"
    land(found, "a.json", [
        {"arxiv_id": "1", "status": 404}, {"arxiv_id": "2", "status": 503},
        {"arxiv_id": "3", "status": 200, "body": {"id": "3", "upvotes": 2, "githubRepo": ""}},
        {"arxiv_id": "3", "status": 404}, {"arxiv_id": "unknown", "status": 404},
    ])
    jobs.backfill_stream(jobs.stream_json(spark, str(found), schemas.PAPER_LOOKUP), held, str(tmp_path / "cp1")).awaitTermination()
    rows = current(held)
    assert set(rows) == {"1", "2", "3"}
    assert (rows["1"]["hf_paper_id"], rows["1"]["hf_upvotes"], rows["1"]["hype_label"]) == ("checked_none", None, None)
    assert rows["2"]["hf_upvotes"] == 9
    assert (rows["3"]["hf_paper_id"], rows["3"]["hf_upvotes"], rows["3"]["has_code"], rows["3"]["hype_label"]) == ("3", 2, False, False)

    land(stars, "a.json", [{"arxiv_id": "1", "status": 200, "body": {"stargazers_count": 101}}, {"arxiv_id": "2", "status": 404}, {"arxiv_id": "3", "status": 403}])
    jobs.label_stream(jobs.stream_json(spark, str(stars), schemas.REPO_LOOKUP), held, str(tmp_path / "cp2")).awaitTermination()
    rows = current(held)
    assert [(rows[k]["github_stars_t60"], rows[k]["hype_label"]) for k in "123"] == [(101, True), (0, False), (120, False)]


def test_stream_dedup_over_two_runs(spark, tmp_path):
    landed, out, checkpoint = tmp_path / "landed", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "arxiv_id string, submitted_at timestamp"

    def run():
        arriving = jobs.stream_json(spark, str(landed), schema).withColumn("landed_at", F.col("_metadata.file_modification_time"))
        once = jobs.stream_dedup(arriving)
        once.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
        return sorted(r["arxiv_id"] for r in spark.read.schema(schema).parquet(out).collect())

    land(landed, "a.json", [{"arxiv_id": "1", "submitted_at": "2024-01-01T00:00:00Z"}] * 2)
    assert run() == ["1"]
    land(landed, "b.json", [{"arxiv_id": "1", "submitted_at": "2024-01-02T00:00:00Z"}, {"arxiv_id": "2", "submitted_at": "2024-01-02T00:00:00Z"}])
    assert run() == ["1", "2"]
    # A paper much older than all before.
    land(landed, "c.json", [{"arxiv_id": "0", "submitted_at": "2001-01-01T00:00:00Z"}, {"arxiv_id": "2", "submitted_at": "2024-01-02T00:00:00Z"}])
    assert run() == ["0", "1", "2"]


def test_a_batch_reads_the_index_by_bucket(spark, tmp_path):
    held = table(spark, tmp_path)
    assert {tuple(r) for r in held.index().collect()} == {(r["arxiv_id"], r["submitted_month"]) for r in held.read().collect()}
    batch = spark.createDataFrame([("2",), ("none",)], "arxiv_id string")
    part = held.index(batch)
    assert "PartitionFilters: [bucket" in part._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert held.touched_months(batch) == ["2024-03"]
    # Against a scan of the table, for every key.
    for key, row in current(held).items():
        assert held.touched_months(spark.createDataFrame([(key,)], "arxiv_id string")) == [row["submitted_month"]]


def test_the_index_keeps_up_and_can_be_made_anew(spark, tmp_path):
    held = table(spark, tmp_path)
    new = spark.createDataFrame([paper(**FULL | {"arxiv_id": "9", "submitted_at": datetime(2024, 3, 7)})], schemas.PAPERS)
    for _ in range(2):
        march = held.read(["2024-03"]).drop("submitted_month")
        held.replace_months(march.unionByName(new).dropDuplicates(["arxiv_id"]), new)
        assert held.index().filter("arxiv_id = '9'").count() == 1
    before = {tuple(r) for r in held.index().collect()}
    held.reindex()
    assert {tuple(r) for r in held.index().collect()} == before
    other = PaperTable(spark, held.path, buckets=held.buckets)
    assert other.touched_months(new) == ["2024-03"]


def test_preferred_copy_over_batches(spark, tmp_path):
    source, out = tmp_path / "landed", str(tmp_path / "out")
    schema = "arxiv_id string, fetch_category string, n int, landed_at timestamp"
    land(source, "a.json", [{"arxiv_id": k, "fetch_category": c, "n": 1, "landed_at": "2024-01-01 00:00:00"}
                            for k, c in (("1", "cs.CL"), ("2", "cs.LG"), ("3", None), ("4", "cs.CV"))])
    start = lambda: jobs.stream_preferred(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source)), jobs.category_rank()
    ).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out)
    start().awaitTermination()
    land(source, "b.json", [{"arxiv_id": k, "fetch_category": c, "n": 2, "landed_at": "2024-01-01 00:40:00"}
                            for k, c in (("1", "cs.LG"), ("2", "cs.LG"), ("3", "cs.AI"))])
    start().awaitTermination()
    land(source, "c.json", [{"arxiv_id": "4", "fetch_category": "cs.LG", "n": 3, "landed_at": "2024-01-01 09:00:00"},
                            {"arxiv_id": "5", "fetch_category": "cs.LG", "n": 3, "landed_at": "2024-01-02 09:00:00"}])
    start().awaitTermination()
    found = sorted((r["arxiv_id"], r["n"]) for r in spark.read.schema(schema).parquet(out).collect())
    # 4 comes again after the delay, as a new fetch; 5 is still waiting.
    assert found == [("1", 2), ("2", 1), ("3", 2), ("4", 1), ("4", 3)]


def test_sessions_are_sorted_behind_the_shuffle(spark, tmp_path, capfd):
    """No task sorts a whole input split: between the source and the exchange by key there is no sort."""
    source = tmp_path / "landed"
    schema = "arxiv_id string, fetch_category string, landed_at timestamp"
    land(source, "a.json", [{"arxiv_id": str(k), "fetch_category": "cs.LG", "landed_at": "2024-01-01 00:00:00"} for k in range(9)])
    query = jobs.stream_preferred(spark.readStream.schema(schema).json(str(source)), jobs.category_rank()).writeStream.format(
        "parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    capfd.readouterr()
    query.explain()
    plan = capfd.readouterr().out
    assert plan.count("Exchange") == 1 and "Sort" in plan
    assert "Sort" not in plan.split("Exchange")[1]

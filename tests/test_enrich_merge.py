import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paperlens import schemas
from paperlens.operators import joins
from paperlens.operators.aggregates import dedup_first, dedup_last
from paperlens.operators.cumulative import quantiles
from paperlens.operators.filters import lookup_candidates
from paperlens.operators.merge import backfill_columns, ingest, update_labels, update_lookup_fields, upsert_papers
from paperlens.operators.skew import heavy_keys, heavy_left_join, salted_left_join
from paperlens.sources.writers import backfill_done, backfill_in_chunks


def batches(spark, kind, rows):
    return spark.createDataFrame(rows, schemas.PAPER_BATCH if kind == "paper" else schemas.AUTHOR_BATCH)


def enriched(spark, papers, authors, **options):
    answers = joins.paper_responses(batches(spark, "paper", papers))
    stats = joins.author_responses(batches(spark, "author", authors))
    made = joins.enrich_authors(answers, stats, **options)
    return {r["arxiv_id"]: r.asDict() for r in made.collect()}


def test_author_signals(spark):
    papers = [(["arXiv:1"], [("p-9", 7, [(None,), ("u",), ("",), ("v",), ("w",)])])]
    row = enriched(spark, papers, [(["u", "v"], [(3, 100), (21, 4)]), (["w"], [(20, 1)])])["1"]
    assert (row["ss_paper_id"], row["citation_count"], row["author_ids"]) == ("p-9", 7, ["u", "v", "w"])
    assert (row["max_h_index"], row["total_prior_papers"], row["has_author_enrichment"]) == (21, 105, True)


def test_unknown_paper_and_author(spark):
    papers = [(["arXiv:1", "arXiv:2", "arXiv:3"], [("p", 6, [("u",), ("x",)]), None, None])]
    found = enriched(spark, papers, [(["x", "u"], [None, (2, 3)])])
    assert set(found) == {"1"}
    assert (found["1"]["citation_count"], found["1"]["max_h_index"], found["1"]["total_prior_papers"]) == (6, 2, 3)


@pytest.mark.parametrize("policy, expected", [("null", (None, None, False)), ("zero", (0, 0, True))])
def test_paper_without_authors(spark, policy, expected):
    papers = [(["arXiv:1", "arXiv:2"], [("s1", 0, []), ("s2", 1, None)])]
    found = enriched(spark, papers, [(["a"], [(1, 1)])], no_authors=policy)
    for row in found.values():
        assert (row["max_h_index"], row["total_prior_papers"], row["has_author_enrichment"]) == expected


def test_repeated_author_counts_twice(spark):
    papers = [(["arXiv:1"], [("s1", 0, [("a",), ("a",)])])]
    assert enriched(spark, papers, [(["a"], [(3, 5)])])["1"]["total_prior_papers"] == 10


def test_hot_author_is_spread_and_exact(spark):
    rng = random.Random(1)
    pairs = [(i % 300, 7 if rng.random() < 0.4 else rng.randrange(50)) for i in range(3000)]
    facts = spark.createDataFrame(pairs, "paper_id long, author_id long")
    stats = spark.createDataFrame([(a, a % 9, a * 2) for a in range(45)], "author_id long, h_index long, paper_count long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_left_join(facts, stats, "author_id", salts=8)
        assert "_salt" in joined._jdf.queryExecution().executedPlan().toString()
        found = {r["paper_id"]: tuple(r)[1:] for r in joins.author_aggregate_join(facts, stats, salts=8).collect()}
        assert joined.count() == len(pairs)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for paper in range(300):
        own = [a for p, a in pairs if p == paper]
        assert found[paper] == (max(a % 9 if a < 45 else 0 for a in own), sum(a * 2 for a in own if a < 45))


def test_one_part_is_a_plain_join(spark):
    facts = spark.createDataFrame([(1, 1), (2, None)], "paper_id long, author_id long")
    stats = spark.createDataFrame([(1, 5, 6)], "author_id long, h_index long, paper_count long")
    joined = salted_left_join(facts, stats, "author_id")
    assert sorted(map(tuple, joined.select("paper_id", "h_index").collect())) == [(1, 5), (2, None)]


def test_first_and_last_of_copies(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("a", 3, "y"), ("b", 1, None)], "k string, pos int, v string")
    assert sorted(map(tuple, dedup_first(df, "k", "pos").collect()))[0] == ("a", 1, "x")
    assert sorted(map(tuple, dedup_last(df, "k", "pos").collect())) == [("a", 3, "y"), ("b", 1, None)]


def test_skip_predicate(spark):
    rows = [("found", "x/7", 90), ("old", "checked_none", 11), ("recent", "checked_none", 1), ("never", "", 400), ("null", None, 2)]
    df = spark.createDataFrame(rows, "arxiv_id string, hf_paper_id string, age int").withColumn(
        "submitted_at", F.lit("2024-03-01 00:00:00").cast("timestamp") - F.make_interval(days=F.col("age"))
    )
    assert {r["arxiv_id"] for r in lookup_candidates(df, "2024-03-01 00:00:00").collect()} == {"recent", "never", "null"}


def paper(**values):
    names = [f.split()[0] for f in schemas.PAPERS.replace("array<struct<name: string>>", "x").split(",")]
    return tuple(values.get(n) for n in names)


FULL = dict(
    arxiv_id="1", title="Title", abstract="Abstract", categories=["cs.LG"], authors=[("A",)],
    submitted_at=datetime(2024, 1, 1), updated_at_api=datetime(2024, 1, 2), ss_paper_id="ss", citation_count=17,
    max_h_index=4, total_prior_papers=88, has_code=True, hf_paper_id="1", hf_upvotes=9, hf_github_repo="r",
    github_stars_t60=120, hype_label=True, enriched_at=datetime(2024, 1, 3),
)


def upserted(spark, old, new, **options):
    stored = spark.createDataFrame([paper(**o) for o in old], schemas.PAPERS)
    incoming = spark.createDataFrame([paper(**n) for n in new], schemas.PAPERS)
    incoming = incoming.withColumn("pos", F.monotonically_increasing_id())
    made = upsert_papers(stored, incoming, "pos", F.lit("2024-02-01 00:00:00").cast("timestamp"), **options)
    assert made.schema.simpleString() == stored.schema.simpleString()
    return {r["arxiv_id"]: r.asDict(True) for r in made.collect()}


def test_insert_reads_back(spark):
    row = upserted(spark, [], [FULL])["1"]
    assert row["ingested_at"] == datetime(2024, 2, 1)
    assert {k: row[k] for k in FULL if k != "authors"} == {k: v for k, v in FULL.items() if k != "authors"}
    assert row["authors"] == [{"name": "A"}]


def test_second_upsert_keeps_enrichment(spark):
    again = dict(arxiv_id="1", title="Renamed", submitted_at=datetime(2025, 1, 1), has_code=False,
                 hf_paper_id="", ss_paper_id="", github_stars_t60=5)
    row = upserted(spark, [FULL | {"ingested_at": datetime(2023, 1, 1)}], [again])["1"]
    assert (row["title"], row["abstract"], row["categories"]) == ("Renamed", None, None)
    for kept in ("ss_paper_id", "citation_count", "max_h_index", "hf_paper_id", "hype_label", "enriched_at", "submitted_at"):
        assert row[kept] == FULL[kept]
    assert row["has_code"] is False and row["github_stars_t60"] == 120
    assert row["ingested_at"] == datetime(2023, 1, 1)


@pytest.mark.parametrize("protect, label", [(False, False), (True, True)])
def test_early_label_and_ground_truth(spark, protect, label):
    row = upserted(spark, [FULL], [FULL | {"hype_label": False}], protect_t60=protect)["1"]
    assert row["hype_label"] is label


def test_upsert_twice_changes_nothing(spark):
    stored = spark.createDataFrame([paper(**FULL)], schemas.PAPERS)
    incoming = spark.createDataFrame(
        [paper(arxiv_id="1", title="New", hype_label=False), paper(arxiv_id="2", title="Two")], schemas.PAPERS
    )
    incoming = incoming.withColumn("pos", F.lit(0))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    once = upsert_papers(stored, incoming, "pos", now)
    twice = upsert_papers(once, incoming, "pos", now)
    assert once.count() == 2 and once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_rows_of_a_key_are_applied_in_order(spark):
    new = [dict(arxiv_id="1", title="First", hf_upvotes=1, github_stars_t60=5), dict(arxiv_id="1", title="Last", github_stars_t60=6),
           dict(arxiv_id="2", title="Two", hf_upvotes=3), dict(arxiv_id="2", abstract="a", hf_upvotes=4)]
    found = upserted(spark, [dict(arxiv_id="1", title="Old", citation_count=9)], new)
    assert set(found) == {"1", "2"}
    assert [found["1"][c] for c in ("title", "hf_upvotes", "github_stars_t60", "citation_count")] == ["Last", 1, 5, 9]
    assert [found["2"][c] for c in ("title", "abstract", "hf_upvotes")] == [None, "a", 4]


def test_updates_by_key(spark):
    rows = spark.createDataFrame([paper(**FULL), paper(**FULL | {"arxiv_id": "2"})], schemas.PAPERS)
    gone = spark.createDataFrame([("1", "z", 4, "r", True, True, 0), ("1", "checked_none", None, None, False, None, 1), ("9", "9", 1, "r", True, True, 0)],
                                 "arxiv_id string, hf_paper_id string, hf_upvotes int, hf_github_repo string, has_code boolean, hype_label boolean, pos int")
    updated = update_lookup_fields(rows, gone, "pos")
    found = {r["arxiv_id"]: r for r in updated.collect()}
    assert set(found) == {"1", "2"} and updated.count() == 2
    assert (found["1"]["hf_paper_id"], found["1"]["hf_upvotes"], found["1"]["hype_label"]) == ("checked_none", None, None)
    assert found["2"]["hf_upvotes"] == 9 and found["1"]["github_stars_t60"] == 120

    stars = spark.createDataFrame([("2", 3, False, 9), ("2", 300, True, 8)], "arxiv_id string, github_stars_t60 int, hype_label boolean, pos int")
    found = [(r["arxiv_id"], r["github_stars_t60"], r["hype_label"]) for r in update_labels(rows, stars, "pos").collect()]
    assert sorted(found) == [("1", 120, True), ("2", 3, False)]

    added = backfill_columns(rows.select("arxiv_id"), stars.select("arxiv_id", "github_stars_t60", "pos"), "pos")
    assert sorted(map(tuple, added.collect())) == [("1", None), ("2", 3)]


def test_daily_hydration(spark):
    rows = spark.createDataFrame([paper(arxiv_id="1"), paper(**FULL | {"arxiv_id": "2"})], schemas.PAPERS)
    daily = spark.createDataFrame([("1", 3, "r", 0), ("1", 6, "", 1)], "arxiv_id string, upvotes int, github_repo string, pos int")
    found = {r["arxiv_id"]: r for r in joins.hydrate_from_daily(rows, daily).collect()}
    one = found["1"]
    assert (one["hf_paper_id"], one["hf_upvotes"], one["hf_github_repo"], one["has_code"], one["hype_label"]) == ("1", 6, None, False, True)
    assert found["2"]["hf_upvotes"] == 9


def test_heavy_keys_are_found_and_joined_apart(spark):
    rows = [(k % 3 if k % 2 else k, k) for k in range(4000)] + [(None, -k) for k in range(500)]
    facts = spark.createDataFrame(rows, "a long, b long").repartition(8)
    lookup = spark.range(2000).select(F.col("id").alias("a"), (F.col("id") * 2).alias("c"))
    assert sorted(heavy_keys(facts, "a", share=0.05)) == [0, 1, 2]
    for share in (0.05, 2.0):
        made = heavy_left_join(facts, lookup, "a", share=share)
        assert sorted(map(tuple, made.collect()), key=repr) == sorted(map(tuple, facts.join(lookup, "a", "left").collect()), key=repr)
    # The frequent keys do not take part in a shuffle by key.
    assert "BroadcastHashJoin" in heavy_left_join(facts, lookup, "a", share=0.05)._jdf.queryExecution().toString()
    assert heavy_left_join(facts.limit(0), lookup, "a").count() == 0


def test_outcome_of_an_ingest(spark, tmp_path):
    stored = spark.createDataFrame([("1", "old"), ("2", "old")], "arxiv_id string, title string")
    rows = [("2", "new", 0), ("3", "new", 0), ("3", "newer", 1), (None, "x", 0), (" ", "y", 0)]
    batch = spark.createDataFrame(rows, "arxiv_id string, title string, pos int")
    path = str(tmp_path / "merged")
    counts = ingest(stored, batch, "pos", lambda merged: merged.write.parquet(path))
    assert counts == {"upserted": 2, "updated": 1, "inserted": 1, "failed": 2}
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("1", "old"), ("2", "new"), ("3", "newer")}


def test_a_killed_backfill_goes_on(spark, tmp_path):
    papers = spark.range(200).select(F.col("id").cast("string").alias("arxiv_id"))
    path, seen = str(tmp_path / "snapshot"), []

    def fill(part):
        if len(seen) == 2:
            raise RuntimeError("killed")
        seen.append(part.count())
        return part.withColumn("stars", F.length("arxiv_id"))

    with pytest.raises(RuntimeError):
        backfill_in_chunks(papers, fill, path, 5)
    assert len(seen) == 2 and not backfill_done(spark, path, 5)
    later = backfill_in_chunks(papers, lambda part: part.withColumn("stars", F.length("arxiv_id")), path, 5)
    assert len(later) == 3 and backfill_done(spark, path, 5)
    assert backfill_in_chunks(papers, fill, path, 5) == []
    assert sorted(r[0] for r in spark.read.parquet(path).select("arxiv_id").collect()) == sorted(str(k) for k in range(200))


def test_exact_quantiles(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, rng.randrange(30)]), rng.random(), None) for _ in range(501)]
    df = spark.createDataFrame(rows, "a int, b double, c int").repartition(6)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = {r["feature"]: r["q"] for r in quantiles(df, ["a", "b", "c"], shares).collect()}
    assert set(found) == {"a", "b"}
    for name in found:
        expected = df.agg(F.percentile(name, F.array(*map(F.lit, shares)))).first()[0]
        assert found[name] == pytest.approx(expected)

import pytest
from pyspark.sql import functions as F

from paperlens.checks.bindings import toy_model
from paperlens.operators import ranking as ops
from paperlens.operators.filters import feed_search, tier_filter
from paperlens.plans.feed import feed_screen, paper_detail

AS_OF = "2024-03-01 00:00:00"


def papers(spark, n=400):
    start = F.lit(AS_OF).cast("timestamp")
    i = F.col("id").cast("int")
    return spark.range(n).select(
        F.lpad(F.col("id").cast("string"), 4, "0").alias("arxiv_id"),
        F.concat(F.lit("Title "), F.col("id")).alias("title"),
        F.repeat(F.lit("x"), (i * 37) % 3000).alias("abstract"),
        F.array(F.when(i % 2 == 0, "cs.LG").otherwise("cs.CV")).alias("categories"),
        F.array_repeat(F.concat(F.lit("Author "), F.col("id") % 7), i % 9 + 1).alias("author_names"),
        (start - F.make_interval(hours=i * 3)).alias("submitted_at"),
        F.lit(True).alias("has_code"),
        F.when(i % 3 != 0, i % 80).alias("max_h_index"),
        F.when(i % 3 != 0, i).alias("total_prior_papers"),
    )


@pytest.mark.parametrize("days, limit, n", [
    (None, None, 50), (0, 0, 50), (-1, -5, 50), (30, 1000, 200), (1, 200, 9), (2, 5, 5),
])
def test_recent_arguments(spark, days, limit, n):
    assert ops.recent_topn(papers(spark), AS_OF, days, limit).count() == n


def test_feed_is_sorted_and_limited_before_the_tier(spark):
    rows = ops.ranked_feed(papers(spark), toy_model(), AS_OF, limit=40).collect()
    scores = [r["hype_score"] for r in rows]
    assert len(rows) == 40 and scores == sorted(scores, reverse=True)
    likely = ops.ranked_feed(papers(spark), toy_model(), AS_OF, limit=40, tier="likely").collect()
    assert [r["arxiv_id"] for r in likely] == [r["arxiv_id"] for r in rows if r["hype_tier"] == "likely"]
    assert 0 < len(likely) < 40
    assert ops.ranked_feed(papers(spark), toy_model(), AS_OF, tier="odd").count() == 0
    assert ops.ranked_feed(papers(spark), toy_model(), AS_OF, tier="").count() == 50


def test_top_n_is_not_a_full_sort(spark):
    plan = ops.ranked_feed(papers(spark), toy_model(), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan.split("TakeOrderedAndProject")[1]


def test_pages(spark):
    feed = ops.ranked_feed(papers(spark), toy_model(), AS_OF, limit=45).cache()
    ids = [r["arxiv_id"] for r in feed.collect()]
    pages = [[r["arxiv_id"] for r in ops.feed_page(feed, p).orderBy("position").collect()] for p in range(1, 6)]
    assert sum(pages, []) == ids and len(pages[-1]) == 5
    late = ops.feed_page(feed, 99).collect()
    assert len(late) == 5 and late[0]["page"] == 5 and late[0]["pages"] == 5
    assert ops.feed_page(feed.limit(0), 3).count() == 0


@pytest.mark.parametrize("days, tier, expected", [
    (None, None, (30, 100, None)), (365, "hype", (90, 100, "hype")), (7, "odd", (7, 100, None)), (0, "", (30, 100, None)),
])
def test_client_arguments(days, tier, expected):
    assert tuple(ops.client_feed_args(days, tier).values()) == expected


def test_search(spark):
    df = spark.createDataFrame([("1", "Deep Nets", ["Ann Lee"]), ("2", "Other", ["Bob DEEPak"]), ("3", "x", []), ("4", "100% a_b", ["c"])],
                               "arxiv_id string, title string, author_names array<string>")
    ids = lambda q: [r["arxiv_id"] for r in feed_search(df, q).collect()]
    assert ids(" deep ") == ["1", "2"] and ids("%") == ["4"] and ids("_") == ["4"] and ids("  ") == ["1", "2", "3", "4"]


def test_tier_filter(spark):
    df = spark.createDataFrame([("hype",), ("low",)], "hype_tier string")
    assert tier_filter(df, None).count() == 2 and tier_filter(df, "low").count() == 1


def test_screen_and_detail(spark):
    shown = feed_screen(papers(spark), toy_model(), AS_OF, search="author 3").collect()
    assert len(shown) == 10 and all("Author 3" in r["author_line"] for r in shown)
    row = paper_detail(papers(spark), toy_model(), "0003").first()
    assert (row["max_h_index"], row["hf_upvotes"], row["submitted_at"]) == (None, None, "2024-02-29T15:00:00Z")
    assert paper_detail(papers(spark), toy_model(), "nope").count() == 0


def test_request_batches(spark):
    ids = spark.range(1234).select((F.col("id") % 1003).cast("string").alias("arxiv_id"))
    chunks = [r["ids"] for r in ops.chunk_requests(ids, 100).orderBy("chunk").collect()]
    assert [len(c) for c in chunks] == [100] * 10 + [3]
    assert sorted(sum(chunks, []), key=int) == [str(i) for i in range(1003)]


def test_chunks_of_many_buckets(spark):
    ids = spark.range(5003).select(F.col("id").cast("string").alias("arxiv_id"))
    ids = ids.unionByName(ids.limit(700)).unionByName(spark.createDataFrame([(None,)], "arxiv_id string"))
    for per_bucket in (1, 3, 1000):
        rows = ops.chunk_requests(ids, 100, chunks_a_bucket=per_bucket).collect()
        assert sorted(r["chunk"] for r in rows) == list(range(51))
        assert sorted(len(r["ids"]) for r in rows) == [3] + [100] * 50
        assert {len(r["ids"]) for r in rows if r["chunk"] < 50} == {100}
        assert sorted(sum((r["ids"] for r in rows), []), key=int) == [str(i) for i in range(5003)]
    assert ops.chunk_requests(ids.limit(0), 100).count() == 0


def test_top_k(spark):
    rows = [(t, f, float((t * 7 + f * 3) % 11)) for t in range(4) for f in range(12)]
    df = spark.createDataFrame(rows, "ts int, feature int, value double")
    found = {(r["ts"], r["feature"]) for r in ops.topk_per_time(df, 3).collect()}
    for t in range(4):
        best = sorted((-v, f) for s, f, v in rows if s == t)[:3]
        assert {f for s, f in found if s == t} == {f for _, f in best}


def test_best_trial(spark):
    rows = [("t0", "objective", "val_pr_auc", "0.2"), ("t1", "objective", "val_pr_auc", "0.5"), ("t2", "objective", "val_pr_auc", "0.5"),
            ("t3", "param", "val_pr_auc", "0.9"), ("t3", "objective", "val_roc_auc", "0.9")]
    best = ops.best_trial(spark.createDataFrame(rows, "run_id string, kind string, key string, value string")).first()
    assert tuple(best) == ("t1", 0.5)
    closer = [("t0", "objective", "val_pr_auc", "0.50001"), ("t1", "objective", "val_pr_auc", "0.50002")]
    assert ops.best_trial(spark.createDataFrame(closer, "run_id string, kind string, key string, value string")).first()["run_id"] == "t1"


def test_chunks_follow_the_order_of_ids(spark):
    """Which batch an id is in is fixed: the ids in order, cut after every hundred."""
    ids = spark.range(5003).select(F.col("id").cast("string").alias("arxiv_id"))
    ids = ids.unionByName(ids.limit(700))
    wanted = sorted(str(i) for i in range(5003))
    for per_bucket in (1, 3, 1000):
        made = ops.chunk_requests(ids.repartition(5), 100, chunks_a_bucket=per_bucket).collect()
        assert {r["chunk"]: r["ids"] for r in made} == {k: wanted[k * 100: k * 100 + 100] for k in range(51)}

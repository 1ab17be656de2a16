import pytest
from pyspark.sql import functions as F

from paperlens.operators import split as ops


def rows(spark, n=100, every=5):
    return spark.range(n).select(
        F.col("id").cast("string").alias("key"), (F.col("id") % every == 0).cast("int").alias("y")
    )


def members(df, **options):
    made = ops.stratified_split(df, "y", "key", **options)
    return {r["key"]: (r["split"], r["y"]) for r in made.collect()}


def test_sizes_and_proportions(spark):
    found = members(rows(spark))
    assert len(found) == 100
    for split, n, positive in [("train", 80, 16), ("val", 10, 2), ("test", 10, 2)]:
        inside = [y for s, y in found.values() if s == split]
        assert (len(inside), sum(inside)) == (n, positive)


def test_same_seed_same_split_whatever_the_layout(spark):
    df = rows(spark)
    assert members(df) == members(df.repartition(7)) != members(df, seed=7)


def test_label_stays_with_its_row(spark):
    assert all(y == int(int(k) % 5 == 0) for k, (_, y) in members(rows(spark)).items())


def test_published_sizes():
    quotas = ops.split_quotas({False: 229_948 - 5_059, True: 5_059})
    sizes = [sum(q[s] for q in quotas.values()) for s in ("train", "val", "test")]
    assert sizes == [183_958, 22_995, 22_995]


@pytest.mark.parametrize("counts", [{0: 3, 1: 4}, {0: 1}, {0: 7, 1: 1, 2: 2}, {0: 999, 1: 2}])
def test_quotas_add_up(counts):
    quotas = ops.split_quotas(counts)
    for label, n in counts.items():
        assert sum(quotas[label].values()) == n and min(quotas[label].values()) >= 0


def test_rows_without_label_drop(spark):
    df = rows(spark).withColumn("y", F.when(F.col("key") != "3", F.col("y")))
    assert "3" not in members(df)


def test_too_many_labels_are_an_error(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("key"), F.col("id").alias("y"))
    with pytest.raises(ValueError, match="labels"):
        ops.stratified_split(df, "y", "key")


def papers(spark, n=300):
    return spark.range(n).select(
        F.col("id").cast("string").alias("arxiv_id"), (F.col("id") % 10).cast("int").alias("max_h_index"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 4 == 0).alias("hype_label"),
    )


def test_reference_sample(spark):
    df = papers(spark)
    pool = {r["arxiv_id"]: r["hype_label"] for r in df.filter("max_h_index > 0").collect()}
    drawn = ops.reference_sample(df, 60)
    assert "hype_label" not in drawn.columns
    ids = [r["arxiv_id"] for r in drawn.collect()]
    assert set(ids) <= set(pool) and len(ids) == len(set(ids))
    for label in (True, False):
        share = round(60 / len(pool) * sum(v is label for v in pool.values()))
        assert sum(pool[i] is label for i in ids) == share
    assert not any(pool[i] is None for i in ids)


def test_reference_sample_of_one_label(spark):
    df = papers(spark).withColumn("hype_label", F.lit(True))
    drawn = ops.reference_sample(df, 50)
    assert drawn.count() == 50
    assert ops.reference_sample(df, 10_000).count() == 270


def test_copies_of_a_key_stay_together(spark):
    copies = rows(spark, 50).crossJoin(spark.range(4).select(F.col("id").alias("copy")))
    made = ops.stratified_split(copies, "y", "key")
    assert made.groupBy("key").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0

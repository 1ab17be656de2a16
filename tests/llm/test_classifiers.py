"""Quality, toxicity and the n-gram ratio: held-out accuracy, brute force, odd rows."""

import math
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperlens.llm import quality_fm, queries, target_ratio, toxic_segments

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def held(report, labels, label):
    rows = report.filter("held_out").select("doc_id", "score", "predicted").join(labels, "doc_id").toPandas()
    return rows.predicted.to_numpy(), rows[label].to_numpy(), rows.score.to_numpy()


def test_quality_on_held_out_documents(tables):
    docs, labels = tables
    predicted, wanted, score = held(quality_fm.quality_report(docs, quality_fm.fit(docs, labels)), labels, "quality")
    assert (predicted == wanted).mean() > 0.97 and predicted[wanted == 1].mean() > 0.98
    assert ((score >= 0) & (score <= 1)).all()


def test_toxicity_on_held_out_documents(tables):
    docs, labels = tables
    predicted, wanted, _ = held(toxic_segments.toxicity_report(docs, toxic_segments.fit(docs, labels)), labels, "toxic")
    assert predicted[wanted == 1].mean() > 0.9 and predicted[wanted == 0].mean() < 0.03


def test_interactions_by_the_sum_of_squares():
    rng = np.random.default_rng(3)
    model = quality_fm.Model(0.3, rng.normal(size=30), rng.normal(size=(30, 4)), False)
    place, value = rng.permutation(30)[:9], rng.normal(size=9)
    pairs = sum(model.factors[i] @ model.factors[j] * x * y
                for a, (i, x) in enumerate(zip(place, value)) for j, y in list(zip(place, value))[a + 1:])
    expected = 0.3 + model.weights[place] @ value + pairs
    assert model.margins(1, np.zeros(9, np.int64), place, value)[0] == pytest.approx(expected)


def test_quality_of_odd_rows(spark, odd, odd_rows, none, labels):
    model = quality_fm.fit(odd, labels)
    report = quality_fm.quality_report(odd, model).collect()
    assert len(report) == len(odd_rows) and all(0 <= r.score <= 1 for r in report)
    scores = {}
    for row, r in zip(sorted(odd_rows, key=repr), sorted(report, key=lambda r: repr(r.doc_id))):
        scores.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for s in scores.values())
    again = quality_fm.keep_good(odd, model, 0.0)
    assert again.columns == odd.columns and again.count() == len(odd_rows)
    assert quality_fm.quality_report(none, model).count() == 0
    empty = quality_fm.fit(none, labels.limit(0))
    assert all(0 <= r.score <= 1 for r in quality_fm.quality_report(odd, empty).collect())
    assert quality_fm.quality_report(odd, empty).count() == len(odd_rows)


def test_labels_of_held_out_rows_are_never_read(spark, tables):
    docs, labels = tables
    docs = docs.filter("doc_id < 400")
    turned = labels.withColumn("quality", F.when(quality_fm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_fm.fit(docs, labels), quality_fm.fit(docs, turned)
    assert (a.weights == b.weights).all() and (a.factors == b.factors).all()


@settings(deadline=None, max_examples=200)
@given(st.lists(st.sampled_from([-3.0, -0.5, -0.25, 1.0, 2.5]), max_size=14))
def test_segments_against_all_spans(scores):
    at = [k for k, s in enumerate(scores) if s > 0]
    lost = [-sum(s for s in scores[a + 1: b] if s < 0) for a, b in zip([-1, *at], at)]
    found = toxic_segments.segments(at, [scores[k] for k in at], lost)

    def maximal(a, b):
        """Maximal segments of scores[a:b]: the best span, the shortest of equals, then those on both sides."""
        best = max(((sum(scores[i:j]), i - j, -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        _, _, _, i, j = best
        return maximal(a, i) + [(i, j)] + maximal(j, b)

    total = sum(sum(scores[i:j]) for i, j in maximal(0, len(scores)))
    assert sum(s for _, _, s in found) == pytest.approx(total)
    assert all(s == pytest.approx(sum(scores[i:j])) for i, j, s in found)
    assert all(b[0] >= a[1] for a, b in zip(found, found[1:]))


def test_chance_of_many_segments():
    """Every segment counts: the formula term by term on short lists, and long lists beyond any fixed number."""
    model = toxic_segments.Model(np.zeros(0, int), np.zeros(0), 0.05, 1.1, 0.003, 0.1)

    def plain(scores, tokens):
        total, best = 0.0, 1.0
        for r, score in enumerate(sorted(scores, reverse=True), 1):
            total += model.rate * score - math.log(model.scale * tokens)
            if total > r:
                tail = math.exp(-total) * total ** (r - 1) / (math.factorial(r) * math.factorial(r - 1))
                best = min(best, 2.0 ** r * -math.expm1(-tail))
        return best

    rng = np.random.default_rng(2)
    for size in (1, 2, 5, 9):
        scores = rng.uniform(0.5, 6, size).tolist()
        assert toxic_segments.chance(scores, 700, model) == pytest.approx(plain(scores, 700))
    assert toxic_segments.chance([0.1], 5000, model) == 1.0
    by_number = [toxic_segments.chance([4.0] * n, 5000, model) for n in (40, 60, 90)]
    assert by_number[0] > by_number[1] > by_number[2] > 0


def test_clean_words_lose_their_log_odds(spark):
    """A word of clean texts costs more between two toxic ones than an unknown word does."""
    rows = [(k, "vile scum " + "filler " * 5 if k % 2 else "garden sun " + "filler " * 5) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxic_segments.fit(docs, labels)
    data = np.frombuffer(b"vile garden scum vile unknown scum", np.uint8)
    (_, _, one), (_, _, two) = toxic_segments.scanned(data, np.array([0, 16, len(data)]), model.table())
    whole = max(s for _, _, s in two)
    assert (model.scores < -model.loss).any() and whole > max(s for _, _, s in one)


def test_toxicity_of_odd_rows(spark, odd, odd_rows, none, labels):
    model = toxic_segments.fit(odd, labels, least=1)
    report = toxic_segments.toxicity_report(odd, model).collect()
    assert len(report) == len(odd_rows) and all(0 <= r.score <= 1 for r in report)
    assert toxic_segments.with_toxicity(odd, model).columns == [c for c in odd.columns if c != "score"] + ["score", "passages"]
    assert toxic_segments.toxicity_report(none, model).count() == 0
    nothing = toxic_segments.fit(none, labels.limit(0))
    assert {r.predicted for r in toxic_segments.toxicity_report(odd, nothing).collect()} <= {0, 1}


def test_passages_are_where_the_words_are(spark, tables):
    docs, labels = tables
    model = toxic_segments.fit(docs, labels)
    text = "é ééé " * 30 + "you worthless pathetic moron of scum" + " and more" * 30
    row = toxic_segments.with_toxicity(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row.score > 0.9
    assert any("worthless pathetic moron" in text[p.start: p.end] for p in row.passages)


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k: k + 5]) for k in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if times[w] > 1:
            covered |= set(range(k, k + 5))
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_rules(spark, odd, odd_rows, none):
    more = [(100 + k, t) for k, t in enumerate(["a b c d e a b c d e x", "x\nx\n \n \nx y\nx", "a a a a a a", "#1 $2 |\n|\n|", "1 2 3 4 1 2 3 4 1 2 3 4"])]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    ids = docs.select("doc_id").filter("doc_id is not null").distinct()
    report = target_ratio.rules_report(docs, ids).collect()
    expected = [(r[0], *brute_rules(r[1])) for r in [*odd_rows, *more]]
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in report]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    for r in report:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept) and math.isfinite(r.llr)
        assert r.llr == pytest.approx(0.0, abs=0.3)  # all documents but that without an id are trusted
    assert target_ratio.rules_report(none, none).count() == 0
    assert target_ratio.rules_report(docs, ids.limit(0)).count() == len(expected)


def test_ratio_tells_junk_from_text(spark, tables):
    docs, labels = tables
    report = target_ratio.rules_report(docs, target_ratio.trusted_sample(labels))
    rows = report.join(labels, "doc_id").filter("not base_failed").toPandas()
    assert rows.kept[rows.quality == 1].mean() > 0.99 and rows.kept[rows.quality == 0].mean() < 0.15


def test_a_filter_does_not_repeat_the_steps(spark):
    """Long texts: 60 words took 40 seconds where the filter went below the steps."""
    text = " ".join(f"w{k % 90}" for k in range(400))
    docs = spark.createDataFrame([(1, text), (2, text + " more")], "doc_id long, text string")
    report = target_ratio.rules_report(docs, docs.select("doc_id"))
    whole = {tuple(r) for r in report.collect()}
    start = time.time()
    assert {tuple(r) for r in report.filter("kept or not base_failed or n_words > 0").collect()} == whole
    assert time.time() - start < 60


def brute_ratios(docs, trusted):
    """Mean log ratio of every document by plain counting; hashes are Spark's."""
    spark = trusted.sparkSession
    grams = {}
    for number, (doc_id, text) in enumerate(docs):
        words = [w for w in re.split("[ \t-\r]+", text or "") if w]
        grams[number] = [(w,) for w in words] + list(zip(words, words[1:]))
    every = sorted({g for gs in grams.values() for g in gs})
    rows = spark.createDataFrame([(k, list(g)) for k, g in enumerate(every)], "k int, g array<string>")
    one = F.xxhash64(F.xxhash64(F.get("g", F.lit(0))))
    two = F.xxhash64(F.xxhash64(F.get("g", F.lit(0))), F.xxhash64(F.get("g", F.lit(1))))
    place = F.shiftrightunsigned(F.when(F.size("g") == 1, one).otherwise(two), 48)
    bucket = {every[r[0]]: r[1] for r in rows.select("k", place).collect()}
    good = {r[0] for r in trusted.collect()}
    raw = Counter(bucket[g] for gs in grams.values() for g in gs)
    aim = Counter(bucket[g] for number, gs in grams.items() if docs[number][0] in good for g in gs)
    all_raw, all_aim = sum(raw.values()), sum(aim.values())
    ratio = {b: math.log((aim[b] + 1) / (all_aim + target_ratio.BUCKETS)) - math.log((raw[b] + 1) / (all_raw + target_ratio.BUCKETS)) for b in raw}
    return [sum(ratio[bucket[g]] for g in gs) / len(gs) if gs else 0.0 for gs in grams.values()]


def test_ratio_and_verdict_by_brute_force(spark, odd, odd_rows):
    trusted = spark.createDataFrame([(i,) for i in (6, 8, 11, 16)], "doc_id long")
    expected = brute_ratios([(r[0], r[1]) for r in odd_rows], trusted)
    found = target_ratio.rules_report(odd, trusted).collect()
    assert len(found) == len(expected)
    for (row, wanted), r in zip(zip(odd_rows, expected), found):
        assert r.doc_id == row[0] and r.llr == pytest.approx(wanted)
        assert r.kept == (not r.base_failed and r.llr >= -0.15)


def test_all_trusted_documents_count(spark, tmp_path):
    """Where every document is labelled good, both multinomials are the same, however many there are."""
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit("w"), F.col("id") * 10 + k) for k in range(10)]).alias("text"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    rows.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    report = queries.QUERIES["op7_target_ratio"](spark, str(tmp_path))
    assert report.count() == 60_000 and report.filter("llr <> 0 or not kept").count() == 0


def test_ratio_by_brute_force(spark, odd, odd_rows):
    """Repeated ids count with each row of theirs, null ids never are trusted."""
    trusted = {6, 8, 11, 16}
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    found = {r.bucket: r.t for r in target_ratio.bucket_counts(target_ratio.of_trusted(odd, ids), "t").collect()}
    total = sum(2 * len(w) - 1 for w in ((r[1] or "").split() for r in odd_rows if r[0] in trusted))
    assert sum(found.values()) == total


def test_learning_rows_reach_the_driver_as_places(spark, monkeypatch):
    """Four bytes for each used place come to the driver; their values are those that scoring makes."""
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(59)), lambda k: F.hex(F.xxhash64("doc_id", k))))
    docs = spark.range(300).select(F.col("id").alias("doc_id")).select("doc_id", text.alias("text"), F.lit(900).alias("n_chars"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    sent, taken = [], {}
    collect = type(docs).toArrow

    def noted(df):
        sent.append(collect(df))
        return sent[-1]

    fit_arrays = quality_fm.fit_arrays
    monkeypatch.setattr(type(docs), "toArrow", noted)
    monkeypatch.setattr(quality_fm, "fit_arrays", lambda *a: taken.update(zip(("y", "row", "place", "value"), a)) or fit_arrays(*a))
    quality_fm.fit(docs, labels)
    assert len(taken["place"]) > 1000 and sum(t.nbytes for t in sent) < 5 * len(taken["place"]) + 50 * len(taken["y"])
    words = taken["place"] < quality_fm.STATISTICS_AT
    squares = np.bincount(taken["row"][words], taken["value"][words] ** 2)
    assert squares == pytest.approx(1.0) and set(taken["value"][~words]) == {1.0}

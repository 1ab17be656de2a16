"""Projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import BUZZWORD_FEATURES, CATEGORY_FEATURES, FEATURE_COLS
from ..functions import authors, dates, features, labels, scores, text
from ..plans.feed import card_view
from ..operators.trees import score_papers
from . import check
from .bindings import FEATURE_LIST, P, PF, PS, papers, table, toy_model


@check("""
SELECT page_id, regexp_replace(concat(url, 'v', cast(page_id AS VARCHAR)), 'v[0-9]+$', '') AS plain,
  regexp_replace(url, 'v[0-9]+$', '') AS url FROM pages
""")
def strip_version(spark, sf):
    tagged = F.concat("url", F.lit("v"), F.col("page_id").cast("string"))
    return table(spark, sf, "pages").select(
        "page_id", text.strip_version(tagged).alias("plain"), text.strip_version(F.col("url")).alias("url")
    )


@check(r"""
WITH u AS (SELECT page_id, CASE page_id % 3
    WHEN 0 THEN concat('http://host/abs/', cast(page_id AS VARCHAR), 'v', cast(page_id % 12 AS VARCHAR))
    WHEN 1 THEN concat(url, '/abs/cs/', cast(page_id AS VARCHAR), '/abs/x')
    ELSE url END AS url FROM pages)
SELECT page_id, CASE WHEN len(string_split(url, '/abs/')) = 2
  THEN trim(regexp_replace(string_split(url, '/abs/')[2], 'v[0-9]+$', '')) ELSE '' END AS paper_id FROM u
""")
def extract_paper_id(spark, sf):
    page = F.col("page_id").cast("string")
    kind = F.col("page_id") % 3
    url = (
        F.when(kind == 0, F.concat(F.lit("http://host/abs/"), page, F.lit("v"),
                                   (F.col("page_id") % 12).cast("string")))
        .when(kind == 1, F.concat("url", F.lit("/abs/cs/"), page, F.lit("/abs/x"))).otherwise(F.col("url"))
    )
    return table(spark, sf, "pages").select("page_id", text.extract_paper_id(url).alias("paper_id"))


@check(r"""
WITH t AS (SELECT doc_id, concat('  ', text, chr(10), ' ') AS padded FROM documents)
SELECT doc_id, cast(length(trim(padded)) AS INT) AS spaces, trim(padded) AS by_spaces,
  regexp_replace(regexp_replace(padded, '^\s+', ''), '\s+$', '') AS by_whitespace FROM t
""")
def clean_text(spark, sf):
    padded = F.concat(F.lit("  "), F.col("text"), F.lit("\n "))
    return table(spark, sf, "documents").select(
        "doc_id", F.length(text.clean_text(padded)).alias("spaces"),
        text.clean_text(padded).alias("by_spaces"),
        text.clean_text(padded, True).alias("by_whitespace"),
    )


@check("""
SELECT doc_id, cast(len(string_split(trim(text), ' ')) AS INT) AS tokens,
  array_to_string(string_split(trim(text), ' '), '|') AS joined FROM documents
""")
def split_categories(spark, sf):
    parts = text.split_categories(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.size(parts).alias("tokens"), F.array_join(parts, "|").alias("joined")
    )


@check("""
SELECT event_id, CASE WHEN event_id % 3 < 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS submitted_at
FROM events
""")
def parse_submitted_at(spark, sf):
    kind = F.col("event_id") % 3
    plain = F.concat(F.date_format("ts", "d MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    created = (
        F.when(kind == 0, F.concat(F.date_format("ts", "EEE"), F.lit(", "), plain))
        .when(kind == 1, plain).otherwise(F.date_format("ts", "yyyy/MM/dd"))
    )
    versions = F.array(F.struct(created.alias("created")), F.struct(F.lit("later").alias("created")))
    parsed = dates.parse_submitted_at(versions)
    return table(spark, sf, "events").select(
        "event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("submitted_at")
    )


@check("""
SELECT o_orderkey, strftime(cast(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')
  AS updated_at FROM orders
""")
def cast_updated_at(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(dates.cast_updated_at(day), "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
    )


@check("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || ' ' || n_name WHEN 1 THEN n_name
  WHEN 2 THEN '' ELSE '-' END AS names,
  cast(CASE WHEN c_custkey % 4 = 2 THEN 0 ELSE 1 END AS INT) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def author_structs(spark, sf):
    joined = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    kind = F.col("c_custkey") % 4
    last = F.concat(F.lit(" "), F.col("n_name"))
    parsed = (
        F.when(kind == 0, F.array(F.array(last, F.col("c_name"), F.lit("Jr"))))
        .when(kind == 1, F.array(F.array(last, F.lit("  "))))
        .when(kind == 3, F.array(F.array(last)))
    )
    names = authors.struct_names(authors.author_structs(parsed))
    shown = F.array_join(F.transform(names, lambda n: F.when(n == "", "-").otherwise(n)), "|")
    return joined.select("c_custkey", shown.alias("names"), F.size(names).alias("n"))


@check(P + """
SELECT arxiv_id, CASE WHEN doc_id % 6 = 5 THEN NULL ELSE array_to_string(author_names, '|') END AS names
FROM papers
""")
def author_names(spark, sf):
    named = F.to_json(F.transform("author_names", lambda n: F.struct(n.alias("name"))))
    raw = F.when(F.col("doc_id") % 6 != 5, named).otherwise(F.lit("[{not json"))
    return papers(spark, sf).select(
        "arxiv_id", F.array_join(authors.author_names(raw), "|").alias("names")
    )


@check(P + """
SELECT arxiv_id, cast(coalesce(len(author_names), 0) AS INT) AS authors,
  cast(CASE WHEN doc_id % 5 = 3 THEN 0 ELSE len(categories) END AS INT) AS categories FROM papers
""")
def list_len(spark, sf):
    categories = F.when(F.col("doc_id") % 5 != 3, F.col("categories"))
    return papers(spark, sf).select(
        "arxiv_id", features.list_len(F.col("author_names")).alias("authors"),
        features.list_len(categories).alias("categories"),
    )


@check(P + """
SELECT arxiv_id, cast(length(abstract) AS INT) AS chars, cast(strlen(abstract) AS INT) AS bytes,
  cast(CASE WHEN doc_id % 2 = 0 THEN 0 ELSE length(title) END AS INT) AS title FROM papers
""")
def text_len(spark, sf):
    title = F.when(F.col("doc_id") % 2 != 0, F.col("title"))
    return papers(spark, sf).select(
        "arxiv_id", features.text_len(F.col("abstract")).alias("chars"),
        features.text_len(F.col("abstract"), "bytes").alias("bytes"),
        features.text_len(title).alias("title"),
    )


@check(P + """
SELECT arxiv_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE cast(isodow(submitted_at) - 1 AS INT) END AS day_of_week,
  CASE WHEN doc_id % 9 = 0 THEN NULL ELSE cast(month(submitted_at) AS INT) END AS month FROM papers
""")
def calendar_parts(spark, sf):
    as_text = F.date_format("submitted_at", "yyyy-MM-dd HH:mm:ss")
    ts = F.when(F.col("doc_id") % 9 == 0, F.lit("not a date")).otherwise(as_text)
    return papers(spark, sf).select(
        "arxiv_id", dates.day_of_week(ts).alias("day_of_week"), dates.month_of_year(ts).alias("month")
    )


@check(PF + f"SELECT arxiv_id, {', '.join(CATEGORY_FEATURES)} FROM features")
def category_multi_hot(spark, sf):
    return features.category_multi_hot(papers(spark, sf), ("arxiv_id",))


@check(PF + f"SELECT arxiv_id, {', '.join(BUZZWORD_FEATURES)} FROM features")
def buzzword_flags(spark, sf):
    return features.buzzword_table(papers(spark, sf), ("arxiv_id",))


@check(P + """
SELECT arxiv_id, cast(contains(lower(title), 'ation') AS INT) AS buzz_ation,
  cast(contains(lower(title), 'ment') AS INT) AS buzz_ment,
  cast(contains(lower(title), 'the') AS INT) AS buzz_the,
  cast(contains(lower(title), 'ing') AS INT) AS buzz_ing FROM papers
""")
def buzzword_flags_frequent(spark, sf):
    return features.buzzword_table(papers(spark, sf), ("arxiv_id",), ["ation", "ment", "the", "ing"])


@check(P + """
SELECT arxiv_id, cast(coalesce(max_h_index, 0) AS BIGINT) AS max_h_index,
  cast(CASE WHEN doc_id % 2 = 0 THEN 0 ELSE coalesce(total_prior_papers, 0) END AS BIGINT)
    AS total_prior_papers,
  cast(max_h_index IS NOT NULL AS INT) AS has_author_enrichment FROM papers
""")
def author_signals(spark, sf):
    total = F.concat(F.col("total_prior_papers").cast("string"), F.lit(".75"))
    rows = papers(spark, sf).withColumn(
        "total_prior_papers", F.when(F.col("doc_id") % 2 == 0, F.lit("n/a")).otherwise(total)
    )
    signals = features.author_signals(rows)
    names = ["max_h_index", "total_prior_papers", "has_author_enrichment"]
    return rows.select("arxiv_id", *[s.alias(n) for s, n in zip(signals, names)])


@check(PF + f"SELECT arxiv_id, {FEATURE_LIST} FROM features")
def build_features(spark, sf):
    return features.build_features(papers(spark, sf), ("arxiv_id",))


@check(PF + f"""
SELECT f.arxiv_id, {', '.join('f.' + c for c in FEATURE_COLS if c not in ('abstract_length', 'title_length'))},
  cast(strlen(p.abstract) AS INT) AS abstract_length, cast(strlen(p.title) AS INT) AS title_length
FROM features f JOIN papers p ON f.arxiv_id = p.arxiv_id
""")
def build_features_bytes(spark, sf):
    return features.build_features(papers(spark, sf), ("arxiv_id",), "bytes")


@check(P + "SELECT arxiv_id, cast(hype_label AS INT) AS label FROM papers WHERE hype_label IS NOT NULL")
def get_label(spark, sf):
    rows = papers(spark, sf).filter(F.col("hype_label").isNotNull())
    return rows.select("arxiv_id", features.get_label(F.col("hype_label") == 1).alias("label"))


REPO_URLS = """u AS (SELECT page_id, CASE page_id % 5
    WHEN 0 THEN url
    WHEN 1 THEN regexp_replace(url, '^https?://[^/]+', 'https://github.com')
    WHEN 2 THEN concat('  https://github.com/owner', cast(page_id AS VARCHAR), '/repo.git// ')
    WHEN 3 THEN concat('https://github.com/o/r', cast(page_id AS VARCHAR), '.git')
    ELSE concat('https://github.com/', cast(page_id AS VARCHAR)) END AS url FROM pages)"""


def repo_urls(spark, sf):
    page = F.col("page_id").cast("string")
    kind = F.col("page_id") % 5
    url = (
        F.when(kind == 0, F.col("url"))
        .when(kind == 1, F.regexp_replace("url", "^https?://[^/]+", "https://github.com"))
        .when(kind == 2, F.concat(F.lit("  https://github.com/owner"), page, F.lit("/repo.git// ")))
        .when(kind == 3, F.concat(F.lit("https://github.com/o/r"), page, F.lit(".git")))
        .otherwise(F.concat(F.lit("https://github.com/"), page))
    )
    return table(spark, sf, "pages").select("page_id", url.alias("url"))


@check(f"""
WITH {REPO_URLS},
c AS (SELECT page_id, string_split(regexp_replace(rtrim(trim(url), '/'), '\\.git$', ''), '/') AS p FROM u)
SELECT page_id, CASE WHEN ok THEN p[4] END AS owner, CASE WHEN ok THEN p[5] END AS repo
FROM (SELECT page_id, p, coalesce(p[1] = 'https:' AND p[2] = '' AND p[3] = 'github.com'
        AND p[4] <> '' AND p[5] <> '', false) AS ok FROM c) x
""")
def parse_repo_url(spark, sf):
    parsed = text.parse_repo_url(F.col("url"))
    return repo_urls(spark, sf).select("page_id", parsed["owner"].alias("owner"), parsed["repo"].alias("repo"))


@check("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS status FROM orders
""")
def empty_to_null(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", text.empty_to_null(status).alias("status"))


@check(P + "SELECT arxiv_id, hf_upvotes > 5 AS label FROM papers")
def prelim_label(spark, sf):
    return papers(spark, sf).select("arxiv_id", labels.prelim_label(F.col("hf_upvotes")).alias("label"))


@check(P + """
SELECT arxiv_id, CASE WHEN github_stars_t60 IS NOT NULL THEN github_stars_t60 > 100
  ELSE doc_id % 2 = 0 END AS label FROM papers
""")
def star_label(spark, sf):
    old = F.col("doc_id") % 2 == 0
    return papers(spark, sf).select(
        "arxiv_id", labels.star_label(F.col("github_stars_t60"), old).alias("label")
    )


@check("SELECT o_orderkey, o_orderkey % 3 = 0 AS has_code FROM orders")
def has_code_from_repo(spark, sf):
    kind = F.col("o_orderkey") % 3
    repo = F.when(kind == 0, F.col("o_orderstatus")).when(kind == 1, "")
    return table(spark, sf, "orders").select("o_orderkey", labels.has_code_from_repo(repo).alias("has_code"))


@check("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN cast(o_custkey AS INT) WHEN 1 THEN 0 END AS stars,
  CASE o_orderkey % 3 WHEN 0 THEN cast(o_orderkey AS VARCHAR) WHEN 1 THEN 'checked_none' END AS hf_paper_id,
  CASE WHEN o_orderkey % 3 = 0 THEN cast(o_custkey AS INT) END AS upvotes,
  CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus <> 'F' WHEN 1 THEN false END AS has_code,
  CASE WHEN o_orderkey % 3 = 0 THEN o_custkey > 5 END AS label
FROM orders
""")
def lookup_outcome(spark, sf):
    kind = F.col("o_orderkey") % 3
    status = F.when(kind == 0, 200).when(kind == 1, 404).otherwise(503)
    count = F.col("o_custkey").cast("int")
    repo = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    paper = labels.paper_lookup(status, F.col("o_orderkey").cast("string"), count, repo)
    return table(spark, sf, "orders").select(
        "o_orderkey", labels.repo_stars(status, count).alias("stars"),
        paper["hf_paper_id"].alias("hf_paper_id"), paper["hf_upvotes"].alias("upvotes"),
        paper["has_code"].alias("has_code"), paper["hype_label"].alias("label"),
    )


@check(P + "SELECT arxiv_id, concat('arXiv:', arxiv_id) AS key FROM papers")
def enrichment_key(spark, sf):
    return papers(spark, sf).select("arxiv_id", text.enrichment_key(F.col("arxiv_id")).alias("key"))


@check(PS + "SELECT arxiv_id, hype_tier FROM scored")
def hype_tier(spark, sf):
    return score_papers(papers(spark, sf), toy_model()).select("arxiv_id", "hype_tier")


@check("""
SELECT event_id, round(1 / (1 + exp(-(ln(0.3 / 0.7) + value / 100))), 6) AS score FROM events
""")
def sigmoid_score(spark, sf):
    margin = scores.logit(F.lit(0.3)) + F.col("value") / 100
    return table(spark, sf, "events").select(
        "event_id", F.round(scores.sigmoid(margin), 6).alias("score")
    )


@check("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts FROM events""")
def iso_timestamp(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.iso_timestamp(F.col("ts")).alias("ts"))


@check(PS + """
SELECT arxiv_id, title,
  CASE WHEN len(author_names) > 3 THEN array_to_string(author_names[1:3], ' · ') || ' +' ||
       cast(len(author_names) - 3 AS VARCHAR) ELSE array_to_string(author_names, ' · ') END AS author_line,
  array_to_string(categories[1:3], ' · ') AS category_line,
  strftime(submitted_at, '%b %-d, %Y') AS date_label,
  cast(floor(hype_score * 100 + 0.5) AS INT) AS score_percent,
  repeat('█', cast(floor(hype_score * 12 + 0.5) AS INT)) ||
    repeat('░', 12 - cast(floor(hype_score * 12 + 0.5) AS INT)) AS score_bar,
  upper(hype_tier) AS tier_badge FROM scored
""", name="card_view")
def cards(spark, sf):
    return card_view(score_papers(papers(spark, sf), toy_model()))


@check("""
SELECT event_id,
  CASE WHEN value / 200 >= 0.3 THEN 'orange' WHEN value / 200 >= 0.1 THEN 'green' ELSE 'blue' END AS mean_score,
  CASE WHEN value / 200 >= 0.5 THEN 'red' WHEN value / 200 >= 0.2 THEN 'yellow' ELSE 'green' END AS drift_share,
  CASE WHEN value / 200 >= 0.3 THEN 'red' WHEN value / 200 >= 0.1 THEN 'yellow' ELSE 'green' END AS feature_drift,
  CASE event_id % 3 WHEN 0 THEN 'No drift' WHEN 1 THEN 'DRIFT' END AS flag
FROM events
""")
def threshold_band(spark, sf):
    value = F.col("value") / 200
    kinds = ["mean_score", "drift_share", "feature_drift"]
    return table(spark, sf, "events").select(
        "event_id", *[scores.threshold_band(value, k).alias(k) for k in kinds],
        scores.drift_text(F.col("event_id") % 3).alias("flag"),
    )


@check("SELECT event_id, round(value / 7, 4) AS value FROM events")
def round4(spark, sf):
    return table(spark, sf, "events").select("event_id", scores.round4(F.col("value") / 7).alias("value"))

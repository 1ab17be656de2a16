"""The given tables in the shapes the operators expect, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BUZZWORDS, FEATURE_COLS, TARGET_CATEGORIES
from ..operators.trees import TreeModel
from ..session import configure

AS_OF = "2024-02-12 00:00:00"


def first_line():
    return F.split("text", "\n")[0]


SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string,
        l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id long, ts timestamp_ntz, user_id long, event_type string, value double,
        props string""",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def papers(spark: SparkSession, sf: str) -> DataFrame:
    """One paper per document, with labels where the document has one."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    kind = F.col("doc_id") % 5
    categories = (
        F.when(kind == 0, "cs.LG cs.AI").when(kind == 1, "cs.CV").when(kind == 2, "cs.CL cs.LG stat.ML")
        .when(kind == 3, "math.ST").otherwise("cs.AI")
    )
    labeled = F.col("quality").isNotNull()
    known = F.col("doc_id") % 3 != 0
    lookup = F.col("doc_id") % 4
    arxiv_id = F.concat(F.lit("2401."), F.lpad(F.col("doc_id").cast("string"), 6, "0"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return d.join(l, "doc_id", "left").select(
        "doc_id",
        arxiv_id.alias("arxiv_id"),
        first_line().alias("title"),
        F.col("text").alias("abstract"),
        F.split(categories, " ").alias("categories"),
        F.split(first_line(), " ").alias("author_names"),
        (start + F.make_interval(hours=F.col("doc_id").cast("int"))).alias("submitted_at"),
        F.when(known, F.col("n_chars") % 120).cast("int").alias("max_h_index"),
        F.when(known, F.col("n_chars") % 900).cast("int").alias("total_prior_papers"),
        labeled.alias("has_code"),
        F.when(labeled, F.col("n_chars") % 200).cast("int").alias("github_stars_t60"),
        F.col("quality").alias("hype_label"),
        F.when(lookup == 0, None).when(lookup == 1, "checked_none").otherwise(arxiv_id)
        .alias("hf_paper_id"),
        F.when(lookup >= 2, F.col("n_chars") % 20).cast("int").alias("hf_upvotes"),
    )


PAPERS = """papers AS (
  SELECT d.doc_id,
    concat('2401.', lpad(cast(d.doc_id AS VARCHAR), 6, '0')) AS arxiv_id,
    string_split(d.text, chr(10))[1] AS title,
    d.text AS abstract,
    string_split(CASE d.doc_id % 5 WHEN 0 THEN 'cs.LG cs.AI' WHEN 1 THEN 'cs.CV'
        WHEN 2 THEN 'cs.CL cs.LG stat.ML' WHEN 3 THEN 'math.ST' ELSE 'cs.AI' END, ' ') AS categories,
    string_split(string_split(d.text, chr(10))[1], ' ') AS author_names,
    TIMESTAMP '2024-01-01 00:00:00' + d.doc_id * INTERVAL '1' HOUR AS submitted_at,
    CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE cast(d.n_chars % 120 AS INT) END AS max_h_index,
    CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE cast(d.n_chars % 900 AS INT) END AS total_prior_papers,
    (l.doc_id IS NOT NULL) AS has_code,
    CASE WHEN l.doc_id IS NULL THEN NULL ELSE cast(d.n_chars % 200 AS INT) END AS github_stars_t60,
    l.quality AS hype_label,
    CASE d.doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'checked_none'
        ELSE concat('2401.', lpad(cast(d.doc_id AS VARCHAR), 6, '0')) END AS hf_paper_id,
    CASE WHEN d.doc_id % 4 >= 2 THEN cast(d.n_chars % 20 AS INT) END AS hf_upvotes
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

_flags = [
    f"cast(list_contains(categories, '{c}') AS INT) AS cat_{c.replace('.', '_')}" for c in TARGET_CATEGORIES
] + [f"cast(contains(lower(title), '{w}') AS INT) AS buzz_{w}" for w in BUZZWORDS]

FEATURES = f"""features AS (
  SELECT arxiv_id, doc_id, hype_label,
    cast(len(author_names) AS INT) AS num_authors,
    cast(length(abstract) AS INT) AS abstract_length,
    cast(length(title) AS INT) AS title_length,
    cast(isodow(submitted_at) - 1 AS INT) AS day_of_week,
    cast(month(submitted_at) AS INT) AS month,
    cast(len(categories) AS INT) AS num_categories,
    {', '.join(_flags)},
    cast(coalesce(max_h_index, 0) AS BIGINT) AS max_h_index,
    cast(coalesce(total_prior_papers, 0) AS BIGINT) AS total_prior_papers,
    cast(max_h_index IS NOT NULL AS INT) AS has_author_enrichment
  FROM papers)"""

FEATURE_LIST = ", ".join(FEATURE_COLS)


def toy_model() -> TreeModel:
    """Three small trees over abstract length, h-index, weekday, category and authors."""
    return TreeModel(
        [
            {
                "left_children": [1, 3, -1, -1, -1], "right_children": [2, 4, -1, -1, -1],
                "split_indices": [1, 24, 0, 0, 0],
                "split_conditions": [1500.0, 40.0, 0.0, 0.0, 0.0],
                "base_weights": [0.0, 0.0, 1.25, -0.75, 0.375],
            },
            {
                "left_children": [1, -1, 3, -1, -1], "right_children": [2, -1, 4, -1, -1],
                "split_indices": [3, 0, 6, 0, 0],
                "split_conditions": [3.0, 0.0, 1.0, 0.0, 0.0],
                "base_weights": [0.0, 0.5, 0.0, -0.625, 0.875],
            },
            {
                "left_children": [1, -1, -1], "right_children": [2, -1, -1],
                "split_indices": [0, 0, 0], "split_conditions": [7.0, 0.0, 0.0],
                "base_weights": [0.0, -0.25, 0.125],
            },
        ],
        base_score=0.3,
        threshold=0.6,
    )


MARGIN = """ln(0.3 / 0.7)
    + CASE WHEN f.abstract_length < 1500 THEN CASE WHEN f.max_h_index < 40 THEN -0.75 ELSE 0.375 END
           ELSE 1.25 END
    + CASE WHEN f.day_of_week < 3 THEN 0.5 WHEN f.cat_cs_LG < 1 THEN -0.625 ELSE 0.875 END
    + CASE WHEN f.num_authors < 7 THEN -0.25 ELSE 0.125 END"""

SCORED = f"""scored AS (
  SELECT *, CASE WHEN hype_score >= 0.6 THEN 'hype' WHEN hype_score >= 0.3 THEN 'likely'
                 ELSE 'low' END AS hype_tier
  FROM (SELECT p.*, 1.0 / (1.0 + exp(-({MARGIN}))) AS hype_score
        FROM papers p JOIN features f ON p.arxiv_id = f.arxiv_id) x)"""

P = f"WITH {PAPERS}\n"
PF = f"WITH {PAPERS},\n{FEATURES}\n"
PS = f"WITH {PAPERS},\n{FEATURES},\n{SCORED}\n"


def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Scores with many ties beside the label."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    score = (F.col("n_chars") % 97).cast("double") / 97
    return d.select("doc_id", score.alias("score")).join(
        l.select("doc_id", F.col("quality").alias("label")), "doc_id"
    )


LABELED = """labeled AS (
  SELECT d.doc_id, cast(d.n_chars % 97 AS DOUBLE) / 97 AS score, l.quality AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
COUNTS = """counts AS (
  SELECT score, cast(sum(label) AS DOUBLE) AS pos, cast(sum(1 - label) AS DOUBLE) AS neg
  FROM labeled GROUP BY score)"""
RANKED = """ranked AS (
  SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp,
    sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS all_pos,
    sum(neg) OVER () AS all_neg
  FROM counts)"""
R = f"WITH {LABELED},\n{COUNTS},\n{RANKED}\n"


def series(spark: SparkSession, sf: str) -> DataFrame:
    """A metric sample per event."""
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_type").alias("name"), (F.col("user_id") % 20).alias("feature"),
        F.col("ts").cast("timestamp").alias("ts"), "value",
    )


SERIES = """series AS (
  SELECT event_type AS name, user_id % 20 AS feature, ts, value FROM events)"""


def stored_incoming(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders as a stored table and an overlapping batch, NULLs on both sides."""
    o = table(spark, sf, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    arxiv_id = key.cast("string").alias("arxiv_id")
    stored = o.filter("o_orderstatus <> 'P'").select(
        arxiv_id,
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").cast("timestamp").alias("submitted_at"),
        F.when(key % 4 != 0, customer).cast("int").alias("citation_count"),
        F.when(key % 2 != 0, F.lit("stored")).alias("hf_paper_id"),
        (key % 7 == 0).alias("has_code"),
        F.when(key % 5 != 0, customer % 200).cast("int").alias("github_stars_t60"),
        F.when(key % 5 != 0, customer % 200 > 100).alias("hype_label"),
    )
    incoming = o.filter("o_orderstatus <> 'O'").select(
        arxiv_id,
        F.col("o_orderstatus").alias("title"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("submitted_at"),
        F.when(key % 2 != 0, customer + 1).cast("int").alias("citation_count"),
        F.when(key % 4 == 0, F.lit("")).otherwise("incoming").alias("hf_paper_id"),
        (key % 11 == 0).alias("has_code"),
        (customer % 150).cast("int").alias("github_stars_t60"),
        F.when(key % 8 != 0, customer % 150 > 100).alias("hype_label"),
    )
    return stored, incoming


SIDES = """s AS (
  SELECT cast(o_orderkey AS VARCHAR) AS arxiv_id, o_orderpriority AS title, o_orderdate AS submitted_at,
    CASE WHEN o_orderkey % 4 <> 0 THEN cast(o_custkey AS INT) END AS citation_count,
    CASE WHEN o_orderkey % 2 <> 0 THEN 'stored' END AS hf_paper_id,
    o_orderkey % 7 = 0 AS has_code,
    CASE WHEN o_orderkey % 5 <> 0 THEN cast(o_custkey % 200 AS INT) END AS github_stars_t60,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 200 > 100 END AS hype_label
  FROM orders WHERE o_orderstatus <> 'P'),
i AS (
  SELECT cast(o_orderkey AS VARCHAR) AS arxiv_id, o_orderstatus AS title,
    o_orderdate + INTERVAL '1' DAY AS submitted_at,
    CASE WHEN o_orderkey % 2 <> 0 THEN cast(o_custkey + 1 AS INT) END AS citation_count,
    CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'incoming' END AS hf_paper_id,
    o_orderkey % 11 = 0 AS has_code,
    cast(o_custkey % 150 AS INT) AS github_stars_t60,
    CASE WHEN o_orderkey % 8 <> 0 THEN o_custkey % 150 > 100 END AS hype_label
  FROM orders WHERE o_orderstatus <> 'O')"""
SI = f"WITH {SIDES}\n"


def stamp(column: str):
    """Timestamps leave as text, so that both engines agree on their form."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})

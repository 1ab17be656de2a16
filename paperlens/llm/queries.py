"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, work_dir
from . import quality_fm, toxic_segments
from .byte_bpe import encode_documents
from .merkle_manifest import documents_manifest
from .ngram_join import similar_documents
from .periodic_runs import with_runs
from .personal_data import (
    BASE, BEFORE, BEHIND, CAPITALS, KINDS, SMALL, STEP, THRESHOLD, let, personal_report,
)
from .pfair_mix import mix
from .phrase_automata import without_repeats
from .rotated_codes import search
from .secret_ledger import scan_unseen, scanned_rows, secret_report
from .simple8b import token_report
from .target_ratio import rules_report, trusted_ids

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ORACLES["op4_rotated_codes"] = """
    WITH v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

ORACLES["op5_pfair_mix"] = """
    WITH RECURSIVE sized AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    w AS (
        SELECT source, n, round(pow(n, 0.8) / sum(pow(n, 0.8)) OVER () * (1000 - count(*) OVER ()), 9) AS e FROM sized
    ), f AS (
        SELECT *, row_number() OVER (ORDER BY e - floor(e) DESC, source NULLS FIRST) AS rk,
               1000 - sum(floor(e) + 1) OVER () AS rest FROM w
    ), s AS (
        SELECT source, n, CAST(floor(e) + 1 + CASE WHEN rk <= rest THEN 1 ELSE 0 END AS BIGINT) AS share,
               row_number() OVER (ORDER BY source NULLS FIRST) AS i FROM f
    ), m AS (SELECT list(share ORDER BY i) AS a FROM s),
    edf AS (
        SELECT 0::BIGINT AS t, list_transform(a, lambda x: 0::BIGINT) AS had, NULL::BIGINT AS pick FROM m
        UNION ALL
        SELECT t + 1, list_transform(had, lambda h, k: h + CASE WHEN k = p THEN 1 ELSE 0 END), p FROM (
            SELECT t, had, list_min(list_transform(range(1, len(a) + 1), lambda k:
                CASE WHEN (had[k] * 1000) // a[k] <= t
                     THEN CAST(ceil((had[k] + 1) * 1000 / a[k]) AS BIGINT) * 100000 + k END)) % 100000 AS p
            FROM edf, m WHERE t < 1000)
    ), turns AS (
        SELECT s.source, s.n, s.share, t - 1 AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn
        FROM edf JOIN s ON s.i = edf.pick
    ), placed AS (
        SELECT doc_id, source, count(*) OVER (PARTITION BY source) AS n,
               (row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1) // 16 AS block
        FROM documents
    ), sized_blocks AS (
        SELECT source, share, CAST(ceil(n / 16) AS BIGINT) AS b FROM s
    ), ends AS (
        SELECT max((z.b - 1) // z.share * 1000 + t.slot) AS e
        FROM sized_blocks z JOIN turns t ON z.source IS NOT DISTINCT FROM t.source AND t.turn = (z.b - 1) % z.share
    ), runs AS (
        SELECT t.source, p.p * 1000 + t.slot AS slot, p.p * t.share + t.turn AS turn, z.b
        FROM turns t JOIN sized_blocks z ON z.source IS NOT DISTINCT FROM t.source, ends,
             (SELECT unnest(range(0, (SELECT e // 1000 + 1 FROM ends))) AS p) p
        WHERE p.p * 1000 + t.slot <= ends.e
    )
    SELECT d.doc_id, d.source, r.slot::BIGINT AS slot, (r.turn // r.b)::BIGINT AS epoch, d.block::BIGINT AS block
    FROM runs r JOIN placed d ON d.source IS NOT DISTINCT FROM r.source AND d.block = r.turn % r.b
"""

# The kinds of op11 with patterns as the contract has them; the native ones match the same stretches.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "local": r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
}
CONFIRMED = """CASE kind
    WHEN 'ip' THEN list_max(list_transform(string_split(value, '.'), lambda x: x::HUGEINT)) <= 255
    WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1),
        lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse(digits), i, 1)::INT
                       ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr(reverse(digits), i, 1)::INT + 1] END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    WHEN 'iban' THEN list_reduce(list_prepend(0::BIGINT, list_transform(
        string_split(substr(replace(value, ' ', ''), 5) || substr(replace(value, ' ', ''), 1, 4), ''),
        lambda c: CASE WHEN ascii(c) < 58 THEN ascii(c) - 48 ELSE ascii(c) - 55 END::BIGINT)),
        lambda a, v: CASE WHEN v < 10 THEN (a * 10 + v) % 97 ELSE (a * 100 + v) % 97 END) = 1
    WHEN 'ssn' THEN NOT regexp_matches(value, '^(000|666|9)|-00-|-0000$')
    ELSE true END"""


def _personal_sql() -> str:
    def near(words: str) -> str:
        if not words:
            return "0"
        pattern = f"(^|[^a-z])({words})([^a-z]|$)"
        return f"(regexp_matches(before, '{pattern}') OR regexp_matches(behind, '{pattern}'))::INT"

    small = f"'{CAPITALS}', '{SMALL}'"
    parts = [f"""
        SELECT doc_id, {place} AS place, '{k.name}' AS kind, found[i] AS value, {k.score} AS first_score,
          {str(k.certain).lower()} AS certain, {str(k.alone).lower()} AS alone,
          translate(right(gaps[i], {BEFORE}), {small}) AS before, translate(left(gaps[i + 1], {BEHIND}), {small}) AS behind,
          {near(k.for_it)} - {near(k.against_it)} AS moved,
          sum(length(gaps[i]) + length(found[i])) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS end_
        FROM (SELECT doc_id, found, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
            SELECT doc_id, regexp_extract_all(text, '{PLAIN[k.name]}') AS found,
                   string_split_regex(text, '{PLAIN[k.name]}') AS gaps FROM t))""" for place, k in enumerate(KINDS)]
    shown = "coalesce(string_agg(kind || ':' || (end_ - length(value)) || ':' || end_, ',' ORDER BY end_ - length(value), place) {}, '')"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)
    return f"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        m AS ({" UNION ALL ".join(parts)}),
        c AS (
            SELECT *, least(100, first_score + {STEP} * moved) AS score, regexp_replace(value, '[^0-9]', '', 'g') AS digits
            FROM m WHERE NOT alone OR NOT (regexp_matches(before, '[a-z0-9]\\z') OR regexp_matches(behind, '^[a-z0-9]'))
        ), s AS (SELECT * FROM c WHERE {CONFIRMED} AND (certain OR score >= {THRESHOLD}))
        SELECT t.doc_id, {counts}, sha256({shown.format(f"FILTER (place < {len(BASE)})")}) AS base_sha256,
          {shown.format("FILTER (kind IS NOT NULL)")} AS spans, count(*) FILTER (place >= {len(BASE)}) AS n_added,
          count(*) FILTER (score >= 80) AS n_likely
        FROM t LEFT JOIN s ON t.doc_id = s.doc_id GROUP BY t.doc_id"""


ORACLES["op11_personal_data"] = _personal_sql()

ORACLES["op13_merkle_manifest"] = """
    WITH RECURSIVE bits AS (
        SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
    ), d AS (
        SELECT doc_id, n_chars, coalesce('=' || lang, '') AS part,
            concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-')) AS head,
            coalesce(strlen(text) || ':' || text, '-') AS tail,
            list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) AS crc
        FROM documents, bits
    ), l AS (
        SELECT doc_id, part,
            sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
            CASE WHEN xor(crc, 4294967295) % 7 = 0
                 THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS other
        FROM d
    ), p AS (
        SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
               count(*) OVER (PARTITION BY part) AS size FROM l
    ), low AS (
        SELECT part, 0 AS level, place, size, leaf AS node FROM p
        UNION ALL
        SELECT part, level + 1, place // 2, (size + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
        FROM low WHERE size > 1 GROUP BY part, level, place // 2, size
    ), tops AS (
        SELECT part, node AS subroot, level AS height, row_number() OVER (ORDER BY part) - 1 AS place, count(*) OVER () AS size
        FROM low WHERE size = 1
    ), high AS (
        SELECT 0 AS level, place, size, subroot AS node FROM tops
        UNION ALL
        SELECT level + 1, place // 2, (size + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
        FROM high WHERE size > 1 GROUP BY level, place // 2, size
    ), root AS (SELECT node AS root, level AS height FROM high WHERE size = 1),
    steps AS (
        SELECT p.part, p.place, s.level AS step, (p.place >> s.level) & 1 AS side, coalesce(n.node, '') AS sibling
        FROM p JOIN tops t ON p.part = t.part CROSS JOIN LATERAL (SELECT unnest(range(t.height)) AS level) s
        LEFT JOIN low n ON n.part = p.part AND n.level = s.level AND n.place = xor(p.place >> s.level, 1)
        UNION ALL
        SELECT p.part, p.place, t.height + s.level, (t.place >> s.level) & 1, coalesce(n.node, '')
        FROM p JOIN tops t ON p.part = t.part CROSS JOIN root r CROSS JOIN LATERAL (SELECT unnest(range(r.height)) AS level) s
        LEFT JOIN high n ON n.level = s.level AND n.place = xor(t.place >> s.level, 1)
    ), fold AS (
        SELECT part, place, 0 AS step, coalesce(other, leaf) AS node FROM p
        UNION ALL
        SELECT f.part, f.place, f.step + 1, sha256(CASE WHEN s.side = 1 THEN s.sibling || f.node ELSE f.node || s.sibling END)
        FROM fold f JOIN steps s ON f.part = s.part AND f.place = s.place AND f.step = s.step
    ), proofs AS (SELECT part, place, sha256(string_agg(sibling, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY part, place)
    SELECT p.doc_id, p.leaf, t.subroot, r.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
           f.node AS folded_root, f.node = r.root AS verified
    FROM p JOIN tops t ON p.part = t.part CROSS JOIN root r
    JOIN fold f ON f.part = p.part AND f.place = p.place AND f.step = t.height + r.height
    LEFT JOIN proofs q ON q.part = p.part AND q.place = p.place
"""



def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality_fm(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every text by a factorisation machine."""
    docs = table(spark, folder, "documents")
    return quality_fm.quality_report(docs, quality_fm.fit(docs, table(spark, folder, "labels")))


@query
def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents linked by the similarity of their 4-word shingles."""
    return similar_documents(table(spark, folder, "documents"))


@query
def op3_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text and its passages by maximum-scoring segments."""
    docs = table(spark, folder, "documents")
    return toxic_segments.toxicity_report(docs, toxic_segments.fit(docs, table(spark, folder, "labels")))


@query
def op4_rotated_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector with all others."""
    vectors = table(spark, folder, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query
def op5_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in a mixture whose sources weigh their size to the power 0.8."""
    return mix(table(spark, folder, "documents")).select("doc_id", "source", "slot", "epoch", "block")


@query
def op6_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every text through a ledger that begins empty."""
    return secret_report(table(spark, folder, "documents"), work_dir(spark, "ledger"))


@query
def secret_ledger_passes(spark: SparkSession, folder: str) -> DataFrame:
    """How many versions each of three passes over one ledger is given, and how many blobs it scans.

    The first is given all documents, the second all documents and raw pages, the third the same again.
    """
    first = table(spark, folder, "documents").select(F.concat(F.lit("document/"), F.col("doc_id")).alias("doc_id"), "text")
    pages = table(spark, folder, "pages").select(F.concat(F.lit("page/"), F.col("page_id")).alias("doc_id"), F.col("html").alias("text"))
    second = first.unionByName(pages)
    ledger, rows, before = work_dir(spark, "ledger"), [], 0
    for number, versions in enumerate((first, second, second), 1):
        scan_unseen(versions, ledger)
        after = scanned_rows(spark, ledger)
        rows.append((number, versions.count(), after - before))
        before = after
    return spark.createDataFrame(rows, "pass int, n_versions long, n_scanned long")


ORACLES["secret_ledger_passes"] = """
    WITH d AS (SELECT DISTINCT coalesce(text, '') AS t FROM documents), p AS (SELECT DISTINCT coalesce(html, '') AS t FROM pages),
    n AS (SELECT (SELECT count(*) FROM documents) AS n_docs, (SELECT count(*) FROM pages) AS n_pages)
    SELECT 1::INTEGER AS pass, n_docs AS n_versions, (SELECT count(*) FROM d) AS n_scanned FROM n
    UNION ALL SELECT 2, n_docs + n_pages, (SELECT count(*) FROM p ANTI JOIN d USING (t)) FROM n
    UNION ALL SELECT 3, n_docs + n_pages, 0 FROM n
"""


@query
def op7_target_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and n-gram log ratio of every text; trusted are all documents labelled good."""
    docs = table(spark, folder, "documents")
    return rules_report(docs, trusted_ids(table(spark, folder, "labels")))


@query
def op8_phrase_automata(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every text without the passages of 20 words that came before."""
    return without_repeats(table(spark, folder, "documents"))


@query
def op9_simple8b(spark: SparkSession, folder: str) -> DataFrame:
    """Every text as token ids in files of 64-bit words, read back."""
    docs = table(spark, folder, "documents")
    return token_report(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text as byte-level BPE ids, decoded again."""
    docs = table(spark, folder, "documents")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every text: patterns, checksums and the words near by."""
    return personal_report(table(spark, folder, "documents"))


def planted(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the checksum of its id, repeats a part of its words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(w):
        n, g = F.size(w).cast("bigint"), F.floor(h / 10)
        return let(F.struct((g % n).alias("a"), n.alias("n"), (3 + g % 8).alias("part")), lambda s: let(
            1 + F.floor((s["n"] - s["a"]) / s["part"]), lambda p: F.array_join(F.transform(
                F.sequence(F.lit(0).cast("bigint"), s["n"] - 1),
                lambda i: F.get(w, F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % p).cast("int"))), " ")))

    text = F.when(h % 10 == 0, let(words, lambda w: F.when(F.size(w) > 0, repeated(w)))).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of words that repeat four times or more, and what is left without the repeats."""
    runs = with_runs(planted(table(spark, folder, "documents")))
    greater = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return runs.select("*", greater.alias("best")).select(
        "doc_id", "n_words", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves, roots and proofs of all documents by language; every seventh is folded as tampered with."""
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    made = documents_manifest(docs, {"n_chars": F.col("n_chars") + 1}, tampered, keep_proof=False)
    return made.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))

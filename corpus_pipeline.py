"""From raw documents to token ids: quality, near copies, secrets, mixture, encoding.

Each stage takes all rows that the one before it kept, and its result is written as Parquet in the
shared folder and read again. Parameters are those of production; the operators are in ``paperlens.llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paperlens.llm import byte_bpe, ngram_join, pfair_mix, quality_fm, secret_ledger
from paperlens.session import configure, materialize, prepare_local, work_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the labels of those that are here."""
    configure(spark)
    return quality_fm.keep_good(docs, quality_fm.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by five-word shingles at a similarity of 0.8."""
    configure(spark)
    return ngram_join.first_of_each(docs, n=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by their kind; the ledger of this run begins empty."""
    configure(spark)
    return secret_ledger.without_secrets(docs, work_dir(spark, "ledger"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh their size to the power 0.8: small ones go round again until the largest has gone once."""
    configure(spark)
    return pfair_mix.in_mixed_order(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every placed document, with their digests and its position in the mixture."""
    configure(spark)
    placed = pfair_mix.with_position(docs)
    return byte_bpe.encode_documents(placed, public_tokenizers.path("byte_bpe_50k.tiktoken"), keep_ids=True, also=("position",))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", encoded),
]

# A trained classifier and merges have no SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    prepare_local(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

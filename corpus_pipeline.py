"""Corpus pipeline: from raw documents to packed training sequences.

Five stages, in order: quality rules drop documents, line dedup drops shared
lines, the n-gram Jaccard join keeps one document of each near-duplicate group,
secret scans redact what they find, and packing lays the documents out in
sequences of tokens.  Each stage works on all that the one before kept, read
back from its Parquet table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.near_dup import keep_one_of_each
from tessera.llm.packing import pack
from tessera.llm.quality import judge
from tessera.llm.secrets import find_secrets, redact

TOKENIZER = "byte_bpe_50k.json"


def _documents(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with n_chars (if there is one) told anew from the text."""
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*like.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return judge(docs).filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more share (but for the last one's); texts may become empty."""
    return _documents(dedup_lines(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return keep_one_of_each(docs, size=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    found = find_secrets(docs)
    return _documents(found.withColumn("text", redact(F.coalesce("text", F.lit("")), F.col("spans"))), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens, with their ids."""
    pieces = pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", F.col("n").alias("length"), "doc_tokens", "sequence_id", "offset", "ids"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL cannot express tokenization; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; each stage but the last is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

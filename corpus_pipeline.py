"""From documents to token ids: quality, exact copies, near copies, mixture, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.llm.exact_dedup import unique_rows
from beatline.llm.mixing import mixed_rows
from beatline.llm.quality import kept_documents
from beatline.llm.sentencepiece import decode, encode
from beatline.llm.simhash import one_of_each
from beatline.runtime import store

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

#: Bytes of an Arrow batch between the JVM and its Python workers; Spark's default is 64 MB, held several times over by both.
BATCH = 4 << 20


def _bounded(spark: SparkSession) -> None:
    """From now on this session's Arrow batches hold BATCH bytes at most, unless a bound of its own was set."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == f"{64 << 20}b":  # Spark's default; a setting reads as it was written, like 8m
        spark.conf.set(key, f"{BATCH}b")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands.

    Null and empty texts have no words and go; a null language is judged by the
    script; repeated rows stay or go together.
    """
    _bounded(spark)
    return kept_documents(docs, PIECES, BYTES)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the smallest doc_id.

    A null text equals an empty one, a null doc_id comes after all others, and of
    rows equal in every column one stays.
    """
    return unique_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the smallest doc_id.

    Texts without words share the zero fingerprint and are one group; rows that
    repeat the kept one's id and text stay with it.
    """
    _bounded(spark)
    return one_of_each(docs, shingle=4, most=4)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2 over 150 % of all words; a document taken twice is there twice.

    A null source is a source, the last one; texts without words have size 0.
    """
    return mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of each document, and whether they decode to its text.

    Null and empty texts have no ids; repeated rows are encoded one by one.
    """
    _bounded(spark)
    both = decode(encode(docs, PIECES), PIECES)
    return both.select(
        F.col("id").alias("doc_id"),
        "ids",
        "n_tokens",
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


#: Every stage gives an empty table for an empty one, and keeps the columns of documents but for the last.
STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mixture),
    ("sentencepiece", token_ids),
]

#: The tokenizers, the fingerprints and the encoding have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

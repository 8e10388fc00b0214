"""The training-data pipeline: documents in, token ids out.

Each stage reads all that the one before kept, from Parquet. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, decontaminate, minhash, quality, secrets
from starloom.llm.queries import VOCABULARY, table
from starloom.llm.stored import stored

#: The stages are models, components and tokenizers: not for SQL. Tests compare them with brute force.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that the quality classifier takes for bad or toxic."""
    return quality.judged(docs, table(spark, sf_dir, "labels"), docs.columns).where("kept").select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (runs of five words, similarity of 0.8 or more); the same row twice is one document."""
    found = minhash.near_duplicates(docs).where("chosen").select(F.col("doc_id").alias("id"), "text_key").distinct()
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(found["id"]) & (keyed["__key"] == found["text_key"])
    return keyed.join(found, same, "left_semi").dropDuplicates(["doc_id", "__key"]).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a benchmark item."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("id"), "text_key")
    found = stored(found.distinct(), "contaminated")
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(found["id"]) & (keyed["__key"] == found["text_key"])
    return keyed.join(found, same, "left_anti").select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by marks; ``n_chars`` follows the text."""
    clean = secrets.scan(docs, redacted=True).drop("spans")
    changed = F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document: doc_id, n_tokens and ids (packed little-endian 32-bit integers)."""
    return bpe.encode_documents(docs, VOCABULARY)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", without_copies),
    ("benchmark", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

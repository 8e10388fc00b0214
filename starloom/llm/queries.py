"""The registered queries of this package: each operator over its whole given table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe, centroids, decontaminate, importance, kd_search, language_model, minhash, quality, secrets, suffix_dedup, token_files, trie_counts, url_filter

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


#: Whole texts go to Python in batches of about so many bytes, which bounds a worker's memory. It sets the caller's session.
BATCH_BYTES = "16m"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Python workers that start later find this library where the driver has it, unless told otherwise."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, folder, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, folder, "documents"), path, VOCABULARY)
    return token_files.digests(token_files.read_documents(spark, path))


def op3_trie_counts(spark: SparkSession, folder: str) -> DataFrame:
    return trie_counts.token_counts(table(spark, folder, "documents"), PIECES)


def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_documents(table(spark, folder, "documents"))


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"), columns=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secrets.BASE_RULES]))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(r.kind) for r in secrets.BASE_RULES),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that stay, with their posteriors."""
    return quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"), ["doc_id", "source", "lang"]).where("kept")


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_key")


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_kd_search(spark: SparkSession, folder: str) -> DataFrame:
    return kd_search.exact_top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    decoded = bpe.encode_documents(table(spark, folder, "documents"), VOCABULARY, decoded=True)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's verdict, by the fixed rules or by trees fitted to the labelled pages."""
    pages = table(spark, folder, "pages")
    model = url_filter.fit(url_filter.labelled_pages(pages, table(spark, folder, "labels")))
    return url_filter.judged(pages, url_filter.RULES, model, ["page_id"])


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's weight toward the benchmark's texts, and the rank of those drawn."""
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Every kept vector's cluster after five rounds."""
    return centroids.clustered(table(spark, folder, "embeddings"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_minhash, op2_token_files, op3_trie_counts, op4_language_model, op5_secrets, op6_quality, op7_decontaminate, op8_suffix_dedup, op9_kd_search, op10_bpe, op11_url_filter, op12_importance, op13_centroids)}


def oracle_sql() -> dict[str, str]:
    return {"op9_kd_search": kd_search.SQL, "op13_centroids": centroids.sql()}

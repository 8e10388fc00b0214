"""Importance resampling toward a target distribution, by hashed runs of words.

1. A 256-byte table lower-cases A-Z and blanks all other ASCII bytes but letters and digits; what is left between blanks are the words. As
   every byte of a longer UTF-8 character is 128 or more, the table never cuts one.
2. A run of words is known by the CRC-32 of its bytes; the CRC of a run seeds that of the run one word longer. Buckets of runs are counted
   over all documents, and over all texts of the target.
3. A bucket that is more frequent in the target has a positive gain. A document's weight is the sum of gains over its runs.
4. Each document draws a Gumbel number from its id. The highest sums of weight and number are a sample without replacement, in which each
   document's chance follows its weight.

The texts are read twice, for the counts and for the weights, and never shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import by_size
from .stored import stored

#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of longer characters, blanks the rest.
TABLE = bytes(b + 32 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else b if chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" or b >= 128 else 32 for b in range(256))
PIECE_BYTES = 4 << 20


def word_list(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def run_hashes(words: list[bytes], longest: int) -> list[int]:
    """The CRC-32 of every run of 1 to ``longest`` words, joined by one space."""
    seeds = list(map(crc32, words))
    out, spaced = list(seeds), [b" " + w for w in words] if longest > 1 else []
    for n in range(1, longest):
        seeds = list(map(crc32, spaced[n:], seeds))
        out += seeds
    return out


def bucket_counts(texts: DataFrame, text: str, longest: int, buckets: int) -> list[int]:
    """How many runs of all texts fall in each bucket. A task sends one number for each bucket; the driver gets ``buckets`` numbers."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in by_size(batch, "text", PIECE_BYTES):
                seen: Counter[int] = Counter()
                for one in piece.column("text").to_pylist():
                    seen.update(run_hashes(word_list(one), longest))
                where = np.fromiter(seen.keys(), np.int64, len(seen)) % buckets
                np.add.at(total, where, np.fromiter(seen.values(), np.int64, len(seen)))
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], ["bucket", "n"])

    counted = texts.select(F.col(text).cast("binary").alias("text")).mapInArrow(task, "bucket int, n bigint")
    out = [0] * buckets
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 * ln of how much more frequent the bucket is in the target), with one more count in each bucket."""
    buckets, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)))) for s, t in zip(corpus, target)], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """A thousandth part of a Gumbel number drawn by the id; a null id draws as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(docs: DataFrame, gains: np.ndarray, longest: int, seed: int) -> DataFrame:
    buckets = len(gains)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "text", PIECE_BYTES):
                n_words, n_features, weight = [], [], []
                for one in piece.column("text").to_pylist():
                    words = word_list(one)
                    hashes = run_hashes(words, longest)
                    n_words.append(len(words))
                    n_features.append(len(hashes))
                    weight.append(int(gains[np.fromiter(hashes, np.int64, len(hashes)) % buckets].sum()))
                score = [w + gumbel(i, seed) for w, i in zip(weight, piece.column("doc_id").to_pylist())]
                values = [pa.array(x, pa.int64()) for x in (n_words, n_features, weight, score)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *values], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.mapInArrow(task, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def _ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """Ranks 1 to ``drawn`` in order of falling score, then rising id (null last); the other rows without a rank.

    Equal rows are one row with a number of copies until the end, so that range partitions stay even. No task sees more than its own range.
    """
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    equal = scored.groupBy(columns).agg(F.count(F.lit(1)).alias("copies"))
    placed = stored(equal.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "placed")
    before, offsets = 0, []
    for part, n in sorted(placed.groupBy("part").agg(F.sum("copies")).collect()):
        offsets.append((part, before))
        before += n
    # One row for each range partition.
    started = placed.join(F.broadcast(placed.sparkSession.createDataFrame(offsets, "part int, offset bigint")), "part")
    earlier = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    reached = started.where(F.col("offset") < drawn).withColumn("offset", F.col("offset") + F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    beyond = started.where(F.col("offset") >= drawn)
    rank = F.transform(F.sequence(F.lit(1).cast("bigint"), "copies"), lambda i: F.when(F.col("offset") + i <= drawn, F.col("offset") + i))
    return reached.unionByName(beyond).select(*columns, F.explode(rank).alias("rank"))


def resampled(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024,
    id_column: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """For each document: doc_id, n_features (runs of 1 to ``longest`` words, repeats counted), weight, score, rank (null if not drawn).

    Of the documents with at least ``least_words`` words, floor(percent * N / 100) are drawn: the highest scores, equal ones by smaller id, null
    ids last. Null and empty texts have no runs, weight 0, and are drawn only if ``least_words`` is 0. Every input row gives one row; repeated
    rows are ranked one after the other. A whole text is used, whatever its length. Empty tables give no rows, or count as nothing on the
    target's side. Other columns are left out, so their names cannot clash; the id's column keeps its name.
    """
    given = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    gains = bucket_gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    scored = stored(_scored(given, gains, longest, seed), "scored")
    enough = F.col("n_words") >= least_words
    drawn = percent * scored.where(enough).count() // 100
    left = scored.where(~enough).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    return _ranked(scored.where(enough), drawn).unionByName(left).withColumnRenamed("doc_id", id_column)

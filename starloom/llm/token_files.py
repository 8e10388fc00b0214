"""Token ids of documents as one long array in files, with Elias-Fano coded document boundaries.

A folder of Parquet files holds blocks: a run of documents in ascending id order. A block has the ids of its documents one
after the other (16 or 32 bits each), the ends of the documents in that array as an Elias-Fano code, the documents' ids, and
its place: ``shard`` (range of document ids), ``block`` (running number in the shard), ``start`` (ids before it in the shard). Spark
writes the files, so a lost task leaves nothing behind and any store that Spark can reach will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrays import as_bytes, bounds, by_size, range_hashes, runs_at
from .bpe import Vocabulary, as_bytes_of_binary, cut_texts
from .elias_fano import SAMPLE, EliasFano

#: Distinct words whose ids a Python worker remembers, at most (about 30 bytes each).
REMEMBERED = 3_000_000
REMEMBERED_BYTES = 64 << 20
#: Text bytes of a block, about.
BLOCK_BYTES = 4 << 20


class WordIds:
    """Ids of words seen by this worker: found by a hash, and taken only if all bytes agree. Forgets all when full; a forgotten word is encoded
    again."""

    _of: dict[str, WordIds] = {}

    def __init__(self, path: str):
        self.vocabulary = Vocabulary.of(path)
        self._clear()

    @classmethod
    def of(cls, path: str) -> WordIds:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _clear(self) -> None:
        self.known, self.bytes = np.zeros(0, np.uint64), np.zeros(0, np.uint8)
        self.word_start, self.word_length = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.uint32)
        self.flat = np.zeros(0, self.vocabulary.id_type)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.known, hashes)
        there = np.zeros(len(hashes), bool)
        within = place < len(self.known)
        there[within] = self.known[place[within]] == hashes[within]
        return place, there

    def _same(self, place: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bool:
        """Whether the known words at these places are those in ``data``, byte by byte."""
        if (self.word_length[place] != sizes).any():
            return False
        return bool((self.bytes[runs_at(self.word_start[place], sizes)] == data[runs_at(starts, sizes)]).all())

    def ids(self, words: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all codes in turn, and the number of ids of each code."""
        data, ends = as_bytes(words)
        hashes, sizes = range_hashes(data, ends[:-1], ends[1:]), np.diff(ends)
        if len(self.known) + len(words) > REMEMBERED or len(self.bytes) + len(data) > REMEMBERED_BYTES:
            self._clear()
        place, there = self._places(hashes)
        if len(np.unique(hashes)) < len(hashes) or not self._same(place[there], data, ends[:-1][there], sizes[there]):
            # Words that share a hash: these are encoded without being remembered.
            flat, at = self.vocabulary.encode_words(words.to_pylist())
            n = np.diff(at)[codes]
            return flat[runs_at(at[:-1][codes], n)], n
        if not there.all():
            new = words.filter(pa.array(~there)).to_pylist()
            flat, at = self.vocabulary.encode_words(new)
            order = np.argsort(hashes[~there])
            added = hashes[~there][order]
            to = np.searchsorted(self.known, added)
            self.known = np.insert(self.known, to, added)
            self.word_start = np.insert(self.word_start, to, (bounds(sizes[~there])[:-1] + len(self.bytes))[order])
            self.word_length = np.insert(self.word_length, to, sizes[~there][order])
            self.bytes = np.concatenate([self.bytes, data[runs_at(ends[:-1][~there], sizes[~there])]])
            self.start = np.insert(self.start, to, (at[:-1] + len(self.flat))[order])
            self.length = np.insert(self.length, to, np.diff(at)[order])
            self.flat = np.concatenate([self.flat, flat])
        place, _ = self._places(hashes)
        n = self.length[place][codes].astype(np.int64)
        return self.flat[runs_at(self.start[place][codes], n)], n


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, id_column: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end_id`` to each, and write the blocks in ascending order of the id column.

    A null or empty text is its end id only. A null id comes first; rows with the same id stand in the order of a digest of their
    text. Other columns are left out. The table is range-partitioned on id and digest, so no task gets more than a share of it.
    """
    kept = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    ordered = kept.withColumn("digest", F.xxhash64("text")).repartitionByRange("id", "digest").sortWithinPartitions("id", "digest")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        words = WordIds.of(vocabulary)
        for batch in batches:
            for piece in by_size(batch, "text", BLOCK_BYTES):
                codes, at, distinct = cut_texts(piece.column("text"))
                ids, n = words.ids(distinct, codes)
                at = bounds(n)[at]
                # Every document gets one place more, for its end.
                whole = np.full(len(ids) + len(at) - 1, end_id, ids.dtype)
                whole[runs_at(at[:-1] + np.arange(len(at) - 1), np.diff(at))] = ids
                ends = at[1:] + np.arange(1, len(at))
                doc_ids = piece.column("id")
                row = [shard, block, start, len(whole), doc_ids.to_pylist(), whole.dtype.itemsize, whole.astype(whole.dtype.newbyteorder("<")).tobytes(), EliasFano.of(ends).to_bytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES)], _NAMES)
                block, start = block + 1, start + len(whole)

    ordered.select("id", "text").mapInArrow(task, _SCHEMA).write.option("compression", "zstd").parquet(path)


_SCHEMA = "shard int, block int, start bigint, n_tokens bigint, doc_ids array<bigint>, width int, ids binary, ends binary"
_NAMES = ["shard", "block", "start", "n_tokens", "doc_ids", "width", "ids", "ends"]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary()]


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, each with ``base``: the ids of all documents before its shard."""
    blocks = spark.read.schema(_SCHEMA).parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # One row for each shard, and there are no more shards than shuffle partitions: small whatever the data.
    before = Window.partitionBy().orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(bases), "shard")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document in the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` (packed little-endian 32-bit integers)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("base", "start", "width", "ids", "ends")}
                flat = np.frombuffer(row["ids"], np.uint16 if row["width"] == 2 else np.uint32)
                ends, ids = EliasFano.from_bytes(row["ends"]), batch.column("doc_ids")[i].values
                before = 0
                # Some documents at a time: their ends by select, and no table of all.
                for first in range(0, ends.count, SAMPLE):
                    stop = min(first + SAMPLE, ends.count)
                    at = np.concatenate([[before], ends.select_range(first, stop).astype(np.int64)])
                    own = flat[before : at[-1]].astype("<u4")
                    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), stop - first, [None, pa.py_buffer((at - before) * 4), pa.py_buffer(own)])
                    before = int(at[-1])
                    yield pa.RecordBatch.from_arrays([ids.slice(first, stop - first), pa.array(at[:-1] + row["base"] + row["start"]), pa.array(np.diff(at)), packed], ["doc_id", "start", "n_tokens", "ids"])

    blocks = read_blocks(spark, path).select("base", "start", "width", "doc_ids", "ids", "ends")
    return blocks.mapInArrow(task, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def digests(documents: DataFrame) -> DataFrame:
    """The packed ids as an unsigned CRC-32."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = as_bytes_of_binary(batch.column("ids"))
            crc = [zlib.crc32(data[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return documents.select("doc_id", "start", "n_tokens", "ids").mapInArrow(task, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

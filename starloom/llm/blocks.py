"""Look-ups for the words of whole texts, without a row for each word.

A block is some MB of whole documents. Its task names each distinct entry (a word, a hash) once and
replaces it in the texts by its number in the block. The entries are dealt out by value into parts; a part sees the
entries of all blocks, answers them, and the answers meet the coded texts of the block they came from:

    documents ─ entries by part ─ solve ─┐
    documents ─ coded texts ─────────────┴─ by block ─ finish ─ rows

The texts are read twice rather than shuffled twice. A block's key is its input split, its number in the split and a digest of its
texts, so that both readings must agree: a block whose answers do not come fails the job. Spark cuts files in the same way
each time unless the number of cores changes during the query on an input of less than one split for each core. No entry is
hot: a block names it once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import as_bytes, by_size, dump, load

#: Text bytes of a block, about. A longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: The part number of a block's own texts. It sorts before the answers.
TEXTS = -1
_ROWS = "block binary, part int, data binary"
_SCHEMA = pa.schema([("block", pa.binary()), ("part", pa.int32()), ("data", pa.binary())])

Entries = dict[int, dict]
#: Turns a batch of whole documents into what stays with the block and what is asked, each when called.
Make = Callable[[pa.RecordBatch], tuple[Callable[[], dict], Callable[[], Entries]]]
#: Gets one part's entries, a dict for each block, and gives one for each in turn, and then what the part knows as a whole (or nothing).
Answer = Callable[[list[dict]], Iterable[dict]]
#: Gets a block's texts and the answers by part, or no texts and what one part knows as a whole.
Finish = Callable[[dict | None, Entries], Iterable[pa.RecordBatch]]


def part_count(spark: SparkSession, each: int = 4) -> int:
    """Parts to deal entries out to: some for each shuffle partition."""
    return each * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _batch(rows: list[tuple[bytes, int, dict]]) -> pa.RecordBatch:
    columns = zip(*((block, part, dump(arrays)) for block, part, arrays in rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, int, bytes]]:
    for batch in batches:
        block, part, data = batch.columns
        for i in range(batch.num_rows):
            yield block[i].as_py(), part[i].as_py(), data[i].as_py()


def _key(split: int, number: int, texts: pa.Array) -> bytes:
    data, at = as_bytes(texts)
    digest = hashlib.blake2b(data, digest_size=16)
    digest.update(at)
    return split.to_bytes(4, "big") + number.to_bytes(4, "big") + digest.digest()


def look_up(docs: DataFrame, text: str, make: Make, answer: Answer, finish: Finish, schema: str, size: int = BLOCK_BYTES) -> DataFrame:
    """The rows that ``finish`` makes of all blocks, and of what each part knows as a whole. See the module's head.

    ``docs`` is a stored table, or one that is read the same way twice.
    """

    def packed(asks: bool):
        def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = 0
            for batch in batches:
                for piece in by_size(batch, text, size):
                    key = _key(piece.column("__split")[0].as_py(), number, piece.column(text))
                    number += 1
                    texts, entries = make(piece)
                    rows = [(key, part, arrays) for part, arrays in entries().items()] if asks else [(key, TEXTS, texts())]
                    if rows:
                        yield _batch(rows)

        return task

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in groupby(_stream(batches), key=lambda row: row[1]):
            blocks, asked = [], []
            for block, _, data in rows:
                blocks.append(block)
                asked.append(load(data))
            yield _batch([(block, part, arrays) for block, arrays in zip([*blocks, b""], answer(asked))])

    def close(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in groupby(_stream(batches), key=lambda row: row[0]):
            if block == b"":
                for _, part, data in rows:
                    yield from finish(None, {part: load(data)})
                continue
            got = {part: load(data) for _, part, data in rows}
            texts = got.pop(TEXTS, None)
            if texts is None:
                raise RuntimeError("the input was cut in another way when it was read again; run the query anew")
            yield from finish(texts, got)

    # The split's number in its own reading; a task's number would count the other side of the union as well.
    docs = docs.withColumn("__split", F.spark_partition_id())
    entries = docs.mapInArrow(packed(True), _ROWS)
    solved = entries.repartition("part").sortWithinPartitions("part").mapInArrow(solve, _ROWS)
    both = solved.unionByName(docs.mapInArrow(packed(False), _ROWS))
    spread = F.when(F.col("block") == b"", F.hash("part")).otherwise(F.hash("block"))
    return both.withColumn("spread", spread).repartition("spread").sortWithinPartitions("block", "part").drop("spread").mapInArrow(close, schema)


def deal(parts_of: np.ndarray) -> dict[int, np.ndarray]:
    """For each part that occurs, the numbers of its entries in ascending order."""
    order = np.argsort(parts_of, kind="stable")
    part, first = np.unique(parts_of[order], return_index=True)
    return {int(p): where for p, where in zip(part, np.split(order, first[1:]))}


def gather(part_of: np.ndarray, answers: Entries, name: str, empty) -> np.ndarray:
    """One value for each entry of a block, from the answers' arrays of that name."""
    out = np.full(len(part_of), empty)
    for part, where in deal(part_of).items():
        out[where] = answers[part][name]
    return out


def join_words(words: list[bytes]) -> dict:
    """Words as arrays that ``dump`` packs well."""
    return {"bytes": b"".join(words), "length": np.fromiter(map(len, words), np.uint32, len(words))}


def cut_words(arrays: dict) -> list[bytes]:
    """The words given to ``join_words``."""
    data, out, at = arrays["bytes"], [], 0
    for n in arrays["length"].tolist():
        out.append(data[at : at + n])
        at += n
    return out


def own(column: pa.Array) -> pa.Array:
    """The values of a slice without the buffers of the whole."""
    return pa.concat_arrays([column]).take(pa.array(np.arange(len(column))))

"""Token counts under a unigram model, by dynamic programming over a trie of the distinct words.

A word is cut into pieces of a public vocabulary so that the sum of their log probabilities is largest. The best score up to a place
depends on what comes before it only, so words with a common prefix share the work: a part's distinct words stand in a trie, every node is
computed once, and a word's count is stored at its end. Walking the words in ascending order is walking the trie depth first; the path from
the root is all that has to be kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import as_bytes, bounds, by_frequency, range_hashes, split_words, sums
from .blocks import cut_words, deal, gather, join_words, look_up, own, part_count

#: Words with the same first bytes share one of so many groups of parts; inside it the whole word decides, so no prefix is hot.
PREFIX, GROUPS = 4, 8


class Pieces:
    """The vocabulary's pieces with unigram log probabilities by Zipf's law over their ranks: p ~ 1 / (rank + 1).

    A character that is no piece stands as its UTF-8 bytes, each as unlikely as 1 / size^2.
    """

    _loaded: dict[str, Pieces] = {}

    @classmethod
    def of(cls, path: str) -> Pieces:
        """One for each file and Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        total = math.log(sum(1 / (k + 1) for k in range(len(names))))
        self.score = {name: -math.log(rank + 1) - total for rank, name in enumerate(names)}
        self.longest = max(map(len, names), default=1)
        self.byte_score = -2 * math.log(size)


def trie_counts(words: Iterable[str], pieces: Pieces) -> Iterator[int]:
    """The number of pieces of each word; words ascending and distinct. Among equal scores the fewest pieces."""
    score_of, longest, byte_score = pieces.score.get, pieces.longest, pieces.byte_score
    best, count, before = [0.0], [0], ""
    for word in words:
        shared, most = 0, min(len(before), len(word))
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del best[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            top, fewest = -math.inf, 0
            for start in range(max(0, end - longest), end):
                score = score_of(word[start:end])
                if score is not None:
                    score += best[start]
                    if score > top or (score == top and count[start] < fewest - 1):
                        top, fewest = score, count[start] + 1
            if score_of(word[end - 1]) is None:
                n = len(word[end - 1].encode())
                score = best[end - 1] + n * byte_score
                if score > top or (score == top and count[end - 1] + n < fewest):
                    top, fewest = score, count[end - 1] + n
            best.append(top)
            count.append(fewest)
        before = word
        yield count[len(word)]


def token_counts(docs: DataFrame, model: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: the id, ``n_words`` and ``n_tokens`` (pieces of all its words; a word is written with U+2581 before it).

    Words are what ASCII white space parts. A null or empty text has none. Every input row gives one row, also for repeated rows and null ids; other
    columns are left out, so their names cannot clash.
    """
    parts = part_count(docs.sparkSession)
    groups = min(GROUPS, parts)
    within = np.uint64(parts // groups)
    kept = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))

    def make(batch: pa.RecordBatch) -> tuple[Callable[[], dict], Callable[[], dict]]:
        codes, at, words = split_words(batch.column("text"))
        codes, words = by_frequency(codes, words)
        data, ends = as_bytes(words)
        group = range_hashes(data, ends[:-1], np.minimum(ends[:-1] + PREFIX, ends[1:])) % np.uint64(groups)
        part_of = (group * within + range_hashes(data, ends[:-1], ends[1:]) % within).astype(np.uint32)

        def entries() -> dict:
            every = words.cast(pa.large_binary()).to_pylist()
            return {p: join_words([every[i] for i in where]) for p, where in deal(part_of).items()}

        return lambda: {"ids": own(batch.column("id")), "n": np.diff(at).astype(np.uint32), "codes": codes, "part_of": part_of}, entries

    def answer(asked: list[dict]) -> Iterator[dict]:
        wanted = [cut_words(a) for a in asked]
        words = sorted({w.decode() for ws in wanted for w in ws})
        count = dict(zip((w.encode() for w in words), trie_counts(("▁" + w for w in words), Pieces.of(model))))
        for ws in wanted:
            yield {"n": np.array([count[w] for w in ws], np.uint32)}

    def finish(texts: dict | None, answers: dict) -> Iterator[pa.RecordBatch]:
        tokens = gather(texts["part_of"], answers, "n", 0)[texts["codes"]]
        yield pa.RecordBatch.from_arrays([texts["ids"], pa.array(texts["n"], pa.int64()), pa.array(sums(tokens, bounds(texts["n"])), pa.int64())], ["id", "n_words", "n_tokens"])

    schema = f"id {kept.schema['id'].dataType.simpleString()}, n_words bigint, n_tokens bigint"
    return look_up(kept, "text", make, answer, finish, schema).withColumnRenamed("id", id_column)

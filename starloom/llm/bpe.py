"""Byte-level BPE by distinct words.

A text is cut where a token can never reach across: before a single blank or line end that stands between two
characters that are no white space. The tokenizers library encodes each distinct piece ("word") once, and a text's ids
are its words' ids in order. Texts with other white space next to such a cut are cut by a regular expression instead.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import bounds, by_frequency, parts_of_words, runs_at
from .blocks import cut_words, deal, join_words, look_up, own, part_count

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
# A word that begins and ends as the cut asks: white space inside does no harm.
_NO_SPACE = r"[^\s\p{Z}\x{85}\x1c-\x1f]"
_WHOLE = rf"^[ \n]?({_NO_SPACE}|{_NO_SPACE}(?s:.)*{_NO_SPACE})$"

_PLAIN = re.compile(r"[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+([.,;:!?]?)\Z")


def cut_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each text's words as numbers, the texts' bounds among them, and the distinct words by number."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n")
    lists = pc.split_pattern(marked, "\0")
    at = np.asarray(lists.offsets, np.int64)
    coded = pc.dictionary_encode(lists.flatten())
    codes, words = np.asarray(coded.indices, np.int64), coded.dictionary
    odd = ~np.asarray(pc.match_substring_regex(words, _WHOLE), bool)
    odd_texts = np.asarray(pc.match_substring(texts, "\0"), bool) | (np.add.reduceat(np.append(odd[codes], False), at[:-1]) > 0 if len(texts) else np.zeros(0, bool))
    if odd_texts.any():
        again = [_CUT.split(t) if t else [] for t in pc.filter(texts, pa.array(odd_texts)).to_pylist()]
        number = {w: i for i, w in enumerate(words.to_pylist())}
        slow = [np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws)) for ws in again]
        lengths, slow_lengths = np.diff(at), [len(x) for x in slow]
        lengths[odd_texts] = slow_lengths
        whole_at = bounds(lengths)
        whole = np.empty(whole_at[-1], np.int64)
        fine = ~odd_texts
        whole[runs_at(whole_at[:-1][fine], lengths[fine])] = codes[runs_at(at[:-1][fine], lengths[fine])]
        if slow:
            whole[runs_at(whole_at[:-1][odd_texts], lengths[odd_texts])] = np.concatenate(slow)
        # Words that only odd texts had in their first form drop out.
        used, codes = np.unique(whole, return_inverse=True)
        words, at = pa.array(list(number), pa.large_string()).take(pa.array(used)), whole_at
    return codes, at, words


class Vocabulary:
    """A tokenizer file: encoding of words, and the bytes of each id."""

    _loaded: dict[str, Vocabulary] = {}

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        """One for each file and Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # Byte-level alphabet: visible Latin-1 bytes stand for themselves, the others for 256, 257, ... in order.
        visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        pieces = []
        for i in range(size):
            token = self.tokenizer.id_to_token(i) or ""
            known = all(c in byte_of for c in token)
            pieces.append(bytes(byte_of[c] for c in token) if known else token.encode())
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_length = np.array([len(p) for p in pieces], np.int64)
        self.piece_at = bounds(self.piece_length)
        self.alphabet = str.maketrans({b: c for c, b in byte_of.items()})
        self.single = {c: self.tokenizer.token_to_id(self.shown(c)) for c in "\n.,;:!?"}
        self.id_type = np.uint16 if size <= 1 << 16 else np.uint32

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and the words' bounds among them."""
        tokenize, single = self.tokenizer.model.tokenize, self.single
        parts: list[list[int] | None] = [None] * len(words)
        rest = []
        for i, (word, shown) in enumerate(zip(words, self.shown("\0".join(words)).split(self.shown("\0")) if words else [])):
            # Letters with at most a blank or line end before and a mark after them: the model alone decides.
            plain = _PLAIN.match(word)
            if plain is None:
                rest.append(i)
                continue
            before, after = word[0] == "\n", plain[1]
            ids = [t.id for t in tokenize(shown[1 if before else 0 : -1 if after else None])]
            parts[i] = [*([single["\n"]] if before else []), *ids, *([single[after]] if after else [])]
        for k in range(0, len(rest), 2000):
            some = rest[k : k + 2000]
            for i, one in zip(some, self.tokenizer.encode_batch([words[i] for i in some], add_special_tokens=False)):
                parts[i] = one.ids
        flat = np.fromiter(chain.from_iterable(parts), self.id_type)
        return flat, bounds(np.fromiter(map(len, parts), np.int64, len(parts)))

    def shown(self, text: str) -> str:
        """The text's bytes in the alphabet of the vocabulary."""
        return text.encode().decode("latin-1").translate(self.alphabet)

    def texts(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The text of each run of ids: their pieces, looked up by id, one after the other."""
        lengths = self.piece_length[ids]
        ends = bounds(lengths)[at].tolist()
        raw = self.piece_bytes[runs_at(self.piece_at[ids], lengths)].tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def _packed(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    """Runs of 32-bit ids as little-endian binaries."""
    data = flat.astype("<u4")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at * 4, np.int64)), pa.py_buffer(data)])


def encode_documents(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """Ids of every whole text: the id column, ``n_tokens`` and ``ids`` (packed little-endian 32-bit integers).

    ``decoded`` adds the text that the ids stand for, as ``decode_ids`` does, in the same pass.

    One row for each input row, also for repeated rows and ids and for null ids. A null or empty text has no ids. Other columns
    are left out, so their names cannot clash. A word is encoded once in the whole table, not once per text.
    """
    spark = docs.sparkSession
    parts = part_count(spark)
    kept = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))

    def make(batch: pa.RecordBatch) -> tuple[Callable[[], dict], Callable[[], dict]]:
        codes, at, words = cut_texts(batch.column("text"))
        codes, words = by_frequency(codes, words)
        part_of = parts_of_words(words, parts)

        def texts() -> dict:
            return {"ids": own(batch.column("id")), "n": np.diff(at).astype(np.uint32), "codes": codes, "part_of": part_of}

        def entries() -> dict:
            every = words.cast(pa.large_binary()).to_pylist()
            return {p: join_words([every[i] for i in where]) for p, where in deal(part_of).items()}

        return texts, entries

    def answer(asked: list[dict]) -> Iterator[dict]:
        number: dict[bytes, int] = {}
        wanted = [[number.setdefault(w, len(number)) for w in cut_words(a)] for a in asked]
        flat, at = Vocabulary.of(vocabulary).encode_words([w.decode() for w in number])
        lengths = np.diff(at)
        for numbers in wanted:
            n = lengths[numbers]
            yield {"n": n.astype(np.uint32), "ids": flat[runs_at(at[:-1][numbers], n)]}

    def finish(texts: dict | None, answers: dict) -> Iterator[pa.RecordBatch]:
        size = len(texts["part_of"])
        length, start = np.zeros(size, np.int64), np.zeros(size, np.int64)
        flat, total = [np.zeros(0, np.uint16)], 0
        for part, where in deal(texts["part_of"]).items():
            got = answers[part]
            length[where] = got["n"]
            start[where] = total + bounds(got["n"])[:-1]
            flat.append(got["ids"])
            total += len(got["ids"])
        every = np.concatenate(flat)
        text_at, codes, row = bounds(texts["n"]), texts["codes"], 0
        while row < len(texts["n"]):
            # Some hundred thousand words at a time, in whole texts.
            stop = max(row + 1, int(np.searchsorted(text_at, text_at[row] + 300_000, side="right")) - 1)
            own = codes[text_at[row] : text_at[stop]]
            n = length[own]
            at = bounds(n)[text_at[row : stop + 1] - text_at[row]]
            flat_ids = every[runs_at(start[own], n)]
            columns = [texts["ids"].slice(row, stop - row), pa.array(np.diff(at), pa.int64()), _packed(flat_ids, at)]
            again = [pa.array(Vocabulary.of(vocabulary).texts(flat_ids, at), pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays([*columns, *again], ["id", "n_tokens", "ids", "decoded"][: 3 + decoded])
            row = stop

    kind = kept.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids binary" + ", decoded string" * decoded
    return look_up(kept, "text", make, answer, finish, schema).withColumnRenamed("id", id_column)


def decode_ids(encoded: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text that packed ids stand for. Ids meet their pieces in a table of the vocabulary's size (bounded).

    Null ids give a null text, no ids an empty one. Bytes that are no UTF-8 become U+FFFD, as in the tokenizers library.
    """
    names = [c for c in encoded.columns if c != decoded]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Vocabulary.of(vocabulary)
        for batch in batches:
            column = batch.column(ids)
            data, at = as_bytes_of_binary(column)
            texts = table.texts(data.view("<u4"), at // 4)
            empty = np.asarray(pc.is_null(column), bool)
            texts = pa.array([None if e else t for t, e in zip(texts, empty)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), texts], [*names, decoded])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*names).schema)
    return encoded.select(*names).mapInArrow(task, f"{kinds}, `{decoded}` string")


def as_bytes_of_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, copied to an aligned array, and the rows' bounds."""
    column = pc.fill_null(column, b"").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(column.buffers()[2] or b"", np.uint8) if len(column) else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]].copy(), offsets - offsets[0]



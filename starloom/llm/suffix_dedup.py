"""Removal of byte strings that an earlier document holds too.

Two documents that share WIDTH bytes also share the marker of that string: the K-byte piece in it with the smallest hash. So

1. a first look-up finds the markers that more than one document holds (a marker of very many documents is called hot);
2. the windows of shared markers go to a part chosen by the marker, as short texts (a run of neighbouring windows with the same marker). Windows of
   a hot marker go one by one, to a part chosen by all their bytes;
3. a part sorts the suffixes of its texts in two stages and compares neighbours: windows whose common prefix reaches WIDTH are the same string, and
   the smallest document of all of them is its owner;
4. back in its document, a byte goes if a window over it has an owner with a smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import as_bytes, bounds, dump, load, range_hashes, rolling_hashes, runs_at
from .blocks import deal, gather, look_up, own, part_count
from .stored import stored

#: Bytes of a string that counts; bytes of a marker; neighbouring windows that travel together, at most.
WIDTH, K, RUN = 50, 20, 64
#: A marker of more documents than this is hot.
HOT = 5000
CHUNK = 1 << 20
NO_ID = np.iinfo(np.int64).max


def windows(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of WIDTH bytes inside one document, as runs with the same marker: start, length, marker (40 bits)."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    doc, docs = 0, len(at) - 1
    while doc < docs:
        stop = max(doc + 1, int(np.searchsorted(at, at[doc] + CHUNK, side="right")) - 1)
        a, b = int(at[doc]), int(at[stop])
        if b - a >= WIDTH:
            least = rolling_hashes(text[a:b], K) >> np.uint64(24)
            span, wanted = 1, WIDTH - K + 1
            while span < wanted:
                step = min(span, wanted - span)
                least = np.minimum(least[:-step], least[step:])
                span += step
            sizes = np.maximum(np.diff(at[doc : stop + 1]) - WIDTH + 1, 0)
            start = runs_at(at[doc:stop] - a, sizes)
            if len(start):
                marker = least[start]
                new = np.flatnonzero(np.concatenate([[True], (marker[1:] != marker[:-1]) | (start[1:] != start[:-1] + 1)]))
                length = np.diff(np.append(new, len(start)))
                pieces = -(-length // RUN)
                first = np.repeat(new, pieces) + RUN * runs_at(np.zeros(len(new), np.int64), pieces)
                length = np.minimum(RUN, np.repeat(new + length, pieces) - first)
                out.append((start[first] + a, length, marker[first]))
        doc = stop
    return tuple(np.concatenate(x) for x in zip(*out))


def _words_at(text: np.ndarray, places: np.ndarray, offset: int) -> np.ndarray:
    """The eight bytes at each place + offset as big-endian numbers: their order is that of the bytes."""
    view = np.ndarray(len(text) - 7, ">u8", text, strides=(1,))
    return view[places + offset].astype(np.uint64)


def two_stage_order(text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The suffixes that start at the ``wanted`` places, sorted by their first WIDTH bytes at least.

    Only suffixes smaller than their successor are sorted directly. Any other has its successor before it, so a scan of the buckets (by first
    byte, ascending) meets the successors in order and puts each such suffix behind those already in its bucket; there they come
    before the directly sorted ones. ``text`` ends with WIDTH + 8 zero bytes and has a zero byte after each piece.
    """
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    following = np.searchsorted(differs, np.arange(n - 1))
    smaller = np.zeros(n, bool)
    inside = following < len(differs)
    at = differs[following[inside]]
    smaller[: n - 1][inside] = text[at] < text[at + 1]
    smaller[text == 0] = True
    # Besides the wanted suffixes, those behind them up to the first that is sorted directly.
    needed = np.zeros(n, bool)
    needed[wanted] = True
    chain = wanted[~smaller[wanted]]
    while len(chain):
        chain = chain[~needed[chain + 1]] + 1
        needed[chain] = True
        chain = chain[~smaller[chain]]
    direct = np.flatnonzero(needed & smaller)
    keys = [_words_at(text, direct, o) for o in range((WIDTH // 8) * 8, -1, -8)]
    direct = direct[np.lexsort(keys)]
    induced = needed & ~smaller
    by_first = np.split(direct, np.searchsorted(text[direct], np.arange(1, 256)))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        bucket = []
        now = np.concatenate(waiting[c]) if waiting[c] else direct[:0]
        while len(now):
            bucket.append(now)
            before = now[now > 0] - 1
            now = before[induced[before] & (text[before] == c)]
        bucket.append(by_first[c])
        whole = np.concatenate(bucket)
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[induced[before] & (text[before] > c)]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            heads, cut = np.unique(first[order], return_index=True)
            for head, some in zip(heads, np.split(before[order], cut[1:])):
                waiting[head].append(some)
    order = np.concatenate(out)
    asked = np.zeros(n, bool)
    asked[wanted] = True
    return order[asked[order]]


def neighbours_agree(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether the common prefix of each suffix and the one before it reaches WIDTH bytes."""
    agree = np.ones(max(0, len(order) - 1), bool)
    for offset in [*range(0, WIDTH - 7, 8), WIDTH - 8]:
        left = np.flatnonzero(agree)
        word = _words_at(text, order, offset)
        agree[left] = word[left] == word[left + 1]
    return agree


def owners(pieces: list[bytes], runs: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each window of each piece (run after run) the smallest id among the pieces that hold the same string."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    at = bounds(lengths + 1)
    text = np.frombuffer(b"\0".join([*pieces, bytes(WIDTH + 8)]), np.uint8)
    places = runs_at(at[:-1], runs)
    if not len(places):
        return np.zeros(0, np.int64)
    order = two_stage_order(text, places)
    group = np.concatenate([[0], np.cumsum(~neighbours_agree(text, order))])
    window = np.searchsorted(places, order)
    ids = np.repeat(least, runs)[window]
    smallest = np.minimum.reduceat(ids, np.flatnonzero(np.concatenate([[True], np.diff(group) > 0])))
    out = np.empty(len(places), np.int64)
    out[window] = smallest[group]
    return out


def _shared_markers(docs: DataFrame, parts: int) -> DataFrame:
    """Documents without a shared marker, which stay whole; and the others in packed blocks, with the windows of shared markers."""

    def make(batch: pa.RecordBatch) -> tuple[Callable[[], dict], Callable[[], dict]]:
        text, at = as_bytes(batch.column("text"))

        def entries() -> dict:
            start, _, marker = windows(text, at)
            doc = np.searchsorted(at, start, side="right") - 1
            order = np.lexsort((doc, marker))
            marker, doc = marker[order], doc[order]
            first = np.concatenate([[True], (marker[1:] != marker[:-1]) | (doc[1:] != doc[:-1])])[: len(marker)]
            each, count = np.unique(marker[first], return_counts=True)
            out = {}
            for part, where in deal((each % np.uint64(parts)).astype(np.int64)).items():
                own_markers = each[where]
                gaps = np.diff(own_markers, prepend=np.uint64(0))
                small = np.uint32 if gaps.max(initial=np.uint64(0)) < 1 << 32 else np.uint64
                out[part] = {"gaps": gaps.astype(small), "docs": np.minimum(count[where], 0xFFFF).astype(np.uint16)}
            return out

        def texts() -> dict:
            data = dump({"text": text.tobytes()}, LEVEL)
            return {"ids": own(batch.column("id")), "lengths": np.diff(at).astype(np.uint32), "data": data}

        return texts, entries

    def answer(asked: list[dict]) -> Iterator[dict]:
        markers = [np.cumsum(a["gaps"].astype(np.uint64), dtype=np.uint64) for a in asked]
        every = np.concatenate(markers)
        each, place = np.unique(every, return_inverse=True)
        docs_of = np.bincount(place, np.concatenate([a["docs"] for a in asked]).astype(float))
        kind = ((docs_of > 1).astype(np.uint8) + (docs_of > HOT)).astype(np.uint8)
        yield from ({"kind": k} for k in np.split(kind[place], np.cumsum([len(m) for m in markers])[:-1]))

    def finish(texts: dict | None, answers: dict) -> Iterator[pa.RecordBatch]:
        text, at = np.frombuffer(load(texts["data"])["text"], np.uint8), bounds(texts["lengths"])
        start, run, marker = windows(text, at)
        each, place = np.unique(marker, return_inverse=True)
        kind = gather((each % np.uint64(parts)).astype(np.int64), answers, "kind", np.uint8(0))[place]
        hot = kind == 2
        single = runs_at(start[hot], run[hot])
        start = np.concatenate([start[kind == 1], single])
        key = np.concatenate([marker[kind == 1], range_hashes(text, single, single + WIDTH)])
        run = np.concatenate([run[kind == 1], np.ones(len(single), np.int64)])
        order = np.argsort(start, kind="stable")
        start, run, key = start[order], run[order], key[order]
        n_bytes = np.diff(at)
        doc = np.searchsorted(at, start, side="right") - 1
        busy = np.zeros(len(n_bytes), bool)
        busy[doc] = True
        whole = text.tobytes()
        done = np.flatnonzero(~busy)
        yield _rows(texts["ids"].take(pa.array(done)), n_bytes[done], [whole[at[i] : at[i + 1]] for i in done], 0 * done, 0 * done)
        if busy.any():
            # The busy documents move together; windows keep their place in their document.
            left = np.flatnonzero(busy)
            moved = bounds(n_bytes[left])
            data = {
                "text": b"".join([whole[at[i] : at[i + 1]] for i in left]),
                "lengths": n_bytes[left].astype(np.uint32),
                "ids": np.asarray(texts["ids"].take(pa.array(left)).fill_null(NO_ID), np.int64),
                "no_id": np.asarray(texts["ids"].take(pa.array(left)).is_null(), bool),
                "gaps": np.diff(start - at[doc] + moved[np.searchsorted(left, doc)], prepend=0).astype(np.uint32),
                "runs": run.astype(np.uint8),
                "keys": key,
            }
            yield pa.RecordBatch.from_arrays([pa.array([None], f.type) for f in _OUT] + [pa.array([dump(data, LEVEL)], pa.binary())], [*_OUT.names, "data"])

    return stored(look_up(docs, "text", make, answer, finish, f"{_RESULT}, data binary"), "windows")


#: Compression of whole texts: they are shuffled, so their size counts.
LEVEL = 9
_RESULT = "id bigint, n_bytes bigint, kept binary, n_removed bigint, n_spans bigint"
_OUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])


def _rows(ids: pa.Array, n_bytes: np.ndarray, kept: list[bytes], n_removed: np.ndarray, n_spans: np.ndarray, data: bool = True) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip((ids, n_bytes, kept, n_removed, n_spans), _OUT)]
    return pa.RecordBatch.from_arrays([*columns, *([pa.nulls(len(ids), pa.binary())] if data else [])], [*_OUT.names, *(["data"] if data else [])])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document: the id, ``n_bytes``, ``kept`` (the bytes that stay), ``n_removed`` and ``n_spans`` (maximal removed runs).

    A byte goes if a string of WIDTH bytes over it, inside its document, also starts in a document with a smaller id. Texts are
    UTF-8; null counts as empty and keeps 0 bytes. All is judged on the input. Rows with the same id do not take from each other. A null id is
    larger than all others. Every input row gives one row; other columns are left out, so their names cannot clash.
    """
    parts = part_count(docs.sparkSession)
    given = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))

    def unpack(data: bytes) -> tuple:
        row = load(data)
        starts = np.cumsum(row["gaps"].astype(np.int64))
        return row, np.frombuffer(row["text"], np.uint8), bounds(row["lengths"]), starts, row["runs"].astype(np.int64)

    def distinct_runs(data: bytes, starts: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first of each distinct run of windows, and for each run which distinct one it is, by their bytes."""
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(data[a:b], len(number)) for a, b in zip(starts.tolist(), (starts + runs + WIDTH - 1).tolist())], np.int64)
        first = np.empty(len(number), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        return first, which

    def make(batch: pa.RecordBatch) -> tuple[Callable[[], dict], Callable[[], dict]]:
        packed = batch.column("data")[0].as_py()

        def entries() -> dict:
            row, text, at, starts, runs = unpack(packed)
            first, which = distinct_runs(row["text"], starts, runs)
            least = np.full(len(first), NO_ID)
            np.minimum.at(least, which, row["ids"][np.searchsorted(at, starts, side="right") - 1])
            data, out = row["text"], {}
            for part, where in deal((row["keys"][first] % np.uint64(parts)).astype(np.int64)).items():
                s, r = starts[first[where]], runs[first[where]]
                out[part] = {"bytes": b"".join([data[a:b] for a, b in zip(s.tolist(), (s + r + WIDTH - 1).tolist())]), "runs": r.astype(np.uint8), "least": least[where]}
            return out

        return lambda: {"packed": packed}, entries

    def answer(asked: list[dict]) -> Iterator[dict]:
        number: dict[bytes, int] = {}
        wanted = []
        for a in asked:
            ends = bounds(a["runs"].astype(np.int64) + WIDTH - 1).tolist()
            data = a["bytes"]
            wanted.append(np.array([number.setdefault(data[x:y], len(number)) for x, y in zip(ends, ends[1:])], np.int64))
        least = np.full(len(number), NO_ID)
        for which, a in zip(wanted, asked):
            np.minimum.at(least, which, a["least"])
        pieces = list(number)
        runs = np.fromiter(map(len, pieces), np.int64, len(pieces)) - WIDTH + 1
        owner, at = owners(pieces, runs, least), bounds(runs)
        for which in wanted:
            # Few owners, many windows.
            each, place = np.unique(owner[runs_at(at[which], runs[which])], return_inverse=True)
            yield {"each": each, "owner": place.astype(np.uint16 if len(each) < 1 << 16 else np.uint32)}

    def finish(texts: dict | None, answers: dict) -> Iterator[pa.RecordBatch]:
        row, text, at, starts, runs = unpack(texts["packed"])
        first, which = distinct_runs(row["text"], starts, runs)
        begin, total, flat = np.zeros(len(first), np.int64), 0, [np.zeros(0, np.int64)]
        for part, where in deal((row["keys"][first] % np.uint64(parts)).astype(np.int64)).items():
            begin[where] = total + bounds(runs[first[where]])[:-1]
            flat.append(answers[part]["each"][answers[part]["owner"]])
            total += len(flat[-1])
        owner = np.concatenate(flat)[runs_at(begin[which], runs)]
        place = runs_at(starts, runs)
        taken = place[owner < np.repeat(row["ids"][np.searchsorted(at, starts, side="right") - 1], runs)]
        cover = np.zeros(len(text) + 1, np.int32)
        np.add.at(cover, taken, 1)
        np.add.at(cover, taken + WIDTH, -1)
        gone = np.cumsum(cover[:-1]) > 0
        begins = gone & ~np.concatenate([[False], gone[:-1]])
        begins[at[:-1][at[:-1] < len(text)]] |= gone[at[:-1][at[:-1] < len(text)]]
        n_gone, n_spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[at]) for x in (gone, begins))
        n_bytes = np.diff(at)
        kept_at = bounds(n_bytes - n_gone)
        kept = text[~gone]
        ids = pa.array(row["ids"], pa.int64(), mask=row["no_id"])
        yield _rows(ids, n_bytes, [kept[a:b].tobytes() for a, b in zip(kept_at, kept_at[1:])], n_gone, n_spans, data=False)

    marked = _shared_markers(given, parts)
    whole = marked.where("data IS NULL").drop("data")
    # Each packed row is a block already.
    shared = look_up(marked.where("data IS NOT NULL").select("data"), "data", make, answer, finish, _RESULT, size=1)
    return whole.unionByName(shared).withColumnRenamed("id", id_column)

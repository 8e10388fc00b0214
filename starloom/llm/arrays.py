"""Numpy helpers used inside tasks: packed arrays, runs, word hashes."""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

# Freed Arrow memory goes back to the system at once; workers stay alive between tasks.
pa.set_memory_pool(pa.system_memory_pool())


def dump(arrays: dict, level: int = 3) -> bytes:
    """Arrays and plain values in few bytes. Numbers are stored byte plane by byte plane, then compressed."""
    flat = {}
    for name, value in arrays.items():
        if isinstance(value, np.ndarray) and value.dtype.itemsize > 1 and value.ndim == 1:
            planes = value.view(np.uint8).reshape(len(value), value.dtype.itemsize).T.tobytes()
            flat[name] = (value.dtype.str, planes)
        elif isinstance(value, np.ndarray):
            flat[name] = (None, value)
        else:
            flat[name] = value
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(flat, protocol=5))


def load(data: bytes) -> dict:
    """What ``dump`` was given."""
    arrays = {}
    for name, value in pickle.loads(zstandard.ZstdDecompressor().decompress(data)).items():
        if isinstance(value, tuple) and len(value) == 2 and value[0] is None:
            value = value[1]
        elif isinstance(value, tuple) and len(value) == 2 and isinstance(value[0], str):
            kind = np.dtype(value[0])
            planes = np.frombuffer(value[1], np.uint8).reshape(kind.itemsize, -1)
            value = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
        arrays[name] = value
    return arrays


def bounds(lengths) -> np.ndarray:
    """Start of each run, and the end of the last."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def runs_at(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one after the other."""
    at = bounds(lengths)
    return np.arange(at[-1]) + np.repeat(np.asarray(starts, np.int64) - at[:-1], lengths)


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of each run given by its bounds; 0 for an empty run."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each text's words as numbers, the texts' bounds among them, and the distinct words. ASCII white space parts words.

    ``lower``: A-Z count as a-z.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    at = np.asarray(lists.offsets, np.int64)
    coded = pc.dictionary_encode(lists.flatten())
    codes, words = np.asarray(coded.indices, np.int64), coded.dictionary
    # White space at an end leaves an empty word.
    full = np.asarray(pc.binary_length(words), np.int64) > 0
    stays = full[codes]
    at = np.concatenate([[0], np.cumsum(stays)])[at - at[0]]
    return (np.cumsum(full) - 1)[codes[stays]], at, words.filter(pa.array(full))


def by_frequency(codes: np.ndarray, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes and words with new numbers: frequent words get small ones, equally frequent ones stand in order of the alphabet.

    Both pack well.
    """
    count = np.bincount(codes, minlength=len(words))
    alphabet = np.asarray(pc.sort_indices(words), np.int64)
    order = alphabet[np.argsort(-count[alphabet], kind="stable")]
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words), dtype=np.uint32)
    return rank[codes], words.take(pa.array(order))


def parts_of_words(words: pa.Array, parts: int) -> np.ndarray:
    """The part that each word is dealt to, by its hash."""
    data, at = as_bytes(words)
    return (range_hashes(data, at[:-1], at[1:]) % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.uint32)


def per_run(ufunc, values: np.ndarray, at: np.ndarray, empty) -> np.ndarray:
    """``ufunc`` over each run; ``empty`` for a run without values. Values may have more axes."""
    out = np.full((len(at) - 1, *values.shape[1:]), empty, values.dtype)
    full = at[1:] > at[:-1]
    if full.any():
        out[full] = ufunc.reduceat(values, at[:-1][full], axis=0)
    return out


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and each text's bounds. Null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def own_rows(batch: pa.RecordBatch, start: int, stop: int) -> pa.RecordBatch:
    """A copy of some rows: some Arrow kernels misread the offsets of a slice."""
    return batch.take(pa.array(np.arange(start, stop)))


def by_size(batch: pa.RecordBatch, column: str, limit: int):
    """Batches of whole rows whose text makes up about ``limit`` bytes at most; a longer text stands alone."""
    if batch.num_rows == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield own_rows(batch, start, stop)
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_ODD = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, up to n."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def range_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of text[start:end] for each pair; both ascending. Ranges may overlap.

    A polynomial: good for dealing out, but long texts can be made to collide, so never proof that two are the same.
    """
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        origin = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(starts, origin + chunk)))
        last = int(ends[hi - 1])
        power, inverse = _power_tables(last - origin + 1)
        total = np.zeros(last - origin + 1, np.uint64)
        np.cumsum(_BYTE[text[origin:last]] * power[: last - origin], dtype=np.uint64, out=total[1:])
        s, e = starts[lo:hi] - origin, ends[lo:hi] - origin
        out[lo:hi] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        lo = hi
    return out


def rolling_hashes(text: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of text[i:i + width] for every i."""
    n = len(text)
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[text] * power[:n], dtype=np.uint64, out=total[1:])
    return mix((total[width:] - total[:-width]) * inverse[: n + 1 - width])


#: Digests of short words that a worker has seen; forgotten when there are too many.
_digests: dict[bytes, bytes] = {}
_REMEMBERED, _SHORT = 400_000, 48


def digests_of(values: pa.Array) -> np.ndarray:
    """A keyed 64-bit digest of each text or byte string."""
    out = []
    for value in values.cast(pa.large_binary()).to_pylist():
        digest = _digests.get(value)
        if digest is None:
            digest = hashlib.blake2b(value, digest_size=8, key=b"starloom").digest()
            if len(value) <= _SHORT:
                if len(_digests) >= _REMEMBERED:
                    _digests.clear()
                _digests[value] = digest
        out.append(digest)
    return np.frombuffer(b"".join(out), np.uint64)


def word_hashes(text: np.ndarray, at: np.ndarray, is_space: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of the words of every text, and each text's bounds among them.

    Each distinct word is digested once, by a keyed cryptographic hash, so that no texts can be made to collide. ``at``: the texts' bounds. ``is_space``: whether a byte parts words; ``fold``: what a byte counts as.
    """
    inside = np.zeros(len(text) + 2, bool)
    np.logical_not(is_space[text], out=inside[1:-1])
    cut = np.zeros(len(text) + 1, bool)
    cut[at] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    joined = np.ascontiguousarray(fold[text[inside[1:-1]]])
    offsets = bounds(ends - starts)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    coded = pc.dictionary_encode(words)
    return digests_of(coded.dictionary)[np.asarray(coded.indices, np.int64)], np.searchsorted(starts, at)


ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[ord("A") : ord("Z") + 1] += 32


def shingles(words: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``width`` words, with bounds; a shorter text is one run, an empty one none."""
    n = np.diff(at)
    counts = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    out_at = bounds(counts)
    mixed = np.zeros(out_at[-1], np.uint64)
    full = n >= width
    first = runs_at(at[:-1][full], counts[full])
    long = np.zeros(len(first), np.uint64)
    for k in range(width):
        long = mix(long * np.uint64(_ODD) + words[first + k] + np.uint64(k + 1))
    mixed[runs_at(out_at[:-1][full], counts[full])] = long
    for i in np.flatnonzero((n > 0) & ~full):
        one = np.zeros(1, np.uint64)
        for k, word in enumerate(words[at[i] : at[i + 1]]):
            one = mix(one * np.uint64(_ODD) + word + np.uint64(k + 1))
        mixed[out_at[i]] = mix(one + np.uint64(counts[i] + n[i]))[0]
    return mixed, out_at


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run's distinct values in ascending order, with bounds."""
    parts = [np.unique(values[at[i] : at[i + 1]]) for i in range(len(at) - 1)]
    return (np.concatenate(parts) if parts else values[:0]), bounds([len(p) for p in parts])

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from documents_by_hand import FOLDER, awkward, given, rows_of
from tokenizers import Tokenizer

from starloom.llm import bpe, queries, token_files
from starloom.llm.elias_fano import EliasFano
from starloom.session import scratch_path

tokenizer = Tokenizer.from_file(queries.VOCABULARY)


def encoded(texts):
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def little(ids):
    return np.array(ids, "<u4").tobytes()


def test_words_of_random_texts_give_the_library_s_ids():
    rng = random.Random(3)
    alphabet = ["a", "b c", " ", "\n", "\t", "\0", "  ", "é", "'s", "'", "1", "<|endoftext|>", ".", "!", "\r", "\x1f", "漢", "👍", "　", "Don"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(4000)]
    codes, at, words = bpe.cut_texts(pa.array(texts))
    flat, word_at = bpe.Vocabulary.of(queries.VOCABULARY).encode_words(words.to_pylist())
    for i, wanted in enumerate(encoded(texts)):
        ids = [x for c in codes[at[i] : at[i + 1]] for x in flat[word_at[c] : word_at[c + 1]].tolist()]
        assert ids == wanted, texts[i]


@pytest.mark.parametrize("table", [awkward, given])
def test_encode_and_decode(spark, table):
    docs = table(spark)
    rows = rows_of(docs)
    wanted = sorted((str(i), little(ids), tokenizer.decode(ids, skip_special_tokens=False)) for (i, _), ids in zip(rows, encoded([t for _, t in rows])))
    found = bpe.encode_documents(docs, queries.VOCABULARY, decoded=True).collect()
    assert sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in found) == wanted
    assert all(4 * r.n_tokens == len(r.ids) for r in found)
    apart = bpe.decode_ids(bpe.encode_documents(docs, queries.VOCABULARY), queries.VOCABULARY).collect()
    assert sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in apart) == wanted


def test_broken_ids_decode_like_the_library(spark):
    ids = [[125], [125, 64], [], [50256]]
    frame = spark.createDataFrame([(k, bytearray(little(x))) for k, x in enumerate(ids)] + [(9, None)], "k int, ids binary")
    found = {r.k: r.decoded for r in bpe.decode_ids(frame, queries.VOCABULARY).collect()}
    assert found == {**{k: tokenizer.decode(x, skip_special_tokens=False) for k, x in enumerate(ids)}, 9: None}


@pytest.mark.parametrize("table", [awkward, given])
def test_token_files(spark, table):
    docs = table(spark)
    path = scratch_path(spark, "test")
    token_files.write_token_files(docs, path, queries.VOCABULARY)
    found = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)
    rows = rows_of(docs)
    bodies = {}
    for (i, _), ids in zip(rows, encoded([t for _, t in rows])):
        bodies.setdefault(i, []).append(little([*ids, 2]))
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in found:
        assert r.start == start
        bodies[r.doc_id].remove(bytes(r.ids))
        start += r.n_tokens
    assert not any(bodies.values())


def test_words_made_to_collide_under_a_polynomial_keep_their_ids(spark):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    texts = [word, word.translate({97: 98, 98: 97}), f"{word} {word[::-1]}", word]
    path = scratch_path(spark, "test")
    token_files.write_token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1), path, queries.VOCABULARY)
    found = {r.doc_id: bytes(r.ids) for r in token_files.read_documents(spark, path).collect()}
    assert found == {i: little([*ids, 2]) for i, ids in enumerate(encoded(texts))}


def test_words_that_share_a_hash_are_told_by_their_bytes(monkeypatch):
    monkeypatch.setattr(token_files, "range_hashes", lambda data, starts, ends: (np.asarray(ends) - starts).astype(np.uint64))
    seen = token_files.WordIds(queries.VOCABULARY)
    for some in (["one", "three", "four"], ["seven"], ["zwanzig", "x"], ["one"], ["two"], ["three", "two"], ["one", "x", "four"]):
        flat, n = seen.ids(pa.array(some), np.arange(len(some)))
        assert flat.tolist() == [x for ids in encoded(some) for x in ids] and n.tolist() == [len(ids) for ids in encoded(some)]


def test_token_files_of_nothing(spark):
    path = scratch_path(spark, "test")
    token_files.write_token_files(awkward(spark).limit(0), path, queries.VOCABULARY)
    assert token_files.read_documents(spark, path).count() == 0
    assert bpe.encode_documents(awkward(spark).limit(0), queries.VOCABULARY).count() == 0


def test_elias_fano():
    rng = random.Random(1)
    for values in [[], [0], [5], [7] * 1000, list(range(3000)), sorted(rng.randrange(1 << 40) for _ in range(2500)), sorted(rng.randrange(90) for _ in range(999))]:
        code = EliasFano.of(values)
        again = EliasFano.from_bytes(code.to_bytes())
        assert again.values().tolist() == values
        assert [again.select(i) for i in range(len(values))] == values
        cuts = sorted(rng.randrange(len(values) + 1) for _ in range(40))
        assert all(again.select_range(a, b).tolist() == values[a:b] for a, b in zip(cuts, cuts[1:]))
    dense = np.cumsum([rng.randrange(200, 900) for _ in range(20000)])
    assert 8 * len(EliasFano.of(dense).to_bytes()) < 13 * len(dense)
    with pytest.raises(ValueError):
        EliasFano.of([2, 1])


def test_queries(spark):
    rows = sorted(rows_of(given(spark)))
    start = 0
    ten = {r.doc_id: r for r in queries.op10_bpe(spark, FOLDER).collect()}
    two = {r.doc_id: r for r in queries.op2_token_files(spark, FOLDER).collect()}
    assert len(ten) == len(two) == len(rows)
    for (i, text), ids in zip(rows, encoded([t for _, t in rows])):
        assert (ten[i].n_tokens, ten[i].ids_sha256) == (len(ids), hashlib.sha256(little(ids)).hexdigest())
        assert ten[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (two[i].start, two[i].n_tokens, two[i].ids_crc32) == (start, len(ids) + 1, zlib.crc32(little([*ids, 2])))
        start += len(ids) + 1

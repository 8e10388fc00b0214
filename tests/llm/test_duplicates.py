import hashlib
import random
import re

import numpy as np
import pytest
from documents_by_hand import FOLDER, awkward, given, rows_of

from starloom.llm import minhash, queries, suffix_dedup
from starloom.llm.components import components

LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_by_hand(rows, width, percent=80):
    """(id, text) rows: set size and component by comparing all pairs."""
    sets = [shingle_set(t, width) for _, t in rows]
    home = list(range(len(rows)))

    def top(i):
        while home[i] != i:
            i = home[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j]) if a and min(len(a), len(sets[j])) * 100 >= percent * max(len(a), len(sets[j])) else 0
            if shared and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                home[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return [(doc, len(s), least.get(top(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize(("table", "width"), [(awkward, 2), (awkward, 5), (given, 2), (given, 5)])
def test_near_duplicates(spark, table, width):
    docs = table(spark)
    wanted = near_by_hand(rows_of(docs), width)
    found = minhash.near_duplicates(docs, width=width).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=key) == sorted(wanted, key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_a_large_group_around_one_original_and_a_chain(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(700):
        words = list(base)
        for k in rng.sample(range(120), 5):
            words[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows.append((700, " ".join(base)))
    chain = [f"c{k}" for k in range(200)]
    rows += [(1000 + k, " ".join(chain[k * 8 : k * 8 + 100])) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = {i: c for i, _, c in near_by_hand(rows, 2)}
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, width=2).collect()} == wanted


def tiled(spark, rows):
    """(bucket, name, component, compared, text, earlier buckets) as members, and the texts by name."""
    schema = "bucket bigint, digest binary, component binary, compared binary, text string, earlier array<bigint>, n_shingles bigint"
    frame = spark.createDataFrame([(b, bytearray(d), bytearray(c), bytearray(x), t, e, len(shingle_set(t, 2))) for b, d, c, x, t, e in rows], schema)
    texts = frame.select("digest", "text").distinct()
    tiles = minhash._tiles(frame.drop("text"))
    return minhash._joined_in_tiles(tiles, lambda wanted: texts.join(wanted.distinct(), "digest"), 2, 80).collect()


@pytest.mark.parametrize("tile", [16, 1024])
def test_tiles_join_all_linked_components_by_few_links(spark, tile, monkeypatch):
    """A large group of which most pairs survive verification but few are links: links out stay below the members."""
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(2)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for i in range(120):
        words = list(base)
        for k in rng.sample(range(60), 3):
            words[k] = f"x{rng.randrange(8)}"
        texts.append(" ".join(words))
    same = bytes(minhash.COMPARED)
    homes = [b"main" if i < 70 else bytes([i % 5]) if i < 100 else b"own" + bytes([i]) for i in range(120)]
    rows = [(1, i.to_bytes(4, "big"), homes[i], same, texts[i], []) for i in range(120)]
    found = tiled(spark, rows)
    place = {r[1]: n for n, r in enumerate(rows)}

    def joined(pairs):
        group = list(homes)
        for i, j in pairs:
            group = [group[i] if g == group[j] else g for g in group]
        return [[g == h for h in group] for g in group]

    sets = [shingle_set(t, 2) for t in texts]
    real = [(i, j) for i in range(120) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    named = [(place[bytes(r.a)], place[bytes(r.b)]) for r in found]
    assert all((max(p), min(p)) in set(real) for p in named)
    assert joined(named) == joined(real)
    assert len(named) < 120 * (1 if tile == 1024 else 9)


def test_tiles_leave_out_a_pair_only_where_it_met_in_an_earlier_bucket(spark):
    # All lowest bytes agree; only the buckets tell whether the pair has met.
    same = bytes(minhash.COMPARED)
    rows = [(bucket, bytes([bucket, i]), bytes([i]), same, "the same words", [earlier[i]]) for bucket, earlier in ((1, (5, 6)), (2, (7, 7))) for i in range(2)]
    assert [sorted([bytes(r.a), bytes(r.b)]) for r in tiled(spark, rows)] == [[b"\1\0", b"\1\1"]]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_texts_made_to_collide_under_a_polynomial_stay_apart(spark):
    word = thue_morse(4096)
    other = word.translate({97: 98, 98: 97})
    rows = [(1, word), (2, other), (3, f"{word} {other} x"), (4, f"{other} {word} x"), (5, word), (6, f"{word * 3} y"), (7, f"{other * 3} y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, width=2).collect()}
    assert found == {i: (n, c) for i, n, c in near_by_hand(rows, 2)}


def test_bayesian_limits_keep_what_reaches_the_threshold():
    rng = np.random.default_rng(0)
    steps = minhash.least_matches(0.8)
    left = rng.integers(0, 256, (20000, minhash.COMPARED), dtype=np.uint8)

    def share_that_goes_on(similarity):
        right = np.where(rng.random(left.shape) < similarity, left, left + 1 + rng.integers(0, 255, left.shape, dtype=np.uint8) % 255).astype(np.uint8)
        return len(minhash.go_on(left, right, steps)[0]) / len(left)

    assert share_that_goes_on(0.8) > 0.9998
    assert share_that_goes_on(0.5) < 0.01


def test_a_link_at_the_threshold_is_hardly_ever_dropped():
    # Exactly, over all batches: the chance that the matches of a pair of similarity 0.8 fall below a limit.
    chance, lost, before = np.ones(1), 0.0, 0
    t = 0.8 + 0.2 / 256
    for n, least in minhash.least_matches(0.8):
        for _ in range(n - before):
            chance = np.append(chance * (1 - t), 0) + np.append(0, chance * t)
        lost += chance[:least].sum()
        chance[:least], before = 0, n
    assert lost < 1e-5


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    home = {x: x for pair in links for x in pair}
    for _ in range(400):
        for a, b in links:
            home[a] = home[b] = min(home[a], home[b])
    frame = spark.createDataFrame([*links, (None, 3)], "a int, b int")
    assert {r.node: r.component for r in components(frame).collect()} == {n: c for n, c in home.items() if n != c}
    assert components(frame.limit(0)).count() == 0


def removal_by_hand(rows):
    owner = {}
    texts = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for k in range(len(t) - 49):
            owner[t[k : k + 50]] = min(owner.get(t[k : k + 50], i), i)
    out = []
    for (doc, _), (i, t) in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - 49):
            if owner[t[k : k + 50]] < i:
                gone[k : k + 50] = True
        gone[len(t)] = False
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0
        out.append((doc, len(t), int(gone.sum()), spans, np.frombuffer(t, np.uint8)[~gone[:-1]].tobytes()))
    return out


@pytest.mark.parametrize("table", [awkward, given])
@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_removal(spark, table, hot, monkeypatch):
    docs = table(spark)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(found, key=key) == sorted(removal_by_hand(rows_of(docs)), key=key)


def test_owners_by_two_stage_sorting():
    rng = random.Random(5)
    for _ in range(120):
        alphabet = rng.choice([b"ab", b"a", b"abcdefgh \0"])
        pieces = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(50, 71))) for _ in range(rng.randrange(1, 13))]
        pieces = list(dict.fromkeys(pieces + [p[5:] + b"abcde" for p in pieces]))
        least = np.array([rng.randrange(10) for _ in pieces])
        wanted = {}
        for p, i in zip(pieces, least):
            for k in range(len(p) - 49):
                wanted[p[k : k + 50]] = min(wanted.get(p[k : k + 50], 99), i)
        found = suffix_dedup.owners(pieces, np.array([len(p) - 49 for p in pieces]), least)
        assert found.tolist() == [wanted[p[k : k + 50]] for p in pieces for k in range(len(p) - 49)]


def test_nothing(spark):
    empty = awkward(spark).limit(0)
    assert minhash.near_duplicates(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_queries(spark):
    rows = rows_of(given(spark))
    one = {r.doc_id: (r.doc_id, r.n_shingles, r.component_id) for r in queries.op1_minhash(spark, FOLDER).collect()}
    assert one == {i: (i, n, c) for i, n, c in near_by_hand(rows, 2)}
    eight = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op8_suffix_dedup(spark, FOLDER).collect()}
    assert eight == {i: (n, g, s, hashlib.sha256(k).hexdigest()) for i, n, g, s, k in removal_by_hand(rows)}

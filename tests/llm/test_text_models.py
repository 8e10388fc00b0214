import collections
import math
import re
import zlib

import numpy as np
import pytest
from documents_by_hand import FOLDER, awkward, given, rows_of
from pyspark.sql import functions as F

from starloom.llm import decontaminate, language_model, quality, queries, secrets, trie_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def pieces_by_hand(word, pieces):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        ways = [(best[a][0] + pieces.score[word[a:end]], -(best[a][1] + 1)) for a in range(max(0, end - pieces.longest), end) if word[a:end] in pieces.score]
        if word[end - 1] not in pieces.score:
            n = len(word[end - 1].encode())
            ways.append((best[end - 1][0] + n * pieces.byte_score, -(best[end - 1][1] + n)))
        top = max(ways)
        best.append((top[0], -top[1]))
    return best[-1][1]


@pytest.mark.parametrize("table", [awkward, given])
def test_token_counts(spark, table):
    docs = table(spark)
    pieces = trie_counts.Pieces.of(queries.PIECES)
    memo = {}
    wanted = []
    for i, text in rows_of(docs):
        words = WORD.findall(text or "")
        wanted.append((str(i), len(words), sum(memo.setdefault(w, pieces_by_hand("▁" + w, pieces)) for w in words)))
    found = trie_counts.token_counts(docs, queries.PIECES).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in found) == sorted(wanted)


def test_language_model(spark):
    rows = rows_of(given(spark))
    found = {r.doc_id: r for r in queries.op4_language_model(spark, FOLDER).collect()}
    words = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    count = collections.Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in words.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel=1e-9)
    out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in out) > 1.02 * sum(r.base_score for r in out)


def test_language_model_of_awkward_texts(spark):
    found = language_model.score_documents(awkward(spark)).collect()
    assert len(found) == awkward(spark).count()
    assert all(r.n_tokens >= 1 and np.isfinite(r.score) and r.score < 0 for r in found)
    assert {r.held_out for r in found if r.doc_id is None} == {True}
    assert language_model.score_documents(awkward(spark).limit(0)).count() == 0


def test_language_model_only_held_out(spark):
    docs = given(spark).where(F.crc32(F.col("doc_id").cast("string")) % 10 == 0)
    found = language_model.score_documents(docs).collect()
    assert found and all(r.n_known == r.train_tokens == 0 and np.isfinite(r.score) for r in found)


def test_probabilities_sum_to_one():
    counts = np.random.default_rng(1).poisson(0.3, (language_model.CONTEXT, language_model.CONTEXT, 20))
    chances = language_model.log_probabilities(language_model.train(counts, rounds=20))
    assert np.allclose((10**chances).sum(axis=1), 1)


def test_training_finds_what_follows_what():
    counts = np.zeros((language_model.CONTEXT, language_model.CONTEXT, 6), np.int64)
    for near in range(6):
        counts[:6, near, (near + 1) % 6] = 500
        counts[:6, near, near] = 100
    chances = 10 ** language_model.log_probabilities(language_model.train(counts)).reshape(counts.shape)
    for near in range(6):
        assert chances[2, near, (near + 1) % 6] == pytest.approx(5 / 6, abs=0.08)


def spans_by_hand(text):
    found = []
    for k, rule in enumerate(secrets.RULES):
        found += [(m.start(), k, m.end(), rule.kind) for m in re.finditer(rule.expression, text or "") if rule.fits(m)]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


@pytest.mark.parametrize("table", [awkward, given])
def test_secrets(spark, table):
    docs = table(spark)
    found = secrets.scan(docs, columns=["doc_id"]).collect()
    wanted = sorted((str(i), str(spans_by_hand(t))) for i, t in rows_of(docs))
    assert sorted((str(r.doc_id), str([tuple(s) for s in r.spans])) for r in found) == wanted


def test_secrets_keep_other_columns_and_redact(spark):
    clean = secrets.scan(awkward(spark), redacted=True)
    assert clean.columns == [c for c in awkward(spark).columns if c != "spans"] + ["spans"]
    by_text = {r.doc_id: r.text for r in clean.collect()}
    assert by_text[20] == "[secret]'"
    assert by_text[22] == "[secret] [secret] DEADBEEFDEADBEEF"
    assert by_text[0] is None


@pytest.mark.parametrize("expression", [r.expression for r in secrets.RULES] + [r"(abc)+x", r"ab(cd|ef.*gh)i?jkl", r"a{3,5}b", r"x?yz|[ab]cde", r"foo(?:bar|baz)?qux"])
def test_every_match_meets_its_trigram_query(expression):
    import random

    from hypothesis import find, strategies as st  # noqa: F401

    rng = random.Random(expression)
    strings = st.from_regex(re.compile(expression, re.A), fullmatch=True)
    query = secrets.trigram_query(expression)

    def holds(text, q):
        return True if q is True else q[1] in text if q[0] == "has" else (all if q[0] == "and" else any)(holds(text, p) for p in q[1:])

    from hypothesis import given as for_all, settings

    @settings(max_examples=60, deadline=None, derandomize=True)
    @for_all(strings)
    def check(text):
        assert holds(text.lower(), query)

    check()
    assert rng


def shingles_by_hand(text, n=5):
    words = re.findall(r"[^\W_]+", text.lower())
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_benchmark_items(spark):
    folder = "/root/testdata/sf0.01"
    items = {r.item_id: shingles_by_hand(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    wanted = set()
    for i, text in rows_of(spark.read.parquet(f"{folder}/documents.parquet")):
        own = shingles_by_hand(text or "")
        wanted |= {(i, j) for j, s in items.items() if len(s & own) >= 0.8 * len(s)}
    found = {(r.doc_id, r.item_id) for r in queries.op7_decontaminate(spark, folder).collect()}
    assert wanted and found == wanted


def test_benchmark_items_in_awkward_texts(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, "One river stone. THE answer, five more words here."), (2, None), (3, ""), (4, "two words"), (None, "house garden token secret quick night river of the and"), (5, "..")], "item_id bigint, text string")
    extra = spark.createDataFrame([(900, "x " * 400 + "one river\tstone the answer five more words here" + " y" * 300)], "doc_id bigint, text string")
    found = decontaminate.contaminated(docs.select("doc_id", "text").unionByName(extra), items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(900, 1), (7, 4)}
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def test_items_that_stand_apart_in_a_document(spark):
    say = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    items = spark.createDataFrame([(1, say("ask", 20) + "? " + say("told", 10) + "."), (2, say("long", 60))], "item_id bigint, text string")
    two = say("long", 60).split()
    texts = [(1, f"{say('ask', 20)} {say('x', 400)} {say('told', 10)}"), (2, " ".join([*two[:32], say("y", 300), *two[32:]])), (3, f"{say('ask', 20)} {say('x', 400)}")]
    found = decontaminate.contaminated(spark.createDataFrame(texts, "doc_id bigint, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 2)}


def test_scores_do_not_depend_on_the_number_of_indexes(spark, monkeypatch):
    items = [(i, " ".join(f"w{(7 * i + k * k) % 90}" for k in range(12 + i))) for i in range(20)] + [(20, "")]
    items = spark.createDataFrame(items, "item_id bigint, text string").coalesce(1)
    docs = items.select(F.col("item_id").alias("doc_id"), F.concat(F.lit("before "), F.regexp_replace("text", " [^ ]+$", "")).alias("text"))
    found = lambda: sorted(decontaminate.contaminated(docs, items).collect(), key=lambda r: (r.doc_id, r.item_id))
    whole = found()
    monkeypatch.setattr(decontaminate, "INDEX_ITEMS", 12)
    split = found()
    assert [(r.doc_id, r.item_id) for r in split] == [(r.doc_id, r.item_id) for r in whole]
    assert [r.score for r in split] == pytest.approx([r.score for r in whole])


def test_block_max_wand_finds_all_above_the_threshold(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    index = decontaminate.ItemIndex(list(range(len(texts))), texts)
    rng = np.random.default_rng(3)
    for k in range(150):
        terms = rng.choice(len(index.terms), 25, replace=False)
        own = np.unique(index.term_numbers(decontaminate.words_of(__import__("pyarrow").array([texts[k]]))[0]))
        asked = np.unique(np.concatenate([terms, own[rng.random(len(own)) < rng.random()]]))
        score = np.zeros(len(texts))
        for t in asked:
            a, b = index.posting_at[t : t + 2]
            score[index.item[a:b]] += index.impact[a:b]
        wanted = np.flatnonzero(score >= decontaminate.THRESHOLD)
        found = index.block_max_wand(asked)
        assert sorted(i for i, _ in found) == wanted.tolist()
        assert all(s == pytest.approx(score[i]) for i, s in found)


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    learnt = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0)
    found = {r.doc_id: r.kept for r in quality.judged(docs, learnt, ["doc_id"]).collect()}
    assert len(found) == docs.count()
    tested = labels.join(learnt, "doc_id", "left_anti").collect()
    clean = [found[r.doc_id] for r in tested if r.quality == 1 and r.toxic == 0]
    toxic = [found[r.doc_id] for r in tested if r.toxic == 1]
    bad = [found[r.doc_id] for r in tested if r.quality == 0]
    assert np.mean(clean) > 0.99
    assert np.mean(toxic) < 0.15
    assert np.mean(bad) < 0.03


def test_only_copies_are_left_out_of_the_fit(spark):
    import pyarrow as pa

    # Three frequent words with the smallest hashes are in every text; the others differ. The last text is a copy of the one before.
    words = sorted((f"w{k}" for k in range(200)), key=lambda w: quality.vocabulary(pa.array([w]))[0][0])
    texts = [" ".join([*words[:3], *words[a : a + 20]]) for a in (10, 40, 70, 100, 100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, 1, 0), (3, 0, 0), (4, 0, 0)], "doc_id bigint, quality int, toxic int")
    heads = quality.fit(docs, labels)
    assert heads["good"].prior == pytest.approx(3.5 / 5)
    assert heads["toxic"].prior == pytest.approx(0.5 / 5)


def test_quality_of_awkward_texts(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(8, 1, 0), (10, None, 0), (14, 0, None), (14, 0, 1), (None, 1, 1), (999, 1, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = quality.judged(docs, labels, docs.columns)
    assert found.columns == [c for c in docs.columns if c not in ("p_good", "kept")] + ["p_good", "p_toxic", "kept"]
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 < r.p_good < 1 and 0 < r.p_toxic < 1 for r in rows)
    assert quality.judged(docs, labels.limit(0), ["doc_id"]).count() == docs.count()
    assert quality.judged(docs.limit(0), labels, ["doc_id"]).count() == 0


def test_the_fit_equals_one_by_hand(spark):
    """Copies, counts of words, the choice of telling ones and the posterior mode, over plain sets of words."""
    import pyarrow as pa

    label = {r.doc_id: r for r in given(spark, "labels").collect()}
    heads = quality.fit(given(spark), given(spark, "labels"))
    for name, column in (("good", "quality"), ("toxic", "toxic")):
        first = {}
        for i, text in sorted(rows_of(given(spark))):
            if i in label:
                words = frozenset(re.findall(r"(?:[^\x00-\x7F]|[A-Za-z0-9])+", text.lower()))
                first.setdefault((label[i].quality, label[i].toxic, words), (text, words, label[i][column] == 1))
        own = list(first.values())
        positive = np.array([p for _, _, p in own])
        n, yes = len(own), positive.sum()
        both = collections.Counter(w for _, words, _ in own for w in words)
        good = collections.Counter(w for _, words, p in own if p for w in words)
        errors = {}
        for w, c in both.items():
            share = c / n
            errors[w] = abs(good[w] / yes - (c - good[w]) / (n - yes)) / (math.sqrt(share * (1 - share) * (1 / yes + 1 / (n - yes))) + 1e-12) if c >= quality.WORD_DOCUMENTS else 0
        telling = sorted(sorted(errors.values(), reverse=True)[: quality.WORDS])
        head = heads[name]
        digest = {quality.vocabulary(pa.array([w]))[0][0]: w for w in both}
        chosen = [digest[h] for h in head.words]
        assert sorted(errors[w] for w in chosen) == pytest.approx([e for e in telling if e >= quality.WORD_ERRORS])
        assert head.prior == pytest.approx((yes + 0.5) / (n + 1))
        measures = quality.style(pa.array([t for t, _, _ in own]))
        x = np.column_stack([np.ones(n), np.clip((measures - measures.mean(axis=0)) / (measures.std(axis=0) + 1e-9), -8, 8), [[w in words for w in chosen] for _, words, _ in own]])
        ridge = np.full(x.shape[1], quality.RIDGE)
        ridge[0] = 1e-3
        p = 1 / (1 + np.exp(-x @ head.weights))
        # At the mode the gradient of the penalised likelihood is zero.
        assert np.abs(x.T @ (positive - p) - ridge * head.weights).max() < 1e-3 * n


def test_sites_and_posteriors_equal_those_by_hand(spark):
    rng = np.random.default_rng(5)
    rows = [(f"h{h}", f"p{p}", float(o)) for h in range(6) for p in range(3) for o in rng.normal(h - 3 + p / 2, 2, 5 * (h + 1))]
    found = {(r["__host"], r["__path"]): r.site_good for r in quality.site_priors(spark.createDataFrame(rows, "host string, path string, __good double"), {"good": None}, "host", "path").collect()}
    chance = np.array([1 / (1 + math.exp(-o)) for _, _, o in rows])
    whole = chance.mean()

    def strength(n, share, parent):
        beyond = (n * (share - parent) ** 2).sum() / np.mean(parent * (1 - parent)) - len(n)
        return min(1e6, max(1.0, (n.sum() - len(n)) / beyond - 1)) if beyond > 0 else 1e6

    of = lambda key: {k: np.array([c for r, c in zip(rows, chance) if key(r) == k]) for k in sorted({key(r) for r in rows})}
    hosts, paths = of(lambda r: r[0]), of(lambda r: r[:2])
    n, s = (np.array([f(v) for v in hosts.values()]) for f in (len, np.mean))
    host_strength = strength(n, s, np.full(len(n), whole))
    host_share = {h: (v.sum() + host_strength * whole) / (len(v) + host_strength) for h, v in hosts.items()}
    n, s = (np.array([f(v) for v in paths.values()]) for f in (len, np.mean))
    path_strength = strength(n, s, np.array([host_share[h] for h, _ in paths]))
    for (h, p), v in paths.items():
        share = (v.sum() + path_strength * host_share[h]) / (len(v) + path_strength)
        share = max(quality.LEAST_SHARE, min(1 - quality.LEAST_SHARE, share))
        assert found[h, p] == pytest.approx(math.log(share / (1 - share)))
    docs, labels = given(spark), given(spark, "labels")
    heads = quality.fit(docs, labels)
    odds = {r.doc_id: r for r in quality.evidence(docs, heads, ["doc_id", "source", "lang"]).collect()}
    site = {(r["__host"], r["__path"]): r for r in quality.site_priors(quality.evidence(docs, heads, ["source", "lang"]), heads, "source", "lang").collect()}
    for r in quality.judged(docs, labels, ["doc_id", "source", "lang"]).collect():
        for name, got in (("good", r.p_good), ("toxic", r.p_toxic)):
            prior = heads[name].prior
            total = odds[r.doc_id][f"__{name}"] - math.log(prior / (1 - prior)) + site[r.source, r.lang][f"site_{name}"]
            assert got == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
        assert r.kept == (r.p_good >= 0.5 and r.p_toxic < 0.5)


def test_small_sites_are_drawn_to_the_whole(spark):
    heads = {"good": None}
    odds = [("big", "p", 2.0)] * 300 + [("big", "q", -2.0)] * 300 + [("poor", "p", -2.0)] * 400 + [("tiny", "p", -2.0)] + [(None, None, 2.0)]
    scored = spark.createDataFrame(odds, "host string, path string, __good double")
    share = {(r["__host"], r["__path"]): 1 / (1 + math.exp(-r.site_good)) for r in quality.site_priors(scored, heads, "host", "path").collect()}
    whole = np.mean([1 / (1 + math.exp(-o)) for _, _, o in odds])
    assert share["big", "p"] > 0.8 > 0.2 > share["big", "q"]
    assert share["poor", "p"] < share["tiny", "p"] < whole < share[None, None]

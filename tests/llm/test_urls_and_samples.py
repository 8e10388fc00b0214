import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from documents_by_hand import FOLDER, awkward, given

from starloom.llm import centroids, importance, queries, url_filter

# URL filter

URLS = [
    None, "", "no scheme/at.all?x", "http://", "http://a.org", "http://a.org/", "https://A.Example.ORG/es/1?x=1&y=2#z", "http://example.org/en/12/3",
    "http://notexample.org/en/12", "http://xexample.org/es/", "ftp://u.com/fr/9", "http://u.com/de/9", "HTTP://u.com/DE/9", "http://u.net/de/9?a", "http://u.net/?#",
    "x://y://z.com/fr/", "http://com/fr/", "http://u.com?/fr/", "http://u.com#/fr/", "http://ü.com/fr/ß", "http://a\nb.org/c\nd", "http://long.net/" + "a1-" * 20000, "http://u.com/de/9",
]


def parts_by_hand(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (found[1].translate({c: c + 32 for c in range(65, 91)}), found[2]) if found else ("", "")


def rule_by_hand(host, path):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1])) if fits else None


def measures_by_hand(url):
    url = url or ""
    host, path = parts_by_hand(url)
    n, count = len(url), Counter(url)
    query = re.match(r"(?s)[^?#]*\?([^#]*)", url)
    return {
        "length": n, "host_length": len(host), "depth": path.count("/"), "digit_ratio": sum(c in "0123456789" for c in url) / max(n, 1),
        "entropy": -sum(k / n * math.log2(k / n) for k in count.values()), "n_params": query[1].count("&") + 1 if query and query[1] else 0,
        "n_labels": host.count(".") + 1 if host else 0, "n_hyphens": host.count("-"),
    }


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, host string, verdict string")


def test_hosts_paths_rules_and_measures(spark):
    given_urls = [*URLS, *(r.url for r in given(spark, "pages").select("url").collect())]
    seen = pages(spark, given_urls).repartition(3)
    model = url_filter.fit(spark.createDataFrame([], "url string, blocked boolean"))
    assert model.trees == []
    found = {r.page_id: r for r in url_filter.judged(seen, url_filter.RULES, model, ["page_id", "host"]).collect()}
    assert len(found) == len(given_urls)
    for i, url in enumerate(given_urls):
        host, path = parts_by_hand(url)
        rule = rule_by_hand(host, path)
        assert (found[i].host, found[i].path) == (host, path)
        assert found[i].rule == (rule and rule[0] + rule[1])
        assert found[i].verdict == (rule[2] if rule else "allow")
    for r in url_filter.measured(seen.select("page_id", "url"), "url").collect():
        wanted = measures_by_hand(r.url)
        assert {k: r[f"__{k}"] for k in wanted} == pytest.approx(wanted, abs=1e-9), r.url


def labelled(rng, n):
    """Bad URLs have many digits and parameters, and some sites are bad whatever the URL says."""
    rows = []
    for _ in range(n):
        site, bad = rng.choice(["good.net", "fine.com", "casino.biz", "mixed.org"]), rng.random() < 0.5
        bad = bad or site == "casino.biz"
        tail = "".join(rng.choice("0123456789" if bad and rng.random() < 0.6 else "abcdefghij") for _ in range(12))
        rows.append((f"http://{rng.choice(['www', 'm', 'x'])}.{site}/{tail}" + ("?a=1&b=2" if bad and rng.random() < 0.7 else ""), bad))
    return rows


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(3)
    train, test = labelled(rng, 1500), labelled(rng, 1000)
    known = spark.createDataFrame([*train, (None, True), ("http://x.y/", None)], "url string, blocked boolean").repartition(5)
    model = url_filter.fit(known)
    rows = url_filter.judged(pages(spark, [u for u, _ in test]), [], model, ["page_id"]).collect()
    right = sum((r.verdict == "block") == test[r.page_id][1] for r in rows)
    assert right / len(test) > 0.9
    again = url_filter.fit(known.repartition(3))
    assert again.trees == model.trees and again.edges == model.edges


def trees_by_hand(bins, y, prior, rounds, depth):
    """The same boosting over whole arrays: every node's best split among all features and bins."""
    features, raw, out = url_filter.FEATURES, np.full(len(y), prior), []
    score = lambda g, h: (g / 1e6) ** 2 / (h / 1e6 + url_filter.RIDGE)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = np.round((y - p) * 1e6), np.round(p * (1 - p) * 1e6)
        node, splits = np.ones(len(y), int), {}
        for level in range(depth):
            for n in range(1 << level, 2 << level):
                own = node == n
                best, chosen = 1e-9, None
                for f in features if own.any() else []:
                    for b in range(1, url_filter.BINS):
                        left = own & (bins[f] < b)
                        right = own & ~left
                        gain = score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum()) - score(g[own].sum(), h[own].sum())
                        if h[left].sum() and h[right].sum() and gain > best:
                            best, chosen = gain, (f, b)
                if chosen:
                    splits[n] = chosen
                    node[own] = np.where(bins[chosen[0]][own] < chosen[1], 2 * n, 2 * n + 1)
        if not splits:
            break
        leaf = {int(n): url_filter.RATE * (g[node == n].sum() / 1e6) / (h[node == n].sum() / 1e6 + url_filter.RIDGE) for n in np.unique(node)}
        raw = raw + np.array([leaf[int(n)] for n in node])
        out.append((splits, leaf))
    return out


def test_trees_equal_those_grown_by_hand(spark):
    rows = labelled(random.Random(8), 300)
    model = url_filter.fit(spark.createDataFrame(rows, "url string, blocked boolean"), rounds=3)
    known = spark.createDataFrame(rows, "url string, blocked boolean")
    from pyspark.sql import functions as F

    grown = known.where(F.pmod(F.xxhash64("url"), F.lit(2)) == 1)
    table = url_filter._with_rates(url_filter.measured(grown, "url"), model).toPandas()
    values = {f: table[f"__{f}"].to_numpy(float) for f in url_filter.FEATURES}
    for f in url_filter.LEXICAL:
        assert values[f] == pytest.approx([measures_by_hand(u)[f] for u in table["url"]], abs=1e-9)
    rated = [(u, b) for u, b in rows if u not in set(table["url"])]
    share = (sum(b for _, b in rated) + 0.5) / (len(rated) + 1)
    for i, u in enumerate(table["url"]):
        rate = share
        for n in (1, 2, 3):
            same = [b for v, b in rated if parts_by_hand(v)[0].split(".")[-n:] == parts_by_hand(u)[0].split(".")[-n:]]
            rate = (sum(same) + url_filter.STRENGTH * rate) / (len(same) + url_filter.STRENGTH)
            assert values[f"rate_{n}"][i] == pytest.approx(rate, abs=1e-9)
    edges = {f: sorted(set(np.percentile(v, [100 * i / url_filter.BINS for i in range(1, url_filter.BINS)]))) for f, v in values.items()}
    for f in edges:
        assert model.edges[f] == pytest.approx(edges[f], abs=1e-9)
    bins = {f: sum((values[f] > e).astype(int) for e in model.edges[f]) + np.zeros(len(table), int) for f in values}
    wanted = trees_by_hand(bins, table["blocked"].to_numpy(float), model.prior, 3, url_filter.DEPTH)
    assert [s for s, _ in model.trees] == [s for s, _ in wanted]
    for (_, got), (_, leaf) in zip(model.trees, wanted):
        assert {n: got[n] for n in leaf} == pytest.approx(leaf, abs=1e-9)


def test_longest_rule_and_ties(spark):
    rules = [url_filter.Rule("allow", "b", "/xyz"), url_filter.Rule("block", "a.b", "/x"), url_filter.Rule("allow", "a.b", "/x"), url_filter.Rule("allow", "a.b", "/")]
    model = url_filter.fit(spark.createDataFrame([("http://q/", True)], "url string, blocked boolean"))
    urls = ["http://a.b/xyz", "http://a.b/y", "http://c.b/xyz", "http://c.b/"]
    rows = sorted(url_filter.judged(pages(spark, urls), rules, model, ["page_id"]).collect())
    assert [(r.rule, r.verdict) for r in rows] == [("a.b/x", "block"), ("a.b/", "allow"), ("b/xyz", "allow"), (None, "block")]
    assert url_filter.judged(pages(spark, urls).limit(0), rules, model, ["page_id"]).collect() == []


def test_url_query_runs_no_python(spark):
    found = queries.op11_url_filter(spark, FOLDER)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert found.count() == given(spark, "pages").count()


# Importance resampling


def sampled_by_hand(docs, target, longest=1, buckets=10000, percent=10, least_words=20, seed=2024):
    lower = {c: c + 32 for c in range(65, 91)}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    runs = lambda w: [crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    own = [runs(words(t)) for _, t in docs]
    s, t = Counter(b for r in own for b in r), Counter(b for x in target for b in runs(words(x)))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for (i, text), r in zip(docs, own):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, r))
        out.append([i, len(r), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    enough = sorted((r for r in out if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(enough[: percent * len(enough) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize(("table", "longest", "percent"), [(awkward, 1, 10), (awkward, 3, 60), (given, 1, 10), (given, 2, 100)])
def test_importance_resampling(spark, table, longest, percent):
    docs, target = table(spark), given(spark, "benchmark")
    found = importance.resampled(docs, target, longest, percent=percent)
    wanted = sampled_by_hand([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], longest, percent=percent)
    assert Counter(map(tuple, found.collect())) == wanted
    assert [t for _, t in found.dtypes] == ["bigint"] * 5


def test_resampling_of_hot_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(i if i % 3 else 7, f"river stone {i if i % 3 else 7} " * 10) for i in range(3000)], "doc_id bigint, text string").repartition(5)
    none = docs.limit(0)
    found = importance.resampled(docs, none)
    assert Counter(map(tuple, found.collect())) == sampled_by_hand([(r.doc_id, r.text) for r in docs.collect()], [])
    assert importance.resampled(none, docs).collect() == []


# Centroid clustering


def clustered_by_hand(rows, k=40, rounds=5, dims=64, seed=2):
    kept = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in first[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for last in range(rounds + 1):
        home = [min((far(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        for j in range(len(centres)) if last < rounds else []:
            own = [v for (_, v), (_, c) in zip(kept, home) if c == j]
            centres[j] = [sum(x) // len(own) for x in zip(*own)] if own else centres[j]
    inertia = Counter()
    for d, j in home if kept else []:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    top = lambda x: min(x, (1 << 63) - 1)
    return Counter((i, j, top(d), top(inertia[j]), top(inertia.total()), digest[j]) for (i, _), (d, j) in zip(kept, home if kept else []))


VECTOR = "vec_id bigint, embedding array<double>, cluster string, id int, distance string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], VECTOR).repartition(3)


def awkward_vectors(dims):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i % 3, 0.2) for _ in range(dims)]) for i in range(200)]
    rows += [(None, rows[0][1]), (5, rows[5][1]), (5, rows[9][1]), (900, None), (901, []), (902, [1.0] * (dims + 1)), (903, [None] + [1.0] * (dims - 1))]
    rows += [(904, [float("nan")] * dims), (905, [float("inf")] * dims)] + [(1000 + i, [0.5] * dims) for i in range(150)]
    return rows


@pytest.mark.parametrize(("k", "dims"), [(1, 2), (8, 3), (40, 64), (1000, 5)])
def test_clusters(spark, k, dims):
    rows = awkward_vectors(dims)
    found = centroids.clustered(vectors(spark, rows), k=k, dims=dims, rounds=3)
    assert Counter(map(tuple, found.collect())) == clustered_by_hand(rows, k, 3, dims)
    assert dict(found.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}


def test_clusters_of_the_given_table_equal_those_by_hand(spark):
    rows = [(r.vec_id, r.embedding) for r in given(spark, "embeddings").select("vec_id", "embedding").collect()]
    assert Counter(map(tuple, queries.op13_centroids(spark, FOLDER).collect())) == clustered_by_hand(rows)


def test_clusters_of_huge_components_and_none(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10.0**14 for _ in range(4)]) for i in range(60)]
    found = centroids.clustered(vectors(spark, rows), k=5, dims=4, rounds=2)
    assert Counter(map(tuple, found.collect())) == clustered_by_hand(rows, 5, 2, 4)
    beyond = centroids.clustered(vectors(spark, [(1, [1e300, -1e308]), (2, [0.0, 0.0])]), k=2, dims=2)
    assert sorted(r.distance for r in beyond.collect()) == [0, 0]
    assert centroids.clustered(vectors(spark, rows).limit(0)).collect() == []
    assert centroids.clustered(vectors(spark, rows), dims=9).collect() == []


def test_orchard_measures_each_centroid_once_and_stops(spark):
    rng = np.random.default_rng(2)
    around = rng.integers(-2000, 2000, (30, 2))
    points = np.repeat(around, 20, axis=0) + rng.integers(-5, 5, (600, 2))
    orchard = centroids.Orchard(around.tolist())
    nearest, distance = orchard.nearest(points)
    every = ((points[:, None, :] - around[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (nearest == every.argmin(axis=1)).all()

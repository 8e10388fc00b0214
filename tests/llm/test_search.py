import math
import random
from collections import Counter

import pytest
from documents_by_hand import FOLDER, given
from pyspark.sql import functions as F

from starloom.llm import kd_search, queries


def best_by_hand(rows, k=5, scale=256):
    """(id, vector, asks): every query against every other row."""
    kept = [(i, [math.floor(scale * x) for x in v], a) for i, v, a in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for n, (i, q, asks) in enumerate(kept):
        if asks:
            near = [(-max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(q, v)))), j is None, j or 0) for m, (j, v, _) in enumerate(kept) if m != n and len(v) == len(q)]
            for rank, (score, missing, j) in enumerate(sorted(near)[:k], 1):
                out[i, rank, None if missing else j, -score] += 1
    return out


def vectors(spark, rows):
    schema = "vec_id bigint, embedding array<double>, asks boolean, query_id string, rank string, shard int, v string, copies int"
    return spark.createDataFrame([(i, v, a, "x", "y", 1, "z", 2) for i, v, a in rows], schema).repartition(3)


def made(seed, n, dim, asks):
    rng = random.Random(seed)
    return [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0, rng.random()]) for _ in range(dim)], asks(i)) for i in range(n)]


ODD = [
    (None, [1.0, 1.0], False), (None, [1.0, 1.0], None), (50, [1.0, 1.0], True), (50, [1.0, 1.0], True), (51, [1.0, 1.0], False), (51, [1.0, 1.0], False),
    (60, [], True), (61, [], False), (62, [1.0], True), (63, [2.0, 3.0, 4.0], True), (64, None, True), (65, [None, 1.0], True), (66, [float("nan"), 1.0], True), (67, [float("inf"), 0.0], True),
]


@pytest.mark.parametrize(("shard_rows", "query_rows"), [(8192, 512), (7, 3), (1, 1)])
@pytest.mark.parametrize("rows", [ODD, made(1, 60, 2, lambda i: i % 3 == 0) + ODD, made(2, 40, 4, lambda i: False), made(3, 30, 3, lambda i: True), [(1, [1.0], True)], []])
def test_search(spark, rows, shard_rows, query_rows):
    found = kd_search.exact_top_k(vectors(spark, rows), F.col("asks"), shard_rows=shard_rows, query_rows=query_rows)
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == best_by_hand(rows)


def test_a_hot_vector_and_huge_components(spark):
    rows = made(5, 50, 3, lambda i: i % 10 == 0) + [(100 + i, [1.0, 1.0, 1.0], i == 7) for i in range(60)] + [(7, [0.5, 1.0, 0.0], False)] * 40
    found = kd_search.exact_top_k(vectors(spark, rows), F.col("asks"), shard_rows=9, query_rows=4)
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == best_by_hand(rows)
    huge = [(i, [x * 1e12, -x * 3e11, 1.0], i % 2 == 0) for i, x in enumerate([1.0, -2.0, 3.5, 0.0, 1e-9])]
    found = kd_search.exact_top_k(vectors(spark, huge), F.col("asks"), shard_rows=2)
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == best_by_hand(huge)


def test_search_of_the_given_table(spark):
    rows = [(r.vec_id, r.embedding, r.vec_id % 50 == 0) for r in given(spark, "embeddings").collect()]
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in queries.op9_kd_search(spark, FOLDER).collect()) == best_by_hand(rows)

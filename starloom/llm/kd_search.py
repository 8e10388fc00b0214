"""Exact search for the largest inner products, by KD-trees over shards of the vectors.

Vectors are dealt into shards by a digest. A task takes one shard's vectors, which are few, and builds their tree: median splits of
the widest axis, and for every node the tight box around its vectors. The queries sent to that shard then stream by the tree, some at a time. For a
query q the box bounds every score inside: sum over axes of max(q*lo, q*hi). The nodes are opened best first, until the best bound is
below the k-th score found. A first round searches a query's own shard; its k-th score is where the others start from. A vector is shuffled once
in each round, whatever the number of queries; only queries are copied.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import own_rows
from .stored import stored, tasks_for

#: Vectors in a leaf, in a shard, and queries that pass a tree together, about.
LEAF, SHARD_ROWS, QUERY_ROWS = 128, 8192, 512
_EXACT_DOUBLE = 1 << 53
_LONG = (1 << 63) - 1


class KdTree:
    """Nodes in an array: left child 2i + 1, right child 2i + 2; a leaf is a run of ``order``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.points = points
        depth = max(0, math.ceil(math.log2(max(1, len(points) / leaf))))
        self.first_leaf = (1 << depth) - 1
        nodes = (1 << (depth + 1)) - 1
        self.start, self.stop = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        self.low = np.zeros((nodes, points.shape[1]), points.dtype)
        self.high = np.zeros_like(self.low)
        self.stop[0] = len(points)
        for i in range(nodes):
            a, b = self.start[i], self.stop[i]
            if a == b:
                continue
            own = points[self.order[a:b]]
            self.low[i], self.high[i] = own.min(axis=0), own.max(axis=0)
            if i < self.first_leaf:
                middle = (b - a) // 2
                if own.shape[1]:
                    axis = int(np.argmax(self.high[i].astype(float) - self.low[i]))
                    self.order[a:b] = self.order[a:b][np.argpartition(own[:, axis], middle)]
                self.start[2 * i + 1], self.stop[2 * i + 1] = a, a + middle
                self.start[2 * i + 2], self.stop[2 * i + 2] = a + middle, b
        self.ordered = points[self.order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For every query (row) and node (column): no score in the node's box is higher."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.high.T + down @ self.low.T

    def best_first(self, bounds: np.ndarray) -> Iterator[tuple[object, int, int]]:
        """Leaves (bound, start, stop), highest bound first, by opening the best node each time."""
        heap = [(-bounds[0], 0)]
        while heap:
            bound, i = heapq.heappop(heap)
            if i >= self.first_leaf:
                yield -bound, int(self.start[i]), int(self.stop[i])
                continue
            for child in (2 * i + 1, 2 * i + 2):
                if self.stop[child] > self.start[child]:
                    heapq.heappush(heap, (-bounds[child], child))


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The integer arrays in a type in which their inner products are exact."""
    top = [max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0)))) for a in arrays]
    worst = math.prod(top) * max(1, arrays[0].shape[1])
    kind = np.float64 if worst < _EXACT_DOUBLE else np.int64 if worst < _LONG else object
    return [a.astype(kind) for a in arrays]


def _stopped(scores: np.ndarray) -> np.ndarray:
    """Exact scores of any size, stopped at the ends of a long."""
    return np.maximum(np.minimum(scores, _LONG), -_LONG - 1) if scores.dtype == object else scores


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


def search_shard(vectors: pa.RecordBatch, queries: pa.RecordBatch, dim: int, k: int, trees: dict[str, KdTree]) -> pa.RecordBatch:
    """The k best of the shard's vectors for each query, each with its number of copies, the query's own row left out once.

    ``trees`` keeps the shard's tree; there is more than one only if some queries have components too large for its kind of numbers.
    """
    points, asked = _exact(_matrix(vectors["v"], dim), _matrix(queries["v"], dim))
    if points.dtype.str not in trees:
        trees[points.dtype.str] = KdTree(points)
    return _searched(trees[points.dtype.str], vectors, queries, asked, k)


def _searched(tree: KdTree, vectors: pa.RecordBatch, queries: pa.RecordBatch, asked: np.ndarray, k: int) -> pa.RecordBatch:
    ids = vectors["id"]
    missing = np.asarray(ids.is_null(), bool)[tree.order]
    id_at = np.asarray(ids.fill_null(0), np.int64)[tree.order]
    copies = np.asarray(vectors["copies"], np.int64)[tree.order]
    floor = queries["kth"].to_pylist()
    out: dict[str, list] = {"query": [], "id": [], "score": [], "copies": []}
    bounds = _stopped(tree.bounds(asked))
    for row, query_id in enumerate(queries["id"].to_pylist()):
        q, found, kth = asked[row], [], -_LONG - 1 if floor[row] is None else floor[row]
        for bound, a, b in tree.best_first(bounds[row]):
            if bound < kth:
                break
            scores = _stopped(tree.ordered[a:b] @ q)
            at = np.flatnonzero(scores >= kth)
            if len(at) > k + 1:
                cut = np.partition(scores[at], len(at) - k - 1)[len(at) - k - 1]
                at = at[scores[at] >= cut]
            for i in at.tolist():
                j, n = a + i, int(copies[a + i])
                if not missing[j] and id_at[j] == query_id and np.array_equal(tree.ordered[j], q):
                    n -= 1
                if n:
                    found.append((-int(scores[i]), bool(missing[j]), int(id_at[j]), n))
            found.sort()
            total = 0
            for place, one in enumerate(found):
                total += one[3]
                if total >= k:
                    del found[place + 1 :]
                    kth = max(kth, -one[0])
                    break
        for score, no_id, vec_id, n in found:
            out["query"].append(row)
            out["id"].append(None if no_id else vec_id)
            out["score"].append(-score)
            out["copies"].append(min(n, k))
    rows = pa.array(out["query"], pa.int64())
    found = [pa.array(out[c], pa.int64()) for c in ("id", "score", "copies")]
    asking = [queries[c].take(rows) for c in ("id", "v", "copies")]
    return pa.RecordBatch.from_arrays([*asking, *found], ["query_id", "query", "query_copies", "vec_id", "score", "copies"])


_FOUND = "query_id bigint, query array<bigint>, query_copies bigint, vec_id bigint, score bigint, copies bigint"
_COLUMNS = ["dim", "shard", "passes", "id", "v", "copies", "kth"]


def _shards(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[int, pa.RecordBatch | None, pa.RecordBatch | None]]:
    """Of rows sorted by dim, shard and passes: a shard's dim and all its vectors, then dim and its queries, some at a time. Queries of a shard
    without vectors, and vectors without queries, are left out."""
    key, points, open_ = None, [], False
    for batch in batches:
        names = [np.asarray(batch[c], np.int64) for c in ("dim", "shard", "passes")]
        cuts = np.flatnonzero(np.any([n[1:] != n[:-1] for n in names], axis=0)) + 1 if batch.num_rows > 1 else []
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            dim, shard, passes = (int(n[a]) for n in names)
            if (dim, shard) != key:
                key, points, open_ = (dim, shard), [], False
            if not passes:
                points.append(own_rows(batch, a, b))
                continue
            if points:
                yield dim, pa.concat_batches(points), None
                points, open_ = [], True
            for start in range(a, b, rows) if open_ else ():
                yield dim, None, own_rows(batch, start, min(b, start + rows))


def _search(asked: DataFrame, points: DataFrame, k: int, rows: int) -> DataFrame:
    """Every query against the vectors of the shard that it is sent to."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, at, trees = None, None, {}
        for dim, shard, queries in _shards(batches, rows):
            if shard is not None:
                vectors, at, trees = shard, dim, {}
            else:
                yield search_shard(vectors, queries, at, k, trees)

    both = points.withColumns({"passes": F.lit(0), "kth": F.lit(None).cast("bigint")}).select(_COLUMNS)
    both = both.unionByName(asked.withColumn("passes", F.lit(1)).select(_COLUMNS))
    return both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "passes").mapInArrow(task, _FOUND)


def exact_top_k(
    rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """For each query row the k other rows with the largest integer inner product: query_id, rank (from 1), vec_id, score.

    A vector counts as floor(scale * x). Vectors that are null, or hold a null or a value that is not finite, take no part; a vector
    meets only vectors of its own length (those of length 0 score 0). Equal scores: smaller id first, null ids last. Repeated rows are
    rows of their own, as queries and as results; a query leaves out only its own row. A null id is no query. Scores
    beyond a long stop at its ends, and are equal there. Other columns are left out. An empty table gives no rows.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = rows.where(F.col(vector).isNotNull() & finite).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    # Rows that are alike in all that counts are one row with a number of copies: a hot vector stays one row.
    each = taken.groupBy("id", "v", "asks").agg(F.count(F.lit(1)).alias("copies")).withColumn("digest", F.xxhash64("id", "v"))
    each = stored(each, "vectors")
    shards = tasks_for(each.count(), shard_rows)
    points = each.withColumns({"dim": F.size("v"), "shard": F.pmod("digest", F.lit(shards)).cast("int")})
    queries = points.where("asks")
    own = _search(queries.withColumn("kth", F.lit(None).cast("bigint")), points, k, query_rows)
    own = stored(own, "own-shard")
    by_query = Window.partitionBy("query_id", "query")
    best = by_query.orderBy(F.desc("score"), F.asc_nulls_last("vec_id")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("copies").over(best), F.lit(0))
    first = own.withColumn("before", before).where(F.col("before") < k).where(F.col("before") + F.col("copies") >= k)
    kth = first.select(F.col("query_id").alias("of"), F.col("query").alias("of_v"), F.col("score").alias("kth"))
    others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home")))
    onward = queries.drop("asks", "digest").join(kth, (queries["id"] == kth["of"]) & (queries["v"] == kth["of_v"]), "left").withColumnRenamed("shard", "home").withColumn("shard", others)
    found = own.unionByName(_search(onward, points, k, query_rows)) if shards > 1 else own
    ranked = found.withColumn("before", before).where(F.col("before") < k)
    ranks = F.sequence(F.col("before") + 1, F.least(F.col("before") + F.col("copies"), F.lit(k))).cast("array<int>")
    listed = ranked.select("query_id", F.explode(ranks).alias("rank"), "vec_id", "score", "query_copies")
    return listed.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("query_copies")))).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
    SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.place <> c.place AND len(q.e) = len(c.e)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

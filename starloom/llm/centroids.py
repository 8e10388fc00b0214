"""Centroid clustering with Orchard's search for the nearest centroid.

Each round is one pass over the vectors. A task holds the centroids and, for each, the list of all others by rising distance. A vector starts at
some centroid c at distance d and goes through c's list: a centroid x that is nearer to c than 2d may be nearer to the vector, so it is measured
once; if it is better, the search goes on in x's list from its start. It ends where the list's distance is strictly beyond 2d, as no
centroid from there on can be as near (triangle inequality). All vectors of a batch take these steps together.

A task sends one sum for each centroid and component, whatever the size of a cluster; the driver holds the centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stored import stored

_LONG = (1 << 63) - 1
#: Vectors that search together.
TOGETHER = 8192


def _integers(values: np.ndarray) -> np.ndarray:
    """Whole doubles as integers that stop at the ends of a long; 64-bit ones if they are small, else exact Python ones."""
    if values.size == 0 or np.abs(values).max() < 1 << 52:
        return values.astype(np.int64)
    clipped = [max(-_LONG - 1, min(_LONG, int(v))) if np.isfinite(v) else _LONG if v > 0 else -_LONG - 1 for v in values.reshape(-1).tolist()]
    return np.array(clipped, object).reshape(values.shape)


def kept_vectors(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have ``dims`` components, none null or not finite, and those as integers floor(scale * x)."""
    column = column.cast(pa.large_list(column.type.value_type))
    at = np.asarray(column.offsets, np.int64)
    right = np.flatnonzero(~np.asarray(column.is_null(), bool) & (np.diff(at) == dims))
    where = (at[right][:, None] + np.arange(dims)).reshape(-1)
    # A null becomes a value that is not finite.
    flat = np.asarray(column.values.cast(pa.float64()).fill_null(np.nan), np.float64)[where].reshape(len(right), dims)
    good = np.isfinite(flat).all(axis=1)
    with np.errstate(over="ignore"):
        return right[good], _integers(np.floor(scale * flat[good]))


class Orchard:
    """The centroids, their squared distances and each one's list of all others, nearest first."""

    def __init__(self, centroids: list[list[int]]):
        self.top = max((abs(v) for c in centroids for v in c), default=0)
        self.exact = np.array(centroids, object).reshape(len(centroids), -1)
        gap = self.exact[:, None, :] - self.exact[None, :, :]
        self.apart = (gap * gap).sum(axis=2)
        self.order = np.array([sorted((j for j in range(len(centroids)) if j != i), key=lambda j: (self.apart[i, j], j)) for i in range(len(centroids))], np.int64).reshape(len(centroids), -1)
        self.along = np.take_along_axis(self.apart, self.order, axis=1) if len(centroids) > 1 else self.order

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each point (row) the nearest centroid, of equally near ones the first, and the squared distance."""
        most = max(self.top, int(np.abs(points).max(initial=0)) if points.dtype != object else max((abs(v) for v in points.reshape(-1)), default=0))
        kind = np.int64 if 16 * max(1, points.shape[1]) * most * most <= _LONG else object
        points, centroids, along = points.astype(kind), self.exact.astype(kind), self.along.astype(kind)
        n, last = len(points), self.order.shape[1]

        def measure(rows: np.ndarray, of: np.ndarray) -> np.ndarray:
            gap = points[rows] - centroids[of]
            return (gap * gap).sum(axis=1)

        best, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
        distance = measure(np.arange(n), best)
        visited = np.zeros((n, len(centroids)), bool)
        visited[:, 0] = True
        live = np.arange(n) if last else np.arange(0)
        while len(live):
            # Squared: strictly beyond twice the distance.
            live = live[(along[best[live], at[live]] <= 4 * distance[live]).astype(bool)]
            other = self.order[best[live], at[live]]
            at[live] += 1
            new = ~visited[live, other]
            rows, of = live[new], other[new]
            visited[rows, of] = True
            found = measure(rows, of)
            better = ((found < distance[rows]) | ((found == distance[rows]) & (of < best[rows]))).astype(bool)
            rows = rows[better]
            best[rows], distance[rows], at[rows] = of[better], found[better], 0
            live = live[at[live] < last]
        return best, distance


def _searched(batches: Iterable[pa.RecordBatch], orchard: Orchard, dims: int, scale: int) -> Iterator[tuple]:
    """For some rows at a time: the batch, the rows kept in it, their vectors, nearest centroids and squared distances."""
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER):
            piece = batch.slice(start, TOGETHER)
            piece = piece.take(pa.array(np.arange(piece.num_rows)))
            rows, points = kept_vectors(piece.column("vector"), dims, scale)
            if len(rows):
                yield piece, rows, points, *orchard.nearest(points)


def _moved(vectors: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """Centroids after one round; one without vectors stays."""
    orchard = Orchard(centroids)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), dims), object)
        count = np.zeros(len(centroids), np.int64)
        for _, _, points, nearest, _ in _searched(batches, orchard, dims, scale):
            for c in np.unique(nearest).tolist():
                own = points[nearest == c]
                # 2^13 values below 2^50 stay inside a long.
                small = own.dtype != object and np.abs(own).max(initial=0) < 1 << 49
                total[c] += np.array((own if small else own.astype(object)).sum(axis=0).tolist(), object)
                count[c] += len(own)
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(full, dims).astype(np.int32)),
                pa.array(np.tile(np.arange(dims), len(full)).astype(np.int32)),
                pa.array([Decimal(int(v)) for c in full for v in total[c]], pa.decimal128(38, 0)),
                pa.array(np.repeat(count[full], dims)),
            ],
            ["cluster", "dim", "total", "n"],
        )

    sums = vectors.select("vector").mapInArrow(task, "cluster int, dim int, total decimal(38,0), n bigint")
    out = [list(c) for c in centroids]
    # One row for each centroid and component.
    for row in sums.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[row.cluster][row.dim] = int(row.total) // row.n
    return out


def _is_kept(dims: int) -> Column:
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size("vector") == dims) & finite


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: int, seed: int) -> list[list[int]]:
    """The ``k`` kept vectors with the smallest digests of their ids, in that order; of equal ids the smaller vectors first."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = vectors.where(_is_kept(dims)).select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(k).collect()
    if not first:
        return []
    _, points = kept_vectors(pa.array([r.vector for r in first], pa.list_(pa.float64())), dims, scale)
    return [[int(v) for v in p] for p in points]


def clustered(rows: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each kept vector: its id, cluster, squared distance, cluster_inertia and inertia (distances summed over the cluster and over all), and
    centroid_sha256 of its final centroid (components as decimal integers, joined by commas).

    Kept are vectors of ``dims`` components, none null or not finite; a component counts as floor(scale * x) and stops at the ends of a long, as
    do distances and their sums. With fewer than ``k`` vectors each is a centroid. Centroids that are equal (repeated rows) leave all vectors to the first;
    one without vectors stays where it is. A null id counts as an empty text when centroids are chosen. Every kept row gives one row, whatever
    repeats. An empty table gives no rows. Other columns are left out, so their names cannot clash.
    """
    vectors = rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    centroids = first_centroids(vectors, k, dims, scale, seed)
    for _ in range(rounds if centroids else 0):
        moved = _moved(vectors, centroids, dims, scale)
        if moved == centroids:
            break
        centroids = moved
    orchard = Orchard(centroids or [[0] * dims])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, at, _, nearest, distance in _searched(batches, orchard, dims, scale):
            far = pa.array([min(int(d), _LONG) for d in distance.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column("id").take(pa.array(at)), pa.array(nearest.astype(np.int32)), far], ["id", "cluster", "distance"])

    found = stored(vectors.mapInArrow(task, "id bigint, cluster int, distance bigint"), "clusters")
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    every = min(sum(sums.values()), _LONG)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    known = [(c, min(total, _LONG), every, digests[c]) for c, total in sums.items()]
    # One row for each centroid.
    about = found.sparkSession.createDataFrame(known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = found.join(F.broadcast(about), "cluster")
    return out.select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> str:
    """The same in plain SQL, with every vector measured against every centroid."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
    SELECT place, cluster, distance FROM (
        SELECT place, cluster, sum((x - y) * (x - y)) AS distance,
            row_number() OVER (PARTITION BY place ORDER BY sum((x - y) * (x - y)), cluster) AS nth
        FROM p JOIN c{i} USING (d) GROUP BY place, cluster
    ) WHERE nth = 1
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
    SELECT cluster, d, coalesce((s - ((s % n) + n) % n) // n, y) AS y
    FROM c{i} LEFT JOIN (SELECT cluster, d, sum(x) AS s, count(*) AS n FROM p JOIN a{i} USING (place) GROUP BY cluster, d) USING (cluster, d)
)""")
    return f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS HUGEINT)) AS e
    FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
    SELECT place, unnest(e) AS x, unnest(range({dims})) AS d FROM v
), c0 AS MATERIALIZED (
    SELECT cluster, unnest(e) AS y, unnest(range({dims})) AS d
    FROM (SELECT e, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), e) - 1 AS cluster FROM v) WHERE cluster < {k}
), {", ".join(steps)}, f AS (
    SELECT cluster, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
    CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (place) JOIN f USING (cluster)
"""

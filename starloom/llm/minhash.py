"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

1. Documents with the same set of shingles form a class; all that follows is about classes, so copies cost nothing more.
2. Each class has BANDS * ROWS minimum hashes; ROWS of them make a band's bucket. A link of similarity s misses every bucket with
   probability (1 - s^ROWS)^BANDS: 6e-7 at 0.8, less above.
3. In each bucket the class that meets most others is the hub, and all others are compared with it. In a group of copies of one original,
   however large, the original is the hub, and n - 1 comparisons join the group.
4. Buckets that still hold different components are compared in tiles of bounded size, only across components and only in the first
   bucket that a pair shares. Pairs stay inside their tile: it first tells which members have any partner that survives verification, then gets
   their texts, confirms the pairs, and gives only links that join components, fewer than its members. So the rows follow the
   members, however many pairs of a large group lie near the threshold, and no two components with a link between them stay apart.
5. Every comparison goes through batches of hashes: after each, a pair is dropped if the posterior probability that its similarity reaches
   the threshold is below MISS. What survives is confirmed on the full sets of shingles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ASCII_LOWER, ASCII_SPACE, as_bytes, bounds, by_size, distinct, mix, per_run, runs_at, shingles, sums, word_hashes
from .components import components
from .stored import stored, tasks_for

BANDS, ROWS = 36, 5
#: Hashes compared, in batches, by their lowest byte; the chance that a wrongly dropped pair reaches the threshold, for each batch.
COMPARED, BATCH, MISS = BANDS * ROWS, 36, 1e-6
#: Members of a tile on each side, and their shingles, about.
TILE, TILE_SHINGLES = 1024, 4 << 20
#: Pairs of a task, about: when bytes are compared, and when whole texts are.
PAIRS, TEXTS = 20_000, 500
PIECE_BYTES = 4 << 20

_rng = np.random.default_rng(20240229)
_FACTOR = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_OFFSET = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles as ascending 64-bit hashes, with bounds. A-Z count as a-z; words end at ASCII white space."""
    return distinct(*shingles(*word_hashes(*as_bytes(texts), ASCII_SPACE, ASCII_LOWER), width))


def minimum_hashes(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of minimum hashes for each set (all ones for an empty one)."""
    x = (sets >> np.uint64(16)).astype(np.uint32)
    out = np.empty((len(at) - 1, BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        out[:, k] = per_run(np.minimum, x * _FACTOR[k] + _OFFSET[k], at, np.uint32(0xFFFFFFFF))
    return out


def least_matches(threshold: float, compared: int = COMPARED, batch: int = BATCH, miss: float = MISS) -> list[tuple[int, int]]:
    """After n hashes, the fewest matches with which a pair goes on.

    With a uniform prior, the posterior probability of a similarity of at least t after m matches of n is that of at most m successes in n + 1
    trials of chance t. Lowest bytes also agree by chance, once in 256.
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for n in range(batch, compared + 1, batch):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def go_on(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows survive all batches, and their matches."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    before = 0
    for n, least in steps:
        matches[alive] += (left[alive, before:n] == right[alive, before:n]).sum(axis=1)
        alive = alive[matches[alive] >= least]
        before = n
    return alive, matches[alive]


def _signed(docs: DataFrame, id_column: str, text: str, width: int) -> DataFrame:
    """For each document: id, text_key, n_shingles, digest of the set (null if empty), its bands and its bytes to compare."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "text", PIECE_BYTES):
                sets, at = shingle_sets(piece.column("text"), width)
                hashes = minimum_hashes(sets, at)
                rows = hashes.reshape(-1, BANDS, ROWS).astype(np.uint64)
                bands = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
                for k in range(ROWS):
                    bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
                digests = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(at[:-1], at[1:])]
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1) * BANDS, pa.int32()), pa.array(bands.reshape(-1).view(np.int64)))
                compared = pa.array([row.tobytes() for row in (hashes[:, :COMPARED] & 0xFF).astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("text_key"), pa.array(np.diff(at), pa.int64()), pa.array(digests, pa.binary()), listed, compared],
                    ["id", "text_key", "n_shingles", "digest", "bands", "compared"],
                )

    given = docs.select(F.col(id_column).cast("bigint").alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    return given.mapInArrow(task, "id bigint, text_key bigint, n_shingles bigint, digest binary, bands array<bigint>, compared binary")


def _survivors(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (a, b) of digests those that Bayesian verification lets through."""
    steps = least_matches(threshold)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, COMPARED) for n in ("ca", "cb"))
            alive, _ = go_on(left, right, steps)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    of = {s: classes.select(F.col("digest").alias(s), F.col("compared").alias(f"c{s}"), F.col("n_shingles").alias(f"n{s}")) for s in "ab"}
    met = pairs.join(of["a"], "a").join(of["b"], "b").where(F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
    return met.select("a", "b", "ca", "cb").mapInArrow(task, "a binary, b binary")


def _is_link(shared: np.ndarray, left: np.ndarray | int, right: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (left + right - shared)


def _texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame, id_column: str, text: str, label: str) -> DataFrame:
    """The text of one source document of each wanted class (column digest), found again by id and a key of its text."""
    sources = wanted.distinct().join(classes.select("digest", "source"), "digest").select("digest", F.col("source.id").alias("source_id"), F.col("source.text_key").alias("text_key"))
    given = docs.select(F.col(id_column).cast("bigint").alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    same = sources["source_id"].eqNullSafe(given["id"]) & (sources["text_key"] == given["text_key"])
    return stored(given.join(sources, same).groupBy("digest").agg(F.first("text").alias("text")), label)


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_column: str, text: str, width: int, percent: int) -> DataFrame:
    """Of pairs (a, b) of digests those whose full sets are similar enough."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "text_a", PIECE_BYTES):
                (sa, ta), (sb, tb) = (shingle_sets(piece.column(n), width) for n in ("text_a", "text_b"))
                shared = np.array([len(np.intersect1d(sa[ta[i] : ta[i + 1]], sb[tb[i] : tb[i + 1]], assume_unique=True)) for i in range(piece.num_rows)], np.int64)
                yield piece.select(["a", "b"]).filter(pa.array(_is_link(shared, np.diff(ta), np.diff(tb), percent)))

    texts = _texts(pairs.select("a").union(pairs.select("b")).toDF("digest"), classes, docs, id_column, text, "candidates")
    of = {s: texts.select(F.col("digest").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab"}
    return pairs.join(of["a"], "a").join(of["b"], "b").mapInArrow(task, "a binary, b binary")


def _tiles(members: DataFrame) -> DataFrame:
    """The members of all tiles: tile, earlier, main, digest, component, compared.

    ``members``: bucket, digest, component, compared, n_shingles, and earlier: the buckets of the bands before this one. Members of a bucket's
    largest component meet only the others; the others meet everyone.
    """
    sizes = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component", "weight")).alias("top"), F.sum("n").alias("all"), F.sum("weight").alias("weight"))
    sides = members.join(largest, "bucket").withColumn("main", F.col("component") == F.col("top.component"))
    count = lambda n, weight: F.ceil(F.greatest(n / TILE, weight / TILE_SHINGLES)).cast("int")
    tiles = sides.withColumns({"mains": count(F.col("top.n"), F.col("top.weight")), "others": count(F.col("all") - F.col("top.n"), F.col("weight") - F.col("top.weight"))})
    spot = tiles.withColumn("own", F.when(F.col("main"), F.pmod(F.hash("digest"), "mains")).otherwise(F.pmod(F.hash("digest"), "others")))
    row = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    among = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda u: row("o", F.least("own", u), F.greatest("own", u)))
    with_main = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda u: row("m", F.col("own"), u))
    as_main = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda u: row("m", u, F.col("own")))
    dealt = spot.where("others > 0").withColumn("tile", F.explode(F.when(F.col("main"), as_main).otherwise(F.concat(among, with_main))))
    return dealt.select(F.xxhash64("bucket", "tile.kind", "tile.i", "tile.j").alias("tile"), "earlier", "main", "digest", "component", "compared")


@dataclass
class _Tile:
    """The members of one tile side by side."""

    key: int
    earlier: np.ndarray
    main: np.ndarray
    names: list[bytes]
    homes: np.ndarray
    compared: np.ndarray
    texts: list[str] | None

    @classmethod
    def all_of(cls, batches: Iterable[pa.RecordBatch]) -> Iterator[_Tile]:
        """The tiles of rows sorted by tile."""

        def rows() -> Iterator[tuple]:
            for batch in batches:
                lists = batch.column("earlier")
                values, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                earlier = [values[a:b] for a, b in zip(at[:-1], at[1:])]
                texts = batch.column("text").to_pylist() if "text" in batch.schema.names else [None] * batch.num_rows
                yield from zip(batch.column("tile").to_pylist(), earlier, *(batch.column(c).to_pylist() for c in ("main", "digest", "component", "compared")), texts)

        for key, some in groupby(rows(), key=lambda r: r[0]):
            _, earlier, main, names, homes, compared, texts = zip(*some)
            packed = np.frombuffer(b"".join(compared), np.uint8).reshape(-1, COMPARED)
            yield cls(key, np.stack(earlier), np.array(main), list(names), np.unique([h.hex() for h in homes], return_inverse=True)[1], packed, list(texts))

    def survivors(self, steps: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
        """For each member outside the main component its partners, across components as they stand then, that verification lets through."""
        later = np.arange(len(self.names))
        for i in np.flatnonzero(~self.main).tolist():
            at = np.flatnonzero((self.homes != self.homes[i]) & (self.main | (later > i)))
            alive, _ = go_on(np.broadcast_to(self.compared[i], (len(at), COMPARED)), self.compared[at], steps)
            # A pair that shares an earlier bucket is compared there.
            at = at[alive]
            yield i, at[~(self.earlier[i] == self.earlier[at]).any(axis=1)]


def _joined_in_tiles(tiles: DataFrame, texts: Callable[[DataFrame], DataFrame], width: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) that join all components of which two members of a tile are linked. ``texts`` gives the text of each wanted digest."""
    steps = least_matches(percent / 100)

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _Tile.all_of(batches):
            near = np.zeros(len(tile.names), bool)
            for i, partners in tile.survivors(steps):
                near[partners] = True
                near[i] |= len(partners) > 0
            if near.any():
                names = [n for n, wanted in zip(tile.names, near) if wanted]
                yield pa.RecordBatch.from_arrays([pa.array([tile.key] * len(names), pa.int64()), pa.array(names, pa.binary())], ["tile", "digest"])

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _Tile.all_of(batches):
            sets, at = shingle_sets(pa.array(tile.texts, pa.large_string()), width)
            each, codes = np.unique(sets, return_inverse=True)
            size, links, own = np.diff(at), [], np.zeros(len(each), bool)
            for i, partners in tile.survivors(steps):
                if len(partners):
                    own[codes[at[i] : at[i + 1]]] = True
                    shared = sums(own[codes[runs_at(at[partners], size[partners])]].astype(np.int64), bounds(size[partners]))
                    own[codes[at[i] : at[i + 1]]] = False
                    for j in partners[_is_link(shared, size[i], size[partners], percent)].tolist():
                        if tile.homes[i] != tile.homes[j]:
                            tile.homes[tile.homes == tile.homes[j]] = tile.homes[i]
                            links.append((tile.names[i], tile.names[j]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*links)], ["a", "b"])

    dealt = stored(tiles, "tiles")
    near = stored(dealt.repartition("tile").sortWithinPartitions("tile").mapInArrow(told, "tile bigint, digest binary"), "near")
    whole = dealt.join(near, ["tile", "digest"]).join(texts(near.select("digest")), "digest")
    return whole.repartition("tile").sortWithinPartitions("tile").mapInArrow(joined, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """For each row: id, text_key, n_shingles, component_id (smallest id reachable by links, its own included), kept and chosen.

    A document's set: its distinct runs of ``width`` words; with fewer words the whole as one; without words or text (null, empty) the set is empty
    and links with nothing. Documents are linked if 100 * shared >= percent * united. Every input row gives one row, whatever
    repeats. A null id takes part but is never the smallest, unless a component has no other (then ``component_id`` is null). kept: the id is the
    component's; chosen: besides, of several texts with that id, the one with the smallest key (rows alike in both are chosen together). ``text_key`` is Spark's xxhash64 of the text. Other columns are left out, so their names cannot clash.
    """
    threshold = percent / 100
    signed = stored(_signed(docs, id_column, text, width), "signed")
    by_set = signed.where("digest IS NOT NULL").groupBy("digest")
    classes = stored(
        by_set.agg(
            F.min("id").alias("first_id"),
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("source"),
            *(F.first(c).alias(c) for c in ("n_shingles", "bands", "compared")),
        ),
        "classes",
    )
    number = F.xxhash64("digest")
    listed = classes.select(number.alias("c"), F.posexplode("bands").alias("band", "bucket"))
    counts = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(listed.join(counts, "bucket"), "buckets")
    popular = shared.groupBy("c").agg(F.sum("n").alias("met"))
    known = classes.withColumn("c", number)
    members = stored(shared.join(popular, "c").join(known.select("c", "digest"), "c").select("bucket", "band", "n", "met", "digest"), "members")
    hubs = members.groupBy("bucket").agg(F.max(F.struct("met", "digest")).alias("hub"))
    spokes = members.join(hubs, "bucket").select(F.least("digest", "hub.digest").alias("a"), F.greatest("digest", "hub.digest").alias("b"))
    tried = stored(spokes.where("a <> b").distinct(), "pairs")
    alive = stored(_survivors(tried, classes, threshold), "survivors", tasks_for(tried.count(), PAIRS))
    links = stored(_confirmed(alive, classes, docs, id_column, text, width, percent), "confirmed", tasks_for(alive.count(), TEXTS))
    found = stored(components(links), "components")

    # Buckets of two are done with their hub; larger ones go on if they hold several components.
    larger = members.where("n > 2").join(found.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    split = larger.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    still = larger.join(split, "bucket", "left_semi").join(classes.select("digest", "bands", "compared", "n_shingles"), "digest")
    still = still.select("bucket", F.slice("bands", F.lit(1), F.col("band")).alias("earlier"), "digest", "component", "compared", "n_shingles")
    new = stored(_joined_in_tiles(_tiles(still), lambda d: _texts(d, classes, docs, id_column, text, "tile-texts"), width, percent), "joined")
    if not new.isEmpty():
        found = stored(components(links.unionByName(new)), "components")

    homes = classes.select("digest", "first_id", "source").join(found.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    least = homes.groupBy("component").agg(F.min("first_id").alias("component_id"), F.min("source").alias("first"))
    of_class = homes.join(least, "component").select("digest", "component_id", "first")
    whole = signed.select("id", "text_key", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    chosen = F.col("first").isNull() | (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key")))
    return whole.select(
        F.col("id").alias(id_column), "text_key", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), chosen.alias("chosen")
    )

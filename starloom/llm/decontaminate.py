"""Benchmark items inside documents: BM25 over an inverted index of the items, block-max WAND, and a check of question and answer.

Words are runs of letters and digits in lower case, so marks and case do not matter. A document is read in passages of 2 * STEP words, one every STEP
words; each is a query. Scores are shares of what an item would score against itself, as far as a passage must cover it.

1. For each item, the terms with the largest impacts that make up all but REST of its score are its essential terms. Sums over them,
   for all passages at once, leave out the passages that cannot reach the threshold with any item.
2. The others search the index by block-max WAND: posting lists in order of items, with the largest impact of each list and of each
   block of it; all items at or above the threshold come out.
3. An item is found if its words stand anywhere in the document: OVERLAP of the runs of WIDTH words of question and of answer, or of the item as
   a whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import as_bytes, bounds, by_size, distinct, mix, shingles, word_hashes
from .stored import stored

STEP, THRESHOLD, REST = 32, 0.5, 0.25
WIDTH, OVERLAP = 5, 0.8
K1, B = 1.2, 0.75
#: Postings in a block.
BLOCK = 16
#: Items of one index, at most, and their bytes: what goes to every task. More items make more indexes, each with its own pass.
INDEX_ITEMS, INDEX_BYTES = 4096, 8 << 20
PIECE_BYTES = 4 << 20
CELLS = 4 << 20

_LETTERS = re.compile(rb"[0-9A-Za-z\x80-\xff]")
_SAME = np.arange(256, dtype=np.uint8)
_PARTS = np.array([_LETTERS.match(bytes([b])) is None for b in range(256)])


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words, with bounds."""
    return word_hashes(*as_bytes(pc.utf8_lower(texts)), _PARTS, _SAME)


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence is the answer; of a single sentence the last third of its words."""
    sentences = re.split(r"(?<=[.?!])\s+", text.strip())
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = text.split()
    cut = len(words) - len(words) // 3
    return " ".join(words[:cut]), " ".join(words[cut:])


class ItemIndex:
    """Inverted index of some items: impacts as shares of an item's own score, in blocks with their maxima.

    ``every``: of all items, if these are a part of them, how many there are, their mean length, and of each term here how many hold it.
    """

    def __init__(self, ids: list, texts: list[str], step: int = STEP, every: tuple[int, float, dict[int, int]] | None = None):
        words, at = words_of(pa.array(texts, pa.string()))
        self.ids, self.size = ids, np.diff(at)
        item = np.repeat(np.arange(len(ids)), self.size)
        pairs, tf = np.unique(np.stack([words, item.astype(np.uint64)]), axis=1, return_counts=True)
        self.terms, term = np.unique(pairs[0], return_inverse=True)
        item = pairs[1].astype(np.int64)
        if every:
            count, mean, holding = every
            df = np.array([holding[t] for t in self.terms.view(np.int64).tolist()], np.int64)
        else:
            count, mean = len(ids), self.size.mean() if len(ids) else 1.0
            df = np.bincount(term, minlength=len(self.terms))
        idf = np.log1p((count - df + 0.5) / (df + 0.5))
        length = self.size / max(1e-9, mean)
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item]))
        # A passage covers that part of an item at least, wherever it starts.
        n = np.maximum(self.size, 1)
        covered = np.where(n <= step, 1.0, np.minimum(step / 2 + n / 2, 1.5 * step) / n)
        own = np.bincount(item, impact, minlength=len(ids)) * covered
        impact = impact / own[item]
        # Postings in order of term and item; np.unique has sorted them so.
        self.posting_at = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.item, self.impact = item, impact
        starts = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(self.posting_at, self.posting_at[1:])] or [np.zeros(0, np.int64)])
        self.block_top = np.zeros(len(item))
        tops = np.maximum.reduceat(impact, starts) if len(starts) else np.zeros(0)
        self.block_top[:] = np.repeat(tops, np.diff(np.append(starts, len(item))))
        self.list_top = np.maximum.reduceat(impact, self.posting_at[:-1]) if len(self.terms) else np.zeros(0)
        # Essential postings: an item's largest impacts, up to what is left being REST at most.
        order = np.lexsort((impact, item))
        below = np.cumsum(impact[order]) - np.concatenate([[0], np.cumsum(np.bincount(item, impact, minlength=len(ids)))])[item[order]]
        self.essential = np.zeros(len(item), bool)
        self.essential[order] = below > REST
        questions, answers = zip(*map(split_item, texts)) if texts else ((), ())
        self.parts = {n: shingles(*words_of(pa.array(t, pa.string())), WIDTH) for n, t in (("whole", texts), ("question", questions), ("answer", answers))}
        # Lengths of an item's parts that are shorter than a run.
        sizes = np.stack([np.diff(words_of(pa.array(t, pa.string()))[1]) for t in (texts, questions, answers)], axis=1)
        self.short = [sorted({int(n) for n in row if 0 < n < WIDTH}) for row in sizes]
        common = np.zeros(1 << 16, bool)
        common[(self.terms & np.uint64(0xFFFF)).astype(np.int64)] = True
        self._maybe = common

    def term_numbers(self, words: np.ndarray) -> np.ndarray:
        """The number of each word's term, -1 for a word of no item."""
        out = np.full(len(words), -1, np.int64)
        maybe = np.flatnonzero(self._maybe[(words & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.searchsorted(self.terms, words[maybe])
        there = place < len(self.terms)
        there[there] = self.terms[place[there]] == words[maybe][there]
        out[maybe[there]] = place[there]
        return out

    def passages_that_may_reach(self, term: np.ndarray, segment: np.ndarray, segments: int, follows: np.ndarray) -> np.ndarray:
        """Numbers of the segments whose passage (it and, where ``follows``, the next) has essential terms enough for some item.

        A term that repeats counts more than once: the bound is too high then, never too low.
        """
        essential_at = np.concatenate([[0], np.cumsum(self.essential)])
        items, impacts = self.item[self.essential], self.impact[self.essential]
        begin, stop = essential_at[self.posting_at[:-1]], essential_at[self.posting_at[1:]]
        width, found = len(self.ids), []
        chunk = max(1, CELLS // max(1, width))
        for a in range(0, segments, chunk):
            b = min(segments, a + chunk + 1)
            lo, hi = np.searchsorted(segment, [a, b])
            t, s = term[lo:hi], segment[lo:hi] - a
            n = stop[t] - begin[t]
            at = bounds(n)
            posting = np.arange(at[-1]) + np.repeat(begin[t] - at[:-1], n)
            sums = np.bincount(np.repeat(s, n) * width + items[posting], impacts[posting], minlength=(b - a) * width).reshape(b - a, width)
            sums[:-1] += sums[1:] * follows[a : b - 1, None]
            reach = (sums >= THRESHOLD - REST).any(axis=1)
            found.append(a + np.flatnonzero(reach[: min(chunk, b - a)]))
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def block_max_wand(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """All items with a score of at least THRESHOLD for the distinct terms of a passage."""
        cursors = [[int(self.item[self.posting_at[t]]), int(self.posting_at[t]), int(self.posting_at[t + 1]), float(self.list_top[t])] for t in terms.tolist()]
        heapq.heapify(cursors)
        out = []

        def move(cursor: list, least: int) -> list | None:
            """The cursor on its first item from ``least`` on."""
            place = cursor[1] + int(np.searchsorted(self.item[cursor[1] : cursor[2]], least))
            return [int(self.item[place]), place, *cursor[2:]] if place < cursor[2] else None

        while cursors:
            # Take lists in order of their items until their maxima could reach the threshold.
            taken, top = [], 0.0
            while cursors and top < THRESHOLD:
                taken.append(heapq.heappop(cursors))
                top += taken[-1][3]
            if top < THRESHOLD:
                break
            pivot = taken[-1][0]
            while cursors and cursors[0][0] == pivot:
                taken.append(heapq.heappop(cursors))
            on_pivot = [m for m in (move(c, pivot) if c[0] < pivot else c for c in taken) if m]
            here = [c for c in on_pivot if c[0] == pivot]
            if sum(self.block_top[c[1]] for c in here) >= THRESHOLD:
                score = sum(self.impact[c[1]] for c in here)
                if score >= THRESHOLD:
                    out.append((pivot, float(score)))
            for c in on_pivot:
                c = move(c, pivot + 1)
                if c:
                    heapq.heappush(cursors, c)
        return out

    def overlaps(self, item: int, near: np.ndarray) -> dict[str, float]:
        """The shares of the item's runs of words that are among some text's runs."""
        out = {}
        for name, (runs, at) in self.parts.items():
            own = np.unique(runs[at[item] : at[item + 1]])
            out[name] = float(np.isin(own, near).mean()) if len(own) else 1.0
        return out


def found_in(index: ItemIndex, texts: pa.Array) -> list[tuple[int, int, float, float, float, float]]:
    """(text, item, score, and overlaps of question, answer and whole), once for each text and item: at the best passage's score."""
    words, at = words_of(texts)
    term = index.term_numbers(words)
    sizes = np.diff(at)
    segments = -(-sizes // STEP)
    first = bounds(segments)
    text_of = np.repeat(np.arange(len(sizes)), segments)
    known = np.flatnonzero(term >= 0)
    text = np.searchsorted(at, known, side="right") - 1
    segment = first[text] + (known - at[text]) // STEP
    follows = np.append(text_of[1:] == text_of[:-1], False)[: len(text_of)]
    best: dict[int, dict[int, float]] = {}
    for s in index.passages_that_may_reach(term[known], segment, int(first[-1]), follows).tolist():
        i = int(text_of[s])
        start = int(at[i]) + (s - int(first[i])) * STEP
        stop = min(start + 2 * STEP, int(at[i + 1]))
        asked = term[start:stop]
        for item, score in index.block_max_wand(np.unique(asked[asked >= 0])):
            scores = best.setdefault(i, {})
            scores[item] = max(scores.get(item, 0.0), score)
    out = []
    for i, scores in best.items():
        text, here = words[at[i] : at[i + 1]], np.array([0, sizes[i]])
        runs = {WIDTH: np.unique(shingles(text, here, WIDTH)[0])}
        for item, score in scores.items():
            # A part with fewer words is one run, marked by its length.
            short = [n for n in index.short[item] if n <= sizes[i]]
            for n in short:
                if n not in runs:
                    runs[n] = np.unique(mix(shingles(text, here, n)[0] + np.uint64(1 + n)))
            o = index.overlaps(item, np.concatenate([runs[n] for n in (WIDTH, *short)]))
            if o["whole"] >= OVERLAP or min(o["question"], o["answer"]) >= OVERLAP:
                out.append((i, item, score, o["question"], o["answer"], o["whole"]))
    return out


_FOUND = "item_id bigint, score double, question_overlap double, answer_overlap double, overlap double"


def indexes(items: DataFrame, id_column: str = "item_id", text: str = "text") -> Iterator[ItemIndex]:
    """Indexes of all items, each of bounded size; scores are those of one index of all. Items without words are left out; the same text twice is
    two items.
    """
    kept = items.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    count, size = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    shards = max(1, -(-2 * count // INDEX_ITEMS), -(-2 * size // INDEX_BYTES))
    kept = kept.withColumn("shard", F.pmod(F.xxhash64("text", "id"), F.lit(shards)).cast("int"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "text", PIECE_BYTES):
                words, at = words_of(piece.column("text"))
                each, each_at = distinct(words, at)
                listed = pa.ListArray.from_arrays(pa.array(each_at, pa.int32()), pa.array(each.view(np.int64)))
                yield pa.RecordBatch.from_arrays([piece.column("shard"), pa.array(np.diff(at), pa.int64()), listed], ["shard", "size", "words"])

    if shards > 1:
        said = stored(kept.select("shard", "text").mapInArrow(task, "shard int, size bigint, words array<bigint>").where("size > 0"), "item-words")
        many, words = said.agg(F.count(F.lit(1)), F.sum("size")).first()
        terms = said.select("shard", F.explode("words").alias("word"))
        holding = stored(terms.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "item-terms")
    for shard in range(shards):
        own = kept.where(F.col("shard") == shard).orderBy("id", "text").collect()
        own = [r for r in own if len(words_of(pa.array([r.text]))[0])]
        every = None
        if own and shards > 1:
            every = many, words / many, dict(map(tuple, holding.join(terms.where(F.col("shard") == shard), "word", "left_semi").collect()))
        if own:
            yield ItemIndex([r.id for r in own], [r.text for r in own], every=every)


def contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row of documents with each benchmark item found in it: the id, ``text_key``, item_id, score, and the overlaps.

    Whole texts are read. A null or empty text holds nothing, an empty benchmark finds nothing; null ids are carried like others. A row that
    repeats gives its findings again. ``text_key`` is Spark's xxhash64 of the text. Other columns are left out, so their names cannot clash.
    """
    given = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    schema = f"id {given.schema['id'].dataType.simpleString()}, text_key bigint, {_FOUND}"

    def search(index: ItemIndex) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                for piece in by_size(batch, "text", PIECE_BYTES):
                    found = found_in(own, piece.column("text"))
                    if found:
                        rows = pa.array([f[0] for f in found])
                        columns = [pa.array([own.ids[f[1]] for f in found], pa.int64()), *(pa.array([f[k] for f in found], pa.float64()) for k in range(2, 6))]
                        yield pa.RecordBatch.from_arrays([piece.column("id").take(rows), piece.column("text_key").take(rows), *columns], ["id", "text_key", "item_id", "score", "question_overlap", "answer_overlap", "overlap"])

        return given.mapInArrow(task, schema)

    found = [search(index) for index in indexes(items)]
    out = found[0] if found else docs.sparkSession.createDataFrame([], schema)
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("id", id_column)

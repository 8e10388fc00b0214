"""Quality classifier with site priors: hierarchical empirical Bayes.

1. Two logistic models, "good" and "toxic", are fitted to a bounded sample of labelled documents: measures of style, and
   words that are much more frequent on one side. They give every document its evidence (log odds).
2. Grouped sums of the documents' probabilities give each host and each path of a host a posterior share of good (and toxic)
   documents: a path is shrunk toward its host, a host toward the whole, by a Beta prior whose strength follows from how much hosts (paths)
   differ beyond chance. So a site with few documents says little.
3. A document's posterior puts its path's share in the place of the sample's share. It stays if good is likely and toxic is not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import as_bytes, by_size, distinct, per_run, split_words, sums, word_hashes
from .stored import stored

#: Labelled documents in the sample to fit, at most: those with the smallest digests of their ids.
FIT_ROWS = 16384
#: A word is used if its shares on both sides differ by so many standard errors, in so many documents at least; so many words at most.
WORD_ERRORS, WORD_DOCUMENTS, WORDS = 5.0, 4, 256
RIDGE = 0.1
#: Documents whose curvature is summed at a time.
STEP_ROWS = 1024
PIECE_BYTES = 4 << 20
#: Shares of a site stay inside these bounds, so that no site decides by itself.
LEAST_SHARE = 0.02

_LETTER = np.array([chr(b).isalpha() or b >= 128 for b in range(256)])
_UPPER = np.array([b < 128 and chr(b).isupper() for b in range(256)])
_DIGIT = np.array([b < 128 and chr(b).isdigit() for b in range(256)])
_MARK = np.array([b < 128 and chr(b) in ".,;:'\"-" for b in range(256)])
_SPACE = np.array([b in b" \t\n\v\f\r" for b in range(256)])
_SAME = np.arange(256, dtype=np.uint8)
_PARTS = ~(_LETTER | _DIGIT)


def style(texts: pa.Array) -> np.ndarray:
    """Measures of each text's style, one row each."""
    data, at = as_bytes(texts)
    codes, word_at, words = split_words(texts)
    n_bytes, n_words = np.maximum(np.diff(at), 1), np.maximum(np.diff(word_at), 1)
    share = [sums(kind[data].astype(np.int64), at) / n_bytes for kind in (_LETTER, _UPPER, _DIGIT, _MARK, _SPACE)]
    length = np.asarray(pc.binary_length(words), np.int64) if len(words) else np.zeros(0, np.int64)
    alone = np.asarray(pc.match_substring_regex(words, r"^[^\p{L}\p{N}]+$"), bool) if len(words) else np.zeros(0, bool)
    each, each_at = distinct(codes, word_at)
    same = np.zeros(len(codes), np.int64)
    same[1:] = codes[1:] == codes[:-1]
    inner = np.ones(len(codes), bool)
    inner[word_at[:-1][np.diff(word_at) > 0]] = False
    most = np.array([np.bincount(np.unique(codes[a:b], return_inverse=True)[1]).max(initial=0) for a, b in zip(word_at[:-1], word_at[1:])])
    return np.column_stack(
        [
            *share,
            np.log1p(n_words),
            np.diff(each_at) / n_words,
            np.diff(each_at) / n_words * np.log1p(n_words),
            sums(same * inner, word_at) / n_words,
            most / n_words,
            sums(length[codes], word_at) / n_words,
            sums(alone[codes].astype(np.int64), word_at) / n_words,
            per_run(np.maximum, length[codes], word_at, 0),
        ]
    )


def vocabulary(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct words (runs of letters and digits, in lower case) as hashes, with bounds."""
    return distinct(*word_hashes(*as_bytes(pc.utf8_lower(texts)), _PARTS, _SAME))


@dataclass
class Head:
    """A logistic model: weights of standardised style measures, of words, and the share of the sample that is positive."""

    middle: np.ndarray
    scale: np.ndarray
    words: np.ndarray
    weights: np.ndarray
    prior: float

    @classmethod
    def fit(cls, measures: np.ndarray, has: np.ndarray, words: np.ndarray, positive: np.ndarray) -> Head:
        """``has`` tells, for each document (row), which of the chosen words (ascending) are in it."""
        n, yes = len(positive), int(positive.sum())
        prior = (yes + 0.5) / (n + 1)
        middle, scale = measures.mean(axis=0) if n else np.zeros(measures.shape[1]), measures.std(axis=0) + 1e-9 if n else np.ones(measures.shape[1])
        head = cls(middle, scale, words, np.zeros(1 + len(middle) + len(words)), prior)
        if 0 < yes < n:
            x = head._columns(measures, has)
            ridge = np.full(x.shape[1], RIDGE)
            ridge[0] = 1e-3
            for _ in range(25):
                p = 1 / (1 + np.exp(-np.clip(x @ head.weights, -30, 30)))
                weight, curve = p * (1 - p) + 1e-6, np.diag(ridge)
                # Some rows at a time, so that no second array of the sample's size is made.
                for a in range(0, n, STEP_ROWS):
                    some = x[a : a + STEP_ROWS]
                    curve += (some * weight[a : a + STEP_ROWS, None]).T @ some
                step = np.linalg.solve(curve, x.T @ (positive - p) - ridge * head.weights)
                head.weights = head.weights + step
                if np.abs(step).max() < 1e-6:
                    break
        else:
            head.weights[0] = np.log(prior / (1 - prior))
        return head

    def _columns(self, measures: np.ndarray, has: np.ndarray) -> np.ndarray:
        # A measure beyond anything in the sample counts as a far one there.
        return np.column_stack([np.ones(len(measures)), np.clip((measures - self.middle) / self.scale, -8, 8), has])

    def log_odds(self, measures: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
        return self._columns(measures, _has(self.words, words)) @ self.weights


def _has(chosen: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """For each document (its distinct words), which of the chosen words it has."""
    return np.array([np.isin(chosen, w, assume_unique=True) for w in words], bool).reshape(len(words), len(chosen))


def _looked_at(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    hashes, at = vocabulary(texts)
    return style(texts), np.split(hashes, at[1:-1]) if len(at) > 1 else []


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", rows: int = FIT_ROWS) -> dict[str, Head]:
    """The two models, from at most ``rows`` labelled documents. Labels: the id, quality (1: good) and toxic (1: toxic); null labels are left out."""
    chosen = labels.select(F.col(id_column).alias("label_id"), "quality", "toxic").where("label_id IS NOT NULL")
    chosen = chosen.orderBy(F.xxhash64("label_id"), "label_id", "quality", "toxic").limit(rows)
    # At most ``rows`` narrow rows, so this side is small whatever the data.
    sample = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("label_id"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "text", PIECE_BYTES):
                measures, words = _looked_at(piece.column("text"))
                digests = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in words]
                listed = pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64()))
                columns = [pa.array([m.tobytes() for m in measures], pa.binary()), listed, pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("quality").cast(pa.int32()), piece.column("toxic").cast(pa.int32()), *columns], ["id", "quality", "toxic", "measures", "words", "same"])

    kind = sample.schema["id"].dataType.simpleString()
    seen = sample.select("id", "quality", "toxic", "text").mapInArrow(task, f"id {kind}, quality int, toxic int, measures binary, words array<bigint>, same binary")
    # Documents that share an id could be many: the bound holds for them as well.
    seen = stored(seen.orderBy("id", "quality", "toxic", "same", "measures").limit(rows), "labelled")
    # Copies would make all their words look telling: of documents with the same set of words the first stands for all.
    first = seen.groupBy("quality", "toxic", "same").agg(F.min(F.struct("id", "measures", "words")).alias("first"))
    kept = stored(first.select("quality", "toxic", "first.measures", "first.words"), "fitted")
    return {name: _fitted(kept.where(F.col(column).isNotNull()).withColumn("positive", F.col(column) == 1)) for name, column in (("good", "quality"), ("toxic", "toxic"))}


def _fitted(sample: DataFrame) -> Head:
    """The model of one label: Spark counts words and finds the telling ones, and the driver gets those few columns of the sample."""
    n, yes = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("positive").cast("int")), F.lit(0))).first()
    chosen = np.zeros(0, np.uint64)
    if 0 < yes < n:
        counted = sample.select("positive", F.explode("words").alias("word")).groupBy("word").agg(F.count_if("positive").alias("a"), F.count_if(~F.col("positive")).alias("b"))
        both = (F.col("a") + F.col("b")) / F.lit(n)
        error = F.sqrt(both * (1 - both) * F.lit(1 / yes + 1 / (n - yes))) + 1e-12
        telling = counted.where(F.col("a") + F.col("b") >= WORD_DOCUMENTS).select("word", (F.abs(F.col("a") / yes - F.col("b") / (n - yes)) / error).alias("errors"))
        best = telling.where(F.col("errors") >= WORD_ERRORS).orderBy(F.desc("errors"), "word").limit(WORDS).collect()
        chosen = np.sort(np.array([r.word for r in best], np.int64).view(np.uint64))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.asarray(w.values, np.int64).view(np.uint64) for w in batch.column("words")]
            bits = [np.packbits(row).tobytes() for row in _has(chosen, words)]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), batch.column("measures"), pa.array(bits, pa.binary())], ["positive", "measures", "bits"])

    # At most FIT_ROWS rows of some hundred bytes; their order is fixed, so that sums are the same in every run.
    got = sorted((bytes(r.measures), bytes(r.bits), r.positive) for r in sample.select("positive", "measures", "words").mapInArrow(task, "positive boolean, measures binary, bits binary").collect())
    measures = np.frombuffer(b"".join(m for m, _, _ in got)).reshape(len(got), -1) if got else np.zeros((0, style(pa.array([""])).shape[1]))
    packed = np.frombuffer(b"".join(b for _, b, _ in got), np.uint8).reshape(len(got), -(-len(chosen) // 8))
    has = np.unpackbits(packed, axis=1, count=len(chosen)).astype(bool) if len(chosen) else np.zeros((len(got), 0), bool)
    return Head.fit(measures, has, chosen, np.array([p for _, _, p in got], bool))


def evidence(docs: DataFrame, heads: dict[str, Head], columns: list[str], text: str = "text") -> DataFrame:
    """The columns, and each document's log odds for every model. A text without words has only the sample's share for evidence."""
    shared = docs.sparkSession.sparkContext.broadcast(heads)
    names = [f"__{n}" for n in heads]
    given = docs.select(*columns, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            for piece in by_size(batch, "__text", PIECE_BYTES):
                measures, words = _looked_at(piece.column("__text"))
                empty = np.array([not len(w) for w in words], bool)
                odds = [np.where(empty, np.log(m.prior / (1 - m.prior)), m.log_odds(measures, words)) for m in models.values()]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in columns), *map(pa.array, odds)], [*columns, *names])

    return given.mapInArrow(task, ", ".join([kinds, *(f"`{n}` double" for n in names)]))


def _chance(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def _log_odds(share: Column) -> Column:
    kept = F.greatest(F.lit(LEAST_SHARE), F.least(F.lit(1 - LEAST_SHARE), share))
    return F.log(kept / (1 - kept))


def _strength(groups: DataFrame, n: str, total: str, parent: Column) -> float:
    """Documents that the prior counts for: by how much more than chance the groups' shares differ from their parents'."""
    share = F.col(total) / F.col(n)
    spread, chance, expected = groups.agg(
        F.sum(F.col(n) * (share - parent) ** 2), F.avg(parent * (1 - parent)), F.sum(F.col(n))
    ).first()
    if not expected or not chance:
        return 1.0
    count, squares = groups.agg(F.count(F.lit(1)), F.sum(F.col(n).cast("double") * F.col(n))).first()
    # Moments: E[sum n (share - parent)^2] = chance * (count + (expected - count) / (strength + 1)).
    beyond = spread / chance - count
    return float(min(1e6, max(1.0, (expected - count) / beyond - 1))) if beyond > 0 and squares else 1e6


def site_priors(scored: DataFrame, heads: dict[str, Head], host: str, path: str) -> DataFrame:
    """For each host and path (null is a site as well) the log odds of its posterior shares, one column for each model."""
    names = list(heads)
    paths = scored.groupBy(host, path).agg(F.count(F.lit(1)).alias("n"), *(F.sum(_chance(F.col(f"__{m}"))).alias(m) for m in names))
    paths = stored(paths, "paths")
    hosts = paths.groupBy(host).agg(F.sum("n").alias("host_n"), *(F.sum(m).alias(f"host_{m}") for m in names))
    n, *totals = paths.agg(F.sum("n"), *(F.sum(m) for m in names)).first()
    both = paths.join(hosts.withColumnRenamed(host, "__host"), F.col(host).eqNullSafe(F.col("__host"))).drop("__host")
    for name, total in zip(names, totals):
        whole = F.lit((total or 0.0) / n if n else 0.5)
        host_strength = _strength(hosts, "host_n", f"host_{name}", whole)
        both = both.withColumn(f"host_share_{name}", (F.col(f"host_{name}") + host_strength * whole) / (F.col("host_n") + host_strength))
        strength = _strength(both, "n", name, F.col(f"host_share_{name}"))
        both = both.withColumn(f"site_{name}", _log_odds((F.col(name) + strength * F.col(f"host_share_{name}")) / (F.col("n") + strength)))
    return stored(both.select(F.col(host).alias("__host"), F.col(path).alias("__path"), *(f"site_{m}" for m in names)), "sites")


def judged(docs: DataFrame, labels: DataFrame, columns: list[str], id_column: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang") -> DataFrame:
    """The columns, ``p_good`` and ``p_toxic`` (posteriors), and ``kept``: good at least as likely as not, toxic less.

    Every input row gives one row, whatever repeats or is null; a null or empty text is judged by its site alone. Without labels both models
    say one half. Columns that are named like the new ones give way to them.
    """
    heads = fit(docs, labels, id_column, text)
    columns = [c for c in columns if c not in ("p_good", "p_toxic", "kept")]
    given = docs.select(*columns, F.col(host).alias("__own_host"), F.col(path).alias("__own_path"), F.col(text).alias("__own_text"))
    # Texts are measured once: both the sites and the documents start from what is stored here.
    scored = stored(evidence(given, heads, [*columns, "__own_host", "__own_path"], "__own_text"), "evidence")
    sites = site_priors(scored, heads, "__own_host", "__own_path")
    met = scored.join(sites, F.col("__own_host").eqNullSafe(F.col("__host")) & F.col("__own_path").eqNullSafe(F.col("__path")), "left")

    def posterior(name: str) -> Column:
        prior = float(np.log(heads[name].prior / (1 - heads[name].prior)))
        return _chance(F.col(f"__{name}") - prior + F.coalesce(F.col(f"site_{name}"), F.lit(prior)))

    out = met.select(*columns, posterior("good").alias("p_good"), posterior("toxic").alias("p_toxic"))
    return out.withColumn("kept", (F.col("p_good") >= 0.5) & (F.col("p_toxic") < 0.5))

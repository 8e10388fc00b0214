"""A log-bilinear language model, trained by noise-contrastive estimation, and a smoothed unigram base.

Symbols: the WORDS most frequent training words, GROUPS groups of all others (by their last bytes), and the end of a text. The vector of
a context is the sum of one vector for the symbol before and one for the last of the FREQUENT most frequent words before that (such words tell
the language, and the last one may be far back); its product with a symbol's vector, plus the symbol's bias, is the symbol's score:
log p(symbol | context) is the softmax of the scores. Inside a group, words follow their smoothed counts, with one place for words
never seen. So the probabilities of all words, known or not, sum to one.

Everything is learnt from all training texts. Word counts come from a look-up, and the counts of (context, symbol) are what training needs of
the texts: contexts use CONTEXT kinds of symbols, so these counts have a fixed number of cells however large the corpus, and
noise-contrastive estimation takes its expectation over noise exactly instead of drawing samples.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import as_bytes, bounds, by_frequency, dump, load, parts_of_words, per_run, range_hashes, split_words
from .blocks import cut_words, deal, gather, join_words, look_up, own, part_count
from .stored import stored

WORDS, GROUPS, CONTEXT, FREQUENT = 511, 256, 64, 48
SIZE, NOISE, ROUNDS, RATE = 32, 25, 250, 0.05
ADD = 0.1


def _suffix_groups(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The group of each word, by its last three bytes."""
    return (range_hashes(data, np.maximum(at[1:] - 3, at[:-1]), at[1:]) % np.uint64(GROUPS)).astype(np.int64) if len(at) > 1 else np.zeros(0, np.int64)


def _hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return range_hashes(data, at[:-1], at[1:])


def train(counts: np.ndarray, size: int = SIZE, noise: int = NOISE, rounds: int = ROUNDS, rate: float = RATE) -> dict[str, np.ndarray]:
    """Fit the model to the counts of (frequent word before, symbol before, symbol), both of the first as kinds of context."""
    kinds, _, symbols = counts.shape
    flat = counts.reshape(-1, symbols).astype(np.float64)
    seen = np.flatnonzero(flat.sum(axis=1) > 0)
    far, near = np.divmod(seen, kinds)
    share = (flat.sum(axis=0) + ADD) / (flat.sum() + ADD * symbols)
    own = (flat[seen] / max(1.0, flat.sum())).astype(np.float32)
    often = own.sum(axis=1, keepdims=True)
    drawn = (noise * share).astype(np.float32)
    rng = np.random.default_rng(7)
    model = {n: rng.normal(0, 0.1, (k, size)).astype(np.float32) for n, k in (("far", kinds), ("near", kinds), ("symbol", symbols))}
    model["bias"] = np.log(share).astype(np.float32)
    moved = {n: [np.zeros_like(v), np.zeros_like(v)] for n, v in model.items()}
    for step in range(1, (rounds if len(seen) else 0) + 1):
        context = model["far"][far] + model["near"][near]
        # Of a symbol from the text and ``noise`` ones from the noise: how likely is this one from the text?
        real = 1 / (1 + np.exp(np.clip(np.log(drawn) - (context @ model["symbol"].T + model["bias"]), -30, 30)))
        pull = own * (1 - real) - often * drawn * real
        to_context = pull @ model["symbol"]
        change = {"symbol": pull.T @ context, "bias": pull.sum(axis=0)}
        for name, which in (("far", far), ("near", near)):
            change[name] = np.zeros_like(model[name])
            np.add.at(change[name], which, to_context)
        now = rate * min(1.0, 2 * (1 - (step - 1) / rounds))
        for name, slope in change.items():
            first, second = moved[name]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            model[name] += now * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-10)
    return model


def log_probabilities(model: dict[str, np.ndarray]) -> np.ndarray:
    """log10 p(symbol | context) for all contexts at once, normalised over the symbols."""
    context = (model["far"][:, None, :] + model["near"][None, :, :]).reshape(-1, model["far"].shape[1])
    scores = (context @ model["symbol"].T + model["bias"]).astype(np.float64)
    scores -= scores.max(axis=1, keepdims=True)
    scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return scores / np.log(10)


@dataclass
class Lexicon:
    """The symbols of words, and what is known of all training tokens."""

    hashes: np.ndarray
    """Of the frequent words, ascending."""
    place: np.ndarray
    """Their symbols: 0 is the most frequent."""
    words: int
    tokens: int
    distinct: int
    texts: int
    group_tokens: np.ndarray
    group_words: np.ndarray

    @property
    def symbols(self) -> int:
        return self.words + GROUPS + 1

    @property
    def end(self) -> int:
        return self.words + GROUPS

    def of_words(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's symbol, and its kind as a context."""
        group = _suffix_groups(data, at)
        hashes = _hashes(data, at)
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        known = self.hashes[place] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        symbol = np.where(known, self.place[place], self.words + group) if len(self.hashes) else self.words + group
        return symbol, np.where(symbol < FREQUENT, symbol, FREQUENT + group % (CONTEXT - 1 - FREQUENT))

    def inside_groups(self, symbol: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its group; 0 for a word that is a symbol of its own."""
        group = np.clip(symbol - self.words, 0, GROUPS - 1)
        share = (count + ADD) / (self.group_tokens[group] + ADD * (self.group_words[group] + 1))
        return np.where(symbol < self.words, 0.0, np.log10(share))

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + ADD) / (self.tokens + ADD * (self.distinct + 1)))


#: As a context: before the first word of a text.
START = CONTEXT - 1


def _sequences(block: dict, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all tokens of a block: number of the word (-1: end), symbol, context (far * CONTEXT + near); and the texts' bounds."""
    data = np.frombuffer(block["bytes"], np.uint8)
    symbol, kind = lexicon.of_words(data, bounds(block["length"]))
    n = block["n"].astype(np.int64)
    at = bounds(n + 1)
    word = np.full(at[-1], -1, np.int64)
    inside = np.ones(at[-1], bool)
    inside[at[1:] - 1] = False
    word[inside] = block["codes"]
    kinds = np.append(kind, START)[word]
    near = np.concatenate([[START], kinds[:-1]])[: len(word)]
    near[at[:-1]] = START
    # The last place of a frequent word, two tokens back or more, if it is in the same text.
    last = np.maximum.accumulate(np.where(inside & (kinds < FREQUENT), np.arange(len(word)), -1))
    last = np.concatenate([[-1, -1], last])[: len(word)]
    far = np.where(last >= np.repeat(at[:-1], np.diff(at)), kinds[last], START)
    return word, np.append(symbol, lexicon.end)[word], far * CONTEXT + near, at


_BLOCKS = "data binary, train_texts bigint, top array<struct<word:binary,n:bigint>>, groups array<struct<g:int,tokens:bigint,words:bigint>>"


def _counted(docs: DataFrame, id_column: str, text: str, held_out) -> DataFrame:
    """Blocks of coded texts with the training count of each word, and rows of what the parts know of all words."""
    # Each part gives its most frequent words: few parts, few of those.
    parts = part_count(docs.sparkSession, each=1)
    given = docs.select(F.col(id_column).cast("bigint").alias("id"), (~held_out).alias("train"), F.col(text).alias("text"))
    types = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])), pa.list_(pa.struct([("g", pa.int32()), ("tokens", pa.int64()), ("words", pa.int64())]))

    def row(data: dict | None, texts: int | None, top: list | None, groups: list | None) -> pa.RecordBatch:
        columns = [pa.array([None if data is None else dump(data)], pa.binary()), pa.array([texts], pa.int64()), pa.array([top], types[0]), pa.array([groups], types[1])]
        return pa.RecordBatch.from_arrays(columns, ["data", "train_texts", "top", "groups"])

    def make(batch: pa.RecordBatch) -> tuple[Callable[[], dict], Callable[[], dict]]:
        codes, at, words = split_words(batch.column("text"), lower=True)
        codes, words = by_frequency(codes, words)
        part_of = parts_of_words(words, parts)
        trains = np.asarray(batch.column("train"), bool)
        every = words.cast(pa.large_binary()).to_pylist()

        def texts() -> dict:
            return {"ids": own(batch.column("id")), "train": trains, "n": np.diff(at).astype(np.uint32), "codes": codes, "part_of": part_of, **join_words(every)}

        def entries() -> dict:
            count = np.bincount(codes[np.repeat(trains, np.diff(at))], minlength=len(words)).astype(np.uint32)
            return {p: {**join_words([every[i] for i in where]), "count": count[where]} for p, where in deal(part_of).items()}

        return texts, entries

    def answer(asked: list[dict]) -> Iterator[dict]:
        number: dict[bytes, int] = {}
        wanted = [np.array([number.setdefault(w, len(number)) for w in cut_words(a)], np.int64) for a in asked]
        total = np.zeros(len(number), np.int64)
        for which, a in zip(wanted, asked):
            total[which] += a["count"]
        for which in wanted:
            yield {"count": total[which]}
        words = list(number)
        top = np.argsort(-total, kind="stable")[: 2 * WORDS]
        top = sorted((-int(total[i]), words[i]) for i in top if total[i])[:WORDS]
        data, at = as_bytes(pa.array(words, pa.large_binary()).cast(pa.large_string()))
        group = _suffix_groups(data, at)
        yield {"top": top, "tokens": np.bincount(group, total, GROUPS).astype(np.int64), "words": np.bincount(group, total > 0, GROUPS).astype(np.int64)}

    def finish(texts: dict | None, answers: dict) -> Iterator[pa.RecordBatch]:
        if texts is None:
            (known,) = answers.values()
            groups = [{"g": g, "tokens": int(t), "words": int(w)} for g, (t, w) in enumerate(zip(known["tokens"], known["words"])) if w]
            yield row(None, None, [{"word": w, "n": -n} for n, w in known["top"]], groups)
            return
        texts["count"] = gather(texts.pop("part_of"), answers, "count", 0)
        yield row(texts, int(texts["train"].sum()), None, None)

    return stored(look_up(given, "text", make, answer, finish, _BLOCKS), "coded")


def _lexicon(coded: DataFrame) -> Lexicon:
    """What all parts know together: WORDS words and GROUPS sums."""
    top = coded.where("top IS NOT NULL").selectExpr("inline(top)").orderBy(F.desc("n"), "word").limit(WORDS).collect()
    sums = coded.where("groups IS NOT NULL").selectExpr("inline(groups)").groupBy("g").agg(F.sum("tokens").alias("t"), F.sum("words").alias("w")).collect()
    texts = coded.agg(F.coalesce(F.sum("train_texts"), F.lit(0))).first()[0]
    tokens, words = np.zeros(GROUPS, np.int64), np.zeros(GROUPS, np.int64)
    for g, t, w in sums:
        tokens[g], words[g] = t, w
    all_tokens, distinct = int(tokens.sum()) + texts, int(words.sum()) + (texts > 0)
    data, at = as_bytes(pa.array([bytes(r.word) for r in top], pa.large_binary()).cast(pa.large_string()))
    hashes = _hashes(data, at)
    own_group = _suffix_groups(data, at)
    np.subtract.at(tokens, own_group, np.array([r.n for r in top], np.int64))
    np.subtract.at(words, own_group, 1)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], order, len(top), all_tokens, distinct, texts, tokens, words)


def _context_counts(coded: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Training counts of (far, near, symbol); CONTEXT^2 * symbols cells, summed on the executors by far."""
    shared = coded.sparkSession.sparkContext.broadcast(lexicon)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros((CONTEXT, CONTEXT * own.symbols), np.int64)
        for batch in batches:
            for data in batch.column("data").to_pylist():
                block = load(data)
                _, symbol, context, at = _sequences(block, own)
                learnt = np.repeat(block["train"], np.diff(at))
                total += np.bincount(context[learnt] * own.symbols + symbol[learnt], minlength=total.size).reshape(total.shape)
        far = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(far, pa.int32()), pa.array([dump({"n": total[f]}) for f in far], pa.binary())], ["far", "data"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for far, data in zip(*(c.to_pylist() for c in batch.columns)):
                total[far] = total.get(far, 0) + load(data)["n"]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([dump({"n": n}) for n in total.values()], pa.binary())], ["far", "data"])

    schema = "far int, data binary"
    rows = coded.where("data IS NOT NULL").select("data").mapInArrow(count, schema).repartition("far").mapInArrow(add, schema).collect()
    out = np.zeros((CONTEXT, CONTEXT, lexicon.symbols), np.int64)
    for far, data in rows:
        out[far] = load(bytes(data))["n"].reshape(CONTEXT, -1)
    return out


def score_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: the id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the whole text).

    Texts whose id's CRC-32 (as text; a null id as empty text) ends in 0 are held out, all others are learnt from. Tokens are words in
    lower case (A-Z) and one end. A null or empty text is its end. Every input row gives one row, and counts for training as often as it is there.
    Without training texts all words are unknown. Other columns are left out, so their names cannot clash.
    """
    held_out = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 10 == 0
    coded = _counted(docs, id_column, text, held_out)
    lexicon = _lexicon(coded)
    model = train(_context_counts(coded, lexicon))
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, model))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, fitted = shared.value
        chances = None
        for batch in batches:
            chances = log_probabilities(fitted) if chances is None else chances
            for data in batch.column("data").to_pylist():
                block = load(data)
                word, symbol, context, at = _sequences(block, own)
                count = np.append(block["count"], own.texts)
                all_symbols = np.append(own.of_words(np.frombuffer(block["bytes"], np.uint8), bounds(block["length"]))[0], own.end)
                inside = np.append(own.inside_groups(all_symbols[:-1], count[:-1]), 0.0)
                columns = {
                    "id": block["ids"],
                    "held_out": pa.array(~block["train"]),
                    "n_tokens": pa.array(np.diff(at)),
                    "n_known": pa.array(per_run(np.add, (count > 0)[word].astype(np.int64), at, 0)),
                    "train_tokens": pa.array(np.full(len(at) - 1, own.tokens)),
                    "base_score": pa.array(per_run(np.add, own.base(count)[word], at, 0.0)),
                    "score": pa.array(per_run(np.add, chances[context, symbol] + inside[word], at, 0.0)),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return coded.where("data IS NOT NULL").select("data").mapInArrow(task, schema).withColumnRenamed("id", id_column)

"""Search for secrets with a trigram index.

Each rule's regular expression gives a Boolean query of trigrams that every match must hold. A block of documents gets an inverted
index of the trigrams that some rule asks for: for each the documents that hold it. Intersecting and uniting these lists leaves
the candidates, in which the expression itself is looked for. A rule without mandatory trigrams reads every text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from re import _constants as sre
from re import _parser as parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import ASCII_LOWER, as_bytes, by_size

BLOCK_BYTES = 8 << 20
#: Strings that an expression's part may stand for, at most, to be followed one by one.
FOLLOWED = 64

Query = tuple | bool


def _all(parts: list[Query]) -> Query:
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts: list[Query]) -> Query:
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings: set[str]) -> Query:
    """One of the strings occurs."""
    if min(map(len, strings)) < 3:
        return True
    # A string that holds another of them adds nothing.
    least = [s for s in sorted(strings) if not any(other != s and other in s for other in strings)]
    return _any([_all([("has", t) for t in sorted({s[i : i + 3] for i in range(len(s) - 2)})]) for s in least])


def _follow(tree) -> tuple[set[str] | None, Query]:
    """The strings that a parsed expression stands for, in lower case (None: too many), and what any match must hold."""
    now, must, whole = {""}, [], True

    def ended() -> None:
        nonlocal now, whole
        must.append(_of_strings(now))
        now, whole = {""}, False

    def then(strings: set[str]) -> None:
        nonlocal now
        if len(now) * len(strings) > FOLLOWED:
            ended()
        now = {a + b for a in now for b in strings}

    for op, arg in tree:
        strings: set[str] | None = None
        inside: Query = True
        more = False
        if op is sre.LITERAL:
            strings = {chr(arg).lower()}
        elif op is sre.IN and all(kind is sre.LITERAL for kind, _ in arg):
            strings = {chr(c).lower() for _, c in arg}
        elif op is sre.SUBPATTERN:
            strings, inside = _follow(arg[3])
        elif op is sre.BRANCH:
            found = [_follow(branch) for branch in arg[1]]
            if all(s is not None for s, _ in found):
                strings = set().union(*(s for s, _ in found))
            else:
                inside = _any([_of_strings(s) if s is not None else q for s, q in found])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, part = arg
            strings, inside = _follow(part)
            if (least, most) == (0, 1) and strings is not None:
                strings = strings | {""}
            elif least == 0:
                strings, inside = None, True
            else:
                more = most != 1
        elif op is sre.AT:
            continue
        if strings is None or len(strings) > FOLLOWED:
            ended()
            must.append(inside if strings is None else _of_strings(strings))
            continue
        then(strings)
        if more:
            ended()
            then(strings)
    if whole:
        return now, _of_strings(now)
    ended()
    return None, _all(must)


def trigram_query(expression: str) -> Query:
    """What every match of the expression holds: True (anything), ("has", trigram), ("and", ...) or ("or", ...), in lower case."""
    strings, must = _follow(parser.parse(expression))
    return _of_strings(strings) if strings is not None else must


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``fits`` drops matches that the expression alone lets through."""

    kind: str
    expression: str
    fits: Callable[[re.Match], bool] = lambda match: True
    query: Query = field(init=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "query", trigram_query(self.expression))


def _either_case(words: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in words)


BASE_RULES = (
    Rule("assign", rf"({_either_case('password|passwd|secret|token|api_?key')})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 12),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    Rule("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("map_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("payment_key", r"[sr]k_(?:live|test)_[0-9A-Za-z]{16,}"),
)
RULES = (*BASE_RULES, *MORE_RULES)


def _trigrams(query: Query) -> set[str]:
    return set() if query is True else {query[1]} if query[0] == "has" else set().union(*map(_trigrams, query[1:]))


class TrigramIndex:
    """The documents of a block by the trigrams of some queries."""

    def __init__(self, data: np.ndarray, at: np.ndarray, wanted: list[str]):
        self.all = np.arange(len(at) - 1)
        codes = np.array(sorted(int.from_bytes(w.encode(), "big") for w in wanted), np.uint32)
        self.postings = {int(c): self.all[:0] for c in codes}
        if len(data) < 3 or not len(codes):
            return
        low = ASCII_LOWER[data]
        # First by the leading two bytes, then the whole trigram at the places that are left.
        lead = np.zeros(1 << 16, bool)
        lead[codes >> 8] = True
        places = np.flatnonzero(lead[(low[:-2].astype(np.uint16) << 8) | low[1:-1]])
        here = (low[places].astype(np.uint32) << 16) | (low[places + 1].astype(np.uint32) << 8) | low[places + 2]
        known = np.isin(here, codes)
        places, here = places[known], here[known]
        doc = np.searchsorted(at, places, side="right") - 1
        inside = places + 3 <= at[doc + 1]
        pairs = np.unique((here[inside].astype(np.uint64) << np.uint64(32)) | doc[inside].astype(np.uint64))
        of = (pairs >> np.uint64(32)).astype(np.int64)
        docs = (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        for code in self.postings:
            a, b = np.searchsorted(of, [code, code + 1])
            self.postings[code] = docs[a:b]

    def documents(self, query: Query) -> np.ndarray:
        """Ascending numbers of the documents that meet the query."""
        if query is True:
            return self.all
        if query[0] == "has":
            return self.postings[int.from_bytes(query[1].encode(), "big")]
        lists = sorted((self.documents(q) for q in query[1:]), key=len)
        out = lists[0]
        for other in lists[1:]:
            out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
        return out


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, columns: list[str] | None = None, text: str = "text", spans: str = "spans", redacted: bool = False) -> DataFrame:
    """Add the secrets of every whole text as ``spans``: an array of (kind, start, end) in code points, end exclusive.

    For each kind they are the leftmost matches that do not overlap, without those that do not fit; sorted by start, then by the order of the
    rules. ``columns``: those to keep (all if left out; one that is named like the new column gives way). A null or empty text has
    no spans. Every input row gives one row. No shuffle: each input split is indexed where it is read. ``redacted`` replaces the
    spans in the kept text column by marks; ``spans`` still counts in the given text.
    """
    kept = [c for c in (columns or docs.columns) if c != spans]
    wanted = sorted(set().union(*(_trigrams(r.query) for r in rules)))
    expressions = [re.compile(r.expression) for r in rules]
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, "__text", BLOCK_BYTES):
                column = piece.column("__text")
                index = TrigramIndex(*as_bytes(column), wanted)
                texts = pc.fill_null(column, "").to_pylist()
                found: list[list] = [[] for _ in texts]
                for order, (rule, expression) in enumerate(zip(rules, expressions)):
                    for i in index.documents(rule.query).tolist():
                        found[i] += [(m.start(), order, m.end()) for m in expression.finditer(texts[i]) if rule.fits(m)]
                listed = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(f)] for f in found]
                clean = pa.array(redact(column.to_pylist(), listed), pa.string()) if redacted else column
                yield pa.RecordBatch.from_arrays([*(clean if c == text else piece.column(c) for c in kept), pa.array(listed, kind_type)], [*kept, spans])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    given = docs.select(*kept, F.col(text).alias("__text"))
    return given.mapInArrow(task, f"{kinds}, `{spans}` array<struct<kind:string,start:int,end:int>>")


def listed(spans: Column) -> Column:
    """The spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(texts: Iterable[str | None], spans: Iterable[list[dict]], mark: str = "[secret]") -> list[str | None]:
    """The texts with each run of overlapping spans replaced by one mark."""
    out: list[str | None] = []
    for text, some in zip(texts, spans):
        parts, at = [], 0
        for span in some or []:
            if span["start"] >= at:
                parts += [text[at : span["start"]], mark]
            at = max(at, span["end"])
        out.append(text if not some else "".join([*parts, text[at:]]))
    return out

"""URL filter: allow and block rules, and gradient-boosted trees for URLs that no rule decides.

All of it is DataFrame work. The trees are grown on a bounded sample of labelled URLs: each level is one grouped sum of gradients by node, feature
and bin, the driver picks the splits from those few sums, and the trees become one SQL expression. Judging is one pass over the URLs without
a shuffle: measures of the text, a look-up of the label rates of the host's suffixes, the expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stored import stored

#: Labelled URLs in the sample to fit, at most: those with the smallest hashes of their text.
FIT_ROWS = 16384
ROUNDS, DEPTH, RATE, RIDGE, BINS = 8, 3, 0.4, 1.0, 16
#: Labelled URLs that a suffix's parent counts for in its rate.
STRENGTH = 20
#: Gradients are summed as whole numbers, so that sums and trees are the same in every run.
UNIT = 1_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = ["length", "host_length", "depth", "digit_ratio", "entropy", "n_params", "n_labels", "n_hyphens"]
SUFFIX = ["rate_1", "rate_2", "rate_3"]
FEATURES = [*LEXICAL, *SUFFIX]


@dataclass(frozen=True)
class Rule:
    """Allows or blocks a host and its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed rules of the registered query.
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one or for null."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (verdict, host and path together), of equally long ones that with the longer host, then block; null if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    # From the weakest to the strongest, so that the strongest is asked first.
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits of a character, from the shares of the text's characters. Sorted characters make runs, so the work follows the length."""
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))
    gain = lambda run: F.when(run > 1, run * F.log2(run)).otherwise(0.0)

    def step(state: Column, c: Column) -> Column:
        same = state["last"] == c
        return F.struct(
            c.alias("last"),
            F.when(same, state["run"] + 1.0).otherwise(1.0).alias("run"),
            F.when(same, state["total"]).otherwise(state["total"] + gain(state["run"])).alias("total"),
        )

    n = F.length(text).cast("double")
    total = F.aggregate(F.array_sort(F.split(text, "")), start, step, lambda s: s["total"] + gain(s["run"]))
    return F.when(n > 0, F.log2(n) - total / n).otherwise(0.0)


def measured(urls: DataFrame, url: str) -> DataFrame:
    """The rows with host, path, lexical measures and the hashes of the host's last one, two and three labels (the whole host if it has fewer)."""
    text = F.coalesce(F.col(url), F.lit(""))
    count = lambda of, chars: (F.length(of) - F.length(F.translate(of, chars, ""))).cast("double")
    query = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^[^?#]*\?([^#]*)", 1), F.lit(""))
    # Text before the measures: each part of a URL is taken once.
    parts = urls.withColumns({"__host": host_of(F.col(url)), "__path": path_of(F.col(url)), "__query": query})
    host = F.col("__host")
    return parts.withColumns(
        {
            "__length": F.length(text).cast("double"),
            "__host_length": F.length(host).cast("double"),
            "__depth": count(F.col("__path"), "/"),
            "__digit_ratio": count(text, "0123456789") / F.greatest(F.length(text), F.lit(1)),
            "__entropy": _entropy(text),
            "__n_params": F.when(F.col("__query") == "", 0.0).otherwise(1.0 + count(F.col("__query"), "&")),
            "__n_labels": F.when(host == "", 0.0).otherwise(1.0 + count(host, ".")),
            "__n_hyphens": count(host, "-"),
            **{f"__suffix_{n}": F.xxhash64(F.substring_index(host, ".", -n)) for n in (1, 2, 3)},
        }
    )


@dataclass
class UrlModel:
    """Log odds of block before any tree, the rate that suffixes shrink to, bins' edges by feature, the suffixes' counts, and for each tree its
    splits by node (feature, bin) and its leaves' weights."""

    prior: float
    share: float
    edges: dict[str, list[float]]
    suffixes: dict[int, DataFrame]
    trees: list[tuple[dict[int, tuple[str, int]], dict[int, float]]]


def _share(n: int, yes: int) -> float:
    return (yes + 0.5) / (n + 1)


def _log_odds(n: int, yes: int) -> float:
    return math.log(_share(n, yes) / (1 - _share(n, yes)))


def _with_rates(rows: DataFrame, model: UrlModel) -> DataFrame:
    """The rows with the label rates of their suffixes, each shrunk toward the shorter one's, the shortest toward the rate of all."""
    shorter = F.lit(model.share)
    for i, known in model.suffixes.items():
        # At most FIT_ROWS rows of three numbers on the other side.
        rows = rows.join(F.broadcast(known), f"__suffix_{i}", "left")
        shorter = (F.coalesce(F.col(f"__yes_{i}"), F.lit(0)) + STRENGTH * shorter) / (F.coalesce(F.col(f"__n_{i}"), F.lit(0)) + STRENGTH)
        rows = rows.withColumn(f"__rate_{i}", shorter)
        shorter = F.col(f"__rate_{i}")
    return rows


def _binned(edges: dict[str, list[float]]) -> dict[str, Column]:
    """The number of edges below each measure."""
    return {f: sum(((F.col(f"__{f}") > e).cast("int") for e in edges[f]), F.lit(0)) for f in FEATURES}


def _node(splits: dict[int, tuple[str, int]], depth: int, prefix: str, node: int = 1) -> str:
    """SQL for the node that a row has come to after ``depth`` splits: 1 is the root, 2n and 2n + 1 are the children of n."""
    if depth == 0 or node not in splits:
        return str(node)
    feature, least = splits[node]
    left, right = (_node(splits, depth - 1, prefix, 2 * node + side) for side in (0, 1))
    return f"IF({prefix}{feature} < {least}, {left}, {right})"


def _weight(splits: dict[int, tuple[str, int]], leaves: dict[int, float], prefix: str, node: int = 1) -> str:
    if node not in splits:
        return f"{leaves[node]!r}D"
    feature, least = splits[node]
    left, right = (_weight(splits, leaves, prefix, 2 * node + side) for side in (0, 1))
    return f"IF({prefix}{feature} < {least}, {left}, {right})"


def _score(model: UrlModel, prefix: str) -> str:
    """SQL for the trees' sum over columns of bins, named by ``prefix`` and feature."""
    return " + ".join([f"{model.prior!r}D", *(_weight(splits, leaves, prefix) for splits, leaves in model.trees)])


def _total(sums: dict[tuple[str, int], tuple[int, int]], feature: str, bins: range) -> tuple[int, int]:
    """Gradient and curvature of all rows in these bins of a feature."""
    cells = [sums.get((feature, b), (0, 0)) for b in bins]
    return sum(g for g, _ in cells), sum(h for _, h in cells)


def best_split(sums: dict[tuple[str, int], tuple[int, int]], total: tuple[int, int]) -> tuple[str, int] | None:
    """The split (feature, first bin on the right) that gains most, of equal ones the first in order of features and bins; none if nothing is gained.

    ``sums``: gradient and curvature by feature and bin, in units of 1 / UNIT.
    """
    score = lambda g, h: (g / UNIT) ** 2 / (h / UNIT + RIDGE)
    best, chosen = 1e-9, None
    for f in FEATURES:
        left = (0, 0)
        for b in range(1, BINS):
            g, h = sums.get((f, b - 1), (0, 0))
            left = (left[0] + g, left[1] + h)
            right = (total[0] - left[0], total[1] - left[1])
            gain = score(*left) + score(*right) - score(*total)
            if left[1] and right[1] and gain > best:
                best, chosen = gain, (f, b)
    return chosen


def fit(labelled: DataFrame, url: str = "url", blocked: str = "blocked", rows: int = FIT_ROWS, rounds: int = ROUNDS, depth: int = DEPTH) -> UrlModel:
    """The model from at most ``rows`` labelled URLs. Labels: true (block), false (allow); null ones are left out, and null URLs count as empty."""
    chosen = labelled.select(F.coalesce(F.col(url), F.lit("")).alias("url"), F.col(blocked).cast("int").alias("y")).where("y IS NOT NULL")
    chosen = chosen.orderBy(F.xxhash64("url"), "url", "y").limit(rows)
    sample = stored(measured(chosen, "url").withColumn("__half", F.pmod(F.xxhash64("url"), F.lit(2))).drop("url", "__path", "__query"), "labelled-urls", 1)
    # One half of the URLs gives the rates of suffixes, the other grows the trees: no row's own label is among its measures.
    rated, grown = sample.where("__half = 0"), sample.where("__half = 1")
    rated_n, rated_yes = rated.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    n, yes = grown.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    listed = F.explode(F.array(*(F.struct(F.lit(i).alias("labels"), F.col(f"__suffix_{i}").alias("suffix")) for i in (1, 2, 3))))
    counts = rated.select("y", listed.alias("s")).groupBy("s.labels", "s.suffix").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("yes"))
    counts = stored(counts, "suffixes", 1)
    suffixes = {i: counts.where(F.col("labels") == i).select(F.col("suffix").alias(f"__suffix_{i}"), F.col("n").alias(f"__n_{i}"), F.col("yes").alias(f"__yes_{i}")) for i in (1, 2, 3)}
    model = UrlModel(_log_odds(n + rated_n, yes + rated_yes), _share(rated_n, rated_yes), {f: [] for f in FEATURES}, suffixes, [])
    if not 0 < yes < n:
        return model
    full = stored(_with_rates(grown, model).select("y", *(f"__{f}" for f in FEATURES)), "measured-urls", 1)
    cuts = full.agg(*(F.percentile(f"__{f}", F.array(*(F.lit(i / BINS) for i in range(1, BINS)))).alias(f) for f in FEATURES)).first()
    model.edges = {f: sorted(set(cuts[f])) for f in FEATURES}
    # At most ``rows`` narrow rows: one partition, so that a level is one task without a shuffle.
    table = stored(full.select("y", *(c.alias(f) for f, c in _binned(model.edges).items())), "binned-urls", 1).coalesce(1)
    cells = ", ".join(f"struct('{f}' AS feature, {f} AS bin)" for f in FEATURES)
    for _ in range(rounds):
        splits, totals = {}, {}
        for level in range(depth):
            # Nodes times features times bins: a few hundred rows.
            summed = table.sparkSession.sql(
                f"""SELECT node, c.feature, c.bin, CAST(sum(round((y - p) * {UNIT})) AS BIGINT) AS g, CAST(sum(round(p * (1 - p) * {UNIT})) AS BIGINT) AS h
                FROM (SELECT node, y, 1 / (1 + exp(-raw)) AS p, explode(array({cells})) AS c
                    FROM (SELECT *, {_score(model, "")} AS raw, {_node(splits, level, "")} AS node FROM {{binned}}) WHERE node >= {1 << level})
                GROUP BY node, c.feature, c.bin""",
                binned=table,
            ).collect()
            by_node: dict[int, dict] = {}
            for r in summed:
                by_node.setdefault(r.node, {})[r.feature, r.bin] = (r.g, r.h)
            for node, sums in by_node.items():
                whole = _total(sums, FEATURES[0], range(BINS))
                totals[node] = whole
                split = best_split(sums, whole)
                if split:
                    splits[node] = split
                    left = totals[2 * node] = _total(sums, split[0], range(split[1]))
                    totals[2 * node + 1] = (whole[0] - left[0], whole[1] - left[1])
            if not any(node in splits for node in by_node):
                break
        if not splits:
            break
        leaves = {i: RATE * (g / UNIT) / (h / UNIT + RIDGE) for i, (g, h) in totals.items() if i not in splits}
        model.trees.append((splits, leaves))
    return model


def judged(urls: DataFrame, rules: Sequence[Rule], model: UrlModel, columns: list[str], url: str = "url") -> DataFrame:
    """The columns, and for each URL host, path, rule (null if none fits), verdict (allow or block) and score (the trees' log odds of block).

    A rule's verdict stands; else the trees block where their log odds are above 0. A null URL counts as empty: no host, no path, judged by the trees. A rule
    on a path fits only URLs that have that path written out. Every input row gives one row, whatever repeats; texts of any length are read
    whole. Without labels, or with labels of one kind, the trees' answer is the same for all. Columns that are named like the new ones give way to them.
    """
    columns = [c for c in columns if c not in ("host", "path", "rule", "verdict", "score")]
    given = urls.select(*(F.col(c).alias(f"own_{i}") for i, c in enumerate(columns)), F.col(url).alias("__url"))
    rated = _with_rates(measured(given, "__url"), model)
    binned = rated.withColumns({f"__bin_{f}": c for f, c in _binned(model.edges).items()})
    found = binned.withColumns({"__rule": rule_of(F.col("__host"), F.col("__path"), rules), "__score": F.expr(_score(model, "__bin_"))})
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("__score") > 0, "block").otherwise("allow"))
    own = (F.col(f"own_{i}").alias(c) for i, c in enumerate(columns))
    return found.select(*own, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), F.col("__score").alias("score"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled URLs (url, blocked) of the given tables: the number in a page's path is that of its document; low quality or toxic is block."""
    number = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*/[a-z]+/([0-9]{1,18})", 1)
    numbered = pages.select("url", F.when(number != "", number.cast("bigint")).alias("number"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), True).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), False)
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("blocked"))
    return numbered.join(known, F.col("number") == F.col("doc_id")).select("url", "blocked")

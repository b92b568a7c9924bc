"""Quality rules: fixed limits first, then gradient-boosted trees over document statistics.

The trees are grown in numpy on histograms, with monotonic constraints: more repetition, more repeated lines
or more symbols can never raise a score. They are flattened into node arrays, so scoring a batch is a
few array lookups per level. Texts are read once; all later steps use the narrow statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bounded_sample, map_batches
from martloom.session import write_once

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LABELLED_ROWS = 20_000  # bound of the labelled sample the trees are fitted on
TREES, DEPTH, RATE, BINS, LEAST_LEAF = 60, 4, 0.15, 64, 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Statistics the trees read, with the sign their effect must have (0: free).
FEATURES = {"log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "distinct_share": 0, "upper_share": 0, "digit_share": 0, "line_words": 0, "end_share": 0}


def repeated_words(words: list) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    number = {w: i for i, w in enumerate(set(words))}
    ids = np.array([number[w] for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, which, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts and the features of one text; a null text has no words."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = sum(map(text.count, "0123456789"))
    ends = sum(map(text.count, ".!?"))
    features = [float(np.log1p(n)), chars / max(1, n), symbols / max(1, chars), dup / max(1, len(lines)), repeat / max(1, n),
                len(set(words)) / max(1, n), upper / max(1, chars), digits / max(1, chars), n / max(1, len(lines)), ends / max(1, n)]
    return [n, chars, symbols, dup, repeat], features


def with_statistics(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        def step(ids, texts):
            found = [statistics(t) for t in texts]
            out = {"doc_id": ids, "features": [f for _, f in found]}
            return out | {name: [c[i] for c, _ in found] for i, name in enumerate(COUNTS)}
        return step

    fields = ", ".join(f"{c} bigint" for c in COUNTS)
    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, {fields}, features array<double>", make)


@dataclass
class Forest:
    """Complete binary trees as arrays [tree, node]; node i has children 2i+1 and 2i+2."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _grow(bins: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray, signs: list[int]):
    """One tree, level by level; a constrained split bounds the values on its two sides by their middle."""
    nodes = 2 ** (DEPTH + 1) - 1
    feature, limit, value = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
    low, high = np.full(nodes, -np.inf), np.full(nodes, np.inf)
    node = np.zeros(len(bins), np.int64)
    leaf = lambda g, h: -g / (h + 1.0)
    for level in range(DEPTH + 1):
        first, count = 2 ** level - 1, 2 ** level
        at = node - first
        g, h = np.bincount(at, gradient, count), np.bincount(at, weight, count)
        value[first:first + count] = np.clip(leaf(g, h), low[first:first + count], high[first:first + count])
        if level == DEPTH:
            break
        best = np.full(count, 1e-6)
        for f, sign in enumerate(signs):
            key = at * BINS + bins[:, f]
            gl = np.bincount(key, gradient, count * BINS).reshape(count, BINS).cumsum(axis=1)[:, :-1]
            hl = np.bincount(key, weight, count * BINS).reshape(count, BINS).cumsum(axis=1)[:, :-1]
            nl = np.bincount(key, minlength=count * BINS).reshape(count, BINS).cumsum(axis=1)
            total, nl = nl[:, -1:], nl[:, :-1]
            gr, hr = g[:, None] - gl, h[:, None] - hl
            left = np.clip(leaf(gl, hl), low[first:first + count, None], high[first:first + count, None])
            right = np.clip(leaf(gr, hr), low[first:first + count, None], high[first:first + count, None])
            gain = -(gl * left + (hl + 1) * left ** 2 / 2) - (gr * right + (hr + 1) * right ** 2 / 2)
            gain -= -(g * value[first:first + count] + (h + 1) * value[first:first + count] ** 2 / 2)[:, None]
            gain[(nl < LEAST_LEAF) | (total - nl < LEAST_LEAF) | (sign * (right - left) < 0)] = -np.inf
            gain[:, len(cuts[f]):] = -np.inf
            cut = gain.argmax(axis=1)
            better = gain[np.arange(count), cut] > best
            for i in np.flatnonzero(better):
                n = first + i
                best[i] = gain[i, cut[i]]
                feature[n], limit[n] = f, cuts[f][cut[i]]
                middle = (left[i, cut[i]] + right[i, cut[i]]) / 2
                for child in (2 * n + 1, 2 * n + 2):
                    low[child], high[child] = low[n], high[n]
                if sign:
                    lower, upper = (2 * n + 1, 2 * n + 2) if sign > 0 else (2 * n + 2, 2 * n + 1)
                    high[lower], low[upper] = middle, middle
        for i in np.flatnonzero(~(best > 1e-6)):  # no split: everything goes left and keeps its bounds
            for child in (2 * (first + i) + 1, 2 * (first + i) + 2):
                low[child], high[child] = low[first + i], high[first + i]
        chosen = feature[node]
        thresholds = np.array([np.searchsorted(cuts[f], limit[n]) if np.isfinite(limit[n]) else BINS for n, f in enumerate(feature)])
        node = 2 * node + 1 + (bins[np.arange(len(bins)), chosen] > thresholds[node])
    return feature, limit, value * RATE


def fit(x: np.ndarray, y: np.ndarray, signs: list[int] | None = None) -> Forest:
    """Boosted trees for labels 0 and 1. Without both labels the score is the same everywhere."""
    signs = list(FEATURES.values()) if signs is None else signs
    shape = (TREES, 2 ** (DEPTH + 1) - 1)
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    forest = Forest(np.zeros(shape, np.int64), np.full(shape, np.inf), np.zeros(shape), base)
    if not len(y) or y.min() == y.max():
        return forest
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1], method="lower")) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    total = np.full(len(y), base)
    rows = np.arange(len(x))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        forest.feature[t], forest.limit[t], forest.value[t] = _grow(bins, cuts, p - y, p * (1 - p), signs)
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, forest.feature[t][node]] > forest.limit[t][node])
        total += forest.value[t][node]
    return forest


def train(measured: DataFrame, labels: DataFrame) -> Forest:
    """Fit on about ``LABELLED_ROWS`` labelled rows at most, chosen by a hash of the id; null labels are ignored."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = bounded_sample(marked, "doc_id", LABELLED_ROWS).withColumnRenamed("doc_id", "label_id")
    rows = measured.join(sample, F.col("doc_id") == F.col("label_id")).groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.min("features").alias("features")).orderBy("doc_id").collect()
    x = np.array([r["features"] for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["quality"] for r in rows], float))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, base_failed, score and kept of every row.

    An empty text fails the base. Ids that repeat are learned from once. Columns other than doc_id, text and the label are not read.
    """
    measured = write_once(with_statistics(docs), "statistics")
    sent = docs.sparkSession.sparkContext.broadcast(train(measured, labels))
    columns = ["doc_id", *COUNTS]
    schema = measured.select(*columns).schema.add("score", "double")

    def make():
        def step(features, *kept):
            x = np.array(features, float).reshape(len(features), len(FEATURES))
            return {"score": sent.value.scores(x).tolist()} | dict(zip(columns, kept))
        return step

    scored = map_batches(measured, ["features", *columns], schema, make)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return scored.select(*columns, failed.alias("base_failed"), "score", (~failed & (F.col("score") >= 0.5)).alias("kept"))

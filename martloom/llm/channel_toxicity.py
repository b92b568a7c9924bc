"""Toxicity of texts written through a noisy channel.

Disguised words (leetspeak, spaced letters, repeated letters) are read as lattices of characters.
Viterbi decoding under a character trigram model restores them; a logistic model over learned words
scores what was restored together with the plain words.

The character model counts all training texts. Words and weights are learned from a bounded sample of
labelled training rows (``LABELLED_ROWS``); only the text of a row enters its score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bounded_sample, crc_mod, map_batches
from martloom.session import write_once

HELD_OUT = 5
LABELLED_ROWS = 10_000
LEAST_DOCS, LEAST_Z = 5, 4.0
BEGINNINGS = (4, 6)  # letters of the word beginnings that count as features beside whole words
SYMBOLS = 28  # boundary, a to z, any other letter

# What a character may stand for besides itself.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou"}
FILLERS = ".-_*~'^#%&"
COST_SWAP, COST_DROP, COST_FILLER, COST_REPEAT, COST_DOUBLE, COST_BREAK = -1.0, -8.0, -0.3, -0.3, -2.0, -4.0

_CODES = bytes(
    b - 96 if 97 <= b <= 122 else b - 64 if 65 <= b <= 90 else 27 if b >= 128 else 0 for b in range(256))
_LETTERS = re.compile(r"[^\W\d_]+")
_leet = re.escape("".join(LEET))
_fill = re.escape(FILLERS)
# A disguise: a letter and a leet sign anywhere, equal letters in a row, or letters kept apart by single fillers. Runs are
# matched without giving back, so a long run of signs takes one pass.
_DISGUISED = re.compile(rf"([^\W\d_])\1|[^\W\d_][{_fill}]++[^\W\d_][{_fill}]++[^\W\d_]")
_SIGN = re.compile(f"[{_leet}]")
_SPACED = re.compile(rf"(?<!\S)(?:[^\W_]|[{_leet}])(?!\w)(?>[ {_fill}]{{1,3}}+(?:[^\W_]|[{_leet}])(?!\w)){{2,}}")
_EDGES = "\"'()[]{}<>.,;:?!*#%&~^|$@+€ "
_PLAIN_EDGES = "".join(c for c in _EDGES if c not in LEET)


def trigram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of symbol trigrams; runs of boundaries or of other letters count as one."""
    codes = np.frombuffer("\n".join([t for t in texts if t]).encode().translate(_CODES), np.uint8)
    codes = np.concatenate([[0, 0], codes, [0]]).astype(np.int32)
    keep = np.concatenate([[True], (codes[1:] != codes[:-1]) | ((codes[1:] != 0) & (codes[1:] != 27))])
    keep[:2] = True
    codes = codes[keep]
    return np.bincount((codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:], minlength=SYMBOLS ** 3)


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities [a, b, c] of symbol c after a and b, interpolated with shorter contexts.

    Every task counts its texts; counts are added per trigram, so the driver gets 28^3 rows at most.
    """
    def make():
        total = np.zeros(SYMBOLS ** 3, np.int64)

        def step(texts):
            for i in range(0, len(texts), 500):
                total[:] += trigram_counts(texts[i:i + 500])

        def finish():
            at = np.flatnonzero(total)
            return {"tri": at.tolist(), "n": total[at].tolist()}

        step.finish = finish
        return step

    rows = map_batches(docs, ["text"], "tri int, n bigint", make).groupBy("tri").agg(F.sum("n").alias("n")).collect()
    tri = np.zeros(SYMBOLS ** 3)
    for r in rows:
        tri[r["tri"]] = r["n"]
    tri = tri.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
    first = (uni + 1) / (uni.sum() + SYMBOLS)
    second = (bi + 5 * first) / (bi.sum(axis=1, keepdims=True) + 5)
    return np.log((tri + 5 * second[None]) / (tri.sum(axis=2, keepdims=True) + 5)).astype(np.float32)


@cache
def _readings(char: str, run: int) -> tuple[tuple[str, float], ...]:
    """Readings of a run of one character with their channel costs; runs of three and more are read alike."""
    readings: list[tuple[str, float]] = []
    for letter, cost in [(char, 0.0)] * char.isalpha() + [(x, COST_SWAP) for x in LEET.get(char, "")]:
        if run == 1:
            readings.append((letter, cost))
        else:
            readings.append((letter, cost + (COST_DOUBLE if run == 2 else COST_REPEAT)))
            readings.append((letter * 2, cost + (0.0 if run == 2 else COST_REPEAT)))
    if not char.isalpha():
        wide = char == " " and run > 1
        readings.append(("", COST_BREAK if wide else COST_FILLER if char in FILLERS or char == " " else COST_DROP))
        readings.append((" ", 0.0 if wide else COST_BREAK if char in FILLERS or char == " " else COST_DROP))
    return tuple(readings)


def lattice(token: str) -> Iterator[tuple[tuple[str, float], ...]]:
    """Readings of each run of equal characters of a lower-case token, with their channel costs."""
    i, n = 0, len(token)
    while i < n:
        j = i + 1
        while j < n and token[j] == token[i]:
            j += 1
        yield _readings(token[i], min(j - i, 3))
        i = j


def prefix_tree(features: Iterable[str]) -> dict:
    """Words and word beginnings as nested dictionaries; a feature ends where None is a key."""
    tree: dict = {}
    for feature in features:
        node = tree
        for letter in feature.rstrip("*"):
            node = node.setdefault(letter, {})
        node[None] = feature
    return tree


def reachable(token: str, tree: dict) -> bool:
    """May any reading of the token have a word that is a feature or starts with one?

    All readings are followed through the tree at once, whatever their cost: a word starts at the token's start or behind a run that may
    be a gap. Where this says no, decoding the token cannot give a feature.
    """
    at = [tree]
    for readings in lattice(token):
        after = []
        for written, _ in readings:
            if written == " ":
                after.append(tree)
            elif not written:
                after += at
            else:
                for node in at:
                    for letter in written:
                        node = node.get(letter)
                        if node is None:
                            break
                        if None in node:
                            return True
                    else:
                        after.append(node)
        if not after:
            # Without a place to go on only a run that may be a gap can start a word again.
            if token.isalpha():
                return False
        # Different ways may lead to one place.
        at = after if len(after) < 2 else list({id(node): node for node in after}.values())
    return False


def _code(char: str) -> int:
    return 0 if char == " " else ord(char) - 96 if "a" <= char <= "z" else 27


def restore(token: str, model: np.ndarray | list[float]) -> str:
    """Most probable reading of a token: Viterbi over its lattice, a state being the last two symbols."""
    flat = model if isinstance(model, list) else model.ravel().tolist()
    # A state is 28 times the symbol before last plus the last symbol.
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for readings in lattice(token):
        after: dict[int, tuple[float, tuple | None]] = {}
        for state, (score, path) in states.items():
            for written, cost in readings:
                x, s = state, score + cost
                for char in written:
                    z = _code(char)
                    if z or x % SYMBOLS:
                        x = x * SYMBOLS + z
                        s += flat[x]
                        x %= SYMBOLS * SYMBOLS
                known = after.get(x)
                if known is None or s > known[0]:
                    after[x] = (s, (path, written))
        states = after
    best = max(states.items(), key=lambda x: x[1][0] + flat[x[0] * SYMBOLS])[1]
    parts, path = [], best[1]
    while path:
        path, written = path
        parts.append(written)
    return "".join(reversed(parts)).strip()


def disguised(token: str) -> bool:
    return " " in token or bool(_DISGUISED.search(token)) or bool(_SIGN.search(token) and _LETTERS.search(token))


def cores(token: str) -> list[str]:
    """A token without the signs around it; signs that may stand for letters are kept on both sides, on either and on none."""
    wide = token.strip(_PLAIN_EDGES)
    return list(dict.fromkeys((token.strip(_EDGES), wide.rstrip(_EDGES), wide.lstrip(_EDGES), wide)))


class Reader:
    """Words of tokens, disguised ones restored; remembers those met lately.

    With ``features``, tokens none of whose readings can reach one of them are not decoded: what they would give is asked for by nobody.
    """

    def __init__(self, model: np.ndarray, features: Iterable[str] | None = None):
        self.model, self.known = model.ravel().tolist(), {}
        self.tree = None if features is None else prefix_tree(features)

    def words_of(self, token: str) -> tuple[str, ...]:
        known = self.known.get(token)
        if known is None:
            words = _LETTERS.findall(token)
            for core in cores(token):
                if disguised(core) and (self.tree is None or reachable(core, self.tree)):
                    words += _LETTERS.findall(restore(core, self.model))
            if len(self.known) >= 100_000:
                self.known.clear()
            known = self.known[token] = tuple(words)
        return known

    def features(self, token: str) -> set[str]:
        """Words of a token, and beginnings of its words (marked by a star)."""
        words = self.words_of(token)
        return set(words).union(w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n)

    @staticmethod
    def tokens(text: str | None) -> Counter[str]:
        """Lower-case tokens with their counts; letters spaced apart also stand as one token."""
        if not text:
            return Counter()
        lowered = text.lower()
        found = Counter(lowered.split())
        found.update(m.group(0) for m in _SPACED.finditer(lowered))
        return found


def presence_and_density(count: int, n_tokens: int) -> tuple[float, float]:
    """How a feature enters the model: whether it is there, and how densely, up to 1."""
    return float(count > 0), min(1.0, 100 * count / (n_tokens + 50))


@dataclass
class Model:
    """Everything scoring needs; as large as the vocabulary of the sample's toxic rows at most."""

    characters: np.ndarray
    lexicon: dict[str, tuple[float, float]]  # weights of presence and density
    bias: float


def _fit(rows: list[tuple[int, int, list[int], list[int]]], size: int) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty by Newton steps; rows are (label, tokens, features, counts).

    Rows are kept sparse and each step is solved by conjugate gradients, so memory follows the features that are there.
    """
    y = np.array([r[0] for r in rows], float)
    sizes = np.array([len(r[2]) for r in rows])
    feature = np.fromiter((j for r in rows for j in r[2]), np.int64, int(sizes.sum()))
    dense = np.fromiter((presence_and_density(k, r[1])[1] for r in rows for k in r[3]), float, len(feature))
    row, width = np.repeat(np.arange(len(rows)), sizes), 2 * size + 1

    def times(w):
        return np.bincount(row, w[2 * feature] + dense * w[2 * feature + 1], len(rows)) + w[-1]

    def back(v):
        out = np.zeros(width)
        out[:-1:2], out[1::2] = np.bincount(feature, v[row], size), np.bincount(feature, dense * v[row], size)
        out[-1] = v.sum()
        return out

    w = np.zeros(width)
    penalty = np.full(width, 0.01)
    penalty[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        spread = p * (1 - p) + 1e-6
        diagonal = penalty.copy()
        diagonal[:-1:2] += np.bincount(feature, spread[row], size)
        diagonal[1::2] += np.bincount(feature, dense * dense * spread[row], size)
        diagonal[-1] += spread.sum()
        step, left = np.zeros(width), back(p - y) + penalty * w
        ahead = left / diagonal
        least, norm = 1e-16 * float(left @ ahead), float(left @ ahead)
        for _ in range(width + 100):
            if norm <= least:
                break
            moved = back(spread * times(ahead)) + penalty * ahead
            by = norm / float(ahead @ moved)
            step += by * ahead
            left -= by * moved
            turned = left / diagonal
            before, norm = norm, float(left @ turned)
            ahead = turned + norm / before * ahead
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1].reshape(-1, 2), float(w[-1])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the rows whose id is not held out.

    Equal texts count once. Labels of null and labels without a document are ignored; with no usable label all scores are the same.
    """
    spark = docs.sparkSession
    training = docs.where(crc_mod("doc_id", HELD_OUT) != 0)
    characters = character_model(training)
    marked = labels.where((crc_mod("doc_id", HELD_OUT) != 0) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    sample = bounded_sample(marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id", LABELLED_ROWS)
    sent = spark.sparkContext.broadcast(({r["doc_id"]: int(r["toxic"]) for r in sample.collect()}, characters))

    def make():
        toxic, characters = sent.value
        reader = Reader(characters)

        def step(ids, hashes, texts):
            out = {"h": [], "toxic": [], "n": [], "found": []}
            for doc_id, h, text in zip(ids, hashes, texts):
                if doc_id in toxic:
                    out["h"].append(h)
                    out["toxic"].append(toxic[doc_id])
                    tokens, counts = reader.tokens(text), Counter()
                    for token, k in tokens.items():
                        for feature in reader.features(token):
                            counts[feature] += k
                    out["n"].append(sum(tokens.values()))
                    out["found"].append([{"feature": f, "k": k} for f, k in counts.items()])
            return out

        return step

    kind = "h bigint, toxic int, n int, found array<struct<feature: string, k: int>>"
    seen = write_once(map_batches(training, ["doc_id", F.xxhash64("text"), "text"], kind, make).groupBy("h").agg(
        F.max("toxic").alias("toxic"), F.first("n").alias("n"), F.first("found").alias("found")), "toxicity-sample")
    totals = seen.agg(F.sum("toxic").alias("n1"), F.count("*").alias("n")).first()
    n1, n0 = totals["n1"] or 0, (totals["n"] or 0) - (totals["n1"] or 0)
    if not n1 or not n0:
        return Model(characters, {}, math.log((n1 + 0.5) / (n0 + 0.5)))
    counted = seen.select("toxic", F.explode("found.feature").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("c1"), F.sum(1 - F.col("toxic")).alias("c0"))
    odds = F.log((F.col("c1") + 0.5) / (n1 - F.col("c1") + 0.5)) - F.log((F.col("c0") + 0.5) / (n0 - F.col("c0") + 0.5))
    spread = F.sqrt(1 / (F.col("c1") + 0.5) + 1 / (F.col("c0") + 0.5))
    chosen = counted.where(F.col("c1") >= LEAST_DOCS).withColumn("z", odds / spread).where(F.col("z") >= LEAST_Z).select(
        "feature").collect()
    place = {f: i for i, f in enumerate(sorted(r["feature"] for r in chosen))}
    listed = spark.sparkContext.broadcast(place)

    def known():
        place = listed.value

        def step(toxic, tokens, features, counts):
            on = [[(place[f], k) for f, k in zip(fs, ks) if f in place] for fs, ks in zip(features, counts)]
            return {"toxic": toxic, "n": tokens, "features": [[j for j, _ in x] for x in on], "counts": [[k for _, k in x] for x in on]}

        return step

    marks = map_batches(seen, ["toxic", "n", F.col("found.feature").alias("features"), F.col("found.k").alias("counts")],
                        "toxic int, n int, features array<int>, counts array<int>", known)
    rows = [(r["toxic"], r["n"], r["features"], r["counts"]) for r in marks.collect()]
    weights, bias = _fit(rows, len(place))
    return Model(characters, {f: (float(weights[i, 0]), float(weights[i, 1])) for f, i in place.items()}, bias)


def _scorer(model: Model):
    reader = Reader(model.characters, model.lexicon)
    weight = model.lexicon
    hits: dict[str, tuple[str, ...]] = {}
    misses: set[str] = set()
    short, long = BEGINNINGS

    def known_features(token: str) -> tuple[str, ...]:
        """The token's features that the model knows, as ``reader.features`` has them; a plain word needs no look at its signs."""
        word = token.strip(_PLAIN_EDGES)
        if not word.isalpha() or _DISGUISED.search(word) and reachable(word, reader.tree):
            return tuple(f for f in reader.features(token) if f in weight)
        n = len(word)
        found = (word, word[:short] + "*") if n > short else (word,)
        return tuple(f for f in (*found, word[:long] + "*") if f in weight) if n > long else tuple(f for f in found if f in weight)

    def score(text: str | None) -> float:
        tokens = reader.tokens(text)
        counts: Counter[str] = Counter()
        for token in tokens.keys() - misses:
            found = hits.get(token)
            if found is None:
                found = known_features(token)
                if not found:
                    if len(misses) >= 200_000:
                        misses.clear()
                    misses.add(token)
                    continue
                hits[token] = found
            for feature in found:
                counts[feature] += tokens[token]
        n, total = sum(tokens.values()), model.bias
        for feature in sorted(counts):
            here, dense = presence_and_density(counts[feature], n)
            total += weight[feature][0] * here + weight[feature][1] * dense
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))

    return score


def score_documents(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, score and predicted of every row; null text scores as the empty text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")

    def make():
        score = _scorer(sent.value)

        def step(texts, *kept):
            scores = [score(t) for t in texts]
            return {"score": scores, "predicted": [int(s >= 0.5) for s in scores]} | dict(zip(keep, kept))

        return step

    return map_batches(docs, [F.col("text"), *keep], schema, make)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``; other columns of the documents are not read.

    A null id counts as training text. Empty tables train a model without words; repeated rows are scored each.
    """
    scored = score_documents(docs, train(docs, labels))
    return scored.select("doc_id", (crc_mod("doc_id", HELD_OUT) == 0).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, unchanged."""
    columns = tuple(docs.columns)
    return score_documents(docs, train(docs, labels), columns).where("predicted = 0").select(*columns)

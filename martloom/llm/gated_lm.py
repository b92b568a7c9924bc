"""Scoring documents with a gated recurrent language model.

The model is a GRU over words with a class-factored softmax, trained by truncated backpropagation; its state is
carried from window to window, so a document's score is the log-likelihood of the whole text.

Words are counted over all training documents. The ``HEAD`` most frequent ones are told apart by the network, in classes
of ``CLASS``. The next ones up to ``HEAVY`` form classes by frequency, and all others one last class; inside these a
word has its share of the counts. Every word, and one place for all unknown ones, thus has a probability.

Learners are the tasks that hold the training documents: each starts from the same weights, takes gradient steps
on its own documents, and the weights are averaged in a tree, weighted by tokens. What reaches the driver is one set of
weights and the ``HEAVY`` most frequent words, whatever the size of the corpus.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import crc_mod, crc_of, map_batches
from martloom.session import write_once

HELD_OUT = 10
SMOOTH = 0.1
HEAD, CLASS, HEAVY = 1024, 32, 65_536
BUCKETS = 1024  # inputs of words outside the head, by their last letters
HIDDEN = 24
LANES, WINDOW, LEARN_TOKENS = 128, 20, 1_000_000  # texts side by side, steps between updates, tokens laid out at a time while learning
LONGER = 8  # a window takes up to so many times its steps where few long texts still run
SCORE_LANES, SCORE_WINDOW, CHUNK_TOKENS = 256, 32, 5_000_000
CHUNK_CHARS = 4_000_000  # texts are split together up to this size
# Of each round: one of how many training documents takes part (another each round), and the step size. The rounds
# together take every training document once.
ROUNDS = ((3, 0.01), (3, 0.006), (3, 0.003))
AVERAGE_WIDTH = 16
END = ""


def _is_training():
    return crc_mod("doc_id", HELD_OUT) != 0


def _in_chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in order, up to ``CHUNK_CHARS`` at a time; a longer one stands alone."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text or "") > CHUNK_CHARS:
            yield texts[begin:i]
            begin, size = i, 0
        size += len(text or "")
    if texts:
        yield texts[begin:]


def _split(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """All texts' tokens, ends included, as codes one after another; where each text ends; the distinct words by code.

    The words are those of ``space_words``, split and numbered by Arrow. The end is code 0.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(pc.ascii_lower(pa.array(texts, pa.large_string())), ""))
    encoded = lists.flatten().cast(pa.large_binary()).dictionary_encode()
    codes, distinct = encoded.indices.to_numpy() + 1, encoded.dictionary
    # White space at a text's border leaves an empty word, which is none.
    empty = pc.index(distinct, pa.scalar(b"", pa.large_binary())).as_py()
    real = codes != empty + 1 if empty >= 0 else np.ones(len(codes), bool)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    before = np.concatenate([[0], np.cumsum(real)])
    ends = before[bounds[1:] - bounds[0]] + np.arange(1, len(texts) + 1)  # each text's end takes a place
    if empty >= 0:
        codes, distinct = codes[real], pa.concat_arrays([distinct[:empty], distinct[empty + 1:]])
        codes -= codes > empty
    out = np.zeros(int(ends[-1]), np.int32)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[inner] = codes
    return out, ends, pa.concat_arrays([pa.array([b""], pa.large_binary()), distinct])


def _strings(words: list[pa.Array]) -> pa.Array:
    return pa.concat_arrays([w.cast(pa.binary()).cast(pa.string()) for w in words])


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over the documents; the end of a text is the empty word. Tasks count before anything is moved."""
    def make():
        def step(texts):
            found = [(words, np.bincount(codes, minlength=len(words))) for codes, _, words in map(_split, _in_chunks(texts))]
            return {"word": _strings([words for words, _ in found]), "n": np.concatenate([n for _, n in found])}

        return step

    return map_batches(docs, ["text"], "word string, n bigint", make).groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """What the driver knows of the counts: the heavy words by rank, and the totals."""

    def __init__(self, heavy: list[tuple[str, int]], tokens: int, distinct: int, end: int):
        ranked = [(END, end), *[x for x in heavy if x[0] != END]]
        self.tokens, self.distinct = tokens, distinct
        self.rank = {w.encode(): i for i, (w, _) in enumerate(ranked)}
        self.heavy = pa.array(list(self.rank), pa.large_binary())
        self.counts = np.array([n for _, n in ranked], float)
        n, head = len(ranked), min(HEAD, len(ranked))
        self.head_classes = -(-head // CLASS)
        ranks = np.arange(n)
        self.class_of = np.where(ranks < HEAD, ranks // CLASS, self.head_classes + np.log2(np.maximum(ranks, HEAD) // HEAD).astype(int)).astype(np.int32)
        self.rare_class = int(self.class_of.max()) + 1
        self.classes = self.rare_class + 1
        mass = np.bincount(self.class_of, self.counts + SMOOTH, self.classes)
        # The last class: known words beyond the heavy ones, and the unknown.
        mass[self.rare_class] = max(tokens - self.counts.sum(), 0) + SMOOTH * (max(distinct - (self.counts > 0).sum(), 0) + 1)
        self.mass = mass
        self.share = np.log((self.counts + SMOOTH) / mass[self.class_of])
        self.head = head
        self.row_of = np.array([i if i < HEAD else self._bucket(w) for w, i in self.rank.items()], np.int32)

    @staticmethod
    def _bucket(word: bytes) -> int:
        return HEAD + zlib.crc32(word[-3:]) % BUCKETS

    def inputs(self, ranks: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Input row of each word: its own in the head, else by its last letters."""
        out = self.row_of[ranks]
        rare = np.flatnonzero(ranks < 0)
        out[rare] = [self._bucket(words[i]) for i in rare.tolist()]
        return out


def count_words(docs: DataFrame) -> tuple[DataFrame, Words]:
    """The counts of the training documents as a table, and their bounded summary."""
    counts = write_once(word_counts(docs.where(_is_training())), "word-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == END, F.col("n"))).alias("e")).first()
    # Sixteen steps to a doubling: a few hundred rows tell from which count on there are at most HEAVY words.
    step = F.floor(F.log2("n") * 16)
    least, held = None, 0
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n")).orderBy(F.desc("step")).collect():
        held += r["words"]
        if held > HEAVY:
            break
        least = r["n"]
    heavy = counts.where(F.col("n") >= least).collect() if least is not None else []
    ranked = sorted(((r["word"], r["n"]) for r in heavy), key=lambda x: (-x[1], x[0]))
    return counts, Words(ranked, total["n"] or 0, total["v"], total["e"] or 0)


@dataclass
class Text:
    """A text as arrays: rank of each token (-1: not heavy) and its input row; the last token is the end."""

    ranks: np.ndarray
    inputs: np.ndarray


def as_texts(texts: list[str | None], known: Words) -> Iterator[Text]:
    """``as_text`` of each text's words; a word is looked up once for many texts."""
    for some in _in_chunks(texts):
        codes, ends, words = _split(some)
        ranks, inputs = _looked_up(words, known)
        ranks, inputs = ranks[codes], inputs[codes]
        for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
            yield Text(ranks[begin:end], inputs[begin:end])


def _looked_up(words: pa.Array, known: Words) -> tuple[np.ndarray, np.ndarray]:
    """Rank and input row of each word."""
    ranks = pc.fill_null(pc.index_in(words, known.heavy), -1).to_numpy(zero_copy_only=False)
    inputs, rare = known.row_of[ranks], np.flatnonzero(ranks < 0)
    ends = pc.binary_slice(words.take(pa.array(rare)).cast(pa.binary()), -3).dictionary_encode()  # few distinct ones
    inputs[rare] = np.array([known._bucket(end) for end in ends.dictionary.to_pylist()], np.int32)[ends.indices.to_numpy()]
    return ranks, inputs


def as_text(words: list[bytes], known: Words) -> Text:
    words = [*words, b""]
    get = known.rank.get
    ranks = np.array([get(w, -1) for w in words], np.int32)
    return Text(ranks, known.inputs(ranks, words))


class Lanes:
    """Texts laid end to end in lanes, longest lane first. Arrays are flat, step after step, and hold the lanes
    that still run at a step, so their size is the number of tokens whatever the longest text."""

    def __init__(self, texts: list[Text], lanes: int):
        heap = [(0, k) for k in range(min(lanes, len(texts)))]
        placed: list[list[int]] = [[] for _ in heap]
        for i in sorted(range(len(texts)), key=lambda i: (-len(texts[i].ranks), i)):
            size, k = heapq.heappop(heap)
            placed[k].append(i)
            heapq.heappush(heap, (size + len(texts[i].ranks), k))
        placed.sort(key=lambda p: -sum(len(texts[i].ranks) for i in p))
        lengths = np.array([sum(len(texts[i].ranks) for i in p) for p in placed])
        self.running = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
        self.begins = np.concatenate([[0], np.cumsum(self.running)])
        size = int(self.begins[-1])
        self.ranks, self.inputs = np.zeros(size, np.int32), np.zeros(size, np.int32)
        self.owner, self.fresh = np.zeros(size, np.int32), np.zeros(size, bool)
        for k, chosen in enumerate(placed):
            at = 0
            for i in chosen:
                places = self.begins[at:at + len(texts[i].ranks)] + k
                self.ranks[places] = texts[i].ranks
                self.inputs[places[1:]] = texts[i].inputs[:-1]  # the first input is the end's row, 0
                self.owner[places] = i
                self.fresh[places[0]] = True
                at += len(places)

    def windows(self, steps: int, tokens: int = 0) -> Iterator[range]:
        """Windows of so many steps; of up to ``LONGER`` times as many where fewer lanes run, until they hold ``tokens``."""
        t = 0
        while t < len(self.running):
            enough = int(np.searchsorted(self.begins, self.begins[t] + tokens))
            end = min(max(t + steps, min(enough, t + LONGER * steps)), len(self.running))
            yield range(t, end)
            t = end

    def flat(self, window: range) -> slice:
        return slice(int(self.begins[window.start]), int(self.begins[window.stop]))


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(logits: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In place of the logits, their exponents; each row's sum, and the log-probability of its chosen column."""
    top = logits.max()
    if top - logits.min() < 80:  # one shift serves all rows: nothing overflows, and no row vanishes
        logits -= top
    else:
        logits -= logits.max(axis=1, keepdims=True)
    score = logits[np.arange(len(logits)), chosen]
    p = np.exp(logits, out=logits)
    total = p @ np.ones(p.shape[1], p.dtype)
    return p, total, score - np.log(total)


class Model:
    """The network's weights; ``rows`` is the input table, already multiplied into the gates."""

    NAMES = ("rows", "rec", "to_class", "class_bias", "to_word", "word_bias")

    def __init__(self, weights: dict[str, np.ndarray], known: Words):
        self.w, self.known = weights, known

    @classmethod
    def fresh(cls, known: Words, seed: int = 11) -> Model:
        """Starts as the unigram model: only the biases speak, the rest is small noise."""
        rng = np.random.default_rng(seed)
        noise = lambda *shape, by=0.1: rng.normal(0, by, shape).astype(np.float32)
        word_bias = np.full((known.head_classes, CLASS), -30, np.float32)
        word_bias.reshape(-1)[:known.head] = known.share[:known.head]
        return cls({"rows": noise(HEAD + BUCKETS, 3 * HIDDEN, by=0.3), "rec": noise(HIDDEN, 3 * HIDDEN, by=HIDDEN ** -0.5),
                    "to_class": noise(HIDDEN, known.classes, by=0.01), "class_bias": np.log(known.mass / known.mass.sum()).astype(np.float32),
                    "to_word": noise(known.head_classes, HIDDEN, CLASS, by=0.01), "word_bias": word_bias}, known)

    def pack(self) -> bytes:
        return b"".join(self.w[k].astype("<f4").tobytes() for k in self.NAMES)

    def unpack(self, data: bytes) -> Model:
        flat, at, out = np.frombuffer(data, "<f4"), 0, {}
        for k in self.NAMES:
            size = self.w[k].size
            out[k] = flat[at:at + size].reshape(self.w[k].shape).copy()
            at += size
        return Model(out, self.known)

    def outputs(self, h: np.ndarray, ranks: np.ndarray, learn: bool = False):
        """Natural log-probabilities of the tokens after the states ``h`` (of a rare one: its class alone), and gradients."""
        known = self.known
        classes = np.where(ranks >= 0, known.class_of[ranks], known.rare_class)
        logits = h @ self.w["to_class"]
        logits += self.w["class_bias"]
        p, total, score = _softmax(logits, classes)
        rows = np.arange(len(h))
        grads, dh = {}, None
        if learn:
            p /= total[:, None]
            p[rows, classes] -= 1
            grads = {"to_class": h.T @ p, "class_bias": p.sum(axis=0), "to_word": np.zeros_like(self.w["to_word"]), "word_bias": np.zeros_like(self.w["word_bias"])}
            dh = p @ self.w["to_class"].T
        banded = (classes >= known.head_classes) & (ranks >= 0)
        score[banded] += known.share[ranks[banded]]
        # Words of the head stand by class, so that each class is one product and all else is done for all of them at once.
        order = np.argsort(classes.astype(np.int16), kind="stable")
        edges = np.searchsorted(classes[order], np.arange(known.head_classes + 1)).tolist()
        order = order[:edges[-1]]
        spans = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
        sorted_h, place, rows = h[order], ranks[order] % CLASS, rows[:len(order)]
        logits = np.empty((len(order), CLASS), h.dtype)
        for c, at in spans:
            np.matmul(sorted_h[at], self.w["to_word"][c], out=logits[at])
            logits[at] += self.w["word_bias"][c]
        if len(order):
            q, total, inside = _softmax(logits, place)
            score[order] += inside
        if learn and len(order):
            q /= total[:, None]
            q[rows, place] -= 1
            back = np.empty_like(sorted_h)
            for c, at in spans:
                np.matmul(sorted_h[at].T, q[at], out=grads["to_word"][c])
                q[at].sum(axis=0, out=grads["word_bias"][c])
                np.matmul(q[at], self.w["to_word"][c].T, out=back[at])
            dh[order] += back
        return score, grads, dh

    def window(self, lanes: Lanes, window: range, state: np.ndarray, learn: bool = False):
        """States after each step of a window, one step's after another's; the trace for learning; the state carried on.

        A fresh text starts from nothing. Half the gates' sums go into tanh, which gives the sigmoid.
        """
        at = lanes.flat(window)
        size, kind = at.stop - at.start, self.w["rec"].dtype
        from_input, fresh = self.w["rows"][lanes.inputs[at]], lanes.fresh[at]
        to_gates, to_new = np.ascontiguousarray(from_input[:, :2 * HIDDEN]), np.ascontiguousarray(from_input[:, 2 * HIDDEN:])
        to_gates *= 0.5
        half, rest = self.w["rec"][:, :2 * HIDDEN] * kind.type(0.5), np.ascontiguousarray(self.w["rec"][:, 2 * HIDDEN:])
        before, after, new = (np.empty((size, HIDDEN), kind) for _ in range(3))
        part = np.empty((size, HIDDEN), kind)
        starts = np.add.reduceat(fresh, lanes.begins[window.start:window.stop] - at.start) > 0
        h = state
        for t, any_fresh in zip(window, starts.tolist()):
            n, begin = int(lanes.running[t]), int(lanes.begins[t]) - at.start
            here = slice(begin, begin + n)
            then = before[here]
            then[...] = h[:n]
            if any_fresh:
                then[fresh[here]] = 0
            gates = to_gates[here]
            gates += then @ half
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            state_part = np.matmul(then, rest, out=part[here])
            value = np.multiply(gates[:, :HIDDEN], state_part, out=new[here])
            value += to_new[here]
            np.tanh(value, out=value)
            h = np.subtract(then, value, out=after[here])
            h *= gates[:, HIDDEN:]
            h += value
        return after, (before, to_gates, new, part, fresh, starts) if learn else None, h

    def score(self, texts: list[Text]) -> np.ndarray:
        """Natural log-likelihood of each text, less the shares of its rare words inside their class."""
        total = np.zeros(len(texts))
        if not texts:
            return total
        lanes = Lanes(texts, SCORE_LANES)
        state = np.zeros((lanes.running[0], HIDDEN), np.float32)
        for window in lanes.windows(SCORE_WINDOW, SCORE_LANES * SCORE_WINDOW // 4):
            flat, _, state = self.window(lanes, window, state)
            at = lanes.flat(window)
            score, _, _ = self.outputs(flat, lanes.ranks[at])
            total += np.bincount(lanes.owner[at], score, len(texts))
        return total

    def gradients(self, lanes: Lanes, window: range, state: np.ndarray):
        """Scores and gradients of a window by backpropagation to its first step, the state carried on, the tokens."""
        flat, (before, gates, new, part, fresh, starts), carried = self.window(lanes, window, state, learn=True)
        at = lanes.flat(window)
        score, grads, dh_flat = self.outputs(flat, lanes.ranks[at], learn=True)
        # What a change of the state is multiplied by on its way to each sum, for the whole window at once.
        reset, keep = np.ascontiguousarray(gates[:, :HIDDEN]), np.ascontiguousarray(gates[:, HIDDEN:])
        by_new = (1 - keep) * (1 - new * new)
        by_keep = (before - new) * keep * (1 - keep)
        by_reset = by_new * part * reset * (1 - reset)
        by_part = by_new * reset
        d_state, back = np.empty((len(flat), 3 * HIDDEN), flat.dtype), np.ascontiguousarray(self.w["rec"].T)
        dh = None
        for t, any_fresh in zip(reversed(window), reversed(starts.tolist())):
            begin, n = int(lanes.begins[t]) - at.start, int(lanes.running[t])
            here = slice(begin, begin + n)
            d = dh_flat[here]
            if dh is not None:
                d[:len(dh)] += dh
            to = d_state[here]
            np.multiply(d, by_reset[here], out=to[:, :HIDDEN])
            np.multiply(d, by_keep[here], out=to[:, HIDDEN:2 * HIDDEN])
            np.multiply(d, by_part[here], out=to[:, 2 * HIDDEN:])
            dh = to @ back
            dh += d * keep[here]
            if any_fresh:
                dh[fresh[here]] = 0
        grads["rec"] = before.T @ d_state
        to_rows = d_state
        np.multiply(dh_flat, by_new, out=to_rows[:, 2 * HIDDEN:])
        inputs = lanes.inputs[at]
        order = np.argsort(inputs, kind="stable")
        which, starts = np.unique(inputs[order], return_index=True)
        grads["rows"] = (which, np.add.reduceat(to_rows[order], starts, axis=0))
        return score, {k: (g if k == "rows" else g / len(flat)) for k, g in grads.items()}, carried, len(flat)


class Learner:
    """Adam steps over windows of texts, starting from given weights."""

    def __init__(self, model: Model, rate: float):
        self.model, self.rate, self.tokens, self.steps = model, rate, 0, 0
        self.first = {k: np.zeros_like(v) for k, v in model.w.items()}
        self.second = {k: np.zeros_like(v) for k, v in model.w.items()}

    def learn(self, texts: list[Text]) -> float:
        """One pass over the texts; the mean natural log-probability of a token on the way."""
        lanes = Lanes(texts, LANES)
        state, total, tokens = np.zeros((lanes.running[0], HIDDEN), np.float32), 0.0, 0
        for window in lanes.windows(WINDOW, LANES * WINDOW):
            score, grads, state, n = self.model.gradients(lanes, window, state)
            total, tokens = total + float(score.sum()), tokens + n
            self.steps += 1
            which, summed = grads.pop("rows")
            # A window with few tokens is a noisy guide, and moves the weights less.
            rate = self.rate * min(1.0, self.steps / 20, (n / (LANES * WINDOW)) ** 0.5)
            self._move("rows", summed / n, which, rate)
            for k, g in grads.items():
                self._move(k, g, slice(None), rate)
        self.tokens += tokens
        return total / max(1, tokens)

    def _move(self, name: str, gradient: np.ndarray, at, rate: float) -> None:
        first, second = self.first[name][at], self.second[name][at]
        first *= 0.9
        first += 0.1 * gradient
        second *= 0.99
        gradient = gradient * gradient
        gradient *= 0.01
        second += gradient
        root = np.sqrt(second, out=gradient)
        root += 1e-7
        move = first / root
        move *= rate
        self.model.w[name][at] -= move
        if not isinstance(at, slice):  # else they are the held arrays themselves
            self.first[name][at], self.second[name][at] = first, second


def _averaged(learned: DataFrame, fallback: bytes) -> bytes:
    """Weights averaged by tokens, in a tree of narrow steps."""
    def make():
        held: list = [None, 0]

        def step(weights, tokens):
            for data, n in zip(weights, tokens):
                part = np.frombuffer(data, "<f4").astype(float) * n
                held[0] = part if held[0] is None else held[0] + part
                held[1] += n

        step.finish = lambda: {"weights": [(held[0] / held[1]).astype("<f4").tobytes()], "tokens": [held[1]]} if held[1] else None
        return step

    width = learned.count()
    while width > 1:
        width = -(-width // AVERAGE_WIDTH)
        learned = map_batches(learned.repartition(width), ["weights", "tokens"], learned.schema, make)
    row = learned.first()
    return bytes(row["weights"]) if row else fallback


def train(docs: DataFrame, known: Words, rounds: tuple[tuple[int, float], ...] = ROUNDS) -> Model:
    """Rounds of learning and averaging over the training documents."""
    spark = docs.sparkSession
    model = Model.fresh(known)
    for turn, (share, rate) in enumerate(rounds):
        sent = spark.sparkContext.broadcast(model)

        def make(sent=sent, share=share, rate=rate, turn=turn):
            learner = Learner(Model({k: v.copy() for k, v in sent.value.w.items()}, sent.value.known), rate)
            waiting: list[Text] = []
            size = [0]

            def use():
                if waiting:
                    learner.learn(waiting)
                    waiting.clear()
                    size[0] = 0

            def step(texts):
                for text in as_texts(texts, learner.model.known):
                    waiting.append(text)
                    size[0] += len(text.ranks)
                    if size[0] >= LEARN_TOKENS:
                        use()

            def finish():
                use()
                return {"weights": [learner.model.pack()], "tokens": [learner.tokens]} if learner.tokens else None

            step.finish = finish
            return step

        part = docs.where(_is_training() & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == turn % share))
        learned = write_once(map_batches(part, ["text"], "weights binary, tokens bigint", make), "learned")
        model = model.unpack(_averaged(learned, model.pack()))
        sent.unpersist()
    return model


LN10 = float(np.log(10))


def score_documents(docs: DataFrame, rounds: tuple[tuple[int, float], ...] = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    A null text is the empty text: its only token is the end. A null id counts as training. Repeated rows count and are scored
    each. Without training documents all words are unknown and both scores are those of a single certain outcome per class.
    """
    counts, known = count_words(docs)
    sent = docs.sparkSession.sparkContext.broadcast((known, train(docs, known, rounds).w))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        known, weights = sent.value
        model = Model(weights, known)
        logs = np.log10(known.counts + SMOOTH)
        state = {"key": TaskContext.get().partitionId() << 40}

        def step(ids, texts):
            parts: dict[str, list] = {k: [] for k in ("n_tokens", "n_heavy", "n_rare", "heavy_log", "model_log")}
            rare_words, rare_counts, rare_ends, held = [], [], [np.zeros(1, np.int64)], 0
            waiting, size = [], 0
            for some in _in_chunks(texts):
                codes, ends, words = _split(some)
                rank_of, input_of = _looked_up(words, known)
                ranks, inputs = rank_of[codes], input_of[codes]
                begins = np.concatenate([[0], ends[:-1]])
                heavy = ranks >= 0
                parts["n_tokens"].append(ends - begins)
                parts["n_heavy"].append(np.add.reduceat(heavy & (known.counts[ranks] > 0), begins, dtype=np.int64))
                parts["n_rare"].append(ends - begins - np.add.reduceat(heavy, begins, dtype=np.int64))
                parts["heavy_log"].append(np.add.reduceat(np.where(heavy, logs[ranks], 0.0), begins))
                at = np.flatnonzero(~heavy)
                pairs, times = np.unique(np.searchsorted(ends, at, "right") * len(words) + codes[at], return_counts=True)
                rare_words.append(words.take(pa.array(pairs % len(words))))
                rare_counts.append(times.astype(np.int64))
                rare_ends.append(held + np.searchsorted(pairs // len(words), np.arange(len(some)), "right"))
                held += len(pairs)
                waiting += [Text(ranks[a:b], inputs[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                size += len(ranks)
                if size >= CHUNK_TOKENS:
                    parts["model_log"].append(model.score(waiting) / LN10)
                    waiting, size = [], 0
            parts["model_log"].append(model.score(waiting) / LN10)
            out = {k: np.concatenate(v) for k, v in parts.items()}
            out |= {"key": np.arange(len(ids)) + state["key"], "doc_id": ids, "held_out": [crc_of(i) % HELD_OUT == 0 for i in ids]}
            state["key"] += len(ids)
            ends = pa.array(np.concatenate(rare_ends), pa.int32())
            out["words"] = pa.ListArray.from_arrays(ends, _strings(rare_words))
            out["times"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(rare_counts), pa.int64()))
            return out

        return step

    scored = write_once(map_batches(
        docs, ["doc_id", "text"], f"key bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_heavy bigint, n_rare bigint, heavy_log double, "
        "model_log double, words array<string>, times array<bigint>", make), "scored")
    rare = scored.select("key", F.explode(F.arrays_zip("words", "times")).alias("x")).select("key", F.col("x.words").alias("word"), "x.times")
    # A word beyond the heavy ones holds a small share of the tokens at most, so no key of this join is hot.
    looked_up = rare.join(counts.select(F.col("word").alias("known_word"), "n"), F.col("word") == F.col("known_word"), "left")
    sums = looked_up.groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("rare_log"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known")).withColumnRenamed("key", "rare_key")
    joined = scored.drop("words", "times").join(sums, F.col("key") == F.col("rare_key"), "left")
    every = float(np.log10(known.tokens + SMOOTH * (known.distinct + 1)))
    in_class = float(np.log10(known.mass[known.rare_class]))
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_heavy") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (F.col("heavy_log") + rare_log - F.col("n_tokens") * F.lit(every)).alias("base_score"),
        (F.col("model_log") + rare_log - F.col("n_rare") * F.lit(in_class)).alias("score"))

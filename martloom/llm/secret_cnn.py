"""Secret scanning: plain rules, and a character convolutional network over every other candidate.

Rules mark assignments, access keys and long hex runs. Every further run of key-like characters that mixes
letters and digits is a candidate; the network reads it together with the text around it. It is trained
in numpy on labelled findings rendered from known secret and harmless shapes, its scores are calibrated on
held-out findings, and the threshold is the highest that still keeps ``RECALL`` of the held-out secrets.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_batches, sha256_hex

KINDS = ("assign", "access", "hex", "learned")
# The rules.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=~-]{16,}")
LEFT, INNER, RIGHT = 24, 48, 8  # characters read before, inside and after; longer candidates are read in pieces
WIDTH = LEFT + INNER + RIGHT
STEP = 32
SYMBOLS = 1 + 95 + 2  # nothing, printable ASCII, line ends, all others
EMBED, KERNEL, FILTERS = 8, 5, 24
EXAMPLES, EPOCHS, RECALL = 4000, 6, 0.98


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the rules' findings, in order."""
    found = []
    lowered = text.lower()
    if any(h in lowered for h in _HINTS):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Key-like runs with letters and digits, and what rule findings leave of them. Both lists are in order and read once."""
    out, first = [], 0
    for m in _CANDIDATE.finditer(text):
        at, pieces = m.start(), []
        while first < len(taken) and taken[first][1] <= at:
            first += 1
        for i in range(first, len(taken)):
            s, e, _ = taken[i]
            if s >= m.end():
                break
            if at < e:
                pieces.append((at, s))
                at = e
        for start, end in [*pieces, (at, m.end())]:
            piece = text[start:end]
            run = piece.strip(".=-/_")
            if not (re.search(r"[0-9]", run) and re.search(r"[A-Za-z]", run)) or len(run) < 16:
                continue
            start += piece.index(run)
            out.append((start, start + len(run)))
    return out


def encode(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where((codes >= 32) & (codes < 127), codes - 31, np.where((codes == 10) | (codes == 13), 96, 97)).astype(np.uint8)


def windows(text: str, start: int, end: int) -> np.ndarray:
    """The candidate and its surroundings as symbol rows; a long candidate gives several."""
    rows = []
    for at in range(start, max(start + 1, end - INNER + STEP), STEP):
        stop = min(end, at + INNER)
        left, right = text[max(0, at - LEFT):at], text[stop:stop + RIGHT]
        row = np.zeros(WIDTH, np.uint8)
        row[LEFT - len(left):LEFT] = encode(left)
        row[LEFT:LEFT + stop - at] = encode(text[at:stop])
        row[LEFT + INNER:LEFT + INNER + len(right)] = encode(right)
        rows.append(row)
    return np.stack(rows)


@dataclass
class Network:
    """Embedding, one convolution, maxima over the three zones, a linear output, and its calibration."""

    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    offset: float
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5

    def _convolve(self, rows: np.ndarray):
        x = self.embed[rows].reshape(len(rows), -1)
        columns = np.lib.stride_tricks.sliding_window_view(x, KERNEL * EMBED, axis=1)[:, ::EMBED]
        return columns, np.maximum(columns @ self.kernel + self.bias, 0)

    @staticmethod
    def zones() -> list[tuple[int, int]]:
        return [(0, LEFT - KERNEL + 1), (LEFT - KERNEL + 1, LEFT + INNER - KERNEL + 1), (LEFT + INNER - KERNEL + 1, WIDTH - KERNEL + 1)]

    def _pool(self, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima and where they stand; the inner zone also gives its mean."""
        at = np.stack([a + active[:, a:b].argmax(axis=1) for a, b in self.zones()], axis=1)
        best = np.take_along_axis(active, at, axis=1)
        a, b = self.zones()[1]
        return np.concatenate([best.reshape(len(active), -1), active[:, a:b].mean(axis=1)], axis=1), at

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(rows), 256):
            _, active = self._convolve(rows[i:i + 256])
            out.append(self._pool(active)[0] @ self.out + self.offset)
        return np.concatenate(out) if out else np.empty(0)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.logits(rows) + b, -30, 30)))

    def gradients(self, rows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        columns, active = self._convolve(rows)
        pooled, at = self._pool(active)
        error = (1 / (1 + np.exp(-np.clip(pooled @ self.out + self.offset, -30, 30))) - labels) / len(rows)
        back = error[:, None] * self.out
        spread = np.zeros_like(active)
        np.put_along_axis(spread, at, back[:, :3 * FILTERS].reshape(len(rows), 3, FILTERS), axis=1)
        a, b = self.zones()[1]
        spread[:, a:b] += back[:, None, 3 * FILTERS:] / (b - a)
        spread *= active > 0
        flat = spread.reshape(-1, FILTERS)
        to_kernel = columns.reshape(-1, KERNEL * EMBED).T @ flat
        to_columns = (flat @ self.kernel.T).reshape(len(rows), -1, KERNEL, EMBED)
        to_embed = np.zeros_like(self.embed)
        for k in range(KERNEL):
            np.add.at(to_embed, rows[:, k:k + to_columns.shape[1]], to_columns[:, :, k])
        return [to_embed, to_kernel, flat.sum(axis=0), pooled.T @ error, np.array(error.sum())]


def _render(rng: np.random.Generator) -> tuple[str, int, int, int]:
    """A labelled finding: text, start, end, label."""
    pick = lambda pool, n: "".join(rng.choice(list(pool), n))
    word = lambda: pick("etaoinshrdlucmfy", int(rng.integers(2, 9)))
    alnum, upper, low = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, string.ascii_lowercase
    before, after = " ".join(word() for _ in range(rng.integers(0, 6))), " ".join(word() for _ in range(rng.integers(0, 3)))
    label = int(rng.random() < 0.5)
    if label:
        shapes = [
            lambda: ("ghp_" + pick(alnum, 36), ""), lambda: ("sk_live_" + pick(alnum, 24), ""), lambda: ("xoxb-" + pick(string.digits, 11) + "-" + pick(alnum, 24), ""),
            lambda: (pick(alnum + "+/", int(rng.integers(32, 60))), rng.choice(["", "key: ", "Authorization: Bearer ", "credential="])),
            lambda: ("eyJ" + pick(alnum, 20) + "." + pick(alnum + "_-", 40) + "." + pick(alnum + "_-", 30), rng.choice(["", "Bearer "])),
            lambda: (pick(alnum, int(rng.integers(20, 44))), rng.choice(["auth = ", "pwd=", "private_key: ", "access key ", "client_id="])),
            lambda: ("AIza" + pick(alnum + "_-", 35), ""), lambda: ("glpat-" + pick(alnum + "_-", 20), ""), lambda: ("SG." + pick(alnum, 22) + "." + pick(alnum, 43), ""),
        ]
        token, lead = shapes[rng.integers(len(shapes))]()
    else:
        shapes = [
            lambda: (f"mail{rng.integers(100)}.{word()}.{rng.choice(['com', 'org', 'net'])}", rng.choice(["@", "", word() + "@"])),
            lambda: (f"www.{word()}{rng.integers(1000)}.{word()}.org/{word()}/{rng.integers(9999)}", rng.choice(["http://", ""])),
            lambda: ("-".join(pick("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)), rng.choice(["id ", "uuid: ", ""])),
            lambda: (f"20{rng.integers(10, 30)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}T{rng.integers(24):02d}.{rng.integers(60):02d}.00Z", ""),
            lambda: (f"{word()}-{word()}-{word()}_{rng.integers(100)}.{rng.choice(['txt', 'py', 'html', 'tar.gz'])}", rng.choice(["", "file "])),
            lambda: (word() + word() + word() + rng.choice([".", "-", ""]) + str(rng.integers(10000)), ""),
            lambda: (str(rng.integers(1000)) + rng.choice(["", ".", "-"]) + word() + word() + word() + word(), ""),
            lambda: (pick("0123456789ABCDEF", 40), rng.choice(["fingerprint ", "", "sha1 "])),
            lambda: (f"{word().title()}{word().title()}{word().title()}{rng.integers(100)}", ""), lambda: (f"version-{rng.integers(10)}.{rng.integers(30)}.{rng.integers(99)}-{word()}", ""),
            lambda: ("+".join(word() for _ in range(4)) + str(rng.integers(10)), ""), lambda: (f"{pick(upper, 2)}{pick(string.digits, 20)}", rng.choice(["IBAN ", ""])),
            lambda: ("/".join(pick(low, int(rng.integers(2, 8))) for _ in range(4)) + f"/{rng.integers(3000)}", ""),
        ]
        token, lead = shapes[rng.integers(len(shapes))]()
    quote = rng.choice(["", "", '"', "'"])
    head = (before + rng.choice([" ", "\n"]) if before else "") + lead + quote
    return head + token + quote + rng.choice([" ", ". ", "\n"]) + after, len(head), len(head) + len(token), label


@lru_cache(maxsize=1)
def train(seed: int = 7) -> Network:
    """Fit, calibrate and set the threshold; the same network every time. The examples are bounded by ``EXAMPLES``."""
    rng = np.random.default_rng(seed)
    made = [_render(rng) for _ in range(EXAMPLES)]
    rows = np.stack([windows(t, s, e)[0] for t, s, e, _ in made])
    labels = np.array([m[3] for m in made], float)
    cut = EXAMPLES * 3 // 4
    net = Network(rng.normal(0, 0.3, (SYMBOLS, EMBED)), rng.normal(0, (KERNEL * EMBED) ** -0.5, (KERNEL * EMBED, FILTERS)),
                  np.zeros(FILTERS), rng.normal(0, 0.1, 4 * FILTERS), 0.0)
    parts = [net.embed, net.kernel, net.bias, net.out, np.zeros(1)]
    first, second, t = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(EPOCHS):
        order = rng.permutation(cut)
        for i in range(0, cut, 64):
            at, t = order[i:i + 64], t + 1
            for k, g in enumerate(net.gradients(rows[at], labels[at])):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                parts[k] -= 0.01 * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
            net.offset = float(parts[4][0])
    logits, held = net.logits(rows[cut:]), labels[cut:]
    a, b = 1.0, 0.0
    for _ in range(300):  # calibration: logistic regression of the held-out labels on the logits
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        a, b = a - 0.05 * float(((p - held) * logits).mean()), b - 0.05 * float((p - held).mean())
    net.scale = (a, b)
    found = np.sort(net.probabilities(rows[cut:])[held == 1])
    net.threshold = float(found[int((1 - RECALL) * len(found))])
    return net


def spans_of(texts: list[str | None], net: Network) -> list[list[tuple[int, int, int]]]:
    """All findings of each text, in order of start and kind; a batch's candidates are scored together."""
    out, rows, owners = [], [], []
    for i, text in enumerate(texts):
        out.append(rule_spans(text) if text else [])
        for start, end in candidates(text, out[i]) if text else []:
            pieces = windows(text, start, end)
            rows.append(pieces)
            owners += [(i, start, end)] * len(pieces)
    if rows:
        scores = net.probabilities(np.concatenate(rows))
        found = {owner for owner, score in zip(owners, scores) if score >= net.threshold}
        for i, start, end in sorted(found):
            out[i].append((start, end, 3))
    return [sorted(s, key=lambda x: (x[0], x[2])) for s in out]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_assign, n_access, n_hex, base_sha256 and spans of every row, in one pass without a shuffle.

    Positions are code points. Null and empty texts have no findings and the digest of nothing. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train())
    schema = docs.select(*keep).schema
    for name in ("n_assign", "n_access", "n_hex"):
        schema = schema.add(name, "long")
    schema = schema.add("base_sha256", "string").add("spans", "string")

    def make():
        net = sent.value

        def step(texts, *kept):
            all_spans = spans_of(texts, net)
            count = lambda kind: [sum(k == kind for _, _, k in s) for s in all_spans]
            return {"n_assign": count(0), "n_access": count(1), "n_hex": count(2),
                    "base_sha256": [sha256_hex(joined([x for x in s if x[2] < 3]).encode()) for s in all_spans],
                    "spans": [joined(s) for s in all_spans]} | dict(zip(keep, kept))

        return step

    return map_batches(docs, [F.col("text"), *keep], schema, make)


MASK = "[secret]"


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each group of overlapping findings replaced by ``MASK``."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """All documents with their findings masked and n_chars following; a null text stays null."""
    sent = docs.sparkSession.sparkContext.broadcast(train())
    columns = docs.columns

    def make():
        net = sent.value

        def step(*lists):
            rows = dict(zip(columns, lists))
            texts = rows["text"]
            spans = spans_of(texts, net)
            rows["text"] = [masked(t, s) if s else t for t, s in zip(texts, spans)]
            if "n_chars" in rows:
                rows["n_chars"] = [len(t) if s else n for t, s, n in zip(rows["text"], spans, rows["n_chars"])]
            return rows

        return step

    return map_batches(docs, columns, docs.schema, make)

"""Packing documents into token sequences by linear grouping and best fit.

There are at most ``CAPACITY`` different lengths whatever the corpus, so the packing is planned on the histogram of
lengths alone and carried out on the rows by their rank among the pieces of their length:

1. Lengths above a share of the capacity are put in order, cut into groups of equal cardinality and rounded up to the
   largest of their group. Few sizes remain.
2. The linear programme over configurations of those sizes is solved by column generation (knapsack prices), and the
   whole part of each configuration's number is taken.
3. Actual pieces take the places of their group, the longest first. What the rounding left is free again.
4. All other pieces, longest first, go where they fit best: into the sequence with the least room that holds them.

The plan is a list of runs "pieces of one length with ranks r, r + 1, ... go to sequences q, q + 1, ..., so many each,
from that offset". A run is cut only where a length, a group or a class of equal room ends, so their number
follows the lengths, groups and configurations, never the documents. The share and the number of groups are those of the
best of a few ``SCHEMES``.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from martloom.llm.common import map_batches
from martloom.session import write_once

CAPACITY = 2048
END_ID = 0
# Share of the capacity from which a length is large, and number of groups; tried in turn until nothing can be better.
SCHEMES = ((1 / 4, 24), (1 / 3, 100), (2 / 5, 200), (1 / 2, 100))
COLUMNS = 10_000  # configurations tried in one linear programme; every basis on the way is a valid cover


# --- tokens

@lru_cache(maxsize=2)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """Byte-level BPE by a rank file; strings of special tokens are ordinary text."""
    with open(ranks, "rb") as lines:
        held = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=held, special_tokens={})


def piece_bounds(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: one, or whole sequences after a shorter first piece."""
    first = n % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def pieces(docs: DataFrame, ranks: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, part, nth``: every piece, numbered among its task's pieces of its length."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        coder = encoding(ranks, pattern)
        seen: dict[int, int] = defaultdict(int)

        def step(ids, texts, parts):
            out = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth")}
            for doc_id, text, part in zip(ids, texts, parts):
                tokens = np.append(coder.encode_to_numpy(text or "", disallowed_special=()), END_ID).astype("<u4")
                for piece, (start, length) in enumerate(piece_bounds(len(tokens), capacity)):
                    row = (doc_id, piece, start, length, zlib.crc32(tokens[start:start + length].tobytes()), part, seen[length])
                    seen[length] += 1
                    for held, value in zip(out.values(), row):
                        held.append(value)
            return out
        return step

    return map_batches(docs, ["doc_id", "text", F.spark_partition_id().alias("part")], f"doc_id {kind}, piece int, start bigint, "
                       "length bigint, ids_crc32 bigint, part int, nth bigint", make)


# --- the plan

class Runs:
    """Pieces in an order, as runs ``[length, first rank, number]``; takes from the front split a run."""

    def __init__(self, runs: list[tuple[int, int, int]]):
        self.runs = [list(r) for r in reversed(runs)]

    def take(self, most: int) -> tuple[int, int, int] | None:
        """Up to ``most`` pieces of one length."""
        if not self.runs:
            return None
        run = self.runs[-1]
        taken = (run[0], run[1], min(most, run[2]))
        run[1] += taken[2]
        run[2] -= taken[2]
        if not run[2]:
            self.runs.pop()
        return taken

    def rest(self) -> list[tuple[int, int, int]]:
        return [tuple(r) for r in reversed(self.runs)]


def linear_groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int, int]]]:
    """Groups of equal cardinality, longest first, as runs ``(length, first rank, number)``; groups of one rounded length are one."""
    total, out, room = sum(counts.values()), [], 0
    each = -(-total // groups)
    for length in sorted(counts, reverse=True):
        rank = 0
        while rank < counts[length]:
            if not room:
                if out and out[-1][0][0] == length:  # the next group would be rounded to the same length
                    room = each
                    continue
                out.append([])
                room = each
            n = min(room, counts[length] - rank)
            out[-1].append((length, rank, n))
            rank += n
            room -= n
    return out


def _best_configuration(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of sizes that fits: a knapsack over the capacity, one more piece at a time."""
    room = np.arange(capacity + 1)[:, None] - sizes  # what is left of each capacity after one piece of each size
    values, chosen = [np.zeros(capacity + 1)], []
    for _ in range(capacity // int(sizes.min())):
        gains = np.where(room >= 0, values[-1][np.maximum(room, 0)] + prices, 0)
        best = gains.argmax(axis=1)
        chosen.append(best)
        values.append(gains[np.arange(capacity + 1), best])
    used, left = np.zeros(len(sizes)), capacity
    for value, before, best in zip(values[:0:-1], values[-2::-1], chosen[::-1]):
        if value[left] > before[left] + 1e-12 or value is values[1] and value[left] > 0:
            used[best[left]] += 1
            left -= int(sizes[best[left]])
    return float(prices @ used), used


def configurations(sizes: list[int], demand: list[int], capacity: int = CAPACITY) -> list[tuple[list[int], float]]:
    """``(number of each size, how often)`` of a least fractional cover of the demand, by column generation."""
    size, need = np.array(sizes), np.array(demand, float)
    basis = np.diag((capacity // size).astype(float))
    for _ in range(COLUMNS):
        often = np.linalg.solve(basis, need)
        prices = np.linalg.solve(basis.T, np.ones(len(size)))
        worth, column = _best_configuration(size, np.maximum(prices, 0), capacity)
        if worth <= 1 + 1e-9:
            break
        change = np.linalg.solve(basis, column)
        ratio = np.where(change > 1e-9, np.maximum(often, 0) / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    often = np.linalg.solve(basis, need)
    return [([int(x) for x in basis[:, j]], float(often[j])) for j in range(len(size))]


def grouped_plan(counts: dict[int, int], share: float, groups: int, capacity: int = CAPACITY) -> tuple[int, np.ndarray]:
    """Number of sequences and the runs ``length, first rank, number, first sequence, per sequence, offset``."""
    runs: list[tuple[int, int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (first sequence, number)
    made = 0
    whole = counts.get(capacity, 0)
    if whole:
        runs.append((capacity, 0, whole, 0, 1, 0))
        made = whole
    large = {length: n for length, n in counts.items() if capacity * share < length < capacity}
    rest = {length: [(length, 0, n)] for length, n in counts.items() if length <= min(capacity * share, capacity - 1)}
    if large:
        held = linear_groups(large, groups)
        queues = [Runs(group) for group in held]
        solved = configurations([g[0][0] for g in held], [sum(r[2] for r in g) for g in held], capacity)
        for numbers, often in solved:
            often = int(often + 1e-6)
            if not often:
                continue
            open_runs = [(made, often, 0)]  # first sequence, number, fill
            for group, number in enumerate(numbers):
                for _ in range(number):
                    filled = []
                    for first, n, fill in open_runs:
                        while n:
                            taken = queues[group].take(n)
                            if taken is None:
                                filled.append((first, n, fill))
                                break
                            length, rank, k = taken
                            runs.append((length, rank, k, first, 1, fill))
                            filled.append((first, k, fill + length))
                            first, n = first + k, n - k
                    open_runs = filled
            for first, n, fill in open_runs:
                rooms[capacity - fill].append((first, n))
            made += often
        for queue in queues:
            for length, rank, n in queue.rest():
                rest.setdefault(length, []).append((length, rank, n))
    made = _best_fit(rest, rooms, runs, made, capacity)
    return made, np.array(sorted(runs), np.int64).reshape(-1, 6)


def _best_fit(rest: dict, rooms: dict, runs: list, made: int, capacity: int) -> int:
    """Put the remaining pieces, longest first, into the sequences with the least room that holds them; sequences in equal
    state move together. Returns the number of sequences."""
    free = sum(1 << room for room in rooms if rooms[room])
    for length in sorted(rest, reverse=True):
        queue = Runs(rest[length])
        while queue.runs:
            able = free >> length
            if not able:
                n = sum(r[2] for r in queue.runs)
                each = capacity // length
                rooms[capacity] = [(made, -(-n // each))]
                made += -(-n // each)
                free |= 1 << capacity
                continue
            room = length + (able & -able).bit_length() - 1
            first, n = rooms[room].pop()
            if not rooms[room]:
                free &= ~(1 << room)
            each, waiting = room // length, queue.runs[-1][2]
            if waiting >= each:
                filled = min(n, waiting // each)
                _, rank, k = queue.take(filled * each)
                left = room - each * length
            else:
                filled = 1
                _, rank, k = queue.take(waiting)
                each, left = k, room - k * length
            runs.append((length, rank, k, first, each, capacity - room))
            for at, number, state in ((first, filled, left), (first + filled, n - filled, room)):
                if number:
                    rooms[state].append((at, number))
                    free |= 1 << state
    return made


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY, schemes: tuple = SCHEMES) -> tuple[int, np.ndarray]:
    """The plan with the fewest sequences over the schemes."""
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    found = None
    for share, groups in schemes:
        plan = grouped_plan(counts, share, groups, capacity)
        if found is None or plan[0] < found[0]:
            found = plan
        if found[0] == least:
            break
    return found


# --- rows to sequences

def pack(docs: DataFrame, ranks: str, pattern: str, capacity: int = CAPACITY, schemes: tuple = SCHEMES) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every row.

    A null or empty text is the end id alone. Rows with a null or repeated id are packed like any other, a repeated row once for
    each time it occurs; no rows give no pieces. Only doc_id and text are read. The driver gets one number per length
    and the tasks the plan's runs; both are bounded by the capacity, not by the corpus.
    """
    rows = write_once(pieces(docs, ranks, pattern, capacity), "pieces")
    by_part = write_once(rows.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).toLocalIterator()}
    _, plan = packing_plan(counts, capacity, schemes)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = by_part.select(F.col("length").alias("of"), F.col("part").alias("within"), F.coalesce(before, F.lit(0)).alias("before"))
    ranked = rows.join(starts, (F.col("length") == F.col("of")) & (F.col("part") == F.col("within")))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        keys = plan[:, 0] << 48 | plan[:, 1]

        def step(doc_id, piece, start, length, crc, rank):
            sizes, ranks_ = np.array(length, np.int64), np.array(rank, np.int64)
            run = plan[np.searchsorted(keys, sizes << 48 | ranks_, side="right") - 1]
            nth = ranks_ - run[:, 1]
            return {"doc_id": doc_id, "piece": piece, "start": start, "length": length, "ids_crc32": crc,
                    "sequence_id": run[:, 3] + nth // run[:, 4], "offset": run[:, 5] + nth % run[:, 4] * sizes}
        return step

    return map_batches(ranked, ["doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")],
                       f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint", make)

"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of documents inside a task. Its words become symbols of the benchmark's
vocabulary; runs that hold another word or are shorter than the shortest window cannot hold a window and
stay out. Test windows are found by backward search, placed by sampled suffix positions, and
overlapping places become removal spans.

The benchmark is taken in blocks of bounded size, each sent to the tasks in turn; documents stream
past once a block and carry what was found so far. A bounded number of blocks makes a pass; between two
passes the documents and their findings are written, and the blocks sent so far are released. Nothing is shuffled.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import alnum_words, map_batches
from martloom.session import write_once

WINDOW = 13
SHARE = 20  # contaminated: one word in so many is hit
BLOCK_BYTES = 4 << 20  # benchmark text sent to the tasks at a time
PASS_BLOCKS = 8  # blocks whose Python workers run side by side in a task
SHARD_WORDS = 1_000_000  # words indexed together; a longer document is a shard of its own

FOUND = "n_words bigint, hit_starts array<bigint>, hit_ends array<bigint>, items array<string>"


class Windows:
    """The distinct windows of some benchmark items, as symbols of their own vocabulary."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in alnum_words(text)]
            width = min(window, len(ids))
            for i in range(len(ids) - width + 1 if ids else 0):
                owners.setdefault(tuple(ids[i:i + width]), set()).add("" if item is None else str(item))
        self.owners = [sorted(names) for names in owners.values()]
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.shortest = int(self.lengths.min()) if owners else 0
        self.patterns = np.zeros((len(owners), int(self.lengths.max()) if owners else 0), np.int32)
        for i, w in enumerate(owners):
            self.patterns[i, self.patterns.shape[1] - len(w):] = w


def find_windows(documents: list[list[bytes]], windows: Windows) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """For each document's words: merged spans of hit words, and the items whose windows occur."""
    from martloom.llm.fm_index import FMIndex

    get = windows.vocabulary.get
    symbols: list[int] = []
    for words in documents:
        symbols += map(get, words, repeat(0))
        symbols.append(0)
    symbols_array = np.array(symbols, np.int32)
    found: list = [([], set()) for _ in documents]
    if not windows.owners:
        return found
    inside = symbols_array != 0
    border = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    begin, end = border[::2], border[1::2]
    enough = end - begin >= windows.shortest
    begin, end = begin[enough], end[enough]
    if not len(begin):
        return found
    # Runs side by side with one separator each; a kept place is moved back by its run's shift.
    size = end - begin + 1
    target = np.concatenate([[0], np.cumsum(size)])
    keep = np.repeat(begin - target[:-1], size) + np.arange(target[-1])
    index = FMIndex(symbols_array[keep], len(windows.vocabulary))
    low, high = index.search(windows.patterns, windows.lengths)
    count = high - low
    hit = np.flatnonzero(count)
    if not len(hit):
        return found
    pattern = np.repeat(hit, count[hit])
    rows = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(count[hit])[:-1]]), count[hit]) + np.arange(len(pattern))
    place = keep[index.locate(rows)]
    change = np.zeros(len(symbols_array) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + windows.lengths[pattern], -1)
    covered = np.cumsum(change[:-1]) > 0
    border = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    offsets = np.concatenate([[0], np.cumsum([len(w) + 1 for w in documents])])
    owner = np.searchsorted(offsets, border[::2], "right") - 1
    for d, s, e in zip(owner.tolist(), border[::2].tolist(), border[1::2].tolist()):
        found[d][0].append((s - int(offsets[d]), e - int(offsets[d])))
    pairs = np.unique(np.stack([np.searchsorted(offsets, place, "right") - 1, pattern]), axis=1)
    for d, p in zip(*pairs.tolist()):
        found[d][1].update(windows.owners[p])
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks keep each near ``block_bytes`` of text; one number comes to the driver."""
    size = benchmark.select(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    return max(1, -(-size // block_bytes))


def find_passages(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """``keep`` columns, n_words, the merged spans of hit words (hit_starts, hit_ends) and the items found.

    Null and empty texts have no words. Repeated items count once by id; a null item id shows as an empty one.
    With an empty benchmark nothing is hit. Other columns of either table are not read.
    """
    spark = docs.sparkSession
    blocks = benchmark_blocks(benchmark, block_bytes)
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    kept = docs.select(*keep).schema
    passed = docs.select(F.struct(*keep).alias("kept"), F.col("text"), F.array().cast("array<bigint>").alias("hit_starts"),
                         F.array().cast("array<bigint>").alias("hit_ends"), F.array().cast("array<string>").alias("items"))
    waiting = []
    for block in range(blocks):
        if len(waiting) == pass_blocks:
            passed = write_once(passed, "contamination-pass")
            for sent in waiting:
                sent.destroy()
            waiting = []
        rows = benchmark.where(spread == block).select("item_id", "text").collect()
        sent = spark.sparkContext.broadcast([tuple(r) for r in rows])
        waiting.append(sent)
        last = block == blocks - 1
        text = "" if last else ", text string"

        def make(sent=sent, last=last):
            windows = Windows(sent.value, window)

            def step(kept_rows, texts, starts, ends, items):
                out = {"kept": kept_rows, "n_words": [], "hit_starts": [], "hit_ends": [], "items": [], "text": texts}
                words, held = [], 0
                shards = []
                for text in texts:
                    words.append(alnum_words(text))
                    held += len(words[-1])
                    out["n_words"].append(len(words[-1]))
                    if held >= SHARD_WORDS:
                        shards += find_windows(words, windows)
                        words, held = [], 0
                shards += find_windows(words, windows)
                for (spans, names), s, e, before in zip(shards, starts, ends, items):
                    spans = merged([*zip(s, e), *spans])
                    out["hit_starts"].append([x[0] for x in spans])
                    out["hit_ends"].append([x[1] for x in spans])
                    out["items"].append(sorted(names.union(before)))
                return out

            return step

        passed = map_batches(passed, ["kept", "text", "hit_starts", "hit_ends", "items"],
                             f"kept {kept.simpleString()}, {FOUND}{text}", make)
    return passed.select("kept.*", "n_words", "hit_starts", "hit_ends", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_words, n_hit, n_items, items_sha256 and contaminated (a twentieth of the words or more is hit)."""
    found = find_passages(docs, benchmark, keep)
    n_hit = F.aggregate(F.arrays_zip("hit_starts", "hit_ends"), F.lit(0).cast("bigint"), lambda a, x: a + x.hit_ends - x.hit_starts)
    return found.select(
        *keep, "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def without_spans(text: str | None, starts: list[int], ends: list[int]) -> str | None:
    """The text less the words of the spans and what stands between them."""
    if not text or not starts:
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, end in zip(starts, ends):
        out.append(text[at:places[start][0]])
        at = places[end - 1][1]
    return "".join(out) + text[at:]


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged and with all their columns.

    Null and empty texts have no words and stay. Each of several equal rows, or rows of one id, is judged by its own text.
    An empty benchmark keeps all rows; an empty table gives none.
    """
    columns = tuple(docs.columns)
    return contamination(docs, benchmark, columns).where(~F.col("contaminated")).select(*columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, k, list_slice(w, i, i + k - 1) AS win FROM (
    SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, k, list_slice(w, i, i + k - 1) AS win FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
found AS (SELECT doc_id, i, places.k AS k, item_id FROM places JOIN windows USING (win)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(name, ',' ORDER BY name)) AS h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A fingerprint's 64 bits are cut into ``BLOCKS`` blocks. If two fingerprints differ in at most
``DISTANCE`` bits, at least ``BLOCKS - DISTANCE`` blocks are equal, so each choice of that many
blocks is a join key and every close pair meets under one of them. A bucket of more than ``LARGEST``
fingerprints is split by the same rule on its remaining bits. Only distinct fingerprints take part,
however many copies stand behind them.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_batches, space_words
from martloom.llm.components import component_roots
from martloom.session import write_once

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCKS = 6  # 20 keys of about 32 bits: a key's bucket stays small up to billions of fingerprints
LARGEST = 1 << 14  # buckets beyond are split on their remaining bits, with the same links


def fingerprint(text: str | None) -> int:
    """SimHash over the word shingles, repeats included; no words: 0."""
    words = space_words(text)
    if not words:
        return 0
    width = min(SHINGLE, len(words))
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e - 1], SEED) for s, e in zip(starts, ends[width - 1:])], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[i:i + 65536].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` of every row; fp as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        return lambda ids, texts: {"doc_id": ids, "fp": [_signed(fingerprint(t)) for t in texts]}

    return map_batches(docs, ["doc_id", "text"], f"doc_id {kind}, fp bigint", make)


def _masks_within(bits: list[int], blocks: int, distance: int) -> list[int]:
    """Masks of every choice of ``blocks - distance`` blocks of the given bits."""
    cuts = [round(len(bits) * i / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << b for b in bits[low:high]) for low, high in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - distance)]


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """Bit masks of every choice of ``blocks - distance`` blocks."""
    return _masks_within(list(range(64)), blocks, distance)


def finer_masks(mask: int, blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """Masks that split a bucket of ``mask``: its bits and every choice of blocks of the others.

    Two of its fingerprints that are close agree under one of them, as close pairs do under the first masks.
    """
    others = [b for b in range(64) if not mask >> b & 1]
    return [mask | finer for finer in _masks_within(others, blocks, distance)]


def close_tree(values: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that connect the distinct fingerprints of one bucket exactly as all its close pairs would.

    Each fingerprint looks once at those not yet reached, so memory is in proportion to the bucket and at
    most one link a fingerprint comes out.
    """
    found = []
    left = np.arange(len(values))
    rest, queue = values.copy(), []
    while len(left):
        if queue:
            at = queue.pop()
        else:
            at, left, rest = int(left[-1]), left[:-1], rest[:-1]
        near = np.bitwise_count(rest ^ values[at]) <= distance
        if near.any():
            reached = left[near].tolist()
            left, rest = left[~near], rest[~near]
            found += [(at, other) for other in reached]
            queue += reached
    return found


def _bucket_links():
    """A task's step over rows sorted by bucket: whole buckets are linked, the last one waits for the next batch."""
    held: list[np.ndarray] = []

    def link(rows: np.ndarray) -> tuple[list, list]:
        a, b = [], []
        edges = np.flatnonzero((np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)) + 1
        begins = np.concatenate([[0], edges])
        sizes = np.diff(np.append(begins, len(rows)))
        for begin, size in zip(begins[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            part = np.unique(rows[begin:begin + size, 2])  # the same finer mask may come from two large buckets
            for i, j in close_tree(part.view(np.uint64)):
                a.append(int(part[i]))
                b.append(int(part[j]))
        return a, b

    def step(mask, key, fp):
        rows = np.array([mask, key, fp], np.int64).T
        held.append(np.ascontiguousarray(rows))
        if (rows[-1, :2] == held[0][0, :2]).all():
            return None
        rows = np.concatenate(held)
        last = int(np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))[-1]) + 1
        held[:] = [rows[last:]]
        a, b = link(np.asfortranarray(rows[:last]))
        return {"a": a, "b": b}

    def finish():
        if not held:
            return None
        a, b = link(np.asfortranarray(np.concatenate(held)))
        return {"a": a, "b": b}

    step.finish = finish
    return step


def _keyed(masks: Column, fp: str = "fp") -> Column:
    """A row per mask of an array column: the mask and the fingerprint's bits under it."""
    return F.inline(F.transform(masks, lambda m: F.struct(m.alias("mask"), m.bitwiseAND(F.col(fp)).alias("key"))))


def close_links(nodes: DataFrame, largest: int = LARGEST) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct values of ``fp`` exactly as all close pairs would.

    Buckets are counted first, partly before the shuffle. Those beyond ``largest`` go on by the finer masks of their own
    mask: the finer buckets agree in about 48 bits, so none can hold more than some 2^17 distinct fingerprints and
    each is a task's work, however many fingerprints share the first 32 bits.
    """
    masks = block_masks()
    keyed = nodes.select(_keyed(F.array(*[F.lit(_signed(m)) for m in masks])), "fp")
    large = write_once(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > largest).select("mask", "key"), "large-buckets")
    finer = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in finer_masks(m)]))])
    split = keyed.join(large, ["mask", "key"], "left_semi").select(_keyed(finer[F.col("mask")]), "fp")
    buckets = keyed.join(large, ["mask", "key"], "left_anti").unionByName(split)
    sorted_buckets = buckets.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return map_batches(sorted_buckets, ["mask", "key", "fp"], "a bigint, b bigint", _bucket_links)


def _components(prints: DataFrame) -> DataFrame:
    """``fp, root_fp, component_id`` of every distinct fingerprint of ``(doc_id, fp)``.

    The graph's nodes are fingerprints, so an id that stands for several texts connects nothing.
    """
    nodes = write_once(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    links = close_links(nodes.where("rep IS NOT NULL"))
    rooted = nodes.join(component_roots(links), F.col("fp") == F.col("node"), "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root_fp"))
    rooted = write_once(rooted, "fingerprint-roots")
    least = rooted.groupBy(F.col("root_fp").alias("of")).agg(F.min("rep").alias("component_id"))
    return rooted.join(least, F.col("root_fp") == F.col("of")).select("fp", "root_fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; ids keep their type.

    Documents without words have fingerprint zero and are linked like others. Rows with a null id get the
    component of their fingerprint's identified rows (null if there is none) and link nothing themselves.
    Rows with one id and different texts connect nothing by their id. Only ``doc_id`` and ``text`` are read.
    """
    prints = write_once(with_fingerprints(docs), "fingerprints")
    labelled = _components(prints).withColumnRenamed("fp", "node_fp")
    return prints.join(labelled, prints.fp == labelled.node_fp).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every component: that of the smallest (id, fingerprint); rows with a null id stay as they are.

    Where an id stands for several texts, each of them is judged by its own fingerprint. Of rows equal in id and fingerprint
    any one stays. Empty texts are copies of each other. Columns of any name stay as they are.
    """
    prints = write_once(with_fingerprints(docs), "fingerprints").where("doc_id IS NOT NULL")
    chosen = prints.join(_components(prints).withColumnRenamed("fp", "node_fp"), F.col("fp") == F.col("node_fp")).groupBy("root_fp").agg(
        F.min(F.struct("doc_id", "fp")).alias("least")).select(F.col("least.doc_id").alias("_kept_id"), F.col("least.fp").alias("_kept_fp"))
    repeated = prints.groupBy(F.col("doc_id").alias("_repeated_id")).agg(F.count("*").alias("_times")).where("_times > 1")
    marked = write_once(chosen.join(repeated, F.col("_kept_id") == F.col("_repeated_id"), "left").select(
        "_kept_id", "_kept_fp", F.col("_repeated_id").isNotNull().alias("_several")), "kept-documents")
    alone = docs.join(marked.where(~F.col("_several")).select("_kept_id"), docs.doc_id == F.col("_kept_id"), "left_semi")
    several = marked.where("_several")
    shared = docs.join(several.select("_kept_id").distinct(), docs.doc_id == F.col("_kept_id"), "left_semi")
    names = shared.columns

    def make():
        at = names.index("text")
        return lambda *columns: {"_fp": [_signed(fingerprint(t)) for t in columns[at]]} | dict(zip(names, columns))

    printed = map_batches(shared, names, docs.select(*names).schema.add("_fp", "long"), make)
    one = printed.join(several, (printed.doc_id == F.col("_kept_id")) & (F.col("_fp") == F.col("_kept_fp")), "left_semi")
    return alone.unionByName(one.dropDuplicates(["doc_id", "_fp"]).drop("_fp")).unionByName(docs.where(F.col("doc_id").isNull()))

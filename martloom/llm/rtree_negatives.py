"""Hard negatives by best-first search in STR-packed R-trees.

Vectors are cut into shards of bounded size along their widest coordinates (sort, tile, recurse), and each shard is an
R-tree: leaves of ``LEAF`` rows in tile order, boxes of ``FANOUT`` children above them. For an anchor ``a`` and a box
``[lo, hi]`` each coordinate gives the interval of ``a_i * x_i``; their sums bound every inner product inside. A search pops
the box with the highest bound inside its score window, skips boxes that miss the window, and ends when the best
bound is strictly below the worst row it would keep.

An anchor first searches the shard it lies in. What it finds there is its floor everywhere else, and it goes only to
groups of shards whose box can reach that floor. Anchors are the stated query set; they meet the shards in blocks.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from martloom.llm.common import map_batches
from martloom.session import write_once

SCALE = 256
LABELS = 10
SWAPPED, ANCHORS = 7, 100  # ids divisible by these have a moved label, are anchors
POSITIVES, NEGATIVES = 5, 5
LEAST_PER_CENT = 80  # of the positive's score
SHARD_ROWS = 1 << 13
LEAF, FANOUT = 32, 16
GROUPS = 1024  # groups of shards whose boxes every task knows, however many shards there are
BLOCK = 2048  # queries that share a copy of a shard
NO_FLOOR = -(1 << 63)
EXACT = 1 << 52


# --- the tree

def tile_order(vectors: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Sort-tile-recursive order: cut along the widest coordinate not cut yet, then each slab along the next."""
    out = []

    def cut(rows: np.ndarray, left: np.ndarray) -> None:
        pages = -(-len(rows) // leaf)
        if pages <= 1 or not len(left):
            out.append(rows)
            return
        held = vectors[rows][:, left].astype(float)
        axis = int(left[held.var(axis=0).argmax()])
        slabs = max(2, int(np.ceil(pages ** (1 / len(left)))))
        size = -(-pages // slabs) * leaf
        order = rows[np.argsort(vectors[rows, axis], kind="stable")]
        for start in range(0, len(order), size):
            cut(order[start:start + size], left[left != axis])

    cut(np.arange(len(vectors)), np.arange(vectors.shape[1]))
    return np.concatenate(out)


class PackedTree:
    """Rows in tile order and their boxes, level by level; the last level has at most ``FANOUT`` boxes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.whole = ids, labels, vectors.astype(np.int64)
        self.vectors = vectors.astype(float)
        starts = np.arange(0, len(ids), LEAF)
        self.levels = [(np.minimum.reduceat(self.vectors, starts), np.maximum.reduceat(self.vectors, starts))]
        while len(self.levels[-1][0]) > FANOUT:
            lo, hi = self.levels[-1]
            starts = np.arange(0, len(lo), FANOUT)
            self.levels.append((np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts)))
        self.reach = float(np.abs(self.vectors).max(initial=0))


def interval(vectors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each vector with any point of each box, widened where doubles may round."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    bottom, top = up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T
    corner = np.maximum(np.abs(lo), np.abs(hi))
    reach = np.abs(vectors).max(initial=0) * corner.max(initial=0) * vectors.shape[1]
    if reach < EXACT:
        return bottom, top
    slack = 1e-9 * (np.abs(vectors) @ corner.T)
    return bottom - slack, top + slack


class Queries:
    """Queries as arrays: vector, label, own id, score window and floor; ``same`` asks for rows of the same label."""

    def __init__(self, vectors, labels, ids, low, high, floor, same: bool):
        self.whole = np.array(vectors, np.int64).reshape(len(ids), -1)
        self.vectors = self.whole.astype(float)
        self.labels, self.ids = np.array(labels, np.int64), np.array(ids, np.int64)
        self.high, self.least = np.array(high, np.int64), np.maximum(np.array(low, np.int64), np.array(floor, np.int64))
        self.same = same


def search(tree: PackedTree, asked: Queries, k: int) -> list[list[tuple[int, int]]]:
    """The first ``k`` fitting rows ``(score, -id)`` of each query, as a heap. Queries that pop the same box do so together."""
    best: list[list[tuple[int, int]]] = [[] for _ in asked.ids]
    queues: list[list[tuple[float, int, int]]] = [[] for _ in asked.ids]
    least, high = asked.least.copy(), asked.high
    exact = tree.reach * np.abs(asked.vectors).max(initial=0) * asked.vectors.shape[1] < EXACT

    def put(level: int, first: int, last: int, who: np.ndarray) -> None:
        lo, hi = tree.levels[level]
        bottom, top = interval(asked.vectors[who], lo[first:last], hi[first:last])
        fits = (bottom <= high[who, None]) & (top >= least[who, None])
        bound = np.minimum(top, high[who, None])
        for i, j in zip(*(x.tolist() for x in np.nonzero(fits))):
            heapq.heappush(queues[who[i]], (-bound[i, j], level, first + j))

    def read(at: int, who: np.ndarray) -> None:
        rows = slice(at * LEAF, (at + 1) * LEAF)
        score = (asked.vectors[who] @ tree.vectors[rows].T).astype(np.int64) if exact else asked.whole[who] @ tree.whole[rows].T
        fits = (tree.labels[rows] == asked.labels[who, None]) == asked.same
        fits &= (tree.ids[rows] != asked.ids[who, None]) & (score >= least[who, None]) & (score <= high[who, None])
        for i, j in zip(*(x.tolist() for x in np.nonzero(fits))):
            held, row = best[who[i]], (int(score[i, j]), -int(tree.ids[at * LEAF + j]))
            if len(held) < k:
                heapq.heappush(held, row)
            elif row > held[0]:
                heapq.heapreplace(held, row)
            if len(held) == k:
                least[who[i]] = max(least[who[i]], held[0][0])

    active = np.arange(len(best))
    put(len(tree.levels) - 1, 0, len(tree.levels[-1][0]), active)
    while True:
        popped = defaultdict(list)
        for q in active.tolist():
            if queues[q]:
                bound, level, at = heapq.heappop(queues[q])
                if -bound >= least[q]:
                    popped[level, at].append(q)
        if not popped:
            return best
        for (level, at), who in popped.items():
            if level:
                put(level - 1, at * FANOUT, min((at + 1) * FANOUT, len(tree.levels[level - 1][0])), np.array(who))
            else:
                read(at, np.array(who))
        active = np.concatenate([np.array(who) for who in popped.values()])


# --- shards

def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, q``: one row an id, with whole components; see ``hard_negatives`` for the rows left out."""
    component = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    # By Cauchy's inequality 100 times the inner product of two such rows fits a long.
    energy = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x.cast("double")) * SCALE + 1, F.lit(2.0)))
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < 2.0 ** 24)) & (energy < 2.0 ** 56)
    label = F.when(F.col("vec_id") % SWAPPED == 0, (F.col("label").cast("bigint") + 1) % LABELS).otherwise(F.col("label").cast("bigint"))
    kept = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(fits, F.lit(False)))
    rows = kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), component.alias("q"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("row")).select("vec_id", "row.label", "row.q")


def widest_coordinates(rows: DataFrame, most: int = 3) -> list[int]:
    """Coordinates of greatest variance, from one sum and one sum of squares a coordinate and task."""
    def make():
        sums: dict[int, np.ndarray] = {}

        def step(q):
            for vector in q:
                x = np.array(vector, float)
                held = sums.setdefault(len(x), np.zeros((3, len(x))))
                held += np.array([np.ones(len(x)), x, x * x])
            return None

        def finish():
            flat = [(i, *held[:, i].tolist()) for held in sums.values() for i in range(held.shape[1])]
            return dict(zip(("axis", "n", "s", "s2"), map(list, zip(*flat)))) if flat else None

        step.finish = finish
        return step

    spread = F.sum("s2") / F.sum("n") - F.pow(F.sum("s") / F.sum("n"), F.lit(2))
    found = map_batches(rows, ["q"], "axis int, n double, s double, s2 double", make).groupBy("axis").agg(spread.alias("v"))
    return [r.axis for r in found.orderBy(F.desc("v"), "axis").limit(most).collect()]


def _blob(vectors: np.ndarray) -> bytes:
    for kind in (np.int16, np.int32):
        if np.abs(vectors).max(initial=0) <= np.iinfo(kind).max:
            return vectors.astype(kind).tobytes()
    return vectors.tobytes()


def _from_blob(data: bytes, n: int, width: int) -> np.ndarray:
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(data) // (n * width) if n * width else 8]
    return np.frombuffer(data, kind).reshape(n, width)


SHARD = "shard bigint, part int, width int, ids binary, labels binary, vectors binary, low array<bigint>, high array<bigint>"


def shards(rows: DataFrame, size: int = SHARD_ROWS) -> DataFrame:
    """One row a shard: its rows in tile order, and its box. A shard has vectors of one length and at most ``size`` rows."""
    total = rows.count()
    axes = widest_coordinates(rows)
    slabs = rows.repartitionByRange(max(1, -(-total // size)), F.size("q"), *[F.get("q", F.lit(a)) for a in axes], "vec_id")

    def make():
        held: list[tuple] = []
        state = {"made": 0}

        def build(part, chosen):
            ids, labels = np.array([r[0] for r in chosen], np.int64), np.array([r[1] for r in chosen], np.int64)
            vectors = np.array([r[2] for r in chosen], np.int64).reshape(len(chosen), -1)
            order = tile_order(vectors)
            state["made"] += 1
            row = ((part << 24) + state["made"], part, vectors.shape[1], ids[order].tobytes(), labels[order].tobytes(),
                   _blob(vectors[order]), vectors.min(axis=0).tolist(), vectors.max(axis=0).tolist())
            return dict(zip(("shard", "part", "width", "ids", "labels", "vectors", "low", "high"), ([v] for v in row)))

        def step(ids, labels, q, parts):
            state["part"] = parts[0]
            held.extend(zip(ids, labels, q))
            out = defaultdict(list)
            while len(held) >= size or held and len(held[0][2]) != len(held[-1][2]):
                width = len(held[0][2])
                n = next((i for i, r in enumerate(held[:size]) if len(r[2]) != width), min(size, len(held)))
                for name, value in build(parts[0], held[:n]).items():
                    out[name] += value
                del held[:n]
            return dict(out) or None

        step.finish = lambda: build(state["part"], held) if held else None
        return step

    # Vectors of one length stand together, so that a shard is cut where the length changes.
    ordered = slabs.sortWithinPartitions(F.size("q"))
    return map_batches(ordered, ["vec_id", "label", "q", F.spark_partition_id().alias("part")], SHARD, make)


def tree_of(ids: bytes, labels: bytes, vectors: bytes, width: int) -> PackedTree:
    held = np.frombuffer(ids, np.int64)
    return PackedTree(held, np.frombuffer(labels, np.int64), _from_blob(vectors, len(held), width))


def anchors_of(trees: DataFrame, every: int = ANCHORS) -> DataFrame:
    """``anchor_id, label, q, home`` of the rows whose id ``every`` divides."""
    def make():
        def step(shard, width, ids, labels, vectors):
            out = {"anchor_id": [], "label": [], "q": [], "home": []}
            for s, w, i, l, v in zip(shard, width, ids, labels, vectors):
                tree = tree_of(i, l, v, w)
                at = np.flatnonzero(tree.ids % every == 0)
                out["anchor_id"] += tree.ids[at].tolist()
                out["label"] += tree.labels[at].tolist()
                out["q"] += tree.whole[at].tolist()
                out["home"] += [s] * len(at)
            return out
        return step

    return map_batches(trees, ["shard", "width", "ids", "labels", "vectors"], "anchor_id bigint, label bigint, q array<bigint>, home bigint", make)


# --- searches

ASKED = ["anchor_id", "slot", "label", "q", "home", "low", "high", "floor"]


def _meet(trees: DataFrame, asked: DataFrame, same: bool, k: int, blocks: int, shard_count: int) -> DataFrame:
    """``anchor_id, slot, score, vec_id``: what each query finds in the shard named beside it.

    A shard goes once to each block of queries and is followed by them in one task's stream, so a task
    holds one tree and one batch of queries.
    """
    block = F.pmod(F.xxhash64("anchor_id", "slot"), F.lit(blocks)).alias("block")
    trees = trees.select("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"), "width", "ids", "labels", "vectors")
    both = trees.unionByName(asked.select("shard", block, *ASKED), allowMissingColumns=True)
    tasks = max(int(trees.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(shard_count * blocks // 4, 100_000))
    ordered = both.repartition(tasks, "shard", "block").sortWithinPartitions("shard", "block", F.col("ids").isNull())

    def make():
        held: dict = {"tree": None}

        def step(shard, block, width, ids, labels, vectors, *query):
            out = {"anchor_id": [], "slot": [], "score": [], "vec_id": []}
            n, at = len(shard), 0
            while at < n:
                if ids[at] is not None:
                    held["tree"] = tree_of(ids[at], labels[at], vectors[at], width[at])
                    at += 1
                    continue
                end = next((i for i in range(at, n) if ids[i] is not None), n)
                anchor, slot, label, q, _, low, high, floor = (column[at:end] for column in query)
                found = search(held["tree"], Queries(q, label, anchor, low, high, floor, same), k)
                for a, s, rows in zip(anchor, slot, found):
                    out["anchor_id"] += [a] * len(rows)
                    out["slot"] += [s] * len(rows)
                    out["score"] += [r[0] for r in rows]
                    out["vec_id"] += [-r[1] for r in rows]
                at = end
            return out
        return step

    return map_batches(ordered, ["shard", "block", "width", "ids", "labels", "vectors", *ASKED],
                       "anchor_id bigint, slot int, score bigint, vec_id bigint", make)


def _group_boxes(trees: DataFrame, groups: int) -> tuple[DataFrame, list]:
    """``shard, g`` of every shard, and for each of at most ``groups`` groups and each length its number and box."""
    parts = trees.agg(F.max("part")).first()[0]
    # Neighbouring parts are neighbouring slabs.
    placed = trees.select("shard", "width", "low", "high", F.floor(F.col("part") * F.lit(groups) / F.lit(max(parts + 1, groups))).cast("int").alias("g"))
    sides = placed.select("g", "width", F.posexplode(F.arrays_zip("low", "high")).alias("axis", "x"))
    boxes = sides.groupBy("g", "width", "axis").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high")).groupBy("g", "width").agg(
        F.sort_array(F.collect_list(F.struct("axis", "low", "high"))).alias("box"))
    empty = [(r.g, 0, [], []) for r in placed.where("width = 0").select("g").distinct().collect()]
    found = [(r.g, r.width, [b.low for b in r.box], [b.high for b in r.box]) for r in boxes.collect()]
    return placed.select(F.col("shard"), F.col("g").alias("of"), "width"), found + empty


def _routed(asked: DataFrame, shard_groups: DataFrame, boxes: list) -> DataFrame:
    """The queries beside every shard but their own whose group's box reaches their window and floor."""
    def make():
        by_width = defaultdict(list)
        for g, width, low, high in boxes:
            by_width[width].append((g, low, high))
        held = {w: (np.array([b[0] for b in found]), *(np.array([b[i] for b in found], float).reshape(len(found), w) for i in (1, 2)))
                for w, found in by_width.items()}

        def step(*columns):
            rows = list(zip(*columns))
            out = {name: [] for name in [*ASKED, "g", "w"]}
            by = defaultdict(list)
            for row in rows:
                by[len(row[3])].append(row)
            for width, chosen in by.items():
                names, lo, hi = held[width]
                asked_ = Queries([r[3] for r in chosen], [r[2] for r in chosen], [r[0] for r in chosen], *([r[i] for r in chosen] for i in (5, 6, 7)), True)
                bottom, top = interval(asked_.vectors, lo, hi)
                for i, j in zip(*np.nonzero((bottom <= asked_.high[:, None]) & (top >= asked_.least[:, None]))):
                    for name, value in zip(out, (*chosen[i], int(names[j]), width)):
                        out[name].append(value)
            return out
        return step

    schema = "anchor_id bigint, slot int, label bigint, q array<bigint>, home bigint, low bigint, high bigint, floor bigint, g int, w int"
    sent = map_batches(asked, ASKED, schema, make)
    return sent.join(shard_groups, (F.col("g") == F.col("of")) & (F.col("w") == F.col("width")) & (F.col("shard") != F.col("home"))).select(*ASKED, "shard")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


class Index:
    """Shards of a table of vectors, written once."""

    def __init__(self, vectors: DataFrame, size: int = SHARD_ROWS, groups: int = GROUPS, block: int = BLOCK):
        self.rows = write_once(quantised(vectors), "quantised")
        self.trees = write_once(shards(self.rows, size), "shards")
        self.count, self.block = self.trees.count(), block
        if self.count:
            self.shard_groups, self.boxes = _group_boxes(self.trees, groups)

    def first(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """``anchor_id, slot, score, vec_id, place``: the first ``k`` rows of every query over all shards.

        ``asked`` has anchor_id, slot, label, q, home, low and high.
        """
        asked = write_once(asked, "queries")
        blocks = max(1, -(-asked.count() // self.block))
        bare = asked.withColumn("floor", F.lit(NO_FLOOR))
        home = write_once(_meet(self.trees, bare.withColumn("shard", F.col("home")), same, k, blocks, self.count), "found-at-home")
        floors = home.groupBy("anchor_id", "slot").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k)
        floored = asked.join(floors, ["anchor_id", "slot"], "left").withColumn("floor", F.coalesce("kth", F.lit(NO_FLOOR)))
        away = _meet(self.trees, _routed(floored, self.shard_groups, self.boxes), same, k, blocks, self.count)
        return _first(home.unionByName(away), k)


def hard_negatives(vectors: DataFrame, every: int = ANCHORS, size: int = SHARD_ROWS, groups: int = GROUPS, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, as the module says.

    Left out are rows with a null id, label or vector, with a null or non-finite component, and with components so large that a
    score may not fit a long (a norm of 2^28 after quantising). Several rows of one id count as the least of them by
    (label, vector). Vectors of different lengths have no score with each other; empty ones score 0. An anchor
    without positives, or a pair without a negative in its window, has no rows. Only vec_id, label and embedding are read.
    """
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    index = Index(vectors, size, groups, block)
    if not index.count:
        return vectors.sparkSession.createDataFrame([], schema)
    anchors = write_once(anchors_of(index.trees, every), "anchors")
    whole = anchors.select("*", F.lit(0).alias("slot"), F.lit(NO_FLOOR).alias("low"), F.lit(-NO_FLOOR - 1).alias("high"))
    positives = write_once(index.first(whole, POSITIVES, True), "positives").select(
        F.col("anchor_id").alias("a"), F.col("place").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # 80 p <= 100 n in whole numbers; below a negative p there is no such n <= p.
    low = F.expr(f"(positive_score * {LEAST_PER_CENT} + 99) div 100")
    windows = anchors.join(positives, F.col("anchor_id") == F.col("a")).where("positive_score >= 0").select(
        "anchor_id", "slot", "label", "q", "home", low.alias("low"), F.col("positive_score").alias("high"))
    found = index.first(windows, NEGATIVES, False)
    return found.join(positives, (F.col("anchor_id") == F.col("a")) & (found.slot == positives.slot)).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


SQL = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM scored JOIN positives USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""

"""Ranks, tiles and growth over groups too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import write_once


# --- tiles over all rows ----------------------------------------------------

def global_ntile(df: DataFrame, tiles: int, orders: Mapping[str, str], tie_break: Sequence[str]) -> DataFrame:
    """``ntile(tiles)`` over the whole frame for several columns at once.

    A window without partition keys would run in a single task. A tile is decided by
    its first row alone, so this finds the ``tiles - 1`` first rows of each ordering
    and compares every row with them: the wide rows are neither moved nor sorted.
    Ascending, nulls last; ``orders`` maps output column to order column. Pass a
    materialised frame, because it is read twice.
    """
    total = df.count()
    starts = [k * (total // tiles) + min(k, total % tiles) for k in range(1, tiles)]
    starts = [s for s in starts if s < total]

    narrow, names = _stacked(df, list(orders.values()), tie_break)
    ranged = _ranged(narrow, names)
    found = _rows_at(ranged, names, len(orders), sorted({*starts, *[s - 1 for s in starts]}))
    cuts = [found[which, s] for which in range(len(orders)) for s in starts]
    if any(found[which, s] == found[which, s - 1] for which in range(len(orders)) for s in starts):
        # Equal rows on both sides of a cut: only their positions can tell them apart.
        return _ntile_by_position(df, tiles, orders, tie_break, total)

    scored = df
    for number, (out, column) in enumerate(orders.items()):
        passed = [_at_or_after(df, column, tie_break, cut, number).cast("int")
                  for cut in cuts if cut["_which"] == number]
        scored = scored.withColumn(out, reduce(Column.__add__, passed, F.lit(1)))
    return scored


def _stacked(df: DataFrame, columns: Sequence[str], tie_break: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """One narrow row per input row and ordering, from a single scan."""
    types = dict(df.dtypes)
    variants = []
    for number in range(len(columns)):
        fields = [F.lit(number).alias("_which"), F.col(columns[number]).isNull().alias("_last")]
        for i, column in enumerate(columns):
            value = F.col(column) if i == number else F.lit(None).cast(types[column])
            fields.append(value.alias(f"_v{i}"))
        for i, column in enumerate(tie_break):
            fields += [F.col(column).isNull().alias(f"_tn{i}"), F.col(column).alias(f"_t{i}")]
        variants.append(F.struct(*fields))
    stacked = df.select(F.inline(F.array(*variants)))
    return stacked, stacked.columns


def _ranged(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range partitions as a table, each row with its partition number. A running id
    comes last in the order, so even identical rows divide over several partitions."""
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    placed = salted.repartitionByRange(*order, "_salt").withColumn("_part", F.spark_partition_id())
    return write_once(placed.drop("_salt"), "ranged")


def _rows_at(ranged: DataFrame, names: Sequence[str], orderings: int, starts: Sequence[int]) -> dict:
    """The rows standing at the given places of each ordering, by (ordering, place)."""
    # One row per shuffle partition and ordering: bounded by the partition count.
    sizes = ranged.groupBy("_which", "_part").count().orderBy("_which", "_part").collect()
    wanted = []
    for which in range(orderings):
        before = 0
        for row in (r for r in sizes if r["_which"] == which):
            wanted += [(which, row["_part"], s - before + 1, s) for s in starts
                       if before <= s < before + row["count"]]
            before += row["count"]
    if not wanted:
        return {}
    here = Window.partitionBy("_which", "_part").orderBy(*names)
    parts = sorted({part for _, part, _, _ in wanted})
    numbered = ranged.where(F.col("_part").isin(parts)).withColumn("_row", F.row_number().over(here))
    hit = [(F.col("_which") == w) & (F.col("_part") == p) & (F.col("_row") == r) for w, p, r, _ in wanted]
    place = {(w, p, r): s for w, p, r, s in wanted}
    # At most two rows per tile border.
    rows = numbered.where(reduce(Column.__or__, hit)).collect()
    return {(r["_which"], place[r["_which"], r["_part"], r["_row"]]): r.asDict() | {"_part": 0, "_row": 0} for r in rows}


def _at_or_after(df: DataFrame, column: str, tie_break: Sequence[str], cut, which: int) -> Column:
    """Does the row stand at or after the cut row?"""
    types = dict(df.dtypes)
    steps = [(F.col(column), cut[f"_v{which}"], types[column])]
    steps += [(F.col(c), cut[f"_t{i}"], types[c]) for i, c in enumerate(tie_break)]
    verdict = F.lit(True)
    for value, bound, kind in reversed(steps):
        if bound is None:
            verdict = value.isNull() & verdict
        else:
            limit = F.lit(bound).cast(kind)
            verdict = value.isNull() | (value > limit) | ((value == limit) & verdict)
    return F.coalesce(verdict, F.lit(False))


def _ntile_by_position(df: DataFrame, tiles: int, orders: Mapping[str, str],
                       tie_break: Sequence[str], total: int) -> DataFrame:
    base, extra = divmod(total, tiles)
    big = extra * (base + 1)
    for out, column in orders.items():
        placed = global_position(df, [F.col(c).asc_nulls_last() for c in (column, *tie_break)], "_pos")
        pos = F.col("_pos") - 1
        late = F.lit(extra) + F.floor((pos - big) / max(base, 1))
        tile = F.when(pos < big, F.floor(pos / (base + 1))).otherwise(late)
        df = placed.withColumn(out, (tile + 1).cast("int")).drop("_pos")
    return df


def global_position(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """1-based place of each row in a total order, one range partition per task."""
    ranged = _ranged(df, order)
    # One row per shuffle partition: bounded by the partition count.
    sizes = ranged.groupBy("_part").count()
    offsets = sizes.select("_part", F.coalesce(
        F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    here = Window.partitionBy("_part").orderBy(*order)
    placed = ranged.withColumn("_row", F.row_number().over(here)).join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, F.col("_before") + F.col("_row")).drop("_part", "_before", "_row")


# --- rank inside groups -----------------------------------------------------

def rank_within(df: DataFrame, ranks: Mapping[str, Sequence[str]], order: str) -> DataFrame:
    """Descending ``rank()`` per group for several groupings of one frame, nulls last.

    Pass a materialised frame, because it is read once more per grouping.
    """
    for out, groups in ranks.items():
        df = _rank_by_counts(df, groups, order, out)
    return df


def _rank_by_counts(df: DataFrame, groups: Sequence[str], order: str, out: str) -> DataFrame:
    """Rank = 1 + rows of the group with a greater value.

    Equal values collapse to one counted row before anything is ordered, so neither
    a large group nor a frequent value lands in one task.
    """
    keys = [*groups, order]
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    sort = [*[F.col(g).asc_nulls_first() for g in groups], F.col(order).desc_nulls_last()]
    ranged = _ranged(counted, sort)

    # Rows of the same group in earlier partitions. At most one group crosses each
    # partition border, so the kept offsets are bounded by the partition count.
    by_part = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*groups, "_part").agg(F.sum("_n").alias("_n"))
               .withColumn("_before", F.sum("_n").over(by_part))
               .where("_before IS NOT NULL")
               .select(*[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_part").alias("_p"), "_before"))
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups],
                  F.col("_part") == F.col("_p"))
    here = (Window.partitionBy("_part", *groups).orderBy(F.col(order).desc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, -1))
    ranked = (
        ranged.withColumn("_above", F.coalesce(F.sum("_n").over(here), F.lit(0)))
        .join(offsets, same, "left")
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                (F.col("_above") + F.coalesce(F.col("_before"), F.lit(0)) + 1).cast("int").alias(out))
    )
    back = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(ranked, back).drop(*[f"_k_{k}" for k in keys])


def top_bottom(df: DataFrame, groups: Sequence[str], value: str, tie_break: str, n: int) -> DataFrame:
    """The n best and n worst rows per group, marked ``side``; a row may be both.

    Each side filters on its row number, so only n rows per group leave a map task.
    """
    sides = []
    for side, first in (("top", F.col(value).desc()), ("bottom", F.col(value).asc())):
        window = Window.partitionBy(*groups).orderBy(first, tie_break)
        sides.append(df.withColumn("position", F.row_number().over(window))
                     .where(F.col("position") <= n).withColumn("side", F.lit(side)))
    return sides[0].unionByName(sides[1])


def with_growth(monthly: DataFrame, order: str, value: str, previous: str, growth: str) -> DataFrame:
    """Previous row's value and relative change. The input has one row per month."""
    in_time = Window.orderBy(order)
    before = F.lag(value).over(in_time)
    rate = (F.col(value) - F.col(previous)).cast("double") / F.nullif(F.col(previous).cast("double"), F.lit(0.0))
    return monthly.withColumn(previous, before).withColumn(growth, rate)

"""Same block key and nearly the same name: the third identity rule.

Limits are whole percentages, so every bound below is integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DELETIONS = 2


def fuzzy_match(a: DataFrame, b: DataFrame, block: str, name: str, a_id: str, b_id: str,
                above_pct: int = 90) -> DataFrame:
    """Best partner in ``b`` for each row of ``a`` whose name is similar enough.

    Copies collapse to distinct (block, name) before names are compared and fan out
    again at the end, one row per row of ``a``. Names within ``k`` edits share a text
    left over after at most ``k`` deletions on each side, so an equi-join on (block,
    remainder) finds every pair without comparing all names of a block. Names long
    enough to allow more than two edits are cut into ``k + 1`` pieces instead: one
    piece survives unchanged, shifted by at most ``k`` places.
    """
    rows_a = a.where(F.col(block).isNotNull() & F.col(name).isNotNull())
    names_a = rows_a.select(F.col(block).alias("_block"), F.col(name).alias("_an")).distinct()
    names_b = (b.where(F.col(block).isNotNull() & F.col(name).isNotNull())
               .groupBy(F.col(block).alias("_block"), F.col(name).alias("_bn"))
               .agg(F.min(b_id).alias("_b")))

    # A name without any counterpart in its block needs no marks.
    blocks_a, blocks_b = names_a.select("_block").distinct(), names_b.select("_block").distinct()
    names_a, names_b = names_a.join(blocks_b, "_block", "left_semi"), names_b.join(blocks_a, "_block", "left_semi")
    marked_a = names_a.withColumn("_mark", F.explode(_marks(F.col("_an"), above_pct, probe=True)))
    marked_b = names_b.withColumn("_mark", F.explode(_marks(F.col("_bn"), above_pct, probe=False)))
    longest = F.greatest(F.length("_an"), F.length("_bn"))
    edits = F.levenshtein("_an", "_bn")
    close = marked_a.join(marked_b, ["_block", "_mark"]).where(
        (longest - edits) * 100 > longest * above_pct)
    best = close.groupBy("_block", "_an").agg(
        F.min(F.struct((edits / longest).alias("distance"), F.col("_b").alias("id"))).alias("_best"))

    on = (rows_a[block] == best["_block"]) & (rows_a[name] == best["_an"])
    return rows_a.join(best, on).select(
        rows_a[a_id], F.col("_best.id").alias(b_id), rows_a[block],
        (F.lit(1.0) - F.col("_best.distance")).alias("similarity"))


def _edits(length: Column, above_pct: int) -> Column:
    """Most edits a pair may need when its longer name has this length."""
    return F.greatest(((length * (100 - above_pct) + 99) / 100).cast("int") - 1, F.lit(0))


def _longest(length: Column, above_pct: int) -> Column:
    """Length of the longest name that can still be a partner."""
    return F.greatest(((length * 100 - 1) / above_pct).cast("int"), F.lit(0))


def _reach(length: Column, above_pct: int) -> Column:
    return _edits(_longest(length, above_pct), above_pct)


def _marks(text: Column, above_pct: int, probe: bool) -> Column:
    """Join marks of one name. Both sides of a close pair share at least one."""
    size = F.length(text)
    reach = _reach(size, above_pct)
    none = F.array().cast("array<string>")

    layer = remainders = F.array(text)
    for k in range(1, MAX_DELETIONS + 1):
        layer = F.array_distinct(F.flatten(F.transform(layer, _without_one)))
        remainders = F.when(reach >= k, F.array_union(remainders, layer)).otherwise(remainders)
    short = F.when(_edits(size, above_pct) <= MAX_DELETIONS,
                   F.transform(remainders, lambda r: F.concat(F.lit("d"), r))).otherwise(none)
    long = F.when(reach > MAX_DELETIONS, _pieces(text, size, above_pct, probe)).otherwise(none)
    return F.concat(short, long)


def _without_one(text: Column) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    return F.transform(places, lambda i: F.concat(F.substr(text, F.lit(1), i - 1),
                                                  F.substr(text, i + 1)))


def _pieces(text: Column, size: Column, above_pct: int, probe: bool) -> Column:
    """Pieces of a name of ``b``, or each place such a piece may sit in a name of ``a``.

    A piece is labelled with the length of the ``b`` name and its number.
    """
    reach = _reach(size, above_pct)
    shifts = F.sequence(-reach, reach) if probe else F.array(F.lit(0))

    def cut(length: Column) -> Column:
        count = _reach(length, above_pct) + 1

        def piece(number: Column) -> Column:
            begin = F.floor(number * length / count).cast("int")
            width = F.floor((number + 1) * length / count).cast("int") - begin
            label = F.concat_ws(":", F.lit("p"), length.cast("string"), number.cast("string"))
            places = F.filter(F.transform(shifts, lambda s: begin + s), lambda p: p >= 0)
            return F.transform(places, lambda p: F.concat_ws(":", label, F.substr(text, p + 1, width)))

        return F.flatten(F.transform(F.sequence(F.lit(0), count - 1), piece))

    if not probe:
        return cut(size)
    lengths = F.sequence(F.greatest(size - reach, F.lit(1)), size + reach)
    return F.array_distinct(F.flatten(F.transform(lengths, cut)))

"""Joins: lookups, any-key matching, key checks and settlement matching.

No join here is hinted. Spark measures each side and broadcasts only below
``spark.sql.autoBroadcastJoinThreshold``; beyond it the join shuffles, and AQE
splits partitions that hold a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.shaping import union_all
from martloom.session import write_once

NULL_SLOTS = 4096


def spread_nulls(key: Column, *by: Column) -> Column:
    """Join key whose nulls are scattered over values no real key can have.

    Rows without a key never match, yet a shuffle would send all of them to one task.
    """
    slot = F.pmod(F.xxhash64(*by), F.lit(NULL_SLOTS)).cast("string")
    return F.coalesce(key.cast("string"), F.concat(F.lit("\u0000"), slot))


def left_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                spread_by: str | Sequence[str]) -> DataFrame:
    """Left equi-join on a nullable key; the right key column is not kept.

    ``spread_by`` is a well-filled column of the left side, or several, that scatter its null keys.
    """
    spread = [spread_by] if isinstance(spread_by, str) else spread_by
    keyed = right.where(F.col(right_key).isNotNull()).withColumn(right_key, F.col(right_key).cast("string")).withColumnRenamed(right_key, "_right_key")
    # A column of its own, so that neither the key nor what scatters it moves along unless it is asked for.
    named = left.withColumn("_left_key", spread_nulls(F.col(left_key), *[F.col(c) for c in spread]))
    return named.join(keyed, F.col("_left_key") == F.col("_right_key"), "left").drop("_left_key", "_right_key")


def with_exists_flag(df: DataFrame, key: str, keys: DataFrame, keys_column: str, name: str, spread_by: str) -> DataFrame:
    """Boolean column: does the key occur in the other frame?"""
    known = (keys.select(F.col(keys_column).alias("_known")).where("_known IS NOT NULL").distinct()
             .withColumn(name, F.lit(True)))
    flagged = left_lookup(df, known, key, "_known", spread_by)
    return flagged.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def left_join_any_key(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]],
                      payload: Sequence[str], spread_by: str, blank_is_missing: bool = False) -> DataFrame:
    """Left join on ``k1 = k1 OR k2 = k2 ...`` as one equi-join over all keys.

    Each row of either side stands once per key, as (number of the key, its text), so both sides are read and shuffled
    once whatever the number of keys. A pair found by several keys is kept under the first of them only: no row
    ids and no distinct over the pairs are needed. The join is inner, so AQE can split a hot key on either side.
    Left rows without any partner are those whose every key is unknown; an anti join on the same
    shuffled rows finds them, and equal left rows are counted and given back as often as they occur.

    Keys compare as text. Columns of the left side must be such that rows can be grouped by them (no maps).
    An empty text equals an empty text, as in the definition, so rows whose key is what
    remains of junk all pair up; ``blank_is_missing`` lets it match nothing.
    """
    types, columns = dict(right.dtypes), [F.col(c) for c in left.columns]
    known = (lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))) if blank_is_missing else (lambda c: F.col(c).cast("string"))
    right_keys = [f"_rk{i}" for i in range(len(keys))]

    def per_key(values: list[Column]) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(i).alias("_kind"), v.alias("_value")) for i, v in enumerate(values)]))

    # Null keys of the left side get values that no real key can have, and are scattered by them.
    mine = left.select(*columns, per_key([spread_nulls(F.col(key), F.col(spread_by)) for key, _ in keys]))
    mine = mine.where("_value IS NOT NULL")  # always so; said here, both joins below read the same shuffle
    side = right.select(*[known(r).alias(name) for (_, r), name in zip(keys, right_keys)], *payload)
    theirs = (side.select("*", per_key([F.col(name) for name in right_keys])).where("_value IS NOT NULL")
              .withColumnsRenamed({"_kind": "_rkind", "_value": "_rvalue"}))
    met = (F.col("_kind") == F.col("_rkind")) & (F.col("_value") == F.col("_rvalue"))
    earlier = [(F.col("_kind") > i) & (F.col(key).cast("string") == F.col(name)) for i, ((key, _), name) in enumerate(zip(keys[:-1], right_keys))]
    found_before = reduce(Column.__or__, [F.coalesce(e, F.lit(False)) for e in earlier], F.lit(False))
    pairs = mine.join(theirs, met & ~found_before).select(*columns, *payload)

    unknown = mine.join(theirs.select("_rkind", "_rvalue").distinct(), met, "left_anti")
    alone = (unknown.groupBy(*columns).agg(F.count_if(F.col("_kind") == 0).alias("_n"), F.bit_or(F.expr("shiftleft(1, _kind)")).alias("_kinds"))
             .where(F.col("_kinds") == (1 << len(keys)) - 1))
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))
    empty = [F.lit(None).cast(types[c]).alias(c) for c in payload]
    return union_all(pairs, alone.select(*columns, times.alias("_i")).select(*columns, *empty))


def with_dims(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Left lookups of a fact in its dimensions, one shared key column each.

    Rows without a key are scattered by what else they hold.
    """
    spread_by = [c for c, kind in fact.dtypes if "map<" not in kind]
    return reduce(lambda df, dim: left_lookup(df, dim[0], dim[1], dim[1], spread_by), dims, fact)


def orphans(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Rows whose non-null foreign key has no dimension row."""
    keys = dim.select(F.col(pk).alias("_pk"))
    return fact.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


# --- payment settlement -----------------------------------------------------

def _within(order_time: str, paid_time: str, interval: str) -> Column:
    upper = F.col(order_time) + F.expr(f"INTERVAL {interval}")
    return F.col(paid_time).between(F.col(order_time), upper)


def match_settlements(orders: DataFrame, payments: DataFrame, interval: str = "1 day") -> DataFrame:
    """Payment to order on reference and settlement time; unmatched rows of both sides are kept.

    ``orders(order_id, ordered_at)`` has one row per id, ``payments(payment_id,
    order_ref, paid_at)`` may repeat a reference many times. A full outer join cannot
    be split on a hot reference; a left join from the payments can, and the orders
    nobody paid for follow from an anti join on the matched ids.
    """
    matched_or_not = write_once(left_settlement(orders, payments, interval), "settlement")  # read twice below
    paid = matched_or_not.where("order_id IS NOT NULL").select("order_id").distinct()
    unpaid = orders.join(paid, "order_id", "left_anti").select(
        "order_id", "ordered_at",
        F.lit(None).cast("string").alias("payment_id"),
        F.lit(None).cast("timestamp").alias("paid_at"),
        F.lit("unpaid_order").alias("match_status"))
    return union_all(matched_or_not.drop("order_ref"), unpaid)


def left_settlement(orders: DataFrame, payments: DataFrame, interval: str) -> DataFrame:
    key = spread_nulls(F.col("order_ref"), F.col("payment_id"))
    joined = payments.join(
        orders, (key == F.col("order_id")) & _within("ordered_at", "paid_at", interval), "left")
    status = F.when(F.col("order_id").isNull(), "unmatched_payment").otherwise("matched")
    return joined.select("order_ref", "order_id", "ordered_at", "payment_id", "paid_at",
                         status.alias("match_status"))


def match_settlements_stream(orders: DataFrame, payments: DataFrame, interval: str = "1 day",
                             order_delay: str = "1 hour", payment_delay: str = "1 hour") -> DataFrame:
    """Stream-stream form: rows of ``match_settlements``, unmatched ones once nothing can match them any more.

    Repeats of an order or a payment count once. Both watermarks and the time bound expire the state of either side; what
    expires without a partner comes out with nulls for the other side. Null references are scattered, so
    they meet in no task.
    """
    left = orders.withWatermark("ordered_at", order_delay).dropDuplicates(["order_id", "ordered_at"])
    right = (payments.withWatermark("paid_at", payment_delay).dropDuplicates(["payment_id", "order_ref", "paid_at"])
             .withColumn("_ref", spread_nulls(F.col("order_ref"), F.col("payment_id"))))
    on = (F.col("_ref") == F.col("order_id")) & _within("ordered_at", "paid_at", interval)
    status = (F.when(F.col("payment_id").isNull(), "unpaid_order").when(F.col("order_id").isNull(), "unmatched_payment")
              .otherwise("matched"))
    return left.join(right, on, "full_outer").select("order_id", "ordered_at", "payment_id", "paid_at", status.alias("match_status"))

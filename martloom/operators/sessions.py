"""Batch sessions, bot flags and stock forecasts: time-ordered logic per key.

Each operator folds the rows of a key into short time buckets before it orders
them. A task then sees at most one row per key and bucket, so a key holding a
large share of all rows costs no more than its time span.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.columns import days_between
from martloom.operators.dedup import latest_per_key
from martloom.operators.joins import spread_nulls

_LATER = "_later_"


def sessions_by_gap(events: DataFrame, key: str, ts: str, gap_minutes: int,
                    counts: Mapping[str, Column], last: tuple[str, ...]) -> DataFrame:
    """Sessions split where two events of a key are more than the gap apart.

    Events of one gap-wide bucket always share a session, so counts and last values
    are folded per bucket first.
    """
    micros = F.unix_micros(F.col(ts))
    width = gap_minutes * 60 * 1_000_000
    latest = {name: F.max(F.when(F.col(name).isNotNull(), F.struct(F.col(ts).alias("t"), F.col(name).alias("v"))))
              for name in last}
    folded = events.groupBy(key, F.floor(micros / width).alias("_bucket")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"),
        *[F.count_if(test).alias(name) for name, test in counts.items()],
        *[value.alias(_LATER + name) for name, value in latest.items()])

    in_time = Window.partitionBy(key).orderBy("_bucket")
    pause = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(in_time))
    marked = folded.withColumn("_new", F.when(pause <= width, 0).otherwise(1))
    numbered = marked.withColumn("_session", F.sum("_new").over(in_time))
    return numbered.groupBy(key, "_session").agg(
        F.min("_first").alias("session_start"), F.max("_last").alias("session_end"),
        *[F.sum(name).alias(name) for name in counts],
        *[F.max(_LATER + name)["v"].alias(name) for name in last]).drop("_session")


def flag_bots(events: DataFrame, user: str, ts: str, max_per_minute: int) -> DataFrame:
    """Mark events of users who exceed the rate in that minute. Unknown users pass."""
    minute = F.date_trunc("minute", F.col(ts))
    busy = (events.where(F.col(user).isNotNull())
            .groupBy(F.col(user).alias("_u"), minute.alias("_m")).count()
            .where(F.col("count") > max_per_minute)
            .select("_u", "_m", F.lit(True).alias("is_bot")))
    key = spread_nulls(F.col(user), F.col(ts))
    joined = events.join(busy, (key == F.col("_u")) & (minute == F.col("_m")), "left")
    return joined.drop("_u", "_m").withColumn("is_bot", F.coalesce("is_bot", F.lit(False)))


def days_of_cover(snapshots: DataFrame, tie_break, lookback_days: int, as_of: Column,
                  at_risk_days: int = 3) -> DataFrame:
    """Days the newest stock lasts at the mean daily drop of the lookback period.

    ``snapshots(store_id, sku, qty_available, snapshot_time)``. One closing row per
    store, sku and day is kept before the days are put in order.
    """
    day = F.to_date("snapshot_time")
    recent = snapshots.where((day <= as_of) & (day > F.date_sub(as_of, lookback_days)))
    closing = latest_per_key(recent.withColumn("day", day), ["store_id", "sku", "day"],
                             "snapshot_time", tie_break)
    in_time = Window.partitionBy("store_id", "sku").orderBy("day")
    drop = F.greatest(F.lag("qty_available").over(in_time) - F.col("qty_available"), F.lit(0))
    steps = closing.withColumn("_drop", F.coalesce(drop, F.lit(0)))
    per_item = steps.groupBy("store_id", "sku").agg(
        F.max(F.struct("day", "qty_available"))["qty_available"].alias("qty_available"),
        F.sum("_drop").alias("consumed"),
        days_between(F.min("day"), F.max("day")).alias("days_observed"))
    per_day = F.col("consumed") / F.nullif(F.col("days_observed"), F.lit(0))
    cover = F.col("qty_available") / F.nullif(per_day, F.lit(0.0))
    return (per_item.withColumn("days_of_cover", cover)
            .withColumn("stockout_risk", F.coalesce(F.col("days_of_cover") <= at_risk_days,
                                                    F.col("qty_available") <= 0)))

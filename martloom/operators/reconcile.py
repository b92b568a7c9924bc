"""Batch against stream totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import rules


def day_total(df: DataFrame, day_column: str, date: dt.date, value: str, name: str = "total") -> DataFrame:
    """One row: the sum over one day, 0 when the day has no rows."""
    kind = dict(df.dtypes)[value]
    day = df.where(F.to_date(day_column) == F.lit(date))
    zero = "bigint" if kind == "bigint" else "decimal(28,2)"
    return day.agg(F.coalesce(F.sum(value), F.lit(0)).cast(zero).alias(name))


def daily(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Drift per day. Inputs are (date_key, revenue) rows of either path."""
    joined = _totals(batch, ["date_key"], "batch_total").join(
        _totals(stream, ["date_key"], "stream_total"), "date_key", "full_outer")
    return _with_drift(joined, "batch_total", "stream_total")


def flag(df: DataFrame, threshold: float = rules.RECONCILIATION_THRESHOLD_PCT) -> DataFrame:
    """Add the alert level and whether the drift stays within the threshold."""
    return df.withColumns({
        "alert_level": rules.reconciliation_alert("discrepancy_pct", threshold),
        "is_within_threshold": F.col("discrepancy_pct") <= threshold,
    })


def by_store(batch: DataFrame, stream: DataFrame, date: dt.date | None = None) -> DataFrame:
    """Stores and channels whose totals drift, worst first.

    Inputs are (date_key, store_id, channel, revenue). Both sides are summed before
    they meet, so the outer join sees one row per key.
    """
    if date is not None:
        batch, stream = (df.where(F.col("date_key") == F.lit(date)) for df in (batch, stream))
    keys = ["date_key", "store_id", "channel"]
    joined = _totals(batch, keys, "batch_revenue").join(
        _totals(stream, keys, "stream_revenue"), keys, "full_outer")
    drifted = flag(_with_drift(joined, "batch_revenue", "stream_revenue"))
    return drifted.where("alert_level <> 'OK'").orderBy(F.desc("discrepancy_pct"), *keys)


def _totals(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("revenue").alias(name))


def _with_drift(df: DataFrame, batch: str, stream: str) -> DataFrame:
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in (batch, stream)})
    return filled.withColumn("discrepancy_pct", rules.drift_pct(batch, stream))

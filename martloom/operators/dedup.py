"""Deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.shaping import require_keys


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str,
                   tie_break: Sequence[Column | str]) -> DataFrame:
    """Newest row per key.

    ``tie_break`` makes the choice among equal times deterministic. The filter on
    the row number lets Spark drop all but one candidate per key in every map task
    before the shuffle, so a key with very many copies does not pile up anywhere.
    """
    order = [F.col(order_by).desc_nulls_last(), *tie_break]
    newest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(newest)).where("_row = 1").drop("_row")


def dedup_any(df: DataFrame, *keys: str) -> DataFrame:
    """Any one row per non-null key. The null filter goes first: fewer rows are shuffled."""
    return require_keys(df, *keys).dropDuplicates(list(keys))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return require_keys(df.select(*columns), *columns).distinct()


def latest_snapshot(stock: DataFrame, tie_break: Sequence[Column | str]) -> DataFrame:
    return latest_per_key(stock, ["store_id", "sku"], "snapshot_time", tie_break)

"""Projections, unions, spines, pivots and rule-driven aggregates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.rules import AggregateRule


def select_typed(df: DataFrame, spec: Iterable[tuple[str, str, str] | str]) -> DataFrame:
    """Rename and cast. A value that does not fit its type becomes null, never an error."""
    columns = []
    for item in spec:
        if isinstance(item, str):
            columns.append(F.col(item))
        else:
            source, target, kind = item
            columns.append(F.col(source).try_cast(kind).alias(target))
    return df.select(*columns)


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, name: str = "date_key") -> DataFrame:
    """One row per day, both ends included."""
    days = (end - start).days + 1
    return spark.range(days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def pivot_sum(df: DataFrame, key: str, source: str, columns: dict[str, str], value: str) -> DataFrame:
    """One summed column per known source value; the list is fixed, so no extra scan finds it."""
    totals = [
        F.coalesce(F.sum(F.when(F.col(source) == val, F.col(value))), F.lit(0)).cast("bigint").alias(name)
        for val, name in columns.items()
    ]
    return df.groupBy(key).agg(*totals)


def aggregate_rule(df: DataFrame, rule: AggregateRule, where: Column | str | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.groupBy(*rule.keys).agg(*[F.expr(sql).alias(name) for name, sql in rule.metrics.items()])


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Report of the n first rows; each task keeps n rows before they are merged."""
    return df.orderBy(*order).limit(n)

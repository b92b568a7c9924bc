"""Collects the queries and their check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.catalog.oracle import CTES
from martloom.plans.lake import Lake
from martloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


_ORDER_MONEY = ("amount", "discount")
_WINDOW_MONEY = ("gross_revenue", "net_revenue", "avg_order_value")
_TOTALS = ("batch_total", "stream_total")

# Decimal columns of a result. Clients hand decimals to Python in different ways, so
# both sides of a comparison show them as doubles; the library itself keeps decimals.
DECIMALS = {
    **dict.fromkeys(["p2_key_not_null", "p3_positive_amount", "p4_order_filter", "s4_read_parquet_partition",
                     "s6_append_partitioned", "s7_overwrite_day", "s8_replace_table", "s11_write_records",
                     "s13_kafka_decode", "t2_valid_orders_stream", "t11_ttl_retention", "x17_compact_files"], _ORDER_MONEY),
    **dict.fromkeys(["a10_rule_driven_agg", "t3_revenue_1min", "t9_summing_merge", "t12_checkpoint_resume",
                     "t13_late_data", "t13_late_rows_kept"], _WINDOW_MONEY),
    **dict.fromkeys(["r1_batch_stream_daily", "r1_batch_vs_drained_stream", "r2_drift_threshold"], _TOTALS),
    "p1_rename_cast": ("total_amount",),
    "a3_conditional_agg": ("completed_amount",),
    "a6_day_total": ("total",),
    "j7_batch_stream_full_join": ("batch_revenue", "stream_revenue"),
    "s17_backfill_range": ("amount",),
    "t7_payment_gateway_stats": ("total_amount",),
}


def query(name: str, sql: str | None = None) -> Callable[[Callable], Callable]:
    """Register ``fn(spark, folder)`` under a name."""
    decimals = DECIMALS.get(name, ())

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder).withColumns({c: F.col(c).cast("double") for c in decimals})
        _QUERIES[name] = run
        if sql is not None:
            shown = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in decimals)
            checked = with_ctes(sql)
            _SQL[name] = f"SELECT * REPLACE ({shown}) FROM ({checked})" if decimals else checked
        return fn
    return register


def lake_query(name: str, sql: str | None = None) -> Callable[[Callable], Callable]:
    """Register ``fn(lake)``: a query over the models."""
    def register(fn: Callable[[Lake], DataFrame]) -> Callable:
        query(name, sql)(lambda spark, folder: fn(Lake.over_sample(spark, folder)))
        return fn
    return register


def with_ctes(sql: str) -> str:
    """Put the named subqueries a statement uses in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text):
            if word in CTES and word not in needed:
                visit(CTES[word])
                needed.append(word)

    visit(sql)
    if not needed:
        return sql
    recursive = sql.lstrip().upper().startswith("WITH RECURSIVE")
    body = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    if recursive:
        return f"WITH RECURSIVE {body},\n{sql.lstrip()[len('WITH RECURSIVE'):]}"
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {body},\n{sql.lstrip()[len('WITH '):]}"
    return f"WITH {body}\n{sql}"


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_SQL)

"""Q and R rows: data checks and reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom import schemas
from martloom.catalog.registry import lake_query, query
from martloom.catalog.relational import both_paths
from martloom.operators import quality, reconcile
from martloom.operators.quality import Check, run_checks
from martloom.operators.shaping import union_all
from martloom.plans.checks import FRESHNESS, GATEWAYS, PAYMENT_STATUSES, PHONE, declared_checks, source_freshness
from martloom.plans.lake import checked_build
from martloom.sources.sample import raw_stream, raw_view, table
from martloom.streaming import live
from martloom.streaming.sinks import drain

AS_OF = dt.datetime(2001, 12, 31)

# The newest live window is still open when the stream has been drained.
CLOSED = "(SELECT max(event_time) - INTERVAL 5 SECOND FROM raw_order_events WHERE customer_id IS NOT NULL AND amount > 0)"


def _row(check: str, measured: str, source: str, ok: str = "= 0") -> str:
    """One report line. ``measured`` is an aggregate over ``source``."""
    return (f"SELECT '{check}' AS \"check\", measured, CASE WHEN measured {ok} THEN 'pass' ELSE 'fail' END AS status "
            f"FROM (SELECT CAST({measured} AS DOUBLE) AS measured FROM {source})")


def _bad(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def _report(*rows: str) -> str:
    return " UNION ALL ".join(rows)


@lake_query("q1_row_count", _report(
    _row("row_count > 0", "count(*)", "dim_stores", "> 0"), _row("row_count = 120", "count(*)", "dim_stores", "= 120")))
def _(lake):
    return run_checks(lake["dim_stores"], [Check.row_count(), Check.row_count("=", 120)])


@query("q2_missing_count", _report(
    _row("missing_count(order_id)", _bad("order_id IS NULL"), "raw_order_events"),
    _row("missing_count(customer_id)", _bad("customer_id IS NULL"), "raw_order_events")))
def _(spark, folder):
    return run_checks(raw_view(spark, folder, "order_events"), [Check.missing("order_id"), Check.missing("customer_id")])


@query("q3_duplicate_count", _report(
    _row("duplicate_count(txn_id)", "count(*)", "(SELECT txn_id FROM raw_pos_transactions GROUP BY 1 HAVING count(*) > 1)"),
    _row("duplicate_count(txn_id, txn_timestamp)", "count(*)",
         "(SELECT 1 FROM raw_pos_transactions GROUP BY txn_id, txn_timestamp HAVING count(*) > 1)")))
def _(spark, folder):
    return run_checks(raw_view(spark, folder, "pos_transactions"),
                      [Check.duplicates("txn_id"), Check.duplicates("txn_id", "txn_timestamp")])


@query("q4_invalid_range", _report(
    _row("invalid_range(amount)", _bad("amount < 0"), "raw_order_events"),
    _row("invalid_range(discount)", _bad("discount < 0 OR discount > 1"), "raw_order_events")))
def _(spark, folder):
    return run_checks(raw_view(spark, folder, "order_events"),
                      [Check.in_range("amount", low=0), Check.in_range("discount", 0, 1)])


@lake_query("q5_invalid_regex", _report(
    _row("invalid_regex(phone_normalized)", _bad("NOT regexp_matches(phone_normalized, '^0\\d{9}$')"), "stg_loyalty__members"),
    _row("invalid_regex(loyalty_member_id)", _bad("NOT regexp_matches(loyalty_member_id, '^LYL-\\d{7,}$')"),
         "stg_loyalty__members")))
def _(lake):
    return run_checks(lake["stg_loyalty__members"],
                      [Check.matches("phone_normalized", PHONE), Check.matches("loyalty_member_id", r"^LYL-\d{7,}$")])


@lake_query("q6_accepted_values", _report(
    _row("accepted_values(gateway)", _bad("gateway NOT IN ('vnpay', 'momo', 'card')"), "stg_payments__consolidated"),
    _row("accepted_values(status)", _bad("status NOT IN ('success', 'failed', 'pending', 'refunded')"),
         "stg_payments__consolidated")))
def _(lake):
    return run_checks(lake["stg_payments__consolidated"],
                      [Check.accepted("gateway", GATEWAYS), Check.accepted("status", PAYMENT_STATUSES)])


def _age(entity: str) -> str:
    ts, (warn, error) = schemas.EVENT_TIMES[entity], FRESHNESS[entity]
    return (f"SELECT '{entity}' AS source, '{ts}' AS ts, {warn} AS warn, {error} AS error, "
            f"(epoch_us(TIMESTAMP '2024-01-31 02:00:00') - epoch_us(max({ts}))) / 3600000000 AS age FROM raw_{entity}")


@query("q7_freshness", f"""
    SELECT source, 'freshness(' || ts || ')' AS "check", age AS measured,
           CASE WHEN age < warn THEN 'pass' WHEN age < error THEN 'warn' ELSE 'fail' END AS status
    FROM ({" UNION ALL ".join(map(_age, FRESHNESS))})""")
def _(spark, folder):
    now = F.lit(dt.datetime(2024, 1, 31, 2))
    return union_all(*[
        run_checks(raw_view(spark, folder, entity), [source_freshness(entity, schemas.EVENT_TIMES[entity], now)])
        .select(F.lit(entity).alias("source"), "check", "measured", "status")
        for entity in FRESHNESS])


@query("q8_relationships", _report(
    _row("relationship(c_custkey)", "count(*)", "(SELECT 1 FROM customer ANTI JOIN orders ON c_custkey = o_custkey)"),
    _row("relationship(c_nationkey)", "count(*)", "(SELECT 1 FROM customer ANTI JOIN nation ON c_nationkey = n_nationkey)")))
def _(spark, folder):
    orders, nations = (table(spark, folder, t) for t in ("orders", "nation"))
    return run_checks(table(spark, folder, "customer"), [
        Check.relationship("c_custkey", orders, "o_custkey"), Check.relationship("c_nationkey", nations, "n_nationkey")])


@lake_query("q9_agg_threshold", _report(
    _row("min(total_revenue_vnd) >= 0", "min(total_revenue_vnd)", "fct_revenue_daily", ">= 0"),
    _row("max(total_orders) < 2.0", "max(total_orders)", "fct_revenue_daily", "< 2")))
def _(lake):
    return run_checks(lake["fct_revenue_daily"], [
        Check.metric("min(total_revenue_vnd)", ">=", 0), Check.metric("max(total_orders)", "<", 2.0)])


@lake_query("q10_failed_rows", _row(
    "failed_rows(alert)", _bad("reconciliation_status = 'ALERT'"), "fct_reconciliation"))
def _(lake):
    return run_checks(lake["fct_reconciliation"], [Check.fails("alert", "reconciliation_status = 'ALERT'")])


def _count(table: str) -> str:
    return _row("row_count > 0", "count(*)", table, "> 0")


def _missing(table: str, *columns: str) -> list[str]:
    return [_row(f"missing_count({c})", _bad(f"{c} IS NULL"), table) for c in columns]


def _twice(table: str, column: str) -> str:
    return _row(f"duplicate_count({column})", "count(*)",
                f"(SELECT 1 FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)")


def _range(table: str, column: str, outside: str) -> str:
    return _row(f"invalid_range({column})", _bad(f"{column} {outside}"), table)


def _pattern(table: str, column: str, pattern: str) -> str:
    return _row(f"invalid_regex({column})", _bad(f"NOT regexp_matches({column}, '{pattern}')"), table)


def _accepted(table: str, column: str, *values: str) -> str:
    return _row(f"accepted_values({column})", _bad(f"{column} NOT IN ({', '.join(repr(v) for v in values)})"), table)


def _fresh(table: str, column: str) -> str:
    return _row(f"freshness({column})", f"(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max({column}))) / 3600000000", table, "< 24")


def _orphans(table: str, key: str, dim: str) -> str:
    return _row(f"relationship({key})", "count(*)", f"{table} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {dim})")


# Every declared check again, as SQL over the same tables.
_DECLARED = {
    "stg_pos__transactions": lambda t: [
        _count(t), *_missing(t, "txn_id"), _twice(t, "txn_id"), _range(t, "total_amount_vnd", "< 0"),
        _pattern(t, "store_id", "^STR-\\d{3}$"), _fresh(t, "txn_timestamp")],
    "stg_ecommerce__orders": lambda t: [
        _count(t), *_missing(t, "order_id"), _twice(t, "order_id"), _range(t, "total_amount_vnd", "< 1000"), _fresh(t, "order_date")],
    "stg_ecommerce__customers": lambda t: [
        _count(t), *_missing(t, "ecom_customer_id"), _twice(t, "ecom_customer_id"), _pattern(t, "phone_normalized", "^0\\d{9}$")],
    "stg_payments__consolidated": lambda t: [
        _count(t), *_missing(t, "payment_id"), _twice(t, "payment_id"), _range(t, "amount_vnd", "< 0"),
        _accepted(t, "gateway", "vnpay", "momo", "card"), _accepted(t, "status", "success", "failed", "pending", "refunded")],
    "stg_inventory__stock_levels": lambda t: [_count(t), *_missing(t, "store_id", "sku"), _range(t, "qty_available", "< 0")],
    "stg_loyalty__members": lambda t: [
        _count(t), *_missing(t, "loyalty_member_id"), _twice(t, "loyalty_member_id"), _pattern(t, "phone_normalized", "^0\\d{9}$"),
        _accepted(t, "tier", "Bronze", "Silver", "Gold", "Platinum")],
    "stg_clickstream__events": lambda t: [_count(t), *_missing(t, "event_id", "session_id")],
    "int_customers_unified": lambda t: [_count(t), *_missing(t, "customer_uid"), _twice(t, "customer_uid")],
    "int_orders_all_channels": lambda t: [_count(t), *_missing(t, "order_id")],
    "dim_customers": lambda t: [
        _count(t), *_missing(t, "customer_uid"), _twice(t, "customer_uid"),
        _accepted(t, "rfm_segment", "Champion", "Loyal", "New Customer", "At Risk", "Hibernating", "Lost", "Regular")],
    "dim_stores": lambda t: [
        _row("row_count = 120", "count(*)", t, "= 120"), *_missing(t, "store_id"), _twice(t, "store_id"),
        _accepted(t, "region", "North", "Central", "South")],
    "dim_products": lambda t: [*_missing(t, "product_id"), _twice(t, "product_id"), *_missing(t, "price_vnd"), _range(t, "price_vnd", "< 0")],
    "dim_date": lambda t: [*_missing(t, "date_key"), _twice(t, "date_key")],
    "fct_revenue_daily": lambda t: [
        _count(t), _row("min(total_revenue_vnd) >= 0", "min(total_revenue_vnd)", t, ">= 0"),
        *_missing(t, "date_key", "total_revenue_vnd"), _range(t, "total_revenue_vnd", "< 0"), _orphans(t, "date_key", "dim_date")],
    "fct_revenue_monthly": lambda t: [*_missing(t, "month_key"), _twice(t, "month_key")],
    "fct_reconciliation": lambda t: [
        _count(t), *_missing(t, "date_key"), _twice(t, "date_key"), _accepted(t, "reconciliation_status", "OK", "ALERT"),
        _row("failed_rows(alert)", _bad("reconciliation_status = 'ALERT'"), t),
        f"""SELECT 'avg(discrepancy_pct) < 2.0' AS "check", round(measured, 9) AS measured, CASE WHEN measured < 2 THEN 'pass' ELSE 'fail' END AS status
            FROM (SELECT avg(discrepancy_pct) AS measured FROM {t})"""],
    "fct_campaign_performance": lambda t: [*_missing(t, "campaign"), _range(t, "conversion_rate", "NOT BETWEEN 0 AND 1")],
    "fct_funnel_daily": lambda t: [*_missing(t, "date_key"), _range(t, "overall_conversion_rate", "NOT BETWEEN 0 AND 1")],
    "fct_store_performance": lambda t: [
        *_missing(t, "store_id", "date_key"), _range(t, "total_revenue_vnd", "< 0"), _orphans(t, "store_id", "dim_stores")],
    "fct_inventory_alerts": lambda t: [
        *_missing(t, "store_id", "sku"), _accepted(t, "stock_status", "OUT_OF_STOCK", "LOW_STOCK", "REORDER_NEEDED"),
        _accepted(t, "alert_severity", "Critical", "High", "Medium")],
}


@lake_query("q11_check_report", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, * FROM ({_report(*rows(name))})" for name, rows in _DECLARED.items()))
def _(lake):
    """Every declared check of every table. Plain checks are observed while a table is written; means are rounded like their SQL."""
    reports = checked_build(lake, declared_checks(lake, F.lit(AS_OF)))
    shown = F.when(F.col("check").startswith("avg("), F.round("measured", 9)).otherwise(F.col("measured")).alias("measured")
    return union_all(*[report.select(F.lit(name).alias("table_name"), "check", shown, "status") for name, report in reports.items()])


# --- reconciliation ---------------------------------------------------------

_DAILY = """
    SELECT date_key, batch_total, stream_total,
           round(abs(CAST(batch_total AS DOUBLE) - CAST(stream_total AS DOUBLE)) / CAST(batch_total AS DOUBLE) * 100, 4) AS discrepancy_pct
    FROM (SELECT CAST(event_time AS DATE) AS date_key, CAST(sum(amount) AS DECIMAL(28,2)) AS batch_total,
                 CAST(coalesce(sum(amount) FILTER (customer_id IS NOT NULL), 0) AS DECIMAL(28,2)) AS stream_total
          FROM raw_order_events WHERE amount > 0 GROUP BY 1)"""


@query("r1_batch_stream_daily", _DAILY)
def _(spark, folder):
    return reconcile.daily(*both_paths(spark, folder))


@query("r1_batch_vs_drained_stream", f"""
    SELECT date_key, batch_total, stream_total,
           round(abs(CAST(batch_total AS DOUBLE) - CAST(stream_total AS DOUBLE)) / CAST(batch_total AS DOUBLE) * 100, 4) AS discrepancy_pct
    FROM (SELECT CAST(event_time AS DATE) AS date_key, CAST(sum(amount) AS DECIMAL(28,2)) AS batch_total,
                 CAST(coalesce(sum(amount) FILTER (customer_id IS NOT NULL
                     AND time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE <= {CLOSED}), 0) AS DECIMAL(28,2)) AS stream_total
          FROM raw_order_events WHERE amount > 0 GROUP BY 1)""")
def _(spark, folder):
    batch, _stream = both_paths(spark, folder)
    windows = drain(live.revenue_realtime(raw_stream(spark, folder, "order_events")), "r1")
    stream = windows.select(F.to_date("window_start").alias("date_key"), F.col("gross_revenue").alias("revenue"))
    return reconcile.daily(batch, stream)


@query("r2_drift_threshold", f"""
    SELECT *, CASE WHEN discrepancy_pct > 3 THEN 'CRITICAL' WHEN discrepancy_pct > 1 THEN 'WARNING' ELSE 'OK' END AS alert_level,
           discrepancy_pct <= 1 AS is_within_threshold FROM ({_DAILY})""")
def _(spark, folder):
    return reconcile.flag(reconcile.daily(*both_paths(spark, folder)))


@lake_query("r3_three_way", "SELECT * FROM fct_reconciliation")
def _(lake):
    return lake["fct_reconciliation"]


_SOURCES = {schemas.LANDING[e][0]: (e, ts) for e, ts in schemas.EVENT_TIMES.items()}


@query("r4_no_data_alert", f"""
    SELECT * FROM (VALUES {", ".join(f"('{name}')" for name in [*_SOURCES, "returns"])}) AS expected(source)
    WHERE source NOT IN (
        SELECT source FROM ({" UNION ALL ".join(f"SELECT '{name}' AS source, max({ts}) AS seen FROM raw_{e}" for name, (e, ts) in _SOURCES.items())})
        WHERE seen > TIMESTAMP '2024-01-31 01:00:00' - INTERVAL 2 HOUR)""")
def _(spark, folder):
    seen = quality.last_seen({name: (raw_view(spark, folder, e), ts) for name, (e, ts) in _SOURCES.items()})
    return quality.silent_sources(spark, seen, [*_SOURCES, "returns"], F.lit(dt.datetime(2024, 1, 31, 1)))

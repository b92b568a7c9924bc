"""The declared checks of every model."""

from __future__ import annotations

from pyspark.sql import Column

from martloom.operators.quality import Check
from martloom.plans.lake import Lake

# --- fixed values: patterns and accepted sets -------------------------------
STORE_ID = r"^STR-\d{3}$"
PHONE = r"^0\d{9}$"
PAYMENT_STATUSES = ["success", "failed", "pending", "refunded"]
GATEWAYS = ["vnpay", "momo", "card"]
TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
REGIONS = ["North", "Central", "South"]
SEGMENTS = ["Champion", "Loyal", "New Customer", "At Risk", "Hibernating", "Lost", "Regular"]
STOCK_STATUSES = ["OUT_OF_STOCK", "LOW_STOCK", "REORDER_NEEDED"]
SEVERITIES = ["Critical", "High", "Medium"]
STORE_COUNT = 120
MIN_ORDER_VND = 1000

# source -> (warn after, error after) in hours
FRESHNESS = {"pos_transactions": (2, 6), "ecom_orders": (1, 4), "stock_levels": (1, 3), "clickstream_events": (1, 6)}


def declared_checks(lake: Lake, as_of: Column) -> dict[str, list[Check]]:
    """Table name to checks. Names follow the models, not the older column names."""
    return {
        "stg_pos__transactions": [
            Check.row_count(), Check.missing("txn_id"), Check.duplicates("txn_id"),
            Check.in_range("total_amount_vnd", low=0), Check.matches("store_id", STORE_ID),
            Check.freshness("txn_timestamp", as_of, 24, 24)],
        "stg_ecommerce__orders": [
            Check.row_count(), Check.missing("order_id"), Check.duplicates("order_id"),
            Check.in_range("total_amount_vnd", low=MIN_ORDER_VND), Check.freshness("order_date", as_of, 24, 24)],
        "stg_ecommerce__customers": [
            Check.row_count(), Check.missing("ecom_customer_id"), Check.duplicates("ecom_customer_id"),
            Check.matches("phone_normalized", PHONE)],
        "stg_payments__consolidated": [
            Check.row_count(), Check.missing("payment_id"), Check.duplicates("payment_id"),
            Check.in_range("amount_vnd", low=0), Check.accepted("gateway", GATEWAYS),
            Check.accepted("status", PAYMENT_STATUSES)],
        "stg_inventory__stock_levels": [
            Check.row_count(), Check.missing("store_id"), Check.missing("sku"),
            Check.in_range("qty_available", low=0)],
        "stg_loyalty__members": [
            Check.row_count(), Check.missing("loyalty_member_id"), Check.duplicates("loyalty_member_id"),
            Check.matches("phone_normalized", PHONE), Check.accepted("tier", TIERS)],
        "stg_clickstream__events": [
            Check.row_count(), Check.missing("event_id"), Check.missing("session_id")],
        "int_customers_unified": [
            Check.row_count(), Check.missing("customer_uid"), Check.duplicates("customer_uid")],
        "int_orders_all_channels": [Check.row_count(), Check.missing("order_id")],
        "dim_customers": [
            Check.row_count(), Check.missing("customer_uid"), Check.duplicates("customer_uid"),
            Check.accepted("rfm_segment", SEGMENTS)],
        "dim_stores": [
            Check.row_count("=", STORE_COUNT), Check.missing("store_id"), Check.duplicates("store_id"),
            Check.accepted("region", REGIONS)],
        "dim_products": [
            Check.missing("product_id"), Check.duplicates("product_id"), Check.missing("price_vnd"),
            Check.in_range("price_vnd", low=0)],
        "dim_date": [Check.missing("date_key"), Check.duplicates("date_key")],
        "fct_revenue_daily": [
            Check.row_count(), Check.metric("min(total_revenue_vnd)", ">=", 0), Check.missing("date_key"),
            Check.missing("total_revenue_vnd"), Check.in_range("total_revenue_vnd", low=0),
            Check.relationship("date_key", lambda: lake["dim_date"], "date_key")],
        "fct_revenue_monthly": [Check.missing("month_key"), Check.duplicates("month_key")],
        "fct_reconciliation": [
            Check.row_count(), Check.missing("date_key"), Check.duplicates("date_key"),
            Check.accepted("reconciliation_status", ["OK", "ALERT"]),
            Check.fails("alert", "reconciliation_status = 'ALERT'"),
            Check.metric("avg(discrepancy_pct)", "<", 2.0)],
        "fct_campaign_performance": [
            Check.missing("campaign"), Check.in_range("conversion_rate", 0, 1)],
        "fct_funnel_daily": [Check.missing("date_key"), Check.in_range("overall_conversion_rate", 0, 1)],
        "fct_store_performance": [
            Check.missing("store_id"), Check.missing("date_key"), Check.in_range("total_revenue_vnd", low=0),
            Check.relationship("store_id", lambda: lake["dim_stores"], "store_id")],
        "fct_inventory_alerts": [
            Check.missing("store_id"), Check.missing("sku"), Check.accepted("stock_status", STOCK_STATUSES),
            Check.accepted("alert_severity", SEVERITIES)],
    }


def source_freshness(entity: str, ts: str, as_of: Column) -> Check:
    warn, error = FRESHNESS[entity]
    return Check.freshness(ts, as_of, warn, error)

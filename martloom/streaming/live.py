"""Live aggregates. Every function takes a streaming frame; those with tumbling or
sliding windows accept a batch frame too and then return all windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import rules
from martloom.functions.columns import count_where, last_by

ORDER_DELAY = "5 seconds"
CLICK_DELAY = "10 seconds"

ORDER_COLUMNS = ("order_id", "customer_id", "store_id", "channel", "amount", "discount",
                 "payment_method", "status", "event_time")


def valid_orders(orders: DataFrame) -> DataFrame:
    """Order log: the shared validity rule, no state."""
    return orders.where(rules.order_filter()).select(*ORDER_COLUMNS)


def _flat_window(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def revenue_realtime(orders: DataFrame, window: str = "1 minute", delay: str = ORDER_DELAY) -> DataFrame:
    """Revenue per tumbling window, store and channel."""
    grouped = (
        valid_orders(orders).withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window), "store_id", "channel")
        .agg(F.count("*").alias("order_count"),
             F.sum("amount").cast("decimal(18,2)").alias("gross_revenue"),
             F.sum(F.col("amount") - F.col("discount")).cast("decimal(18,2)").alias("net_revenue"),
             (F.sum("amount") / F.count("amount")).cast("decimal(10,2)").alias("avg_order_value")))
    return _flat_window(grouped)


SESSION_COUNTS = {"page_views": "page_view", "clicks": "click", "add_to_carts": "add_to_cart", "purchases": "purchase"}
SESSION_LAST = ("user_id", "device_type", "utm_source", "utm_campaign", "city")


def sessions(events: DataFrame, gap_minutes: int = rules.SESSION_TIMEOUT_MINUTES, delay: str = CLICK_DELAY) -> DataFrame:
    """One row per session once the watermark passes its end. For batch frames use
    ``operators.sessions.sessions_by_gap``, which never holds all rows of a key."""
    counts = [count_where(F.col("event_type") == kind).cast("int").alias(name) for name, kind in SESSION_COUNTS.items()]
    return (
        events.withWatermark("event_time", delay)
        .groupBy(F.session_window("event_time", f"{gap_minutes} minutes").alias("window"), "session_id")
        .agg(F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end"),
             *counts, *[last_by(c, "event_time").alias(c) for c in SESSION_LAST])
        .drop("window"))


def flash_sale(events: DataFrame, window: str = "1 minute", delay: str = CLICK_DELAY) -> DataFrame:
    """Flash-sale page events, distinct sessions and distinct users per window.

    Streams cannot count distinct values directly, and one set per window would hold
    every visitor of a sale in one state row. Instead each visitor id is its own
    state row in a first aggregate, and a second one counts them.
    """
    ids = F.array(
        F.struct(F.lit("session").alias("kind"), F.col("session_id").alias("id"), F.lit(1).alias("n")),
        F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.lit(0).alias("n")))
    tagged = (events.where(rules.is_flash_sale("page_url")).withWatermark("event_time", delay)
              .select("event_time", "event_type", F.inline(ids)))
    per_id = (tagged.groupBy(F.window("event_time", window), "event_type", "kind", "id")
              .agg(F.sum("n").alias("n")))
    known = F.col("id").isNotNull()
    grouped = (
        per_id.groupBy(F.window(F.window_time("window"), window), "event_type")
        .agg(F.sum("n").alias("event_count"),
             count_where((F.col("kind") == "session") & known).alias("unique_sessions"),
             count_where((F.col("kind") == "user") & known).alias("unique_users")))
    return _flat_window(grouped)


def gateway_stats(payments: DataFrame, window: str = "1 minute", delay: str = ORDER_DELAY) -> DataFrame:
    """Attempts, outcomes and amount per gateway and window."""
    grouped = (
        payments.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window), "gateway")
        .agg(F.count("*").alias("total_attempts"),
             count_where(F.col("status") == "success").alias("successful"),
             count_where(F.col("status") == "failed").alias("failed"),
             F.sum("amount").cast("decimal(18,2)").alias("total_amount")))
    return _flat_window(grouped).drop("window_end")


def inventory_alerts(stock: DataFrame) -> DataFrame:
    """Classify stock events as they arrive; healthy levels are dropped."""
    return (stock.withColumn("alert_type", rules.inventory_alert())
            .where("alert_type IS NOT NULL")
            .select(F.col("event_time").alias("detected_at"), "store_id", "sku", "product_id",
                    "qty_available", "safety_stock", "alert_type"))


def stock_sliding(stock: DataFrame, size: str = "5 minutes", slide: str = "1 minute", delay: str = CLICK_DELAY) -> DataFrame:
    """Lowest stock per store and sku in sliding windows, where it calls for an alert."""
    grouped = (
        stock.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", size, slide), "store_id", "sku")
        .agg(F.min("qty_available").alias("min_qty"),
             F.max("safety_stock").alias("safety_stock"), F.max("reorder_point").alias("reorder_point")))
    flat = _flat_window(grouped).withColumn("alert_type", rules.inventory_alert("min_qty"))
    return flat.where("alert_type IS NOT NULL").drop("safety_stock", "reorder_point")

"""Intermediate models: identity, order union, customer metrics, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import rules
from martloom.functions.columns import count_where, days_between, safe_ratio, seconds_between, surrogate_key
from martloom.operators.dedup import latest_per_key
from martloom.operators.joins import left_join_any_key, left_lookup, with_exists_flag
from martloom.operators.shaping import union_all

SESSION_KEYS = ("session_id", "ecom_customer_id", "device_type", "browser", "os", "country", "city",
                "referrer", "utm_campaign", "utm_source", "utm_medium")


def int_customers_unified(customers: DataFrame, members: DataFrame, pos: DataFrame,
                          best_match: bool = False, blank_is_missing: bool = False) -> DataFrame:
    """E-commerce customers with loyalty match and in-store activity.

    A customer matching several members appears once per member. ``best_match``
    keeps one: phone before email, then the smallest member id. ``blank_is_missing``
    keeps customers and members with an empty phone or email from matching each other by it.
    """
    base = customers.select("ecom_customer_id", F.col("full_name").alias("customer_name"), "email",
                            "phone_normalized", F.col("registered_at").alias("first_seen_at"))
    side = members.select("loyalty_member_id", F.col("phone_normalized").alias("member_phone"),
                          F.col("email").alias("member_email"))
    carried = side.withColumn("by_phone", F.col("member_phone"))
    matched = left_join_any_key(base, carried, [("phone_normalized", "member_phone"), ("email", "member_email")],
                                ["loyalty_member_id", "by_phone"], spread_by="ecom_customer_id", blank_is_missing=blank_is_missing)
    if best_match:
        matched = (matched.withColumn("_phone_hit", F.coalesce(F.col("by_phone") == F.col("phone_normalized"), F.lit(False)))
                   .transform(latest_per_key, ["ecom_customer_id"], "_phone_hit", ["loyalty_member_id"])
                   .drop("_phone_hit"))
    flagged = with_exists_flag(matched.drop("by_phone"), "phone_normalized", pos, "customer_phone", "in_store",
                               spread_by="ecom_customer_id")
    return flagged.select(
        surrogate_key("ecom_customer_id", "phone_normalized").alias("customer_uid"),
        "ecom_customer_id", "loyalty_member_id", "customer_name", "email", "phone_normalized", "first_seen_at",
        rules.customer_type("loyalty_member_id", "in_store").alias("customer_type"),
        rules.is_omnichannel("loyalty_member_id", "in_store").alias("is_omnichannel"))


def int_orders_all_channels(pos: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Till sales and online orders in one shape, each with its customer."""
    by_phone = customers.select("customer_uid", "phone_normalized")
    by_id = customers.select("customer_uid", "ecom_customer_id")
    shop = left_lookup(pos.drop("items"), by_phone, "customer_phone", "phone_normalized", spread_by="txn_id").select(
        F.col("txn_id").alias("order_id"), F.lit("pos").alias("channel"), "store_id", "customer_uid",
        "total_amount_vnd", "discount_amount_vnd", "tax_amount_vnd", "payment_method", "num_items",
        F.col("txn_timestamp").alias("order_timestamp"), F.col("txn_date").alias("order_date"),
        F.lit("completed").alias("status"))
    web = left_lookup(orders, by_id.withColumnRenamed("ecom_customer_id", "_cid"), "ecom_customer_id", "_cid",
                      spread_by="order_id").select(
        "order_id", F.lit("ecommerce").alias("channel"), F.lit(None).cast("string").alias("store_id"),
        "customer_uid", "total_amount_vnd", F.col("discount_vnd").alias("discount_amount_vnd"),
        F.lit(0).cast("bigint").alias("tax_amount_vnd"), "payment_method", "num_items",
        F.col("order_date").alias("order_timestamp"), F.to_date("order_date").alias("order_date"), "status")
    return union_all(shop, web)


def int_customer_metrics(orders: DataFrame, as_of: Column) -> DataFrame:
    """Order metrics per customer. Each order stands for itself: no days are formed first, so only customers are shuffled."""
    amount = F.col("total_amount_vnd")
    each = _counted(orders).select("customer_uid", "order_date", "channel", F.lit(1).cast("bigint").alias("orders"),
                                   amount.alias("revenue_vnd"), amount.isNotNull().cast("bigint").alias("priced_orders"))
    return customer_metrics(each, as_of)


def _counted(orders: DataFrame) -> DataFrame:
    return orders.where(~rules.is_cancelled("status")).where("customer_uid IS NOT NULL")


def customer_days(orders: DataFrame) -> DataFrame:
    """Orders that count, per customer, day and channel."""
    return _counted(orders).groupBy("customer_uid", "order_date", "channel").agg(
        F.count("*").alias("orders"), F.sum("total_amount_vnd").alias("revenue_vnd"),
        F.count("total_amount_vnd").alias("priced_orders"))


def customer_metrics(days: DataFrame, as_of: Column) -> DataFrame:
    """A customer's set of channels is as small as the list of channels, so it is gathered in the same aggregate as the sums."""
    of = lambda channel: F.coalesce(F.sum(F.when(F.col("channel") == channel, F.col("orders"))), F.lit(0).cast("bigint"))
    grouped = days.groupBy("customer_uid").agg(
        F.sum("orders").alias("total_orders"),
        F.sum("revenue_vnd").alias("lifetime_revenue_vnd"),
        safe_ratio(F.sum("revenue_vnd"), F.sum("priced_orders")).alias("avg_order_value_vnd"),
        F.size(F.collect_set("channel")).cast("bigint").alias("channels_used"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        of("pos").alias("pos_orders"),
        of("ecommerce").alias("ecom_orders"))
    return grouped.select(
        "customer_uid", "total_orders", "channels_used",
        "lifetime_revenue_vnd", "avg_order_value_vnd", "first_order_date", "last_order_date",
        days_between("first_order_date", "last_order_date").alias("tenure_days"),
        days_between("last_order_date", as_of).alias("days_since_last_order"),
        "pos_orders", "ecom_orders")


def int_sessions(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return (
        events.groupBy(*SESSION_KEYS).agg(
            F.count("*").alias("total_events"),
            count_where(kind == "page_view").alias("page_views"),
            count_where(kind == "add_to_cart").alias("add_to_carts"),
            count_where(kind == "purchase").alias("purchases"),
            count_where(kind == "search").alias("searches"),
            F.sum("duration_ms").alias("total_duration_ms"),
            F.min("event_time").alias("session_start"),
            F.max("event_time").alias("session_end"),
            F.min("event_date").alias("session_date"))
        .transform(_with_session_facts)
    )


def _with_session_facts(sessions: DataFrame) -> DataFrame:
    return sessions.withColumns({"session_duration_sec": seconds_between("session_start", "session_end"),
                                 "has_conversion": F.col("purchases") > 0})


def joined_sessions(parts: DataFrame) -> DataFrame:
    """Sessions whose events came in several loads, as one row each."""
    sums = ("total_events", "page_views", "add_to_carts", "purchases", "searches", "total_duration_ms")
    joined = parts.groupBy(*SESSION_KEYS).agg(
        *[F.sum(c).alias(c) for c in sums], F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"), F.min("session_date").alias("session_date"))
    return _with_session_facts(joined).select(*parts.columns)

"""Staging: one cleaned, typed frame per raw entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions import rules
from martloom.functions.columns import email_normalize, phone_digits
from martloom.operators.dedup import latest_per_key
from martloom.operators.shaping import require_keys, select_typed, union_all

# Which of several rows of one key and time counts.
ORDER_TIES = ("status", "total_amount_vnd")
CUSTOMER_TIES = ("email", "phone_raw")
PAYMENT_TIES = ("status", "amount_vnd", "order_ref")
SNAPSHOT_TIES = ("qty_on_hand", "product_id", "qty_reserved")

PAYMENT_COLUMNS = ("payment_id", "order_ref", "gateway", "amount_vnd", "fee_vnd", "status",
                   "bank_code", "paid_at", "payment_date")


def stg_pos_transactions(raw: DataFrame) -> DataFrame:
    if "items" not in raw.columns:  # a CSV drop cannot carry the array
        raw = raw.withColumn("items", F.lit(None).cast(schemas.ITEMS))
    valid = require_keys(raw, "txn_id").where("total_amount > 0")
    # The day of a true time stamp follows from it, so it is not shuffled; a text may hold a day without a readable time.
    follows = dict(raw.dtypes)["txn_timestamp"] == "timestamp"
    typed = select_typed(valid, [
        "txn_id", "store_id", "customer_phone", "cashier_id",
        ("total_amount", "total_amount_vnd", "bigint"),
        ("discount_amount", "discount_amount_vnd", "bigint"),
        ("tax_amount", "tax_amount_vnd", "bigint"),
        "payment_method", "num_items", "items",
        ("txn_timestamp", "txn_timestamp", "timestamp"),
        *([] if follows else [("txn_timestamp", "txn_date", "date")]),
    ])
    newest = latest_per_key(typed, ["txn_id"], "txn_timestamp", pos_ties())
    return newest.withColumn("txn_date", F.to_date("txn_timestamp")) if follows else newest


def pos_ties() -> list[Column | str]:
    """Which of several rows of one sale and time counts."""
    return [F.desc_nulls_last("total_amount_vnd"), "store_id", F.get("items", F.lit(0))["product_id"],
            "num_items", "discount_amount_vnd", "tax_amount_vnd", "payment_method"]


def stg_ecommerce_orders(raw: DataFrame) -> DataFrame:
    valid = require_keys(raw, "order_id").where("total_amount > 0")
    typed = select_typed(valid, [
        "order_id", ("customer_id", "ecom_customer_id", "string"), "status", "payment_method", "num_items",
        ("subtotal", "subtotal_vnd", "bigint"),
        ("discount", "discount_vnd", "bigint"),
        ("shipping_fee", "shipping_fee_vnd", "bigint"),
        ("total_amount", "total_amount_vnd", "bigint"),
        "shipping_address_city", "shipping_address_district",
        ("order_date", "order_date", "timestamp"),
        ("created_at", "created_at", "timestamp"),
        ("updated_at", "updated_at", "timestamp"),
    ])
    return latest_per_key(typed, ["order_id"], "updated_at", ORDER_TIES)


def stg_ecommerce_customers(raw: DataFrame) -> DataFrame:
    typed = require_keys(raw, "customer_id").select(
        F.col("customer_id").alias("ecom_customer_id"), "full_name", *_contact(),
        "gender", "date_of_birth", "registration_source",
        F.col("created_at").try_cast("timestamp").alias("registered_at"),
        F.col("updated_at").try_cast("timestamp").alias("updated_at"))
    return latest_per_key(typed, ["ecom_customer_id"], "updated_at", CUSTOMER_TIES)


def stg_loyalty_members(raw: DataFrame) -> DataFrame:
    return require_keys(raw, "member_id").select(
        F.col("member_id").alias("loyalty_member_id"), "full_name", *_contact(),
        "tier", "points_balance",
        F.col("joined_date").try_cast("timestamp").alias("joined_at"),
        F.col("last_activity_date").try_cast("timestamp").alias("last_activity_at"),
        F.col("updated_at").try_cast("timestamp").alias("updated_at"))


def _contact() -> list[Column]:
    return [email_normalize("email").alias("email"),
            F.regexp_replace("phone", "[^0-9]", "").alias("phone_raw"),
            phone_digits("phone").alias("phone_normalized")]


# --- payments: three record layouts, one shape ------------------------------

def _payment(raw: DataFrame, gateway: str, payment_id: str, order_ref: str, amount: Column, fee: Column,
             code: str, bank: Column, paid: str) -> DataFrame:
    paid_at = F.col(paid).try_cast("timestamp")
    return require_keys(raw, payment_id).select(
        F.col(payment_id).alias("payment_id"), F.col(order_ref).alias("order_ref"),
        F.lit(gateway).alias("gateway"), amount.alias("amount_vnd"), fee.alias("fee_vnd"),
        rules.gateway_status(gateway, code).alias("status"), bank.alias("bank_code"),
        paid_at.alias("paid_at"), paid_at.cast("date").alias("payment_date"))


def newest_payment(payments: DataFrame) -> DataFrame:
    return latest_per_key(payments, ["payment_id"], "paid_at", PAYMENT_TIES)


def stg_payments_vnpay(raw: DataFrame) -> DataFrame:
    return newest_payment(_payment(
        raw, "vnpay", "vnp_txn_ref", "vnp_order_info", F.col("vnp_amount").try_cast("bigint"),
        F.lit(0).cast("bigint"), "vnp_response_code", F.col("vnp_bank_code"), "vnp_pay_date"))


def stg_payments_momo(raw: DataFrame) -> DataFrame:
    return newest_payment(_payment(
        raw, "momo", "trans_id", "order_id", F.col("amount").try_cast("bigint"),
        F.lit(0).cast("bigint"), "result_code", F.lit(None).cast("string"), "response_time"))


def stg_payments_card(raw: DataFrame) -> DataFrame:
    """Card amounts arrive gross; the gateway fee is taken off. Not deduplicated."""
    fee = F.col("fee").try_cast("bigint")
    return _payment(raw, "card", "transaction_id", "merchant_ref",
                    F.col("gross_amount").try_cast("bigint") - fee, fee,
                    "status", F.col("issuer_bank"), "settled_at")


def stg_payments_consolidated(vnpay: DataFrame, momo: DataFrame, card: DataFrame) -> DataFrame:
    return union_all(*[df.select(*PAYMENT_COLUMNS) for df in (vnpay, momo, card)])


# --- clickstream and stock --------------------------------------------------

def stg_clickstream_events(raw: DataFrame) -> DataFrame:
    """Not deduplicated, as the raw feed promises unique events."""
    return select_typed(require_keys(raw, "event_id", "session_id", "event_type"), [
        "event_id", "session_id", ("user_id", "ecom_customer_id", "string"), "event_type", "page_url",
        "referrer", "utm_campaign", "utm_source", "utm_medium", "device_type", "browser", "os",
        "country", "city", ("duration_ms", "duration_ms", "int"),
        ("event_time", "event_time", "timestamp"), ("event_time", "event_date", "date"),
    ])


def stg_inventory_stock_levels(raw: DataFrame) -> DataFrame:
    typed = select_typed(require_keys(raw, "store_id", "sku").where("quantity_on_hand >= 0"), [
        "store_id", "sku", "product_id",
        ("quantity_on_hand", "qty_on_hand", "int"),
        ("quantity_reserved", "qty_reserved", "int"),
        ("safety_stock", "safety_stock_threshold", "int"),
        ("reorder_point", "reorder_point", "int"),
        ("snapshot_time", "snapshot_time", "timestamp"),
        ("snapshot_time", "snapshot_date", "date"),
    ])
    return typed.withColumn("qty_available", F.col("qty_on_hand") - F.col("qty_reserved"))

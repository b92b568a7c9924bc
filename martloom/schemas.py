"""Declared schemas of the raw entities and the streamed messages."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "decimal(18,2)": T.DecimalType(18, 2), "decimal(10,2)": T.DecimalType(10, 2),
}


def _schema(columns: str) -> T.StructType:
    """Flat schema from ``name type`` pairs; works without a session."""
    pairs = (column.split(" ") for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


ITEMS = "array<struct<sku:string,product_id:string,quantity:int,unit_price_vnd:bigint,amount_vnd:bigint>>"

POS_TRANSACTIONS = _schema(
    "txn_id string, store_id string, customer_phone string, cashier_id string, product_id string, "
    "num_items int, total_amount bigint, discount_amount bigint, tax_amount bigint, "
    "payment_method string, txn_timestamp timestamp")
ECOM_CUSTOMERS = _schema(
    "customer_id string, full_name string, email string, phone string, gender string, "
    "date_of_birth string, registration_source string, created_at timestamp, updated_at timestamp")
ECOM_ORDERS = _schema(
    "order_id string, customer_id string, status string, payment_method string, num_items int, "
    "subtotal bigint, discount bigint, shipping_fee bigint, total_amount bigint, "
    "shipping_address_city string, shipping_address_district string, "
    "order_date timestamp, created_at timestamp, updated_at timestamp")
PAYMENTS_VNPAY = _schema(
    "vnp_txn_ref string, vnp_order_info string, vnp_amount bigint, vnp_response_code string, "
    "vnp_bank_code string, vnp_pay_date timestamp")
PAYMENTS_MOMO = _schema(
    "trans_id string, order_id string, amount bigint, result_code int, response_time timestamp")
PAYMENTS_CARD = _schema(
    "transaction_id string, merchant_ref string, gross_amount bigint, fee bigint, status string, "
    "issuer_bank string, settled_at timestamp")
STOCK_LEVELS = _schema(
    "store_id string, sku string, product_id string, quantity_on_hand int, quantity_reserved int, "
    "safety_stock int, reorder_point int, snapshot_time timestamp")
LOYALTY_MEMBERS = _schema(
    "member_id string, full_name string, email string, phone string, tier string, points_balance int, "
    "joined_date timestamp, last_activity_date timestamp, updated_at timestamp")
CLICKSTREAM_EVENTS = _schema(
    "event_id string, session_id string, user_id string, event_type string, page_url string, "
    "referrer string, utm_campaign string, utm_source string, utm_medium string, device_type string, "
    "browser string, os string, country string, city string, duration_ms int, event_time timestamp")
ORDER_EVENTS = _schema(
    "order_id string, customer_id string, store_id string, channel string, amount decimal(18,2), "
    "discount decimal(10,2), payment_method string, status string, event_time timestamp")
CLIENT_PAYLOAD = _schema("event_id bigint, event_type string, user_id bigint")
STORES = _schema(
    "store_id string, store_name string, region string, city string, district string, address string, "
    "store_format string, sqm int, staff_count int, opened_date date, manager_name string")
PRODUCTS = _schema(
    "product_id string, sku string, product_name string, category_l1 string, category_l2 string, "
    "brand string, price_vnd bigint, cost_vnd bigint, supplier_id string, supplier_name string, "
    "weight_kg double, is_active boolean")

RAW = {
    "pos_transactions": POS_TRANSACTIONS,
    "ecom_customers": ECOM_CUSTOMERS,
    "ecom_orders": ECOM_ORDERS,
    "payments_vnpay": PAYMENTS_VNPAY,
    "payments_momo": PAYMENTS_MOMO,
    "payments_card": PAYMENTS_CARD,
    "stock_levels": STOCK_LEVELS,
    "loyalty_members": LOYALTY_MEMBERS,
    "clickstream_events": CLICKSTREAM_EVENTS,
    "stores": STORES,
    "products": PRODUCTS,
}

# Landing folder of each entity, and the file format dropped there.
LANDING = {
    "pos_transactions": ("pos", "csv"),
    "ecom_orders": ("ecommerce/orders", "json"),
    "ecom_customers": ("ecommerce/customers", "json"),
    "payments_vnpay": ("payments/vnpay", "json"),
    "payments_momo": ("payments/momo", "json"),
    "payments_card": ("payments/card", "json"),
    "stock_levels": ("inventory", "json"),
    "loyalty_members": ("loyalty", "json"),
    "clickstream_events": ("ecommerce/clickstream", "json"),
}

# The time column that tells when a landed record happened.
EVENT_TIMES = {
    "pos_transactions": "txn_timestamp", "ecom_orders": "order_date", "ecom_customers": "created_at", "payments_vnpay": "vnp_pay_date",
    "payments_momo": "response_time", "payments_card": "settled_at", "stock_levels": "snapshot_time", "loyalty_members": "updated_at",
    "clickstream_events": "event_time",
}

"""X and F rows: designed operators, and the rules as columns, SQL functions and views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom import schemas
from martloom.catalog.registry import lake_query, query
from martloom.functions import rules
from martloom.functions.columns import (
    email_normalize,
    parse_any_date,
    to_utc,
)
from martloom.functions.sql_functions import register_functions
from martloom.operators import joins
from martloom.operators.changes import apply_cdc, mask, views_by_group
from martloom.operators.fuzzy import fuzzy_match
from martloom.operators.identity import identity_clusters
from martloom.operators.ranking import top_bottom
from martloom.operators.sessions import days_of_cover, flag_bots
from martloom.operators.shaping import union_all
from martloom.plans.daily import load_until
from martloom.plans.lake import SAMPLE_AS_OF
from martloom.plans.marts import delivery_sla, revenue_by_category, revenue_monthly_region
from martloom.session import workspace, write_once
from martloom.sources import messages, tables
from martloom.sources.sample import raw_stream, raw_view
from martloom.sources.store import TableStore
from martloom.streaming import feeds, live
from martloom.streaming.sinks import drain, upsert

# --- malformed input, bots, dates -------------------------------------------


@query("x1_quarantine_malformed", """
    SELECT CASE WHEN event_id % 33 = 0 OR event_id % 47 = 0 OR event_id % 101 = 0 THEN 'bad' ELSE 'good' END AS kind,
           CASE WHEN event_id % 33 = 0 OR event_id % 47 = 0 OR event_id % 101 = 0 THEN NULL ELSE event_id END AS event_id,
           CASE WHEN event_id % 33 = 0 OR event_id % 47 = 0 OR event_id % 101 = 0 THEN body END AS body
    FROM raw_client_payloads""")
def _(spark, folder):
    good, bad = messages.split_malformed(raw_view(spark, folder, "client_payloads"), "body", schemas.CLIENT_PAYLOAD)
    return union_all(
        good.select(F.lit("good").alias("kind"), "event_id", F.lit(None).cast("string").alias("body")),
        bad.select(F.lit("bad").alias("kind"), F.lit(None).cast("bigint").alias("event_id"), "body"))


@query("x2_bot_filter", """
    SELECT *, user_id IS NOT NULL AND count(*) OVER (PARTITION BY user_id, date_trunc('minute', event_time)) > 1 AS is_bot
    FROM raw_clickstream_events""")
def _(spark, folder):
    return flag_bots(raw_view(spark, folder, "clickstream_events"), "user_id", "event_time", 1)


@query("x3_parse_mixed_dates", """
    SELECT o_orderkey, sold_on, coalesce(try_strptime(sold_on, '%Y-%m-%d'), try_strptime(sold_on, '%d/%m/%Y')) AS sold_at
    FROM raw_till_dates""")
def _(spark, folder):
    return raw_view(spark, folder, "till_dates").withColumn("sold_at", parse_any_date("sold_on"))


@query("x4_local_to_utc", """
    SELECT order_id, event_time - INTERVAL 7 HOUR AS utc_time FROM raw_order_events""")
def _(spark, folder):
    return raw_view(spark, folder, "order_events").select("order_id", to_utc("event_time").alias("utc_time"))


# --- matching ---------------------------------------------------------------

def _settlement_sides(lake):
    orders = lake["stg_ecommerce__orders"].select("order_id", F.col("order_date").alias("ordered_at"))
    return orders, lake["stg_payments__consolidated"].select("payment_id", "order_ref", "paid_at")


def _settlement_sql(hours: int) -> str:
    return f"""
    SELECT order_id, order_date AS ordered_at, payment_id, paid_at,
           CASE WHEN payment_id IS NULL THEN 'unpaid_order' WHEN order_id IS NULL THEN 'unmatched_payment'
                ELSE 'matched' END AS match_status
    FROM stg_ecommerce__orders FULL JOIN stg_payments__consolidated
      ON order_ref = order_id AND paid_at BETWEEN order_date AND order_date + INTERVAL {hours} HOUR"""


@lake_query("x5_settlement_match", _settlement_sql(24))
def _(lake):
    return joins.match_settlements(*_settlement_sides(lake), "1 day")


@lake_query("x5_settlement_match_same_day", _settlement_sql(12))
def _(lake):
    return joins.match_settlements(*_settlement_sides(lake), "12 hours")


# The stream's watermark after everything has arrived; unmatched rows behind it are out.
_SETTLED = """(SELECT least((SELECT max(order_date) FROM stg_ecommerce__orders), (SELECT max(paid_at) FROM stg_payments__consolidated))
               - INTERVAL 1 HOUR)"""


@query("x5_settlement_stream", f"""
    SELECT * FROM ({_settlement_sql(12)})
    WHERE match_status = 'matched' OR match_status = 'unpaid_order' AND ordered_at + INTERVAL 12 HOUR < {_SETTLED}
       OR match_status = 'unmatched_payment' AND paid_at < {_SETTLED}""")
def _(spark, folder):
    """All versions of all orders against the payments of every gateway; both unmatched sides of closed windows are kept."""
    orders = raw_stream(spark, folder, "ecom_orders").select("order_id", F.col("order_date").alias("ordered_at"))
    layouts = {"payments_vnpay": ("vnp_txn_ref", "vnp_order_info", "vnp_pay_date"), "payments_momo": ("trans_id", "order_id", "response_time"),
               "payments_card": ("transaction_id", "merchant_ref", "settled_at")}
    payments = union_all(*[raw_stream(spark, folder, gateway).select(
        F.col(key).alias("payment_id"), F.col(ref).alias("order_ref"), F.col(paid).alias("paid_at")) for gateway, (key, ref, paid) in layouts.items()])
    return drain(joins.match_settlements_stream(orders, payments, "12 hours"), "x5")


_TYPO = """CASE points_balance % 4 WHEN 0 THEN replace(full_name, '#', '') WHEN 1 THEN concat(full_name, 'x')
           WHEN 2 THEN replace(full_name, 'Customer', 'Cstmr') ELSE full_name END"""


@lake_query("x6_fuzzy_name_match", f"""
    SELECT c.ecom_customer_id, m.loyalty_member_id, c.phone_normalized,
           1 - levenshtein(c.full_name, m.name) / greatest(length(c.full_name), length(m.name)) AS similarity
    FROM stg_ecommerce__customers c
    JOIN (SELECT loyalty_member_id, phone_normalized, {_TYPO} AS name FROM stg_loyalty__members) m
      ON c.phone_normalized = m.phone_normalized
    WHERE (greatest(length(c.full_name), length(m.name)) - levenshtein(c.full_name, m.name)) * 100
          > 90 * greatest(length(c.full_name), length(m.name))
    QUALIFY row_number() OVER (PARTITION BY c.ecom_customer_id ORDER BY similarity DESC, m.loyalty_member_id) = 1""")
def _(lake):
    members = lake["stg_loyalty__members"].withColumn("full_name", F.expr(_TYPO))
    return fuzzy_match(lake["stg_ecommerce__customers"], members, "phone_normalized", "full_name",
                       "ecom_customer_id", "loyalty_member_id")


_RECORDS = """
    SELECT 'ecom:' || ecom_customer_id AS record_id, phone_normalized AS phone, email FROM stg_ecommerce__customers
    UNION ALL SELECT 'loyalty:' || loyalty_member_id, phone_normalized, email FROM stg_loyalty__members
    UNION ALL SELECT DISTINCT 'pos:' || customer_phone, customer_phone, NULL FROM stg_pos__transactions
              WHERE customer_phone IS NOT NULL"""


@lake_query("x16_identity_clusters", f"""
    WITH RECURSIVE records AS ({_RECORDS}),
    held AS (SELECT record_id, 'p' || phone AS k FROM records WHERE phone IS NOT NULL
             UNION SELECT record_id, 'e' || email FROM records WHERE email IS NOT NULL),
    reach(record_id, other) AS (
        SELECT record_id, record_id FROM records
        UNION SELECT r.record_id, b.record_id FROM reach r JOIN held a ON a.record_id = r.other JOIN held b ON b.k = a.k)
    SELECT record_id, min(other) AS person_id FROM reach GROUP BY record_id""")
def _(lake):
    shops = lake["stg_pos__transactions"].select("customer_phone").where("customer_phone IS NOT NULL").distinct()
    records = union_all(
        lake["stg_ecommerce__customers"].select(
            F.concat(F.lit("ecom:"), "ecom_customer_id").alias("record_id"), F.col("phone_normalized").alias("phone"), "email"),
        lake["stg_loyalty__members"].select(
            F.concat(F.lit("loyalty:"), "loyalty_member_id").alias("record_id"), F.col("phone_normalized").alias("phone"), "email"),
        shops.select(F.concat(F.lit("pos:"), "customer_phone").alias("record_id"), F.col("customer_phone").alias("phone"),
                     F.lit(None).cast("string").alias("email")))
    return identity_clusters(records, "record_id", {"phone": "phone", "email": "email"})


# --- revenue grains, stock, delivery ----------------------------------------

@lake_query("x7_revenue_by_category", """
    SELECT txn_date AS date_key, store_id, 'pos' AS channel, category_l1, CAST(sum(quantity) AS BIGINT) AS quantity,
           CAST(sum(amount) AS BIGINT) AS revenue_vnd
    FROM (SELECT txn_date, store_id, product_id, num_items AS quantity, total_amount_vnd - 10000 AS amount
          FROM stg_pos__transactions
          UNION ALL SELECT txn_date, store_id,
                 'P' || lpad(CAST(CAST(substr(product_id, 2) AS BIGINT) + 1 AS VARCHAR), 7, '0'), 1, 10000
          FROM stg_pos__transactions)
    LEFT JOIN dim_products USING (product_id) GROUP BY 1, 2, 3, 4""")
def _(lake):
    return revenue_by_category(lake["stg_pos__transactions"], lake["dim_products"])


@query("x8_sliding_stock_alerts", """
    SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, store_id, sku, min(qty_available) AS min_qty,
           CASE WHEN min(qty_available) <= 0 THEN 'OUT_OF_STOCK' WHEN min(qty_available) <= max(safety_stock) THEN 'LOW_STOCK'
                ELSE 'REORDER' END AS alert_type
    FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, event_time) - to_minutes(k) AS window_start
          FROM raw_stock_events, (SELECT unnest([0, 1, 2, 3, 4]) AS k))
    GROUP BY 1, 2, 3, 4
    HAVING min(qty_available) <= max(reorder_point)
       AND window_start + INTERVAL 5 MINUTE <= (SELECT max(event_time) - INTERVAL 10 SECOND FROM raw_stock_events)""")
def _(spark, folder):
    return drain(live.stock_sliding(raw_stream(spark, folder, "stock_events")), "x8")


_COVER_AS_OF = dt.date(2001, 8, 1)


@lake_query("x9_stockout_forecast", f"""
    WITH closing AS (
        SELECT store_id, sku, snapshot_date AS day, qty_available FROM stg_inventory__stock_levels
        WHERE snapshot_date <= DATE '{_COVER_AS_OF}' AND snapshot_date > DATE '{_COVER_AS_OF}' - 730
        QUALIFY row_number() OVER (PARTITION BY store_id, sku, snapshot_date
                                   ORDER BY snapshot_time DESC, qty_available, product_id) = 1),
    steps AS (SELECT *, greatest(coalesce(lag(qty_available) OVER (PARTITION BY store_id, sku ORDER BY day) - qty_available, 0), 0) AS fall
              FROM closing),
    items AS (SELECT store_id, sku, arg_max(qty_available, day) AS qty_available, CAST(sum(fall) AS BIGINT) AS consumed,
                     CAST(date_diff('day', min(day), max(day)) AS INTEGER) AS days_observed FROM steps GROUP BY 1, 2)
    SELECT *, qty_available / nullif(consumed / nullif(days_observed, 0), 0) AS days_of_cover,
           coalesce(qty_available / nullif(consumed / nullif(days_observed, 0), 0) <= 3, qty_available <= 0) AS stockout_risk
    FROM items""")
def _(lake):
    stock = lake["stg_inventory__stock_levels"].select("store_id", "sku", "product_id", "qty_available", "snapshot_time")
    return days_of_cover(stock, ["qty_available", "product_id"], 730, F.lit(_COVER_AS_OF))


@lake_query("x10_monthly_by_region", """
    SELECT CAST(date_trunc('month', date_key) AS DATE) AS month_key,
           CASE WHEN channel = 'ecommerce' THEN 'Online' ELSE region END AS region,
           CAST(sum(total_orders) AS BIGINT) AS total_orders, CAST(sum(total_revenue_vnd) AS BIGINT) AS total_revenue_vnd,
           CAST(sum(net_revenue_vnd) AS BIGINT) AS net_revenue_vnd
    FROM fct_revenue_daily LEFT JOIN dim_stores USING (store_id) GROUP BY 1, 2""")
def _(lake):
    return revenue_monthly_region(lake["fct_revenue_daily"], lake["dim_stores"])


@query("x11_incremental_merge", """
    SELECT order_id, status, total_amount, updated_at, CAST(year(updated_at) AS INTEGER) AS yr FROM raw_ecom_orders
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) = 1""")
def _(spark, folder):
    store = TableStore(spark, workspace(spark, "merge-target"))
    versions = raw_view(spark, folder, "ecom_orders").select(
        "order_id", "status", "total_amount", "updated_at", "created_at", F.year("updated_at").alias("yr"))
    store.put("orders", versions.where("updated_at = created_at").drop("created_at"), "yr")
    for _attempt in range(2):
        store.merge("orders", versions.where("updated_at > created_at").drop("created_at"), ["order_id"], "updated_at", "yr", ["status"])
    return store.read("orders")


@query("x11_merge_odd_partitions", """
    SELECT order_id, total_amount, updated_at,
           CASE WHEN status = 'shipped' THEN NULL ELSE 'is:' || status || '/' || CAST(year(updated_at) AS VARCHAR) END AS place
    FROM raw_ecom_orders
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) = 1""")
def _(spark, folder):
    """Partition values that are null or need escaping, and keys that move between them."""
    store = TableStore(spark, workspace(spark, "merge-odd"))
    place = F.when(F.col("status") != "shipped", F.concat(F.lit("is:"), "status", F.lit("/"), F.year("updated_at").cast("string")))
    versions = raw_view(spark, folder, "ecom_orders").select("order_id", "total_amount", "updated_at", "created_at", place.alias("place"))
    store.put("orders", versions.where("updated_at = created_at").drop("created_at"), "place")
    for _attempt in range(2):
        store.merge("orders", versions.where("updated_at > created_at").drop("created_at"), ["order_id"], "updated_at", "place", ["total_amount"])
    return store.read("orders")


# What tells the rows of a built table apart, in text and in numbers, for comparing all tables in one result.
BUILT = {
    "int_customers_unified": ("customer_uid", "loyalty_member_id", "customer_type", "NULL", "NULL"),
    "int_orders_all_channels": ("order_id", "channel", "customer_uid", "total_amount_vnd", "num_items"),
    "int_customer_metrics": ("customer_uid", "first_order_date", "last_order_date", "total_orders", "channels_used"),
    "int_sessions": ("session_id", "ecom_customer_id", "session_date", "total_events", "page_views"),
    "dim_customers": ("customer_uid", "loyalty_member_id", "rfm_segment", "total_orders", "lifetime_revenue_vnd"),
    "dim_stores": ("store_id", "region", "store_size", "staff_count", "sqm"),
    "dim_products": ("product_id", "sku", "category_l1", "price_vnd", "margin_vnd"),
    "dim_date": ("date_key", "NULL", "NULL", "NULL", "NULL"),
    "fct_revenue_daily": ("date_key", "store_id", "channel", "total_orders", "total_revenue_vnd"),
    "fct_revenue_monthly": ("month_key", "NULL", "NULL", "total_orders", "prev_month_revenue_vnd"),
    "fct_reconciliation": ("date_key", "reconciliation_status", "NULL", "expected_total_vnd", "payment_revenue_vnd"),
    "fct_campaign_performance": ("date_key", "campaign", "source", "total_sessions", "conversions"),
    "fct_funnel_daily": ("date_key", "referrer", "device_type", "total_sessions", "sessions_with_purchase"),
    "fct_inventory_alerts": ("date_key", "store_id", "sku", "qty_available", "reorder_point"),
    "fct_store_performance": ("date_key", "store_id", "region", "rank_in_region", "rank_overall"),
}


def _built(table: str, text: str) -> str:
    names = ("k1", "k2", "k3", "n1", "n2")
    return ", ".join([f"'{table}' AS part", *(f"CAST({c} AS {text if n[0] == 'k' else 'BIGINT'}) AS {n}" for c, n in zip(BUILT[table], names))])


# Days up to which three loads take what has landed: most of it, one day more, the rest.
LOADS = (dt.date(2001, 7, 20), dt.date(2001, 7, 21), dt.date(2024, 12, 31))


def sample_landing(spark, folder) -> str:
    """The sources as landing tables by day of arrival. Of those with a spread key every 25th row comes late, corrections among them."""
    root = workspace(spark, "landing")
    stamps = {"pos_transactions": ("txn_timestamp", "txn_id"), "ecom_orders": ("updated_at", "order_id"), "ecom_customers": ("updated_at", "customer_id"),
              "loyalty_members": ("updated_at", "member_id"), "payments_vnpay": ("vnp_pay_date", "vnp_order_info"),
              "payments_momo": ("response_time", "order_id"), "payments_card": ("settled_at", "transaction_id"),
              "clickstream_events": ("event_time", "event_id"), "stock_levels": ("snapshot_time", "product_id")}
    for source, (stamp, key) in stamps.items():
        late, day = F.pmod(F.xxhash64(key, stamp), F.lit(50)), F.to_date(stamp)
        landed = F.when(late == 0, F.lit(LOADS[2])).when(late == 1, F.lit(LOADS[1])).when(day <= F.lit(LOADS[0]), F.lit(LOADS[0])).when(
            day <= F.lit(LOADS[1]), F.lit(LOADS[1])).otherwise(F.lit(LOADS[2]))
        tables.append_table(raw_view(spark, folder, source).withColumn("landed", landed), f"{root}/{source}", ["landed"], gather=False)
    return root


@query("x11_daily_build", " UNION ALL ".join(f"SELECT {_built(table, 'VARCHAR')} FROM {table}" for table in BUILT))
def _(spark, folder):
    """A first load and two more, with late rows and late customers, hold what one full build holds, in every table."""
    landing, store = sample_landing(spark, folder), TableStore(spark, workspace(spark, "daily-build"))
    for day in LOADS:
        load_until(store, lambda source: spark.read.parquet(f"{landing}/{source}"), lambda name: raw_view(spark, folder, name),
                   day, SAMPLE_AS_OF, grain="year", keep=1)
    return union_all(*[store.read(table).selectExpr(*_split(_built(table, "STRING"))) for table in BUILT])


def _split(columns: str) -> list[str]:
    return columns.split(", ")


@query("t10_upsert_sink", """
    SELECT order_id, status, total_amount, updated_at, CAST(year(updated_at) AS INTEGER) AS yr FROM raw_ecom_orders
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) = 1""")
def _(spark, folder):
    """The replacing sink, fed by a stream of all order versions."""
    root = workspace(spark, "upsert")
    versions = raw_stream(spark, folder, "ecom_orders").select(
        "order_id", "status", "total_amount", "updated_at", F.year("updated_at").alias("yr"))
    store = TableStore(spark, f"{root}/out")
    upsert(versions, store, "orders", f"{root}/checkpoint", ["order_id"], "updated_at", "yr", ["status"]).awaitTermination()
    return store.read("orders")


@query("x12_cdc_unwrap", """
    SELECT order_id, status, total_amount FROM raw_order_changes
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1 AND op <> 'd'""")
def _(spark, folder):
    image = F.struct("order_id", "status", "total_amount")
    envelopes = raw_view(spark, folder, "order_changes").select(
        F.when(F.col("op") != "c", image).alias("before"), F.when(F.col("op") != "d", image).alias("after"), "op", "seq")
    return apply_cdc(envelopes, "order_id", "seq")


@query("x12_cdc_applied", """
    SELECT order_id, status, total_amount FROM raw_order_changes
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1 AND op <> 'd'""")
def _(spark, folder):
    """Changes that reach a stored table in three batches, out of order and one of them twice, equal one pass over all."""
    image = F.struct("order_id", "status", "total_amount")
    envelopes = write_once(raw_view(spark, folder, "order_changes").select(
        F.when(F.col("op") != "c", image).alias("before"), F.when(F.col("op") != "d", image).alias("after"), "op", "seq",
        F.pmod(F.xxhash64("order_id", "seq"), F.lit(3)).alias("part")), "envelopes")
    store = TableStore(spark, workspace(spark, "cdc"))
    for batch, part in enumerate((2, 0, 1, 1)):
        feeds.apply_changes(store, "orders", envelopes.where(F.col("part") == part), "order_id", "seq", "orders feed", min(batch, 2), buckets=8)
    return feeds.live_rows(store.read("orders"))


@query("x13_delivery_sla", """
    SELECT partner, CAST(ordered_at AS DATE) AS date_key, count(*) AS shipments,
           count(*) FILTER (delivered_at <= ordered_at + INTERVAL 720 HOUR) AS on_time,
           CAST(count(*) FILTER (delivered_at <= ordered_at + INTERVAL 720 HOUR) AS DOUBLE) / count(*) AS on_time_rate
    FROM raw_shipments GROUP BY 1, 2""")
def _(spark, folder):
    return delivery_sla(raw_view(spark, folder, "shipments"), 720)


@query("x14_mask_pii", """
    SELECT sha256(customer_id) AS customer_id, regexp_replace(lower(trim(email)), '^[^@]*', '***') AS email,
           repeat('*', greatest(length(phone) - 3, 0)) || right(phone, 3) AS phone, registration_source
    FROM raw_ecom_customers""")
def _(spark, folder):
    people = raw_view(spark, folder, "ecom_customers").select(
        "customer_id", "full_name", email_normalize("email").alias("email"), "phone", "registration_source")
    return mask(people, {"customer_id": "hash", "email": "email", "phone": "tail", "full_name": "drop"})


_POLICY = [("marketing", "customers", "ecom_customer_id", "hash"), ("marketing", "customers", "email", "email"),
           ("marketing", "customers", "registration_source", "keep"), ("support", "customers", "ecom_customer_id", "keep"),
           ("support", "customers", "full_name", "keep"), ("support", "customers", "phone_normalized", "tail")]


@lake_query("x14_group_views", """
    SELECT 'marketing' AS consumer_group, sha256(ecom_customer_id) AS ecom_customer_id, regexp_replace(email, '^[^@]*', '***') AS email,
           registration_source, NULL AS full_name, NULL AS phone_normalized FROM stg_ecommerce__customers
    UNION ALL
    SELECT 'support', ecom_customer_id, NULL, NULL, full_name,
           repeat('*', greatest(length(phone_normalized) - 3, 0)) || right(phone_normalized, 3) FROM stg_ecommerce__customers""")
def _(lake):
    """One model as two groups see it; columns without a rule are in neither."""
    policy = lake.spark.createDataFrame(_POLICY, "consumer_group string, table_name string, column_name string, rule string")
    views = views_by_group({"customers": lake["stg_ecommerce__customers"]}, policy)
    marketing, support = (views[g, "customers"].withColumn("consumer_group", F.lit(g)) for g in ("marketing", "support"))
    return marketing.unionByName(support, allowMissingColumns=True)


@lake_query("x15_top_bottom_stores", """
    WITH weekly AS (SELECT CAST(date_trunc('week', txn_date) AS DATE) AS week_start, store_id,
                           CAST(sum(total_amount_vnd) AS BIGINT) AS revenue_vnd FROM stg_pos__transactions GROUP BY 1, 2)
    SELECT *, CAST(row_number() OVER (PARTITION BY week_start ORDER BY revenue_vnd DESC, store_id) AS INTEGER) AS position,
           'top' AS side FROM weekly QUALIFY position <= 10
    UNION ALL
    SELECT *, CAST(row_number() OVER (PARTITION BY week_start ORDER BY revenue_vnd, store_id) AS INTEGER) AS position,
           'bottom' FROM weekly QUALIFY position <= 10""")
def _(lake):
    week = F.to_date(F.date_trunc("week", "txn_date")).alias("week_start")
    weekly = lake["stg_pos__transactions"].groupBy(week, "store_id").agg(F.sum("total_amount_vnd").alias("revenue_vnd"))
    return top_bottom(weekly, ["week_start"], "revenue_vnd", "store_id", 10)


@query("x17_compact_files", "SELECT *, CAST(event_time AS DATE) AS dt FROM raw_order_events")
def _(spark, folder):
    scattered = workspace(spark, "scattered")
    events = raw_view(spark, folder, "order_events").withColumn("dt", F.to_date("event_time"))
    events.repartition(8).write.partitionBy("dt").parquet(scattered)
    tables.compact(spark, scattered, "dt", F.col("dt") >= F.lit(dt.date(2024, 1, 10)))
    return spark.read.parquet(scattered)


# --- the rules in every form ------------------------------------------------

_RULES_SQL = """
    SELECT order_id, order_id IS NOT NULL AND customer_id IS NOT NULL AND amount > 0 AS is_valid,
           status IN ('delivered', 'completed') AS is_completed, status IN ('cancelled', 'returned') AS is_cancelled,
           CASE WHEN CAST(amount AS DOUBLE) > 3 THEN 'CRITICAL' WHEN CAST(amount AS DOUBLE) > 1 THEN 'WARNING' ELSE 'OK' END AS alert,
           CASE WHEN CAST(amount AS INTEGER) <= 0 THEN 'OUT_OF_STOCK' WHEN CAST(amount AS INTEGER) <= 10 THEN 'LOW_STOCK'
                WHEN CAST(amount AS INTEGER) <= 20 THEN 'REORDER' END AS stock_alert
    FROM (SELECT * REPLACE (CAST(floor(amount) AS DECIMAL(18,2)) AS amount) FROM raw_order_events)"""


def _whole_amounts(spark, folder):
    return raw_view(spark, folder, "order_events").withColumn("amount", F.floor("amount").cast("decimal(18,2)"))


@query("f1_rule_columns", _RULES_SQL)
def _(spark, folder):
    return _whole_amounts(spark, folder).select(
        "order_id", rules.order_filter().alias("is_valid"), rules.is_completed().alias("is_completed"),
        rules.is_cancelled().alias("is_cancelled"),
        rules.reconciliation_alert(F.col("amount").cast("double")).alias("alert"),
        rules.inventory_alert(F.col("amount").cast("int"), F.lit(10), F.lit(20)).alias("stock_alert"))


@query("f2_rule_sql_functions", _RULES_SQL)
def _(spark, folder):
    register_functions(spark)
    return spark.sql("""
        SELECT order_id, is_valid_order(order_id, customer_id, amount) AS is_valid, is_completed(status) AS is_completed,
               is_cancelled(status) AS is_cancelled, reconciliation_alert(CAST(amount AS DOUBLE)) AS alert,
               inventory_alert(CAST(amount AS INT), 10, 20) AS stock_alert FROM {events}""",
                     events=_whole_amounts(spark, folder))


@lake_query("f3_model_views", """
    SELECT region, CAST(sum(total_revenue_vnd) AS BIGINT) AS revenue_vnd, count(DISTINCT store_id) AS stores
    FROM fct_revenue_daily JOIN dim_stores USING (store_id) WHERE channel = 'pos' GROUP BY region""")
def _(lake):
    for model in ("fct_revenue_daily", "dim_stores"):
        lake[model].createOrReplaceTempView(f"lake_{model}")
    return lake.spark.sql("""
        SELECT region, sum(total_revenue_vnd) AS revenue_vnd, count(DISTINCT store_id) AS stores
        FROM lake_fct_revenue_daily JOIN lake_dim_stores USING (store_id) WHERE channel = 'pos' GROUP BY region""")

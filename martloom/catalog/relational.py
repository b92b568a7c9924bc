"""D, J, W, L, U and G rows: dedup, joins, windows, ordering, unions, spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.registry import lake_query, query
from martloom.functions.columns import month_start
from martloom.operators import joins, reconcile
from martloom.operators.dedup import dedup_any, distinct_values, latest_per_key, latest_snapshot
from martloom.operators.ranking import global_ntile, rank_within, with_growth
from martloom.operators.shaping import date_spine, top_n, union_all
from martloom.session import write_once
from martloom.sources.sample import raw_view, table

# --- dedup ------------------------------------------------------------------


@query("d1_latest_per_key", """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey) = 1""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")
    newest = latest_per_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", [F.desc("l_extendedprice"), "l_partkey"])
    return newest.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))


@query("d2_drop_duplicates", "SELECT DISTINCT txn_id FROM raw_pos_transactions WHERE txn_id IS NOT NULL")
def _(spark, folder):
    return dedup_any(raw_view(spark, folder, "pos_transactions"), "txn_id").select("txn_id")


@lake_query("d3_distinct_values", """
    SELECT DISTINCT customer_phone FROM stg_pos__transactions WHERE customer_phone IS NOT NULL""")
def _(lake):
    return distinct_values(lake["stg_pos__transactions"], "customer_phone")


@lake_query("d4_latest_snapshot", "SELECT * FROM latest_stock")
def _(lake):
    return latest_snapshot(lake["stg_inventory__stock_levels"], ["qty_on_hand", "product_id", "qty_reserved"])


# --- joins ------------------------------------------------------------------

@lake_query("j1_left_equi", """
    SELECT o.order_id, o.ecom_customer_id, c.email, c.registered_at
    FROM stg_ecommerce__orders o LEFT JOIN stg_ecommerce__customers c USING (ecom_customer_id)""")
def _(lake):
    people = lake["stg_ecommerce__customers"].select("ecom_customer_id", "email", "registered_at")
    orders = lake["stg_ecommerce__orders"].select("order_id", "ecom_customer_id")
    return joins.left_lookup(orders, people.withColumnRenamed("ecom_customer_id", "_id"), "ecom_customer_id", "_id",
                             spread_by="order_id")


@lake_query("j2_left_join_any_key", """
    SELECT c.ecom_customer_id, c.phone_normalized, c.email, m.loyalty_member_id, m.tier
    FROM stg_ecommerce__customers c LEFT JOIN stg_loyalty__members m
      ON c.phone_normalized = m.phone_normalized OR c.email = m.email""")
def _(lake):
    members = lake["stg_loyalty__members"].select(
        "loyalty_member_id", "tier", F.col("phone_normalized").alias("phone"), F.col("email").alias("mail"))
    customers = lake["stg_ecommerce__customers"].select("ecom_customer_id", "phone_normalized", "email")
    return joins.left_join_any_key(customers, members, [("phone_normalized", "phone"), ("email", "mail")],
                                   ["loyalty_member_id", "tier"], spread_by="ecom_customer_id")


@lake_query("j3_exists_flag", """
    SELECT ecom_customer_id, phone_normalized, phone_normalized IN (SELECT customer_phone FROM stg_pos__transactions
           WHERE customer_phone IS NOT NULL) AS has_pos_activity FROM stg_ecommerce__customers""")
def _(lake):
    customers = lake["stg_ecommerce__customers"].select("ecom_customer_id", "phone_normalized")
    return joins.with_exists_flag(customers, "phone_normalized", lake["stg_pos__transactions"], "customer_phone",
                                  "has_pos_activity", spread_by="ecom_customer_id")


@lake_query("j4_star_lookup", """
    SELECT store_id, sku, product_id, qty_available, product_name, brand, store_name, region
    FROM stg_inventory__stock_levels LEFT JOIN dim_products p USING (product_id, sku)
    LEFT JOIN dim_stores USING (store_id)""")
def _(lake):
    products = lake["dim_products"].select("product_id", "product_name", "brand")
    stores = lake["dim_stores"].select("store_id", "store_name", "region")
    facts = lake["stg_inventory__stock_levels"].select("store_id", "sku", "product_id", "qty_available")
    return joins.with_dims(facts, (products, "product_id"), (stores, "store_id"))


@lake_query("j5_dim_metrics_left", """
    SELECT u.customer_uid, u.ecom_customer_id, u.loyalty_member_id, m.total_orders, m.lifetime_revenue_vnd
    FROM int_customers_unified u LEFT JOIN int_customer_metrics m USING (customer_uid)""")
def _(lake):
    metrics = lake["int_customer_metrics"].select("customer_uid", "total_orders", "lifetime_revenue_vnd")
    people = lake["int_customers_unified"].select("customer_uid", "ecom_customer_id", "loyalty_member_id")
    return people.join(metrics, "customer_uid", "left")


@query("j6_fk_orphans", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def _(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return joins.orphans(customers, "c_custkey", table(spark, folder, "orders"), "o_custkey")


_BY_STORE = """
    SELECT date_key, store_id, channel, coalesce(b, 0) AS batch_revenue, coalesce(s, 0) AS stream_revenue,
           round(coalesce(abs(CAST(coalesce(b, 0) AS DOUBLE) - CAST(coalesce(s, 0) AS DOUBLE))
                 / nullif(CAST(coalesce(b, 0) AS DOUBLE), 0) * 100,
                 CASE WHEN coalesce(s, 0) = 0 THEN 0.0 ELSE 100.0 END), 4) AS discrepancy_pct
    FROM (SELECT CAST(event_time AS DATE) AS date_key, store_id, channel, CAST(sum(amount) AS DECIMAL(28,2)) AS b
          FROM raw_order_events WHERE amount > 0 GROUP BY ALL)
    FULL JOIN (SELECT CAST(event_time AS DATE) AS date_key, store_id, channel, CAST(sum(amount) AS DECIMAL(28,2)) AS s
          FROM raw_order_events WHERE amount > 0 AND customer_id IS NOT NULL GROUP BY ALL)
    USING (date_key, store_id, channel)"""


def both_paths(spark, folder):
    """The batch path keeps anonymous sales, the live path drops them."""
    rows = raw_view(spark, folder, "order_events").where("amount > 0").select(
        F.to_date("event_time").alias("date_key"), "store_id", "channel", "customer_id", F.col("amount").alias("revenue"))
    return rows.drop("customer_id"), rows.where("customer_id IS NOT NULL").drop("customer_id")


@query("j7_batch_stream_full_join", f"""
    SELECT *, CASE WHEN discrepancy_pct > 3 THEN 'CRITICAL' ELSE 'WARNING' END AS alert_level,
           discrepancy_pct <= 1 AS is_within_threshold FROM ({_BY_STORE}) WHERE discrepancy_pct > 1""")
def _(spark, folder):
    return reconcile.by_store(*both_paths(spark, folder))


# --- windows ----------------------------------------------------------------

@query("w1_row_number", """
    SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey)
           AS INTEGER) AS recent_rank FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 3""")
def _(spark, folder):
    from pyspark.sql import Window
    recent = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    ranked = table(spark, folder, "orders").select("o_custkey", "o_orderkey", F.row_number().over(recent).alias("recent_rank"))
    return ranked.where("recent_rank <= 3")


@query("w2_rank", """
    SELECT s_suppkey, s_nationkey, s_acctbal,
           CAST(rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC) AS INTEGER) AS rank_in_nation
    FROM supplier""")
def _(spark, folder):
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return rank_within(suppliers, {"rank_in_nation": ["s_nationkey"]}, "s_acctbal")


@query("w2_rank_large_groups", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
           CAST(rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS INTEGER) AS quantity_rank
    FROM lineitem""")
def _(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag")
    return rank_within(lines, {"quantity_rank": ["l_returnflag"]}, "l_quantity").drop("l_returnflag")


@query("w3_ntile_global", """
    SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS date_tile,
           CAST(ntile(5) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS price_tile,
           CAST(ntile(5) OVER (ORDER BY o_custkey, o_orderkey) AS INTEGER) AS customer_tile FROM orders""")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_custkey")
    tiles = {"date_tile": "o_orderdate", "price_tile": "o_totalprice", "customer_tile": "o_custkey"}
    return global_ntile(orders, 5, tiles, ["o_orderkey"]).select("o_orderkey", *tiles)


@query("w4_lag_growth", """
    SELECT *, lag(orders) OVER (ORDER BY month_key) AS previous,
           CAST(orders - lag(orders) OVER (ORDER BY month_key) AS DOUBLE)
             / nullif(lag(orders) OVER (ORDER BY month_key), 0) AS growth
    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_key, count(*) AS orders FROM orders GROUP BY 1)""")
def _(spark, folder):
    monthly = table(spark, folder, "orders").groupBy(month_start("o_orderdate").alias("month_key")).agg(
        F.count("*").alias("orders"))
    return with_growth(monthly, "month_key", "orders", "previous", "growth")


# --- ordering, unions, spines -----------------------------------------------

@lake_query("l1_top_n_alerts", """
    SELECT date_key, discrepancy_vnd, discrepancy_pct, reconciliation_status FROM fct_reconciliation
    WHERE reconciliation_status <> 'OK' ORDER BY discrepancy_pct DESC NULLS LAST, date_key LIMIT 20""")
def _(lake):
    alerts = lake["fct_reconciliation"].where("reconciliation_status <> 'OK'").select(
        "date_key", "discrepancy_vnd", "discrepancy_pct", "reconciliation_status")
    return top_n(alerts, [F.desc_nulls_last("discrepancy_pct"), F.col("date_key")], 20)


@query("l2_drift_order", f"""
    SELECT date_key, store_id, channel, discrepancy_pct FROM ({_BY_STORE})
    WHERE date_key = DATE '2024-01-10' AND discrepancy_pct > 1 ORDER BY discrepancy_pct DESC""")
def _(spark, folder):
    drifted = reconcile.by_store(*both_paths(spark, folder), dt.date(2024, 1, 10))
    return drifted.select("date_key", "store_id", "channel", "discrepancy_pct")


@lake_query("u1_union_all", """
    SELECT gateway, payment_id, amount_vnd FROM stg_payments__consolidated""")
def _(lake):
    return union_all(*[lake[f"stg_payments__{g}"].select("gateway", "payment_id", "amount_vnd")
                       for g in ("vnpay", "momo", "card")])


@query("g1_date_spine", """
    SELECT CAST(d AS DATE) AS date_key, coalesce(n, 0) AS orders
    FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
         generate_series(lo, hi, INTERVAL 1 DAY) AS days(d)
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS o_day, count(*) AS n FROM orders GROUP BY 1) ON o_day = CAST(d AS DATE)""")
def _(spark, folder):
    per_day = table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("date_key")).agg(F.count("*").alias("n"))
    first, last = per_day.agg(F.min("date_key"), F.max("date_key")).first()
    spine = date_spine(spark, first, last)
    return spine.join(per_day, "date_key", "left").select("date_key", F.coalesce("n", F.lit(0)).alias("orders"))

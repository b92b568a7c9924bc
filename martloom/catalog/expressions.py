"""P rows: projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.catalog.oracle import RFM_SQL
from martloom.catalog.registry import lake_query, query
from martloom.functions import columns as C
from martloom.functions import rules
from martloom.operators.dedup import latest_per_key
from martloom.operators.shaping import require_keys, select_typed, union_all
from martloom.sources.sample import raw_view, table


@query("p1_rename_cast", """
    SELECT order_id, customer_id AS ecom_customer_id, CAST(subtotal AS BIGINT) AS subtotal_vnd,
           CAST(total_amount AS DECIMAL(20,2)) AS total_amount, CAST(num_items AS VARCHAR) AS num_items,
           CAST(order_date AS DATE) AS order_day FROM raw_ecom_orders""")
def _(spark, folder):
    return select_typed(raw_view(spark, folder, "ecom_orders"), [
        "order_id", ("customer_id", "ecom_customer_id", "string"), ("subtotal", "subtotal_vnd", "bigint"),
        ("total_amount", "total_amount", "decimal(20,2)"), ("num_items", "num_items", "string"),
        ("order_date", "order_day", "date")])


@query("p2_key_not_null", "SELECT * FROM raw_order_events WHERE order_id IS NOT NULL AND customer_id IS NOT NULL")
def _(spark, folder):
    return require_keys(raw_view(spark, folder, "order_events"), "order_id", "customer_id")


@query("p3_positive_amount", "SELECT * FROM raw_order_events WHERE amount > 0")
def _(spark, folder):
    return raw_view(spark, folder, "order_events").where(F.col("amount") > 0)


@query("p4_order_filter", """
    SELECT * FROM raw_order_events WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND amount > 0""")
def _(spark, folder):
    return raw_view(spark, folder, "order_events").where(rules.order_filter())


@query("p5_is_completed", """
    SELECT order_id, status, status IN ('delivered', 'completed') AS is_completed,
           status IN ('cancelled', 'returned') AS is_cancelled FROM raw_ecom_orders""")
def _(spark, folder):
    return raw_view(spark, folder, "ecom_orders").select(
        "order_id", "status", rules.is_completed().alias("is_completed"), rules.is_cancelled().alias("is_cancelled"))


@query("p6_exclude_cancelled", "SELECT * FROM raw_ecom_orders WHERE status NOT IN ('cancelled', 'returned')")
def _(spark, folder):
    return raw_view(spark, folder, "ecom_orders").where(~rules.is_cancelled())


@query("p7_phone_digits", """
    SELECT member_id, phone, regexp_replace(phone, '[^0-9]', '', 'g') AS digits,
           CASE WHEN regexp_replace(phone, '[^0-9]', '', 'g') LIKE '84%'
                THEN '0' || substring(regexp_replace(phone, '[^0-9]', '', 'g'), 3)
                ELSE regexp_replace(phone, '[^0-9]', '', 'g') END AS normalized FROM raw_loyalty_members""")
def _(spark, folder):
    return raw_view(spark, folder, "loyalty_members").select(
        "member_id", "phone", F.regexp_replace("phone", "[^0-9]", "").alias("digits"),
        C.phone_digits("phone").alias("normalized"))


@query("p8_phone_normalize", """
    WITH phones AS (SELECT member_id AS id, phone FROM raw_loyalty_members
                    UNION ALL SELECT customer_id, phone FROM raw_ecom_customers)
    SELECT id, phone,
           CASE WHEN starts_with(phone, '+84') THEN '0' || substr(translate(phone, ' -', ''), 4)
                WHEN starts_with(phone, '84') AND length(translate(phone, ' -', '')) >= 11
                THEN '0' || substr(translate(phone, ' -', ''), 3)
                ELSE translate(phone, ' -', '') END AS normalized FROM phones""")
def _(spark, folder):
    members = raw_view(spark, folder, "loyalty_members").select(F.col("member_id").alias("id"), "phone")
    customers = raw_view(spark, folder, "ecom_customers").select(F.col("customer_id").alias("id"), "phone")
    return union_all(members, customers).withColumn("normalized", C.phone_normalize("phone"))


@query("p9_email_normalize", "SELECT customer_id, lower(trim(email)) AS email FROM raw_ecom_customers")
def _(spark, folder):
    return raw_view(spark, folder, "ecom_customers").select("customer_id", C.email_normalize("email").alias("email"))


@query("p10_gateway_status", """
    SELECT vnp_txn_ref AS payment_id, vnp_response_code = '00' AS is_success,
           coalesce(MAP {'00': 'success', '07': 'fraud_suspected', '09': 'failed'}[vnp_response_code], 'unknown') AS status
    FROM raw_payments_vnpay
    UNION ALL BY NAME SELECT trans_id AS payment_id, result_code = 0 AS is_success,
           coalesce(MAP {0: 'success', 1006: 'user_cancelled'}[result_code], 'failed') AS status FROM raw_payments_momo
    UNION ALL BY NAME SELECT transaction_id AS payment_id, status = 'SETTLED' AS is_success,
           coalesce(MAP {'SETTLED': 'success', 'DECLINED': 'failed', 'REFUNDED': 'refunded'}[status], 'pending') AS status
    FROM raw_payments_card""")
def _(spark, folder):
    codes = {"vnpay": ("vnp_txn_ref", "vnp_response_code"), "momo": ("trans_id", "result_code"),
             "card": ("transaction_id", "status")}
    return union_all(*[
        raw_view(spark, folder, f"payments_{gateway}").select(
            F.col(key).alias("payment_id"), rules.gateway_status(gateway, code).alias("status"),
            rules.is_success_code(gateway, code).alias("is_success"))
        for gateway, (key, code) in codes.items()])


@lake_query("p11_card_net_of_fee", """
    SELECT transaction_id AS payment_id, gross_amount - fee AS amount_vnd, fee AS fee_vnd FROM raw_payments_card""")
def _(lake):
    return lake["stg_payments__card"].select("payment_id", "amount_vnd", "fee_vnd")


@lake_query("p12_typed_literals", """
    SELECT trans_id AS payment_id, 'momo' AS gateway, CAST(0 AS BIGINT) AS fee_vnd, CAST(NULL AS VARCHAR) AS bank_code
    FROM raw_payments_momo GROUP BY trans_id""")
def _(lake):
    return lake["stg_payments__momo"].select("payment_id", "gateway", "fee_vnd", "bank_code")


@lake_query("p13_qty_available", """
    SELECT store_id, sku, snapshot_time, quantity_on_hand - quantity_reserved AS qty_available FROM raw_stock_levels
    WHERE store_id IS NOT NULL AND sku IS NOT NULL AND quantity_on_hand >= 0""")
def _(lake):
    return lake["stg_inventory__stock_levels"].select("store_id", "sku", "snapshot_time", "qty_available")


@query("p14_surrogate_key", """
    SELECT order_id, md5(concat(order_id, '-', coalesce(customer_id, '_dbt_utils_surrogate_key_null_'))) AS row_key
    FROM raw_order_events""")
def _(spark, folder):
    return raw_view(spark, folder, "order_events").select(
        "order_id", C.surrogate_key("order_id", "customer_id").alias("row_key"))


@lake_query("p15_customer_type", """
    SELECT ecom_customer_id, loyalty_member_id, customer_type, is_omnichannel FROM int_customers_unified""")
def _(lake):
    return lake["int_customers_unified"].select(
        "ecom_customer_id", "loyalty_member_id", "customer_type", "is_omnichannel")


_LEVELS = ("qty_available", "safety_stock_threshold", "reorder_point")


@lake_query("p16_stock_status", """
    SELECT store_id, sku, snapshot_time, qty_available,
           CASE WHEN qty_available <= 0 THEN 'OUT_OF_STOCK' WHEN qty_available < safety_stock_threshold THEN 'LOW_STOCK'
                WHEN qty_available < reorder_point THEN 'REORDER_NEEDED' ELSE 'OK' END AS stock_status,
           CASE WHEN qty_available <= 0 THEN 'Critical' WHEN qty_available < safety_stock_threshold THEN 'High'
                WHEN qty_available < reorder_point THEN 'Medium' ELSE 'Low' END AS alert_severity
    FROM stg_inventory__stock_levels""")
def _(lake):
    return lake["stg_inventory__stock_levels"].select(
        "store_id", "sku", "snapshot_time", "qty_available",
        rules.stock_status(*_LEVELS).alias("stock_status"), rules.stock_severity(*_LEVELS).alias("alert_severity"))


@query("p17_inventory_alert", """
    SELECT store_id, sku, event_time, qty_available,
           CASE WHEN qty_available <= 0 THEN 'OUT_OF_STOCK' WHEN qty_available <= safety_stock THEN 'LOW_STOCK'
                WHEN qty_available <= reorder_point THEN 'REORDER' END AS alert_type FROM raw_stock_events""")
def _(spark, folder):
    return raw_view(spark, folder, "stock_events").select(
        "store_id", "sku", "event_time", "qty_available", rules.inventory_alert().alias("alert_type"))


@lake_query("p18_reconciliation_alert", """
    SELECT date_key, discrepancy_pct * 100 AS discrepancy_pct,
           CASE WHEN discrepancy_pct * 100 > 3 THEN 'CRITICAL' WHEN discrepancy_pct * 100 > 1 THEN 'WARNING'
                ELSE 'OK' END AS alert_level FROM fct_reconciliation""")
def _(lake):
    percent = lake["fct_reconciliation"].select("date_key", (F.col("discrepancy_pct") * 100).alias("discrepancy_pct"))
    return percent.withColumn("alert_level", rules.reconciliation_alert())


@lake_query("p19_reconciliation_status", """
    SELECT date_key, CASE WHEN discrepancy_pct > 0.01 THEN 'ALERT' ELSE 'OK' END AS reconciliation_status
    FROM fct_reconciliation""")
def _(lake):
    return lake["fct_reconciliation"].select("date_key", "reconciliation_status")


def _scores(spark, folder):
    key = F.col("c_custkey")
    # Every seventh value in turn is null, a different one for each score.
    digit = lambda n, gap: F.when(key % 7 != gap, (F.floor(key / n) % 5 + 1).cast("int"))
    return table(spark, folder, "customer").select(
        "c_custkey", digit(1, 0).alias("recency_score"), digit(5, 1).alias("frequency_score"),
        digit(25, 2).alias("monetary_score"))


_SCORES_SQL = """(SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 5 + 1 AS INTEGER) END AS recency_score,
    CASE WHEN c_custkey % 7 <> 1 THEN CAST(c_custkey // 5 % 5 + 1 AS INTEGER) END AS frequency_score,
    CASE WHEN c_custkey % 7 <> 2 THEN CAST(c_custkey // 25 % 5 + 1 AS INTEGER) END AS monetary_score FROM customer)"""


@query("p20_rfm_segment", f"SELECT *, {RFM_SQL} AS rfm_segment FROM {_SCORES_SQL}")
def _(spark, folder):
    return _scores(spark, folder).withColumn("rfm_segment", rules.rfm_segment())


@lake_query("p21_store_buckets", "SELECT store_id, region, region_vi, sqm, store_size FROM dim_stores")
def _(lake):
    return lake["dim_stores"].select("store_id", "region", "region_vi", "sqm", "store_size")


@lake_query("p22_product_margin", "SELECT product_id, margin_vnd, margin_pct FROM dim_products")
def _(lake):
    return lake["dim_products"].select("product_id", "margin_vnd", "margin_pct")


@query("p23_safe_ratio", """
    SELECT store_id, CAST(sqm AS DOUBLE) / nullif(staff_count, 0) AS sqm_per_staff FROM raw_stores""")
def _(spark, folder):
    return raw_view(spark, folder, "stores").select("store_id", C.safe_ratio("sqm", "staff_count").alias("sqm_per_staff"))


@query("p24_like_filter", "SELECT * FROM raw_clickstream_events WHERE page_url LIKE '%flash-sale%'")
def _(spark, folder):
    return raw_view(spark, folder, "clickstream_events").where(rules.is_flash_sale())


@query("p25_calendar_parts", """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(year(o_orderdate) AS INTEGER) AS "year",
           CAST(quarter(o_orderdate) AS INTEGER) AS "quarter", CAST(month(o_orderdate) AS INTEGER) AS "month",
           CAST(day(o_orderdate) AS INTEGER) AS day_of_month, CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week,
           CAST(week(o_orderdate) AS INTEGER) AS week_of_year, isodow(o_orderdate) IN (6, 7) AS is_weekend,
           dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day_of_month,
           CAST(date_trunc('quarter', o_orderdate) AS DATE) AS first_day_of_quarter,
           concat(year(o_orderdate), '-Q', quarter(o_orderdate)) AS year_quarter,
           strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""")
def _(spark, folder):
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.withColumns(C.calendar_parts("d"))


@query("p26_date_trunc_floor", """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
           CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start FROM orders""")
def _(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", C.month_start("o_orderdate").alias("month_start"), C.quarter_start("o_orderdate").alias("quarter_start"))


@query("p27_date_diff", """
    SELECT shipment_id, CAST(date_diff('day', ordered_at, delivered_at) AS INTEGER) AS days,
           CAST((epoch_us(delivered_at) - epoch_us(ordered_at)) // 1000000 AS BIGINT) AS seconds FROM raw_shipments""")
def _(spark, folder):
    return raw_view(spark, folder, "shipments").select(
        "shipment_id", C.days_between("ordered_at", "delivered_at").alias("days"),
        C.seconds_between("ordered_at", "delivered_at").alias("seconds"))


@query("p28_drop_helper", """
    SELECT * EXCLUDE (_n) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) AS _n
                                FROM raw_ecom_orders) WHERE _n = 1""")
def _(spark, folder):
    return latest_per_key(raw_view(spark, folder, "ecom_orders"), ["order_id"], "updated_at", ["status"])


@lake_query("p29_lateral_alias", """
    SELECT session_id, count(*) FILTER (event_type = 'purchase') AS purchases,
           count(*) FILTER (event_type = 'purchase') > 0 AS has_conversion
    FROM stg_clickstream__events GROUP BY session_id""")
def _(lake):
    return lake.spark.sql("""
        SELECT session_id, count_if(event_type = 'purchase') AS purchases, purchases > 0 AS has_conversion
        FROM {events} GROUP BY session_id""", events=lake["stg_clickstream__events"])


# The band rule shares the score fixture with P20.
_BAND = " AND ".join("{0}_score BETWEEN {0}_low AND {0}_high".format(n) for n in ("recency", "frequency", "monetary"))


@query("j8_rfm_band_join", f"""
    WITH bands(pri, segment, recency_low, recency_high, frequency_low, frequency_high, monetary_low, monetary_high) AS (
        VALUES (1, 'Champion', 1, 2, 4, 5, 4, 5), (2, 'Loyal', 2, 4, 3, 5, 3, 5), (3, 'New', 1, 1, 1, 1, 1, 5),
               (4, 'At Risk', 3, 5, 3, 5, 3, 5), (5, 'Hibernating', 4, 5, 1, 2, 1, 2), (6, 'Lost', 5, 5, 1, 5, 1, 5))
    SELECT c_custkey, recency_score, frequency_score, monetary_score, min_by(segment, pri) AS band_segment
    FROM {_SCORES_SQL} LEFT JOIN bands ON {_BAND} GROUP BY ALL""")
def _(spark, folder):
    return _scores(spark, folder).withColumn("band_segment", rules.rfm_band_segment())

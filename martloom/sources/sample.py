"""Raw-shaped views over the sample star-schema tables.

Every view is one SELECT that Spark SQL and ANSI engines both accept, so a test
can evaluate the same text elsewhere. ``{table}`` marks an input table. Money is
an integer in units of 0.0001, which holds price times rate exactly. Numbers are
padded to a minimum width; longer ones are kept whole.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, str] = {}

# Duplicate line keys and 40 % anonymous sales are part of the data.
VIEWS["pos_transactions"] = """
SELECT concat('POS-', l_orderkey, '-', l_linenumber) AS txn_id,
       concat('STR-', lpad(cast(l_suppkey AS string), greatest(6, cast(length(cast(l_suppkey AS string)) AS int)), '0')) AS store_id,
       CASE WHEN l_orderkey % 5 < 2 THEN NULL
            ELSE concat('09', lpad(cast(o_custkey AS string), greatest(8, cast(length(cast(o_custkey AS string)) AS int)), '0')) END AS customer_phone,
       concat('EMP-', cast(l_suppkey AS string), '-', cast(l_linenumber AS string)) AS cashier_id,
       concat('P', lpad(cast(l_partkey AS string), greatest(7, cast(length(cast(l_partkey AS string)) AS int)), '0')) AS product_id,
       cast(l_quantity AS int) AS num_items,
       cast(floor(l_extendedprice * 10000 + 0.5) AS bigint) AS total_amount,
       cast(floor(l_extendedprice * l_discount * 10000 + 0.5) AS bigint) AS discount_amount,
       cast(floor(l_extendedprice * l_tax * 10000 + 0.5) AS bigint) AS tax_amount,
       CASE l_returnflag WHEN 'A' THEN 'cash' WHEN 'R' THEN 'card' ELSE 'momo_qr' END AS payment_method,
       cast(l_shipdate AS timestamp) AS txn_timestamp
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

VIEWS["ecom_customers"] = """
SELECT concat('EC-', lpad(cast(c_custkey AS string), greatest(7, cast(length(cast(c_custkey AS string)) AS int)), '0')) AS customer_id,
       c_name AS full_name,
       concat(' User', cast(c_custkey AS string), '@Mail.VN ') AS email,
       CASE WHEN c_custkey % 2 = 0 THEN concat('+849', lpad(cast(c_custkey AS string), greatest(8, cast(length(cast(c_custkey AS string)) AS int)), '0'))
            ELSE concat('09', lpad(cast(c_custkey AS string), greatest(8, cast(length(cast(c_custkey AS string)) AS int)), '0')) END AS phone,
       CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE NULL END AS gender,
       cast(NULL AS string) AS date_of_birth,
       c_mktsegment AS registration_source,
       cast('1995-01-01 00:00:00' AS timestamp) AS created_at,
       cast('1995-01-02 00:00:00' AS timestamp) AS updated_at
FROM {customer}
"""

# Every third customer: phone match, email-only match, double match, no match.
VIEWS["loyalty_members"] = """
SELECT concat('LYL-', lpad(cast(c_custkey AS string), greatest(7, cast(length(cast(c_custkey AS string)) AS int)), '0')) AS member_id,
       c_name AS full_name,
       CASE WHEN c_custkey % 12 = 6 THEN concat('other', cast(c_custkey AS string), '@mail.vn')
            ELSE concat('user', cast(c_custkey - c_custkey % 12 AS string), '@mail.vn') END AS email,
       CASE c_custkey % 12 WHEN 0 THEN concat('849', lpad(cast(c_custkey AS string), greatest(8, cast(length(cast(c_custkey AS string)) AS int)), '0'))
                           WHEN 3 THEN concat('0999 ', lpad(cast(c_custkey AS string), greatest(6, cast(length(cast(c_custkey AS string)) AS int)), '0'))
                           WHEN 6 THEN concat('+84 9', lpad(cast(c_custkey AS string), greatest(8, cast(length(cast(c_custkey AS string)) AS int)), '0'))
                           ELSE concat('0888-', lpad(cast(c_custkey AS string), greatest(6, cast(length(cast(c_custkey AS string)) AS int)), '0')) END AS phone,
       CASE WHEN c_acctbal < 2500 THEN 'Bronze' WHEN c_acctbal < 5000 THEN 'Silver'
            WHEN c_acctbal < 7500 THEN 'Gold' ELSE 'Platinum' END AS tier,
       cast(c_custkey % 1000 AS int) AS points_balance,
       cast('1996-01-01 00:00:00' AS timestamp) AS joined_date,
       cast('2001-01-01 00:00:00' AS timestamp) AS last_activity_date,
       cast('2001-01-01 00:00:00' AS timestamp) AS updated_at
FROM {customer} WHERE c_custkey % 3 = 0
"""

# Every 50th order has a second, newer version.
VIEWS["ecom_orders"] = """
SELECT concat('ECOM-', lpad(cast(o_orderkey AS string), greatest(8, cast(length(cast(o_orderkey AS string)) AS int)), '0')) AS order_id,
       concat('EC-', lpad(cast(o_custkey AS string), greatest(7, cast(length(cast(o_custkey AS string)) AS int)), '0')) AS customer_id,
       CASE WHEN version = 1 THEN 'delivered' WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'processing'
            WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'returned' END AS status,
       CASE o_orderkey % 4 WHEN 0 THEN 'vnpay' WHEN 1 THEN 'momo' WHEN 2 THEN 'card' ELSE 'cod' END AS payment_method,
       cast(o_orderkey % 5 + 1 AS int) AS num_items,
       cast(floor(o_totalprice * 10000 + 0.5) AS bigint) AS subtotal,
       cast(0 AS bigint) AS discount,
       cast(0 AS bigint) AS shipping_fee,
       cast(floor(o_totalprice * 10000 + 0.5) AS bigint) AS total_amount,
       o_orderpriority AS shipping_address_city,
       cast(NULL AS string) AS shipping_address_district,
       cast(o_orderdate AS timestamp) AS order_date,
       cast(o_orderdate AS timestamp) AS created_at,
       CASE WHEN version = 1 THEN cast(o_orderdate AS timestamp) + INTERVAL '1' DAY
            ELSE cast(o_orderdate AS timestamp) END AS updated_at
FROM (SELECT *, 0 AS version FROM {orders}
      UNION ALL
      SELECT *, 1 AS version FROM {orders} WHERE o_orderkey % 50 = 0) versions
"""

# Every 20th payment is sent twice.
VIEWS["payments_vnpay"] = """
SELECT concat('VNP', lpad(cast(o_orderkey AS string), greatest(10, cast(length(cast(o_orderkey AS string)) AS int)), '0')) AS vnp_txn_ref,
       concat('ECOM-', lpad(cast(o_orderkey AS string), greatest(8, cast(length(cast(o_orderkey AS string)) AS int)), '0')) AS vnp_order_info,
       cast(floor(o_totalprice * 10000 + 0.5) AS bigint) AS vnp_amount,
       CASE WHEN o_orderkey % 100 = 4 THEN '07' WHEN o_orderkey % 100 = 8 THEN '09'
            WHEN o_orderkey % 100 = 12 THEN '12' ELSE '00' END AS vnp_response_code,
       'VCB' AS vnp_bank_code,
       cast(o_orderdate AS timestamp) AS vnp_pay_date
FROM (SELECT * FROM {orders} UNION ALL SELECT * FROM {orders} WHERE o_orderkey % 20 = 0) sent
WHERE o_orderkey % 4 = 0
"""

VIEWS["payments_momo"] = """
SELECT concat('MOMO', lpad(cast(o_orderkey AS string), greatest(10, cast(length(cast(o_orderkey AS string)) AS int)), '0')) AS trans_id,
       concat('ECOM-', lpad(cast(o_orderkey AS string), greatest(8, cast(length(cast(o_orderkey AS string)) AS int)), '0')) AS order_id,
       cast(floor(o_totalprice * 10000 + 0.5) AS bigint) AS amount,
       CASE WHEN o_orderkey % 100 = 5 THEN 1006 WHEN o_orderkey % 100 = 9 THEN 1005 ELSE 0 END AS result_code,
       cast(o_orderdate AS timestamp) AS response_time
FROM (SELECT * FROM {orders} UNION ALL SELECT * FROM {orders} WHERE o_orderkey % 40 = 1) sent
WHERE o_orderkey % 4 = 1
"""

# Fee 2.2 %, settled one day later.
VIEWS["payments_card"] = """
SELECT concat('CARD', lpad(cast(o_orderkey AS string), greatest(10, cast(length(cast(o_orderkey AS string)) AS int)), '0')) AS transaction_id,
       concat('ECOM-', lpad(cast(o_orderkey AS string), greatest(8, cast(length(cast(o_orderkey AS string)) AS int)), '0')) AS merchant_ref,
       cast(floor(o_totalprice * 10000 + 0.5) AS bigint) AS gross_amount,
       cast(floor(floor(o_totalprice * 10000 + 0.5) * 22 / 1000) AS bigint) AS fee,
       CASE WHEN o_orderkey % 100 = 2 THEN 'DECLINED' WHEN o_orderkey % 100 = 6 THEN 'PENDING'
            WHEN o_orderkey % 100 = 10 THEN 'REFUNDED' ELSE 'SETTLED' END AS status,
       'TCB' AS issuer_bank,
       cast(o_orderdate AS timestamp) + INTERVAL '1' DAY AS settled_at
FROM {orders} WHERE o_orderkey % 4 = 2
"""

VIEWS["stock_levels"] = """
SELECT concat('STR-', lpad(cast(l_suppkey AS string), greatest(6, cast(length(cast(l_suppkey AS string)) AS int)), '0')) AS store_id,
       concat('SKU-', lpad(cast(l_partkey % 100 AS string), 5, '0')) AS sku,
       concat('P', lpad(cast(l_partkey AS string), greatest(7, cast(length(cast(l_partkey AS string)) AS int)), '0')) AS product_id,
       cast(l_quantity AS int) AS quantity_on_hand,
       cast(least(l_quantity, cast(l_linenumber * 3 AS double)) AS int) AS quantity_reserved,
       cast(10 AS int) AS safety_stock,
       cast(20 AS int) AS reorder_point,
       cast(l_shipdate AS timestamp) AS snapshot_time
FROM {lineitem}
"""

# A session's rows mix null and known users.
VIEWS["clickstream_events"] = """
SELECT concat('EVT-', lpad(cast(event_id AS string), greatest(12, cast(length(cast(event_id AS string)) AS int)), '0')) AS event_id,
       concat('sess_', cast(user_id AS string), '_', cast(cast(ts AS date) AS string)) AS session_id,
       CASE WHEN event_id % 20 < 9 THEN NULL ELSE concat('EC-', lpad(cast(user_id AS string), greatest(7, cast(length(cast(user_id AS string)) AS int)), '0')) END AS user_id,
       CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
            WHEN 'signup' THEN 'search' WHEN 'error' THEN 'click' ELSE event_type END AS event_type,
       CASE WHEN props LIKE '%: 1%' THEN '/flash-sale' ELSE '/products' END AS page_url,
       CASE user_id % 4 WHEN 0 THEN 'google.com' WHEN 1 THEN 'facebook.com' WHEN 2 THEN 'direct' ELSE NULL END AS referrer,
       CASE user_id % 3 WHEN 0 THEN 'summer_sale' WHEN 1 THEN 'tet_2025' ELSE NULL END AS utm_campaign,
       CASE user_id % 2 WHEN 0 THEN 'google' ELSE NULL END AS utm_source,
       CASE user_id % 2 WHEN 0 THEN 'cpc' ELSE NULL END AS utm_medium,
       CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
       'Chrome' AS browser, 'Android' AS os, 'VN' AS country, 'Ha Noi' AS city,
       cast(floor(value * 100) AS int) AS duration_ms,
       cast(ts AS timestamp) AS event_time
FROM {events}
"""

# Null customers, zero and negative amounts.
VIEWS["order_events"] = """
SELECT concat('ORD-', lpad(cast(event_id AS string), greatest(10, cast(length(cast(event_id AS string)) AS int)), '0')) AS order_id,
       CASE WHEN event_id % 25 = 0 THEN NULL ELSE concat('EC-', lpad(cast(user_id AS string), greatest(7, cast(length(cast(user_id AS string)) AS int)), '0')) END AS customer_id,
       concat('STR-', lpad(cast(user_id % 10 AS string), 6, '0')) AS store_id,
       CASE user_id % 2 WHEN 0 THEN 'pos' ELSE 'ecommerce' END AS channel,
       CASE WHEN event_id % 30 = 0 THEN cast(0 AS decimal(18,2)) WHEN event_id % 31 = 0 THEN cast(-1 AS decimal(18,2))
            ELSE cast(value AS decimal(18,2)) END AS amount,
       cast(0.5 AS decimal(10,2)) AS discount,
       CASE event_id % 3 WHEN 0 THEN 'vnpay' WHEN 1 THEN 'momo' ELSE 'card' END AS payment_method,
       CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'cancelled' ELSE 'pending' END AS status,
       cast(ts AS timestamp) AS event_time
FROM {events}
"""

VIEWS["payment_events"] = """
SELECT concat('PAY-', lpad(cast(event_id AS string), greatest(10, cast(length(cast(event_id AS string)) AS int)), '0')) AS payment_id,
       CASE event_id % 3 WHEN 0 THEN 'vnpay' WHEN 1 THEN 'momo' ELSE 'card' END AS gateway,
       CASE event_type WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'success'
            WHEN 'error' THEN 'failed' ELSE 'pending' END AS status,
       cast(value AS decimal(18,2)) AS amount,
       cast(ts AS timestamp) AS event_time
FROM {events}
"""

VIEWS["stock_events"] = """
SELECT concat('STR-', lpad(cast(user_id % 10 AS string), 6, '0')) AS store_id,
       concat('SKU-', lpad(cast(user_id % 100 AS string), 5, '0')) AS sku,
       concat('P', lpad(cast(user_id AS string), greatest(7, cast(length(cast(user_id AS string)) AS int)), '0')) AS product_id,
       cast(floor(value) AS int) - 5 AS qty_available,
       cast(10 AS int) AS safety_stock,
       cast(20 AS int) AS reorder_point,
       cast(ts AS timestamp) AS event_time
FROM {events}
"""

# staff_count is 0 for some stores.
VIEWS["stores"] = """
SELECT concat('STR-', lpad(cast(s_suppkey AS string), greatest(6, cast(length(cast(s_suppkey AS string)) AS int)), '0')) AS store_id,
       s_name AS store_name,
       CASE n_regionkey % 3 WHEN 0 THEN 'North' WHEN 1 THEN 'Central' ELSE 'South' END AS region,
       n_name AS city,
       cast(NULL AS string) AS district,
       cast(NULL AS string) AS address,
       CASE s_suppkey % 2 WHEN 0 THEN 'mall' ELSE 'street' END AS store_format,
       cast(300 + s_suppkey % 10 * 100 AS int) AS sqm,
       cast(s_suppkey % 7 * 5 AS int) AS staff_count,
       cast('2019-01-01' AS date) AS opened_date,
       cast(NULL AS string) AS manager_name
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

VIEWS["products"] = """
SELECT concat('P', lpad(cast(p_partkey AS string), greatest(7, cast(length(cast(p_partkey AS string)) AS int)), '0')) AS product_id,
       concat('SKU-', lpad(cast(p_partkey % 100 AS string), 5, '0')) AS sku,
       p_name AS product_name, p_type AS category_l1,
       concat('size', cast(p_size AS string)) AS category_l2, p_brand AS brand,
       cast(floor(p_retailprice * 10000 + 0.5) AS bigint) AS price_vnd,
       cast(floor(p_retailprice * 7000 + 0.5) AS bigint) AS cost_vnd,
       concat('SUP', cast(p_partkey % 10 AS string)) AS supplier_id,
       cast(NULL AS string) AS supplier_name,
       cast(NULL AS double) AS weight_kg,
       p_partkey % 11 <> 0 AS is_active
FROM {part}
"""

# One shipment per order line; five delivery partners.
VIEWS["shipments"] = """
SELECT concat('SHP-', l_orderkey, '-', l_linenumber) AS shipment_id,
       concat('partner', cast(l_suppkey % 5 AS string)) AS partner,
       cast(o_orderdate AS timestamp) AS ordered_at,
       CASE WHEN l_shipdate < o_orderdate THEN NULL ELSE cast(l_shipdate AS timestamp) END AS delivered_at
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

# Order state changes as envelopes: create, update, delete.
VIEWS["order_changes"] = """
SELECT concat('ECOM-', lpad(cast(o_orderkey AS string), greatest(8, cast(length(cast(o_orderkey AS string)) AS int)), '0')) AS order_id,
       kind AS op,
       o_orderkey * 10 + step AS seq,
       CASE kind WHEN 'd' THEN NULL WHEN 'u' THEN 'delivered' ELSE 'pending' END AS status,
       CASE kind WHEN 'd' THEN NULL ELSE cast(floor(o_totalprice * 10000 + 0.5) AS bigint) + step END AS total_amount
FROM (SELECT *, 'c' AS kind, 1 AS step FROM {orders}
      UNION ALL
      SELECT *, 'u' AS kind, 2 AS step FROM {orders} WHERE o_orderstatus <> 'O'
      UNION ALL
      SELECT *, 'd' AS kind, 3 AS step FROM {orders} WHERE o_orderstatus = 'P') changes
"""

# Client payloads; old clients cut the object short or send a wrong type.
VIEWS["client_payloads"] = """
SELECT event_id,
       CASE WHEN event_id % 33 = 0 THEN concat('{{"event_id":', cast(event_id AS string), ',"event_type":"', event_type)
            WHEN event_id % 47 = 0 THEN concat('{{"event_id":"x', cast(event_id AS string), '","event_type":"', event_type, '","user_id":1}}')
            WHEN event_id % 101 = 0 THEN ''
            ELSE concat('{{"event_id":', cast(event_id AS string), ',"event_type":"', event_type, '","user_id":', cast(user_id AS string), '}}') END AS body
FROM {events}
"""

# Till exports: ISO, day-first, or unreadable dates, in store-local time.
VIEWS["till_dates"] = """
SELECT o_orderkey,
       CASE o_orderkey % 7 WHEN 0 THEN strfmt_dmy WHEN 3 THEN 'n/a' ELSE strfmt_iso END AS sold_on
FROM (SELECT o_orderkey,
             cast(cast(o_orderdate AS date) AS string) AS strfmt_iso,
             concat(lpad(cast(extract(day FROM o_orderdate) AS string), 2, '0'), '/',
                    lpad(cast(extract(month FROM o_orderdate) AS string), 2, '0'), '/',
                    cast(extract(year FROM o_orderdate) AS string)) AS strfmt_dmy
      FROM {orders}) texts
"""

# The items array of a sale: the product sold and the accessory that goes with it.
ITEMS_SQL = """array(
    named_struct('sku', concat('SKU-', lpad(cast(l_partkey % 100 AS string), 5, '0')),
                 'product_id', concat('P', lpad(cast(l_partkey AS string), greatest(7, cast(length(cast(l_partkey AS string)) AS int)), '0')),
                 'quantity', cast(l_quantity AS int),
                 'unit_price_vnd', cast(floor(l_extendedprice * 10000 + 0.5) AS bigint),
                 'amount_vnd', cast(floor(l_extendedprice * 10000 + 0.5) AS bigint) - 10000),
    named_struct('sku', concat('SKU-', lpad(cast((l_partkey + 1) % 100 AS string), 5, '0')),
                 'product_id', concat('P', lpad(cast(l_partkey + 1 AS string), greatest(7, cast(length(cast(l_partkey + 1 AS string)) AS int)), '0')),
                 'quantity', 1, 'unit_price_vnd', cast(10000 AS bigint),
                 'amount_vnd', cast(10000 AS bigint)))"""


def inputs_of(view: str) -> list[str]:
    fields = string.Formatter().parse(VIEWS[view])
    return sorted({name for _, name, _, _ in fields if name})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One sample table, a file or a folder of part files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_view(spark: SparkSession, folder: str, view: str) -> DataFrame:
    """One raw entity as a lazy frame over the sample tables."""
    sql = VIEWS[view]
    if view == "pos_transactions":
        sql = sql.replace("AS txn_timestamp", f"AS txn_timestamp, {ITEMS_SQL} AS items")
    return spark.sql(sql, **{name: table(spark, folder, name) for name in inputs_of(view)})


def raw_stream(spark: SparkSession, folder: str, view: str, max_files: int | None = None) -> DataFrame:
    """The same projection over a stream of exactly what ``table`` reads.

    A stream takes one file for its path only by a pattern; this one matches nothing but the table's own name.
    """
    (name,) = inputs_of(view)
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return spark.sql(VIEWS[view], **{name: reader.parquet(f"{folder}/{name}.parque[t]")})

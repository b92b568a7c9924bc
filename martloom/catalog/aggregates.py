"""A rows: aggregations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.catalog.registry import lake_query, query
from martloom.functions import rules
from martloom.functions.columns import count_where, exact_mean
from martloom.operators import quality, reconcile
from martloom.operators.shaping import aggregate_rule, pivot_sum, union_all
from martloom.plans.marts import fct_revenue_monthly_distinct
from martloom.sources.sample import raw_view, table


@query("a1_grouped_metrics", """
    SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(l_linenumber) AS BIGINT) AS total,
           CAST(sum(l_linenumber) AS DOUBLE) / count(l_linenumber) AS mean FROM lineitem GROUP BY 1, 2""")
def _(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"), F.sum("l_linenumber").alias("total"), exact_mean("l_linenumber").alias("mean"))


@query("a2_count_distinct", """
    SELECT channel, count(DISTINCT customer_id) AS customers, count(DISTINCT store_id) AS stores
    FROM raw_order_events GROUP BY channel""")
def _(spark, folder):
    return raw_view(spark, folder, "order_events").groupBy("channel").agg(
        F.countDistinct("customer_id").alias("customers"), F.countDistinct("store_id").alias("stores"))


@query("a3_conditional_agg", """
    SELECT store_id, count(*) FILTER (status = 'completed') AS completed,
           count(*) FILTER (status = 'cancelled') AS cancelled,
           CAST(coalesce(sum(amount) FILTER (status = 'completed'), 0) AS DECIMAL(28,2)) AS completed_amount
    FROM raw_order_events GROUP BY store_id""")
def _(spark, folder):
    done = F.col("status") == "completed"
    return raw_view(spark, folder, "order_events").groupBy("store_id").agg(
        count_where(done).alias("completed"), count_where(F.col("status") == "cancelled").alias("cancelled"),
        F.coalesce(F.sum(F.when(done, F.col("amount"))), F.lit(0)).cast("decimal(28,2)").alias("completed_amount"))


@lake_query("a4_pivot_sources", """
    SELECT payment_date, CAST(coalesce(sum(amount_vnd) FILTER (gateway = 'vnpay'), 0) AS BIGINT) AS vnpay_vnd,
           CAST(coalesce(sum(amount_vnd) FILTER (gateway = 'momo'), 0) AS BIGINT) AS momo_vnd,
           CAST(coalesce(sum(amount_vnd) FILTER (gateway = 'card'), 0) AS BIGINT) AS card_vnd
    FROM stg_payments__consolidated GROUP BY payment_date""")
def _(lake):
    gateways = {g: f"{g}_vnd" for g in ("vnpay", "momo", "card")}
    return pivot_sum(lake["stg_payments__consolidated"], "payment_date", "gateway", gateways, "amount_vnd")


@query("a5_min_max", """
    SELECT session_id, min(event_time) AS session_start, max(event_time) AS session_end
    FROM raw_clickstream_events GROUP BY 1""")
def _(spark, folder):
    return raw_view(spark, folder, "clickstream_events").groupBy("session_id").agg(
        F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end"))


@query("a6_day_total", """
    SELECT '2024-01-10' AS day, CAST(coalesce(sum(amount), 0) AS DECIMAL(28,2)) AS total FROM raw_order_events
    WHERE CAST(event_time AS DATE) = DATE '2024-01-10'
    UNION ALL SELECT '1999-01-01', CAST(coalesce(sum(amount), 0) AS DECIMAL(28,2)) FROM raw_order_events
    WHERE CAST(event_time AS DATE) = DATE '1999-01-01'""")
def _(spark, folder):
    orders = raw_view(spark, folder, "order_events")
    days = [dt.date(2024, 1, 10), dt.date(1999, 1, 1)]
    return union_all(*[reconcile.day_total(orders, "event_time", d, "amount").select(F.lit(str(d)).alias("day"), "total")
                       for d in days])


@lake_query("a7_session_rollup", "SELECT * FROM int_sessions")
def _(lake):
    return lake["int_sessions"]


@lake_query("a8_rollup_of_rollup", """
    SELECT m.*, d.monthly_distinct_customers FROM fct_revenue_monthly m
    LEFT JOIN (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_key,
                      count(DISTINCT customer_uid) AS monthly_distinct_customers
               FROM int_orders_all_channels WHERE status NOT IN ('cancelled', 'returned') GROUP BY 1) d USING (month_key)""")
def _(lake):
    return fct_revenue_monthly_distinct(lake["int_orders_all_channels"])


@query("a9_having_duplicates", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(spark, folder):
    return quality.duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a10_rule_driven_agg", """
    SELECT CAST(event_time AS DATE) AS revenue_date, store_id, channel, count(*) AS order_count,
           CAST(sum(amount) AS DECIMAL(28,2)) AS gross_revenue,
           CAST(sum(amount - discount) AS DECIMAL(29,2)) AS net_revenue,
           CAST(round(CAST(sum(amount) AS DOUBLE) / count(*), 6) AS DECIMAL(22,6)) AS avg_order_value
    FROM raw_order_events WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND amount > 0 GROUP BY 1, 2, 3""")
def _(spark, folder):
    dated = raw_view(spark, folder, "order_events").withColumn("revenue_date", F.to_date("event_time"))
    return aggregate_rule(dated, rules.REVENUE_DAILY, rules.order_filter())


@lake_query("a11_rfm_metrics", "SELECT * FROM int_customer_metrics")
def _(lake):
    return lake["int_customer_metrics"]

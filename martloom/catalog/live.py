"""T rows: streaming. Each query drains a stream over the sample and reads its sink.

In append mode a window is written once the watermark has passed its end, so the
check SQL keeps the windows closed by then."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom import schemas
from martloom.catalog.registry import query
from martloom.functions.columns import last_by
from martloom.operators.changes import replacing_read, retain, summing_read
from martloom.operators.sessions import sessions_by_gap
from martloom.operators.shaping import union_all
from martloom.session import workspace
from martloom.sources import tables
from martloom.sources.sample import raw_stream, raw_view
from martloom.sources.store import TableStore
from martloom.streaming import feeds, live
from martloom.streaming.sinks import drain, start
from martloom.streaming.upgrade import run_with_restarts, savepoint

_VALID = "order_id IS NOT NULL AND customer_id IS NOT NULL AND amount > 0"


def _closed(source: str, where: str, seconds: int, ts: str = "event_time") -> str:
    return f"(SELECT max({ts}) - INTERVAL {seconds} SECOND FROM {source} WHERE {where})"


@query("t1_watermark", f"""
    SELECT * FROM (SELECT date_trunc('hour', event_time) AS window_start, count(*) AS orders
                   FROM raw_order_events GROUP BY 1)
    WHERE window_start + INTERVAL 1 HOUR <= {_closed('raw_order_events', 'true', 5)}""")
def _(spark, folder):
    events = raw_stream(spark, folder, "order_events").withWatermark("event_time", live.ORDER_DELAY)
    hourly = events.groupBy(F.window("event_time", "1 hour")).agg(F.count("*").alias("orders"))
    return drain(hourly.select(F.col("window.start").alias("window_start"), "orders"), "t1")


@query("t2_valid_orders_stream", f"SELECT * FROM raw_order_events WHERE {_VALID}")
def _(spark, folder):
    return drain(live.valid_orders(raw_stream(spark, folder, "order_events")), "t2")


_REVENUE = f"""
    SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start,
           time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS window_end, store_id, channel,
           count(*) AS order_count, CAST(sum(amount) AS DECIMAL(18,2)) AS gross_revenue,
           CAST(sum(amount - discount) AS DECIMAL(18,2)) AS net_revenue,
           CAST(((2 * CAST(sum(amount) * 100 AS BIGINT) + count(*)) // (2 * count(*))) / 100 AS DECIMAL(10,2)) AS avg_order_value
    FROM raw_order_events WHERE {_VALID} GROUP BY 1, 2, 3, 4"""


@query("t3_revenue_1min", f"SELECT * FROM ({_REVENUE}) WHERE window_end <= {_closed('raw_order_events', _VALID, 5)}")
def _(spark, folder):
    return drain(live.revenue_realtime(raw_stream(spark, folder, "order_events")), "t3")


_SESSIONS = """
    SELECT session_id, min(event_time) AS session_start, max(event_time) AS session_end,
           CAST(count(*) FILTER (event_type = 'page_view') AS {0}) AS page_views,
           CAST(count(*) FILTER (event_type = 'click') AS {0}) AS clicks,
           CAST(count(*) FILTER (event_type = 'add_to_cart') AS {0}) AS add_to_carts,
           CAST(count(*) FILTER (event_type = 'purchase') AS {0}) AS purchases,
           arg_max(user_id, event_time) AS user_id, arg_max(device_type, event_time) AS device_type,
           arg_max(utm_source, event_time) AS utm_source, arg_max(utm_campaign, event_time) AS utm_campaign,
           arg_max(city, event_time) AS city
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS part
          FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY session_id ORDER BY event_time, event_id)
                               <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM raw_clickstream_events))
    GROUP BY session_id, part"""


@query("t4_sessions_30min", f"""
    SELECT * FROM ({_SESSIONS.format('INTEGER')})
    WHERE session_end + INTERVAL 30 MINUTE <= {_closed('raw_clickstream_events', 'true', 10)}""")
def _(spark, folder):
    return drain(live.sessions(raw_stream(spark, folder, "clickstream_events")), "t4")


@query("t4_sessions_30min_batch", _SESSIONS.format("BIGINT"))
def _(spark, folder):
    counts = {name: F.col("event_type") == kind for name, kind in live.SESSION_COUNTS.items()}
    return sessions_by_gap(raw_view(spark, folder, "clickstream_events"), "session_id", "event_time", 30,
                           counts, live.SESSION_LAST)


@query("t5_last_value", """
    SELECT session_id, arg_max(user_id, event_time) AS user_id, arg_max(page_url, event_time) AS page_url
    FROM raw_clickstream_events GROUP BY session_id""")
def _(spark, folder):
    return raw_view(spark, folder, "clickstream_events").groupBy("session_id").agg(
        last_by("user_id", "event_time").alias("user_id"), last_by("page_url", "event_time").alias("page_url"))


_SALE = "page_url LIKE '%flash-sale%'"


@query("t6_flash_sale_1min", f"""
    SELECT * FROM (SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start,
                          time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS window_end, event_type,
                          count(*) AS event_count, count(DISTINCT session_id) AS unique_sessions,
                          count(DISTINCT user_id) AS unique_users
                   FROM raw_clickstream_events WHERE {_SALE} GROUP BY 1, 2, 3)
    WHERE window_end <= {_closed('raw_clickstream_events', _SALE, 10)}""")
def _(spark, folder):
    return drain(live.flash_sale(raw_stream(spark, folder, "clickstream_events")), "t6")


@query("t7_payment_gateway_stats", f"""
    SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start, gateway, count(*) AS total_attempts,
           count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'failed') AS failed,
           CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount
    FROM raw_payment_events GROUP BY 1, 2
    HAVING time_bucket(INTERVAL 1 MINUTE, max(event_time)) + INTERVAL 1 MINUTE <= {_closed('raw_payment_events', 'true', 5)}""")
def _(spark, folder):
    return drain(live.gateway_stats(raw_stream(spark, folder, "payment_events")), "t7")


@query("t8_inventory_alerts_live", """
    SELECT event_time AS detected_at, store_id, sku, product_id, qty_available, safety_stock,
           CASE WHEN qty_available <= 0 THEN 'OUT_OF_STOCK' WHEN qty_available <= safety_stock THEN 'LOW_STOCK'
                ELSE 'REORDER' END AS alert_type FROM raw_stock_events WHERE qty_available <= reorder_point""")
def _(spark, folder):
    return drain(live.inventory_alerts(raw_stream(spark, folder, "stock_events")), "t8")


@query("t9_summing_merge", _REVENUE)
def _(spark, folder):
    # Partial rows per payment method share the sort key, as after several flushes.
    orders = raw_view(spark, folder, "order_events")
    partial = live.valid_orders(orders).groupBy(
        F.window("event_time", "1 minute").alias("w"), "store_id", "channel", "payment_method").agg(
        F.count("*").alias("order_count"), F.sum("amount").alias("gross_revenue"),
        F.sum(F.col("amount") - F.col("discount")).alias("net_revenue"),
        F.avg("amount").cast("decimal(10,2)").alias("avg_order_value"))
    flat = partial.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w")
    merged = summing_read(flat, ["window_start", "window_end", "store_id", "channel"],
                          ["order_count", "gross_revenue", "net_revenue"],
                          {"avg_order_value": ("gross_revenue", "order_count")})
    return merged.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("gross_revenue", "net_revenue")})


@query("t10_replacing_merge", """
    SELECT session_id, event_time AS session_end, event_type FROM raw_clickstream_events
    QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY event_time DESC, event_type) = 1""")
def _(spark, folder):
    versions = raw_view(spark, folder, "clickstream_events").select(
        "session_id", F.col("event_time").alias("session_end"), "event_type")
    return replacing_read(versions, ["session_id"], "session_end", ["event_type"])


@query("t11_ttl_retention", """
    SELECT * FROM raw_order_events WHERE event_time + INTERVAL 7 DAY > TIMESTAMP '2024-01-31'""")
def _(spark, folder):
    return retain(raw_view(spark, folder, "order_events"), "event_time", 7, F.lit(dt.datetime(2024, 1, 31)))


@query("t11_retention_on_storage", " UNION ALL ".join(f"""
    SELECT {keep} AS keep_days, order_id, event_time FROM raw_order_events
    WHERE CAST(event_time AS DATE) >= DATE '2024-01-31' - {keep}""" for keep in (7, 30, 90)))
def _(spark, folder):
    """Stored days expire by the log; the files of days that stay are not touched."""
    events = raw_view(spark, folder, "order_events").select("order_id", "event_time", F.to_date("event_time").alias("day"))
    kept = []
    for keep in (7, 30, 90):
        store = TableStore(spark, workspace(spark, "expiring"))
        store.put("events", events, "day")
        store.retain("events", dt.date(2024, 1, 31) - dt.timedelta(days=keep))
        kept.append(store.read("events").select(F.lit(keep).alias("keep_days"), "order_id", "event_time"))
    return union_all(*kept)


@query("t13_late_rows_kept", f"SELECT * FROM ({_REVENUE})")
def _(spark, folder):
    """The first half of the month arrives behind the watermark; the daily correction brings it back in."""
    root = workspace(spark, "late")
    middle = F.lit("2024-01-16").cast("timestamp")
    store, events = TableStore(spark, f"{root}/store"), raw_view(spark, folder, "order_events")
    for number, half in enumerate((F.col("event_time") >= middle, F.col("event_time") < middle)):
        tables.write_records(events.where(half), root, "events", f"drop{number}", "parquet")
        stream = spark.readStream.schema(schemas.ORDER_EVENTS).option("recursiveFileLookup", True).parquet(f"{root}/events")
        dated = stream.withColumn("day", F.to_date("event_time"))
        feeds.with_late_rows_aside(dated, store, "orders", f"{root}/checkpoint", "event_time", live.ORDER_DELAY, "day").awaitTermination()
    feeds.take_late_rows(store, "orders", "day")
    return live.revenue_realtime(store.read("orders").drop("day"))


def _two_runs(spark, folder, label, first, second):
    """Run the revenue stream on one drop, stop, and resume it on a second one."""
    root = workspace(spark, label)
    events = raw_view(spark, folder, "order_events")
    for number, keep in enumerate((first, second)):
        tables.write_records(events.where(keep), root, "events", f"drop{number}", "parquet")
        stream = spark.readStream.schema(schemas.ORDER_EVENTS).option("recursiveFileLookup", True).parquet(f"{root}/events")
        start(live.revenue_realtime(stream), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("t12_checkpoint_resume", f"SELECT * FROM ({_REVENUE}) WHERE window_end <= {_closed('raw_order_events', _VALID, 5)}")
def _(spark, folder):
    middle = F.lit("2024-01-16 12:00:30").cast("timestamp")
    return _two_runs(spark, folder, "t12", F.col("event_time") < middle, F.col("event_time") >= middle)


@query("t12_restart_and_savepoint", f"""
    SELECT *, CAST(round(gross_revenue - net_revenue, 2) AS DOUBLE) AS discounts FROM ({_REVENUE})
    WHERE window_end <= {_closed('raw_order_events', _VALID, 5)}""")
def _(spark, folder):
    """Fails twice and is restarted; a changed query then goes on from a copy of the state, on the second half of the month."""
    root, middle = workspace(spark, "upgraded"), F.lit("2024-01-16 12:00:30").cast("timestamp")
    store, events = TableStore(spark, f"{root}/store"), raw_view(spark, folder, "order_events")
    failures = iter(("in its first run", "in its second run"))

    def arriving(drop, rows):
        tables.write_records(events.where(rows), root, "events", drop, "parquet")
        return spark.readStream.schema(schemas.ORDER_EVENTS).option("recursiveFileLookup", True).parquet(f"{root}/events")

    def first(work, rows):
        work.append("revenue", rows)
        if reason := next(failures, None):
            raise RuntimeError(f"the query dies {reason}")

    def second(work, rows):  # the changed query: another table, with a new column
        work.append("revenue_2", rows.withColumn("discounts", F.round(F.col("gross_revenue") - F.col("net_revenue"), 2).cast("double")))

    stream = arriving("drop0", F.col("event_time") < middle)
    run_with_restarts(lambda: feeds.each_batch(live.revenue_realtime(stream), store, f"{root}/checkpoint", first), delay=0.1)
    savepoint(spark, f"{root}/checkpoint", f"{root}/savepoint")
    stream = arriving("drop1", F.col("event_time") >= middle)
    feeds.each_batch(live.revenue_realtime(stream), store, f"{root}/savepoint", second).awaitTermination()
    before = store.read("revenue").withColumn("discounts", F.round(F.col("gross_revenue") - F.col("net_revenue"), 2).cast("double"))
    return union_all(before, store.read("revenue_2"))


@query("t13_late_data", f"""
    SELECT * FROM ({_REVENUE}) WHERE window_start >= TIMESTAMP '2024-01-16'
    AND window_end <= {_closed('raw_order_events', _VALID, 5)}""")
def _(spark, folder):
    # The first half of the month arrives after the second half has been processed.
    middle = F.lit("2024-01-16").cast("timestamp")
    return _two_runs(spark, folder, "t13", F.col("event_time") >= middle, F.col("event_time") < middle)

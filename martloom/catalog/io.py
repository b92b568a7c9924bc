"""S rows: sources, sinks and ingest. Drops and tables are written to the shared
scratch folder from the sample tables and read back with the library's readers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom import schemas
from martloom.catalog.registry import query
from martloom.operators.shaping import union_all
from martloom.session import remove_path, scratch_removed, side_by_side, workspace, write_once
from martloom.sources import landing, messages, tables
from martloom.sources.sample import inputs_of, raw_view, table
from martloom.sources.store import TableStore
from martloom.streaming import feeds

DAY = "2024-01-01"
MID = "2024-01-16"


def _dropped(spark, folder, entity, root, date=DAY, rows=None):
    """Write an entity as one landing drop, compressed: as text it is many times its tables."""
    source, fmt = schemas.LANDING[entity]
    df = raw_view(spark, folder, entity) if rows is None else rows
    tables.write_records(df.select(*schemas.RAW[entity].names), root, source, date, fmt, packed=True)
    return source


@query("s1_read_csv_landing", "SELECT * FROM raw_pos_transactions")
def _(spark, folder):
    root = workspace(spark, "landing")
    source = _dropped(spark, folder, "pos_transactions", root)
    rows = landing.read_csv_landing(spark, root, source, DAY, schemas.POS_TRANSACTIONS)
    return rows.where("_corrupt_record IS NULL").drop("_corrupt_record")


@query("s2_read_json_landing", """
    SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM raw_clickstream_events
    UNION ALL BY NAME SELECT '{"event_id": "cut off ' || nation.n_nationkey AS _corrupt_record FROM nation""")
def _(spark, folder):
    """One drop of whole lines and, for every nation, a line that breaks off."""
    root = workspace(spark, "landing")
    source = _dropped(spark, folder, "clickstream_events", root)
    bad = table(spark, folder, "nation").select(F.concat(F.lit('{"event_id": "cut off '), F.col("n_nationkey").cast("string")).alias("value"))
    bad.write.mode("append").option("header", False).format("text").save(f"{root}/{source}/{DAY}/bad.json")
    whole = landing.read_json_landing(spark, root, source, DAY, schemas.CLICKSTREAM_EVENTS)
    return whole


@query("s3_read_payment_gateways", """
    SELECT 'vnpay' AS gateway, vnp_txn_ref AS id, vnp_amount AS amount, vnp_pay_date AS paid_at FROM raw_payments_vnpay
    UNION ALL SELECT 'momo', trans_id, amount, response_time FROM raw_payments_momo
    UNION ALL SELECT 'card', transaction_id, gross_amount, settled_at FROM raw_payments_card""")
def _(spark, folder):
    root = workspace(spark, "landing")
    for gateway in landing.GATEWAYS:
        _dropped(spark, folder, f"payments_{gateway}", root)
    shapes = {"vnpay": ("vnp_txn_ref", "vnp_amount", "vnp_pay_date"), "momo": ("trans_id", "amount", "response_time"),
              "card": ("transaction_id", "gross_amount", "settled_at")}
    frames = landing.read_payments(spark, root, DAY)
    return union_all(*[
        frames[g].select(F.lit(g).alias("gateway"), F.col(i).alias("id"), F.col(a).alias("amount"), F.col(t).alias("paid_at"))
        for g, (i, a, t) in shapes.items()])


def _dated_events(spark, folder):
    return raw_view(spark, folder, "order_events").withColumn("dt", F.to_date("event_time"))


@query("s4_read_parquet_partition", """
    SELECT *, CAST(event_time AS DATE) AS dt FROM raw_order_events WHERE CAST(event_time AS DATE) = DATE '2024-01-10'""")
def _(spark, folder):
    root = workspace(spark, "raw")
    tables.append_table(_dated_events(spark, folder), f"{root}/order_events", ["dt"])
    return landing.read_partition(spark, root, "order_events", "2024-01-10")


@query("s5_read_updated_day", """
    SELECT * FROM raw_ecom_orders WHERE updated_at >= TIMESTAMP '1998-03-02' AND updated_at < TIMESTAMP '1998-03-03'""")
def _(spark, folder):
    path = workspace(spark, "operational")
    tables.append_table(raw_view(spark, folder, "ecom_orders"), path)
    return landing.read_updated_day(spark, {"path": path}, dt.date(1998, 3, 2), fmt="parquet")


@query("s6_append_partitioned", "SELECT *, CAST(event_time AS DATE) AS dt FROM raw_order_events")
def _(spark, folder):
    path = workspace(spark, "raw")
    events = _dated_events(spark, folder)
    for part in (events.where(F.col("dt") < MID), events.where(F.col("dt") >= MID)):
        tables.append_table(part, path, ["dt"])
    return spark.read.parquet(path)


@query("s7_overwrite_day", """
    SELECT * EXCLUDE (amount), CASE WHEN event_time >= TIMESTAMP '2024-01-16' THEN amount + 1 ELSE amount END
           ::DECIMAL(18,2) AS amount, CAST(event_time AS DATE) AS dt FROM raw_order_events""")
def _(spark, folder):
    path = workspace(spark, "raw")
    events = _dated_events(spark, folder)
    tables.append_table(events, path, ["dt"])
    corrected = events.where(F.col("dt") >= MID).withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
    for _attempt in range(2):
        tables.overwrite_partitions(corrected, path, ["dt"])
    return spark.read.parquet(path)


@query("s8_replace_table", """
    SELECT *, CAST(event_time AS DATE) AS _partition_date FROM raw_order_events WHERE event_time >= TIMESTAMP '2024-01-16'""")
def _(spark, folder):
    path = workspace(spark, "staging")
    events = raw_view(spark, folder, "order_events").withColumn("_partition_date", F.to_date("event_time"))
    tables.replace_table(events, path, ["_partition_date"])
    tables.replace_table(events.where(F.col("_partition_date") >= MID), path, ["_partition_date"])
    return spark.read.parquet(path)


@query("s9_ingest_audit_columns", """
    SELECT order_id, true AS stamped, '2024-01-01' AS _partition_date FROM raw_order_events""")
def _(spark, folder):
    return tables.with_audit(raw_view(spark, folder, "order_events"), DAY).select(
        "order_id", F.col("_ingested_at").isNotNull().alias("stamped"), "_partition_date")


def _landed(entity: str, source: str) -> str:
    key = schemas.RAW[entity].names[0]
    days = f"(VALUES (DATE '{DAY}'), (DATE '2024-01-02'), (NULL)) AS days(landing_date)"
    return f"SELECT '{source}' AS source, landing_date, CAST({key} AS VARCHAR) AS record FROM raw_{entity}, {days}"


@query("s10_ingest_new_files", " UNION ALL ".join(_landed(e, s) for e, (s, _f) in schemas.LANDING.items()))
def _(spark, folder):
    root, lake = workspace(spark, "landing"), workspace(spark, "raw")
    dates = (DAY, "2024-01-02", "no-date")
    with scratch_removed(spark):
        # A join is done once for the three drops.
        joined = {entity: write_once(raw_view(spark, folder, entity).select(*schemas.RAW[entity].names), entity)
                  for entity in schemas.LANDING if len(inputs_of(entity)) > 1}

        def taken(entity, date):
            source, fmt = schemas.LANDING[entity]
            _dropped(spark, folder, entity, root, date, joined.get(entity))
            return landing.ingest_new_files(
                spark, root, source, schemas.RAW[entity], fmt, f"{lake}/_checkpoints/{entity}", f"{lake}/{entity}")

        for turn, date in enumerate(dates):  # each round must take only the new drop
            for run in side_by_side(*[lambda entity=entity, date=date: taken(entity, date) for entity in schemas.LANDING]):
                run.awaitTermination()
            if turn:  # the drop before last round's has been passed over as well
                for source, _fmt in schemas.LANDING.values():
                    remove_path(spark, f"{root}/{source}/{dates[turn - 1]}")
    return union_all(*[
        spark.read.parquet(f"{lake}/{entity}").select(F.lit(source).alias("source"), "landing_date", F.col(schemas.RAW[entity].names[0]).cast("string").alias("record"))
        for entity, (source, _fmt) in schemas.LANDING.items()])


_CUT = "CAST(right(order_id, 3) AS INTEGER) % 40 = 7"


@query("s10_ingest_dead_letters", f"""
    SELECT order_id, landing_date, CASE WHEN {_CUT} THEN 'dead' ELSE 'good' END AS fate
    FROM raw_order_events, (VALUES (DATE '{DAY}'), (DATE '2024-01-02')) AS days(landing_date)""")
def _(spark, folder):
    """Every fortieth line is cut off; none is lost, and running the ingest again adds none."""
    root = workspace(spark, "lines")
    lines = raw_view(spark, folder, "order_events").select("order_id", F.to_json(F.struct(*schemas.ORDER_EVENTS.names)).alias("value"))
    cut = lines.select(F.when(F.expr(_CUT), F.substring("value", 1, 40)).otherwise(F.col("value")).alias("value"))
    store = TableStore(spark, f"{root}/store")
    for day in (DAY, "2024-01-02", None):
        if day:
            cut.write.text(f"{root}/landing/orders/{day}")
        feeds.ingest_lines(spark, f"{root}/landing", "orders", schemas.ORDER_EVENTS, "json", store, f"{root}/checkpoint").awaitTermination()
    dead = store.read(feeds.DEAD).select(F.regexp_extract("line", r'"order_id":"([^"]*)"', 1).alias("order_id"), "landing_date", F.lit("dead").alias("fate"))
    return store.read("orders").select("order_id", "landing_date", F.lit("good").alias("fate")).unionByName(dead)


@query("s11_write_records", """
    SELECT *, 'json' AS fmt FROM raw_order_events UNION ALL SELECT *, 'parquet' FROM raw_order_events""")
def _(spark, folder):
    root = workspace(spark, "records")
    events = raw_view(spark, folder, "order_events")
    frames = []
    for fmt in ("json", "parquet"):
        path = tables.write_records(events, root, f"orders_{fmt}", DAY, fmt)
        frames.append(spark.read.schema(schemas.ORDER_EVENTS).format(fmt).load(path).withColumn("fmt", F.lit(fmt)))
    return union_all(*frames)


# How each kind of value stands in a message.
_JSON_TEXT = {"string": "'\"' || {0} || '\"'", "decimal": "CAST({0} AS VARCHAR)",
              "timestamp": "'\"' || strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z\"'"}


def _json_field(name: str, kind: str) -> str:
    return f"""'"{name}":', coalesce({_JSON_TEXT[kind].format(name)}, 'null')"""


@query("s12_kafka_encode", "SELECT order_id AS \"key\", concat('{', " + ", ',', ".join(
    _json_field(f.name, f.dataType.typeName()) for f in schemas.ORDER_EVENTS) + ", '}') AS value FROM raw_order_events")
def _(spark, folder):
    return messages.kafka_encode(raw_view(spark, folder, "order_events").select(*schemas.ORDER_EVENTS.names))


@query("s13_kafka_decode", "SELECT * FROM raw_order_events")
def _(spark, folder):
    encoded = messages.kafka_encode(raw_view(spark, folder, "order_events"))
    return messages.kafka_decode(encoded, schemas.ORDER_EVENTS)


@query("s14_insert_if_absent", "SELECT c_custkey AS customer FROM customer UNION SELECT o_custkey FROM orders")
def _(spark, folder):
    path = workspace(spark, "customers")
    buyers = table(spark, folder, "orders").select(F.col("o_custkey").alias("customer")).distinct()
    tables.append_table(buyers, path)
    everyone = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer"))
    for _attempt in range(2):
        tables.insert_if_absent(path, everyone, "customer")
    return spark.read.parquet(path)


@query("s15_read_seed", "SELECT * FROM raw_stores")
def _(spark, folder):
    root = workspace(spark, "seeds")
    path = tables.write_records(raw_view(spark, folder, "stores"), root, "stores", DAY, "csv")
    return landing.read_seed(spark, path, schemas.STORES)


@query("s16_ingest_counts", " UNION ALL ".join(
    f"SELECT '{schemas.LANDING[e][0]}' AS source, CAST({ts} AS DATE) AS day, count(*) AS row_count FROM raw_{e} GROUP BY 2"
    for e, ts in schemas.EVENT_TIMES.items()))
def _(spark, folder):
    return tables.ingest_counts({schemas.LANDING[e][0]: (raw_view(spark, folder, e), F.col(ts)) for e, ts in schemas.EVENT_TIMES.items()})


@query("s17_backfill_range", """
    SELECT CAST(event_time AS DATE) AS dt, store_id, count(*) AS orders,
           CASE WHEN CAST(event_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
                THEN CAST(sum(amount) AS DECIMAL(28,2)) ELSE CAST(0 AS DECIMAL(28,2)) END AS amount
    FROM raw_order_events GROUP BY 1, 2""")
def _(spark, folder):
    path = workspace(spark, "daily")
    events = _dated_events(spark, folder)

    def daily(rows):
        return rows.groupBy("dt", "store_id").agg(F.count("*").alias("orders"), F.sum("amount").alias("amount"))

    # The table starts out with wrong amounts everywhere; the backfill corrects its range.
    wrong = daily(events).withColumn("amount", F.lit(0).cast("decimal(28,2)"))
    tables.append_table(wrong, path, ["dt"])
    tables.backfill(events, daily, path, "event_time", dt.date(2024, 1, 5), dt.date(2024, 1, 20), "dt")
    return spark.read.parquet(path)

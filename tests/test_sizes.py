"""What is written and shuffled: packed drops, one shuffle per group, late dimensions."""

from __future__ import annotations

import datetime as dt
import gzip
import os
import re
import zlib

from pyspark.sql import functions as F

from martloom import schemas
from martloom.functions.columns import packed_key
from martloom.operators import joins
from martloom.operators.quality import Check, run_checks
from martloom.plans import intermediate, marts, staging
from martloom.session import configure, own_session, workspace
from martloom.sources import landing, tables
from martloom.sources.sample import raw_stream
from martloom.streaming import sinks
from tests.conftest import plan_of

ORDERS = ("order_id string, channel string, store_id string, customer_uid string, total_amount_vnd bigint, discount_amount_vnd bigint, "
          "tax_amount_vnd bigint, num_items int, order_date date, status string")


def _orders(spark):
    day, uid = dt.date(2024, 1, 1), "0123456789abcdef" * 2
    return spark.createDataFrame([
        ("1", "pos", "A", uid, 10, 1, 1, 1, day, "completed"), ("2", "pos", "A", uid, 20, 1, 1, 1, day, "completed"),
        ("3", "pos", "A", None, 30, 1, 1, 1, day, "completed"), ("4", "pos", "A", uid.upper(), None, 1, 1, 1, day, "completed"),
        ("5", "ecommerce", None, uid, 40, 0, 0, 2, None, "delivered"), ("6", "ecommerce", None, uid, 50, 0, 0, 2, day, "cancelled")], ORDERS)


def _moved(df) -> str:
    """Columns of all shuffles."""
    return " ".join(re.findall(r"\(\d+\) Exchange[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", plan_of(df)))


def _shuffles(df) -> int:
    return plan_of(df).split("\n\n")[0].count("Exchange")


def test_packed_drops_are_compressed_bounded_and_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PACKED_ROWS", 2)
    rows = spark.createDataFrame([(i, "view", i) for i in range(5)], schemas.CLIENT_PAYLOAD).coalesce(1)
    for fmt, read in (("json", landing.read_json_landing), ("csv", landing.read_csv_landing)):
        path = tables.write_records(rows, str(tmp_path), fmt, "2024-01-01", fmt, packed=True)
        files = [f for f in os.listdir(path) if f.startswith("part-")]
        assert len(files) == 3 and all(f.endswith(f".{fmt}.gz") for f in files)
        tables.write_records(rows, str(tmp_path), fmt, "2024-01-01", fmt)  # plain files beside them are read too
        assert sorted(r["event_id"] for r in read(spark, str(tmp_path), fmt, "2024-01-01", schemas.CLIENT_PAYLOAD).collect()) == sorted([*range(5)] * 2)


def test_packed_drops_take_the_fast_level(spark, tmp_path):
    rows = spark.range(20000).select(F.col("id").alias("event_id"), F.lit("view").alias("event_type"), (F.col("id") * 7919 % 1000).alias("user_id"))
    path = tables.write_records(rows.coalesce(1), str(tmp_path), "json", "2024-01-01", "json", packed=True)
    (name,) = [f for f in os.listdir(path) if f.startswith("part-")]
    with open(f"{path}/{name}", "rb") as file:
        packed = file.read()
    assert len(packed) > 1.1 * len(zlib.compress(gzip.decompress(packed), 6))


def test_new_files_of_many_days_are_ingested_without_a_sort_by_day(spark, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    own = own_session(spark, landing.OPEN_DAYS)
    assert int(own.conf.get(key)) > 0 and own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "none"]  # more than are open at once
    for n, day in enumerate(days):
        rows = spark.createDataFrame([(10 * n + i, "view", i) for i in range(5)], schemas.CLIENT_PAYLOAD)
        tables.write_records(rows.coalesce(1), f"{tmp_path}/in", "clicks", day, "json", packed=True)
    ingest = landing.ingest_new_files(spark, f"{tmp_path}/in", "clicks", schemas.CLIENT_PAYLOAD, "json", f"{tmp_path}/c", f"{tmp_path}/out")
    ingest.awaitTermination()
    assert spark.conf.get(key) == before
    sink = ingest._jsq.streamingQuery() if hasattr(ingest._jsq, "streamingQuery") else ingest._jsq
    assert sink.sparkSession().sessionState().conf().maxConcurrentOutputFileWriters() > 0
    got = {(r.event_id, r.landing_date and r.landing_date.isoformat()) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(10 * n + i, day if n < 3 else None) for n, day in enumerate(days) for i in range(5)}


def test_daily_revenue_needs_one_shuffle(spark):
    daily = marts.fct_revenue_daily(_orders(spark))
    assert _shuffles(daily) == 1
    got = {(r["date_key"], r["store_id"], r["channel"]): (r["total_orders"], r["unique_customers"], r["total_revenue_vnd"]) for r in daily.collect()}
    assert got == {(dt.date(2024, 1, 1), "A", "pos"): (4, 2, 60), (None, None, "ecommerce"): (1, 1, 40)}


def test_packed_keys_stay_apart(spark):
    md5 = "00" * 15 + "6a"
    texts = [md5, md5.upper(), "\0" * 15 + "j", "a", "", "a\0", "zz" * 16, None]
    df = spark.createDataFrame([(t,) for t in texts], "k string").select(packed_key("k").alias("p"))
    packed = [r["p"] for r in df.collect()]
    assert len(set(map(bytes, packed[:-1]))) == len(texts) - 1 and packed[-1] is None and len(packed[0]) == 16


def test_customer_metrics_need_one_shuffle_and_equal_those_by_day(spark):
    orders, as_of = _orders(spark), F.lit(dt.date(2024, 2, 1))
    got = intermediate.int_customer_metrics(orders, as_of)
    assert _shuffles(got) == 1
    by_day = intermediate.customer_metrics(intermediate.customer_days(orders), as_of)
    assert got.schema == by_day.schema and sorted(got.collect(), key=str) == sorted(by_day.collect(), key=str)


def test_the_day_of_a_sale_is_not_shuffled_and_texts_keep_theirs(spark):
    raw = spark.createDataFrame([], schemas.POS_TRANSACTIONS)
    moved = _moved(staging.stg_pos_transactions(raw))
    assert "txn_timestamp" in moved and "txn_date" not in moved
    text = spark.createDataFrame([("1", 5, "2024-01-02 99:00")], "txn_id string, total_amount bigint, txn_timestamp string")
    others = [f for f in schemas.POS_TRANSACTIONS if f.name not in text.columns]
    (row,) = staging.stg_pos_transactions(text.withColumns({f.name: F.lit(None).cast(f.dataType) for f in others})).collect()
    assert row["txn_timestamp"] is None and row["txn_date"] == dt.date(2024, 1, 2)


def test_ratios_follow_the_ranks(spark):
    stores = spark.createDataFrame([("A", "a", "North", "n", "c", "big", 2, 10)], "store_id string, store_name string, region string, region_vi string, "
                                   "city string, store_size string, staff_count int, sqm int")
    scored = marts.fct_store_performance(marts.fct_revenue_daily(_orders(spark)), stores)
    assert scored.columns[-5:] == [*marts.RATIOS, *marts.RANKS] and "sqm" not in scored.columns
    (row,) = scored.collect()
    assert (row["revenue_per_staff_vnd"], row["revenue_per_sqm_vnd"], row["rank_overall"]) == (30.0, 6.0, 1)
    moved = _moved(scored)
    assert "region_vi" in moved and not any(ratio in moved for ratio in marts.RATIOS)


def test_a_lookup_moves_neither_the_key_nor_what_scatters_it(spark):
    left = spark.range(10).selectExpr("cast(id AS string) AS wide", "cast(id % 3 AS string) AS k", "id AS v")
    right = spark.range(3).selectExpr("cast(id AS string) AS r", "id AS w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.left_lookup(left, right, "k", "r", "wide").select("v", "w")
        moved = _moved(joined)
        assert "_left_key" in moved and "wide" not in moved
        assert sorted(map(tuple, joined.collect())) == [(i, i % 3) for i in range(10)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_dimension_may_be_named_before_it_stands(spark):
    held = {}
    check = Check.relationship("k", lambda: held["dim"], "id")
    held["dim"] = spark.range(2)
    (row,) = run_checks(spark.range(3).toDF("k"), [check]).collect()
    assert (row["measured"], row["status"]) == (1.0, "fail")


def test_monthly_revenue_over_daily_needs_two_shuffles(spark):
    orders = _orders(spark)
    assert _shuffles(marts.monthly_sums(marts.fct_revenue_daily(orders))) == 2
    got = marts.fct_revenue_monthly(marts.fct_revenue_daily(orders), orders).collect()
    assert {(r["month_key"], r["monthly_distinct_customers"]) for r in got} == {(dt.date(2024, 1, 1), 2), (None, None)}


def test_state_is_not_counted_at_every_write(spark, small):
    """A stream over stored rows keeps them in state without the lookups that counting takes: the store reports no total."""
    seen = raw_stream(spark, small, "order_events").select("order_id", "event_time").withWatermark("event_time", "1 hour").dropDuplicates()
    stream = configure(spark) and seen.writeStream.format("noop").outputMode("append").option(
        "checkpointLocation", workspace(spark, "uncounted")).trigger(availableNow=True).start()
    stream.awaitTermination()
    states = [state for progress in stream.recentProgress for state in progress["stateOperators"]]
    assert sum(s["numRowsUpdated"] for s in states) > 0 and {s["numRowsTotal"] for s in states} == {0}


def test_a_drained_join_closes_its_stores_and_has_one_a_partition(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "workspace", lambda _spark, label: f"{tmp_path}/{label}")
    day = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("o1", day), ("o2", day), ("o3", dt.datetime(2024, 1, 9))], "order_id string, ordered_at timestamp").write.parquet(f"{tmp_path}/o")
    spark.createDataFrame([("p1", "o1", day + dt.timedelta(hours=1)), ("p2", "x", day), ("p3", None, dt.datetime(2024, 1, 9))],
                          "payment_id string, order_ref string, paid_at timestamp").write.parquet(f"{tmp_path}/p")
    configure(spark)
    kept = {key: spark.conf.get(key, None) for key in sinks.STATE_OF_ONE_RUN}
    orders, payments = (spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{t}").schema).parquet(f"{tmp_path}/{t}") for t in "op")
    got = sinks.drain(joins.match_settlements_stream(orders, payments, "12 hours"), "x")
    assert {(r.order_id, r.payment_id, r.match_status) for r in got.collect()} == {
        ("o1", "p1", "matched"), ("o2", None, "unpaid_order"), (None, "p2", "unmatched_payment")}
    stores = {os.path.relpath(folder, f"{tmp_path}/x/checkpoint/state") for folder, _, _ in os.walk(f"{tmp_path}/x/checkpoint/state")}
    assert any(re.match(r"\d+/\d+$", s) for s in stores) and not any("keyToNumValues" in s or "keyWithIndex" in s for s in stores)
    assert {key: spark.conf.get(key, None) for key in sinks.STATE_OF_ONE_RUN} == kept  # a stream that goes on keeps its stores loaded
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate") == "false"


def test_true_monthly_customers_take_one_pass_over_the_orders(spark):
    """Rows and columns of the rollup over the daily table, with one shuffle of orders; totals without a discount or a day included."""
    orders = _orders(spark).union(spark.createDataFrame([
        ("7", "pos", "B", "x", 7, None, 0, 1, dt.date(2024, 2, 1), "completed"), ("8", "pos", "B", None, 8, None, 0, 1, dt.date(2024, 2, 1), "completed"),
        ("9", "pos", "B", "x", 9, 2, 0, 1, dt.date(2024, 2, 2), "completed"), ("10", "pos", "B", None, 9, 2, 0, 1, dt.date(2024, 3, 2), "completed")], ORDERS))
    got, wanted = marts.fct_revenue_monthly_distinct(orders), marts.fct_revenue_monthly(marts.fct_revenue_daily(orders), orders)
    assert got.dtypes == wanted.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
    assert _shuffles(got) < _shuffles(wanted) and plan_of(got).split("\n\n")[0].count("Join") == 0

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

from martloom import schemas
from martloom.operators.sessions import sessions_by_gap
from martloom.sources import tables
from martloom.streaming import live, upgrade
from martloom.sources.sample import raw_stream, raw_view
from martloom.sources.store import TableStore
from martloom.streaming.feeds import each_batch
from martloom.streaming.sinks import drain, start, upsert
from martloom.streaming.upgrade import last_batch, run_with_restarts, savepoint, state_digest
from pyspark.sql import functions as F


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def orders(spark, *items):
    """(id, seconds, amount) as order events."""
    data = [(i, "c", "s", "pos", a, 0.5, "card", "completed", at(t)) for i, t, a in items]
    schema = ("order_id string, customer_id string, store_id string, channel string, amount double, discount double, "
              "payment_method string, status string, event_time timestamp")
    df = spark.createDataFrame(data, schema)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.ORDER_EVENTS.fields])


def run(spark, root, frame, transform, schema, out="out"):
    tables.write_records(frame, f"{root}", "in", "drop", "parquet")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/in")
    start(transform(stream), f"{root}/{out}", f"{root}/ckpt").awaitTermination()
    return spark.read.parquet(f"{root}/{out}")


def test_restart_continues_open_windows_without_loss_or_repeat(spark, tmp_path):
    first = orders(spark, ("a", 10, 1.0), ("b", 20, 2.0))
    run(spark, tmp_path, first, live.revenue_realtime, schemas.ORDER_EVENTS)
    got = run(spark, tmp_path, orders(spark, ("c", 30, 4.0), ("d", 200, 8.0)), live.revenue_realtime, schemas.ORDER_EVENTS)
    assert rows(got.select("order_count", F.col("gross_revenue").cast("double"))) == [(3, 7.0)]
    again = run(spark, tmp_path, orders(spark, ("e", 400, 1.0)), live.revenue_realtime, schemas.ORDER_EVENTS)
    assert rows(again.select("order_count")) == [(1,), (3,)]


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    run(spark, tmp_path, orders(spark, ("a", 10, 1.0), ("b", 500, 1.0)), live.revenue_realtime, schemas.ORDER_EVENTS)
    got = run(spark, tmp_path, orders(spark, ("late", 20, 99.0), ("c", 900, 1.0)), live.revenue_realtime, schemas.ORDER_EVENTS)
    assert "99" not in str(rows(got))
    assert got.agg(F.sum("order_count")).first()[0] == 2


def clicks(spark, *items):
    data = [(f"e{n}", s, u, kind, "/flash-sale", None, None, None, None, "mobile", "b", "o", "VN", "HN", 1, at(t))
            for n, (s, u, kind, t) in enumerate(items)]
    return spark.createDataFrame(data, schemas.CLICKSTREAM_EVENTS)


def test_session_gap_boundary(spark, tmp_path):
    events = clicks(spark, ("s", "u", "click", 0), ("s", None, "purchase", 1800), ("s", "v", "click", 3601), ("z", "u", "click", 99_999))
    got = run(spark, tmp_path, events, live.sessions, schemas.CLICKSTREAM_EVENTS)
    assert rows(got.select("session_start", "session_end", "clicks", "purchases", "user_id")) == [
        (at(0), at(1800), 1, 1, "u"), (at(3601), at(3601), 1, 0, "v")]
    counts = {name: F.col("event_type") == kind for name, kind in live.SESSION_COUNTS.items()}
    batch = sessions_by_gap(events, "session_id", "event_time", 30, counts, live.SESSION_LAST).where("session_id = 's'")
    columns = ["session_start", "session_end", *live.SESSION_COUNTS, *live.SESSION_LAST]
    assert rows(batch.select(*columns)) == rows(got.select(*columns))


def test_flash_sale_counts_distinct_visitors(spark, tmp_path):
    events = clicks(spark, ("s1", "u", "click", 1), ("s1", "u", "click", 2), ("s2", "u", "click", 3), ("s2", None, "click", 4),
                    ("s3", "w", "view", 5), ("s9", "u", "click", 5000))
    got = run(spark, tmp_path, events, live.flash_sale, schemas.CLICKSTREAM_EVENTS)
    assert rows(got.select("event_type", "event_count", "unique_sessions", "unique_users")) == [("click", 4, 2, 1), ("view", 1, 1, 1)]
    batch = live.flash_sale(events).where(F.col("window_start") < at(60))
    assert rows(batch) == rows(got.select(*batch.columns))


def test_sliding_alerts_see_the_lowest_level(spark):
    stock = spark.createDataFrame([("s", "k", 30, 5, 10, at(0)), ("s", "k", 4, 5, 10, at(60)), ("s", "k", 30, 5, 10, at(600))],
                                  "store_id string, sku string, qty_available int, safety_stock int, reorder_point int, event_time timestamp")
    got = live.stock_sliding(stock)
    assert got.count() == 5
    assert rows(got.select("min_qty", "alert_type").distinct()) == [(4, "LOW_STOCK")]


def test_upsert_keeps_the_newest_version_per_key(spark, tmp_path):
    schema = "k string, v int, dt date"
    store, source = TableStore(spark, f"{tmp_path}/out"), f"{tmp_path}/in"
    day = dt.date(2024, 1, 1)
    for batch in ([("a", 1, day), ("a", 2, day), ("b", 5, day)], [("a", 3, dt.date(2024, 1, 2)), ("b", 4, day)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        upsert(stream, store, "t", f"{tmp_path}/ckpt", ["k"], "v", "dt", ["k"]).awaitTermination()
    assert rows(store.read("t").select("k", "v")) == [("a", 3), ("b", 5)]


def test_streams_read_folders_of_part_files(spark, small, tmp_path):
    folder = f"{tmp_path}/sf"
    for name in ("events", "orders"):
        spark.read.parquet(f"{small}/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
    spark.read.parquet(f"{small}/events.parquet").write.parquet(f"{folder}/events_other.parquet")
    for view in ("order_events", "clickstream_events"):
        streamed = drain(raw_stream(spark, folder, view), "folders")
        assert streamed.count() == raw_view(spark, folder, view).count() == raw_view(spark, small, view).count() > 0


class _Ending:
    """A query that ends as told: with an error, or well."""

    def __init__(self, error):
        self.error = error

    def awaitTermination(self):
        if self.error:
            raise self.error


def test_restarts_wait_and_give_up_after_the_last_attempt():
    def starter(failures):
        left = iter([StreamingQueryException(str(i)) for i in range(failures)])
        return lambda: _Ending(next(left, None))

    for failures in range(4):
        waits = []
        assert run_with_restarts(starter(failures), 3, 7.5, waits.append) == failures
        assert waits == [7.5] * failures
    with pytest.raises(StreamingQueryException, match="3"):
        run_with_restarts(starter(4), 3, 0, lambda _: None)
    with pytest.raises(ValueError):  # no failure of the stream: nothing to try again
        run_with_restarts(lambda: _Ending(ValueError()), 3, 0, lambda _: None)


def test_savepoint_goes_on_where_the_original_stands(spark, tmp_path):
    def events(first, last):
        return clicks(spark, *[(f"s{i % 5}", "u", "click", i) for i in range(first, last)])

    source = f"{tmp_path}/in"
    events(0, 300).write.parquet(source)
    stream = live.flash_sale(spark.readStream.schema(schemas.CLICKSTREAM_EVENTS).parquet(source))
    with pytest.raises(ValueError):
        savepoint(spark, f"{tmp_path}/ckpt", f"{tmp_path}/none")
    start(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt").awaitTermination()
    batch = savepoint(spark, f"{tmp_path}/ckpt", f"{tmp_path}/copy")
    assert batch == last_batch(spark, f"{tmp_path}/copy") >= 0
    digest = rows(state_digest(spark, f"{tmp_path}/copy", batch))
    assert len(digest) == 2 and sum(n for _, _, n, _ in digest) > 0  # the first aggregate may have handed all its rows on
    with pytest.raises(ValueError, match="exists"):
        savepoint(spark, f"{tmp_path}/ckpt", f"{tmp_path}/copy")

    events(300, 900).write.mode("append").parquet(source)
    store = TableStore(spark, f"{tmp_path}/store")
    for checkpoint in ("ckpt", "copy"):
        each_batch(stream, store, f"{tmp_path}/{checkpoint}", lambda work, new, table=checkpoint: work.append(table, new) and None).awaitTermination()
    assert rows(store.read("ckpt")) == rows(store.read("copy")) != []


def test_a_damaged_copy_is_refused(spark, tmp_path, monkeypatch):
    source = f"{tmp_path}/in"
    clicks(spark, ("s", "u", "click", 0)).write.parquet(source)
    stream = spark.readStream.schema(schemas.CLICKSTREAM_EVENTS).parquet(source)
    start(live.sessions(stream), f"{tmp_path}/out", f"{tmp_path}/ckpt").awaitTermination()
    monkeypatch.setattr(upgrade, "_copied", lambda *_: lambda rows: None)
    with pytest.raises(RuntimeError, match="files differ|state differs"):
        savepoint(spark, f"{tmp_path}/ckpt", f"{tmp_path}/copy")

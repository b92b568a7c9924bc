import datetime as dt
import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from martloom import schemas
from martloom.operators.changes import views_by_group
from martloom.operators.quality import Check, observed, observed_report, run_checks
from martloom.plans import daily
from martloom.plans.daily import load_until
from martloom.plans.lake import SAMPLE_AS_OF, Lake
from martloom.session import configure, scratch_removed, side_by_side, write_once
from martloom.sources import store as store_module
from martloom.sources.sample import raw_view
from martloom.sources.store import TableStore, Transaction, among
from martloom.streaming import feeds
from tests.conftest import plan_of

ROWS = "id int, v int, part string"


class Killed(RuntimeError):
    pass


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, *values, schema=ROWS):
    return spark.createDataFrame(list(values), schema)


def dying(df):
    """The same rows, whose job fails in its last task after others may have written."""
    return df.repartition(4, "id").withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("v")))


def test_a_merge_moves_rows_and_keeps_odd_partitions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.put("t", frame(spark, (1, 1, None), (2, 1, None), (3, 1, "2000"), (5, 1, "a:b/c")), "part")
    updates = frame(spark, (4, 1, None), (5, 2, "z"), (3, 2, None))
    for _ in range(2):
        store.merge("t", updates, ["id"], "v", "part", ["id"])
    assert rows(store.read("t")) == rows(frame(spark, (1, 1, None), (2, 1, None), (3, 2, None), (4, 1, None), (5, 2, "z")))
    assert rows(store.read("t", 1)) == rows(frame(spark, (1, 1, None), (2, 1, None), (3, 1, "2000"), (5, 1, "a:b/c")))


def test_readers_see_the_old_or_the_new_table_wherever_a_merge_dies(spark, tmp_path, monkeypatch):
    before = frame(spark, (1, 1, "p"), (2, 1, "q"), (3, 1, "q"))
    updates = frame(spark, (2, 2, "p"), (4, 1, "r"))
    after = rows(frame(spark, (1, 1, "p"), (2, 2, "p"), (3, 1, "q"), (4, 1, "r")))
    for place in ("in the data", "before the commit", "in the commit", "after the commit"):
        store = TableStore(spark, f"{tmp_path}/{place.replace(' ', '-')}")
        store.put("t", before, "part")
        with monkeypatch.context() as patch:
            if place == "before the commit":
                patch.setattr(Transaction, "commit", lambda *_a, **_k: (_ for _ in ()).throw(Killed()))
            if place == "in the commit":
                patch.setattr(store_module, "LOG", "version int")  # the line does not fit: its write fails
            if place == "after the commit":
                done = Transaction.commit
                patch.setattr(Transaction, "commit", lambda *a, **k: (done(*a, **k), (_ for _ in ()).throw(Killed())))
            with pytest.raises(Exception):  # noqa: B017  whatever ends the writer
                store.merge("t", dying(updates) if place == "in the data" else updates, ["id"], "v", "part", ["id"], "w", 1)
        assert rows(store.read("t")) == (after if place == "after the commit" else rows(before))
        for _ in range(2):
            store.merge("t", updates, ["id"], "v", "part", ["id"], "w", 1)
        assert rows(store.read("t")) == after


def test_several_tables_show_in_one_commit(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    work = store.begin()
    work.replace("a", frame(spark, (1, 1, "x")))
    work.append("b", frame(spark, (2, 2, "x")), "part")
    assert rows(work.read("a")) == [(1, 1, "x")] and not store.exists("a")
    work.commit({"mark": "7"})
    assert rows(store.read("b")) == [(2, 2, "x")] and store.contents().marks == {"mark": "7"}
    late = store.begin()
    store.put("a", frame(spark, (9, 9, "y")))
    late.replace("a", frame(spark, (8, 8, "y")))
    with pytest.raises(RuntimeError):
        late.commit()
    assert rows(store.read("a")) == [(9, 9, "y")] and rows(store.read("a", 1)) == [(1, 1, "x")]
    assert len(store.unused()) == 1 and store.history().count() == 2


def test_empty_tables_and_emptied_partitions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.put("t", frame(spark), "part")
    assert store.read("t").collect() == [] and store.partitions("t") == set()
    store.merge("t", frame(spark, (1, 1, "p")), ["id"], "v", "part", ["id"])
    store.merge("t", frame(spark, (1, 2, "q")), ["id"], "v", "part", ["id"])
    assert store.partitions("t") == {"q"}


def test_a_read_opens_only_the_current_files_of_its_partitions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.put("t", frame(spark, (1, 1, "p"), (2, 1, "q"), (3, 1, "r")), "part")
    store.merge("t", frame(spark, (1, 2, "p")), ["id"], "v", "part", ["id"])
    one = store.read("t").where(among("part", ["q"]))
    assert "PartitionFilters" in plan_of(one)
    files = store.read("t").where(among("part", ["q"])).select(F.input_file_name().alias("f")).collect()
    assert len(files) == 1 and "part=q" in files[0].f
    assert not any("part=p" in f for f in store.unused())


def test_retention_touches_no_file(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    days = [(i, i, f"2024-01-{i:02d}") for i in range(1, 11)]
    store.put("t", frame(spark, *days, (99, 0, None)), "part")
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    store.retain("t", dt.date(2024, 1, 8))
    assert rows(store.read("t").select("id")) == rows(frame(spark, (8,), (9,), (10,), (99,), schema="id int"))
    assert {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")} == files
    for table, day in (("unknown", dt.date(2024, 1, 8)),):
        with pytest.raises(ValueError):
            store.retain(table, day)
    store.put("u", frame(spark, *days), "part")
    with pytest.raises(ValueError):
        store.retain("u", dt.date(2025, 1, 1))


def test_expiry_removes_what_no_kept_version_needs_and_nothing_else(spark, tmp_path):
    store = TableStore(spark, f"{tmp_path}/store")
    store.put("t", frame(spark, (1, 1, "p"), (2, 2, "q")), "part")
    store.merge("t", frame(spark, (1, 5, "p")), ["id"], "v", "part", ["v"])  # q stays where it is
    store.put("u", frame(spark, (1, 1, "p")))
    store.put("u", frame(spark, (1, 2, "p")))
    first = [f for f in store.unused() if "/u/" in f]
    assert store.expire(keep=2) == [] and store.expire() == first and len(first) == 1 and not os.path.exists(first[0])
    assert rows(store.read("t")) == [(1, 5, "p"), (2, 2, "q")] and rows(store.read("u")) == [(1, 2, "p")]
    store.put("t", frame(spark, (3, 3, "p")), "part")
    gone = store.expire()
    assert len([f for f in gone if "/t/" in f]) == 2 and not any(os.path.exists(f) for f in gone) and store.unused() == gone
    assert rows(store.read("t")) == [(3, 3, "p")]


def test_tables_written_on_the_way_go_with_their_load(spark):
    made = []
    with scratch_removed(spark):
        for df in side_by_side(*[lambda i=i: write_once(frame(spark, (i, i, "p")), "way") for i in range(2)]):
            made += [f.removeprefix("file://").removeprefix("file:") for f in df.inputFiles()]
        assert len(made) >= 2 and all(os.path.exists(f) and f.endswith(".zstd.parquet") for f in made)
    assert not any(os.path.exists(f) for f in made)
    kept = write_once(frame(spark, (1, 1, "p")), "kept")
    assert rows(kept) == [(1, 1, "p")]


def test_shuffle_files_go_when_their_query_ends(spark, tmp_path):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {x for x in blocks.getAllBlocks().mkString(" ").split(" ") if x.startswith("shuffle_")}
    before = held()
    configure(spark).range(1000).groupBy(F.col("id") % 7).count().write.parquet(f"{tmp_path}/t")
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert not held() - before


# --- the daily load

def small_sources(spark, folder, only=None):
    return {s: raw_view(spark, folder, s) if only is None or s in only else raw_view(spark, folder, s).limit(0) for s in daily.SOURCES}


def test_a_source_is_read_above_its_mark_only(spark, tmp_path):
    path = f"{tmp_path}/landing"
    spark.createDataFrame([(i, dt.date(2024, 1, i)) for i in range(1, 6)], "id int, landed date").write.partitionBy("landed").parquet(path)
    taken = daily.arrived(spark.read.parquet(path), "2024-01-02", dt.date(2024, 1, 4))
    assert rows(taken) == [(3,), (4,)]
    plan = plan_of(taken)
    assert "2024-01-04" in plan and "2024-01-02" in plan and "PartitionFilters: [isnotnull(landed" in plan
    assert rows(daily.arrived(spark.read.parquet(path), None, dt.date(2024, 1, 1))) == [(1,)]


def test_a_merge_into_every_partition_does_not_look_for_keys(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    store.put("t", frame(spark, (1, 1, "p"), (2, 1, "q"), (3, 1, None)), "part")
    looked = []
    values_of = store_module.values_of
    monkeypatch.setattr(store_module, "values_of", lambda df, column: looked.append(column) or values_of(df, column))
    store.merge("t", frame(spark, (1, 2, "q"), (4, 2, "p"), (5, 2, None)), ["id"], "v", "part", ["id"])
    assert len(looked) == 2  # of the updates, and of what was written
    assert rows(store.read("t")) == rows(frame(spark, (1, 2, "q"), (2, 1, "q"), (3, 1, None), (4, 2, "p"), (5, 2, None)))


def test_a_first_load_writes_its_staging_once_and_years_without_a_shuffle(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    nothing = spark.createDataFrame([], "id int, landed date")
    load = daily.Load(store, lambda source: nothing, None, dt.date(2024, 1, 1), SAMPLE_AS_OF, grain="year")
    monkeypatch.setattr(daily, "write_once", lambda *_: (_ for _ in ()).throw(Killed()))
    sales = spark.range(8, numPartitions=4).selectExpr("cast(id AS string) AS txn_id", "make_date(2024 + int(id % 2), 1, 1) AS txn_date")
    assert load.fold("stg_pos__transactions", sales, ["txn_id"], lambda rows: rows) == {"2024", "2025"}
    assert rows(load.read("stg_pos__transactions")) == rows(sales)
    assert len(list(tmp_path.rglob("*.parquet"))) == 8  # four tasks, two years; gathered, it would be one a year


def test_steps_run_side_by_side_in_order_and_fail_together():
    meet, ended = threading.Barrier(3, timeout=20), []
    assert side_by_side(*[lambda i=i: (meet.wait(), i)[1] for i in range(3)]) == [0, 1, 2]
    with pytest.raises(Killed):
        side_by_side(lambda: (_ for _ in ()).throw(Killed()), lambda: ended.append(1))
    assert ended == [1]


def test_late_corrections_reach_their_day_and_a_dead_load_changes_nothing(spark, small, tmp_path, monkeypatch):
    """A sale that comes late, one that is corrected, one that moves to another year, and a customer who registers after buying."""
    sources = small_sources(spark, small, {"pos_transactions", "ecom_orders", "ecom_customers", "loyalty_members"})
    some = sources["pos_transactions"].where("customer_phone IS NOT NULL").orderBy("txn_id").limit(300)
    sales = some.withColumn("n", F.pmod(F.xxhash64("txn_id"), F.lit(7)))
    corrected = sales.where("n = 1").withColumn("total_amount", F.col("total_amount") + 5000).withColumn(
        "txn_timestamp", F.col("txn_timestamp") + F.expr("INTERVAL 1 HOUR"))
    moved = sales.where("n = 2").withColumn("txn_timestamp", F.col("txn_timestamp") + F.expr("INTERVAL 400 DAYS"))
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    landed = lambda df, day: df.withColumn("landed", F.lit(day))
    pos = landed(sales.where("n <> 0"), first).unionByName(landed(sales.where("n = 0").unionByName(corrected).unionByName(moved), second)).drop("n")
    customers = sources["ecom_customers"]
    late = F.pmod(F.xxhash64("customer_id"), F.lit(5)) == 0
    landing = {**{s: landed(df, first) for s, df in sources.items()}, "pos_transactions": pos,
               "ecom_orders": landed(sources["ecom_orders"].limit(0), first),
               "ecom_customers": customers.withColumn("landed", F.when(late, F.lit(second)).otherwise(F.lit(first)))}
    store = TableStore(spark, str(tmp_path))
    load = lambda day: load_until(store, landing.__getitem__, lambda n: raw_view(spark, small, n), day, SAMPLE_AS_OF, grain="year")
    assert load(first) == 1
    with monkeypatch.context() as patch:
        patch.setattr(daily.Load, "facts", lambda self: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            load(second)
    assert store.contents().version == 1 and store.contents().marks[daily.mark_of("pos_transactions")] == "2024-01-01"
    load(second)
    full = Lake(spark, lambda n: landing[n].drop("landed") if n in landing else raw_view(spark, small, n), SAMPLE_AS_OF)
    for table in ("int_customers_unified", "int_orders_all_channels", "dim_customers", "fct_revenue_daily", "fct_revenue_monthly",
                  "fct_reconciliation", "fct_store_performance"):
        wanted = full[table]
        got = store.read(table).select(*wanted.columns)
        assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0, table


# --- feeds

def test_cut_lines_are_dead_letters_in_every_format(spark, tmp_path):
    store, root = TableStore(spark, f"{tmp_path}/store"), tmp_path / "landing"
    schema = schemas.POS_TRANSACTIONS
    header = ",".join(schema.names)
    good, bad = "T1,S1,,E1,P1,2,500,0,0,cash,2024-01-01T10:00:00Z", "T2,S1,,E1,P1,two,500,0,0,cash,2024-01-01T10:00:00Z"
    short = "T3,S1,,E1"
    (root / "pos" / "2024-01-01").mkdir(parents=True)
    (root / "pos" / "2024-01-01" / "a.csv").write_text("\n".join([header, good, bad, short, ""]))
    (root / "clicks" / "2024-01-01").mkdir(parents=True)
    (root / "clicks" / "undated").mkdir(parents=True)
    whole = json.dumps({"event_id": 1, "event_type": "a", "user_id": 2})
    (root / "clicks" / "2024-01-01" / "a.json").write_text("\n".join([whole, '{"event_id": 2, "ev', "[1]", '{"event_id": "x"}', "{}", "null"]))
    (root / "clicks" / "undated" / "b.json").write_text(whole)
    for _ in range(2):
        feeds.ingest_lines(spark, str(root), "pos", schema, "csv", store, f"{tmp_path}/c1").awaitTermination()
        feeds.ingest_lines(spark, str(root), "clicks", schemas.CLIENT_PAYLOAD, "json", store, f"{tmp_path}/c2").awaitTermination()
    assert rows(store.read("pos").select("txn_id")) == [("T1",)]
    assert rows(store.read("clicks").select("event_id", "landing_date")) == rows(
        spark.createDataFrame([(1, dt.date(2024, 1, 1)), (1, None)], "event_id long, landing_date date"))
    dead = sorted(r.line for r in store.read(feeds.DEAD).collect())
    assert dead == sorted([bad, short, '{"event_id": 2, "ev', "[1]", '{"event_id": "x"}', "{}", "null"])


def test_a_replayed_batch_is_found_in_the_log(spark, tmp_path):
    store = TableStore(spark, f"{tmp_path}/store")
    work = store.begin()
    work.append("t", frame(spark, (1, 1, "p")), "part")
    work.commit(writer="w", batch=3)
    for batch in (0, 3):
        assert store.begin().seen("w", batch)
    assert not store.begin().seen("w", 4) and not store.begin().seen("v", 0)


def test_late_rows_wait_and_come_back_once(spark, tmp_path):
    schema = "id int, ts timestamp, day date"
    at = lambda h: dt.datetime(2024, 1, 1, h)
    store, source = TableStore(spark, f"{tmp_path}/store"), f"{tmp_path}/in"
    day = dt.date(2024, 1, 1)
    for batch in ([(1, at(10), day), (2, at(12), day)], [(3, at(9), day), (4, at(12), day), (5, None, None), (6, at(11), day)], []):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        feeds.with_late_rows_aside(spark.readStream.schema(schema).parquet(source), store, "e", f"{tmp_path}/c", "ts", "30 minutes",
                                   "day").awaitTermination()
    assert rows(store.read("e").select("id")) == [(1,), (2,), (4,)]
    assert rows(store.read("e_late").select("id")) == [(3,), (5,), (6,)]
    assert feeds.take_late_rows(store, "e", "day") == 2 and feeds.take_late_rows(store, "e", "day") == 0
    assert rows(store.read("e").select("id")) == [(1,), (2,), (3,), (4,), (6,)]


def test_a_late_change_does_not_bring_a_row_back(spark, tmp_path):
    image = "struct<id: string, v: int>"
    envelope = f"before {image}, after {image}, op string, seq int"
    changes = [(None, ("a", 1), "c", 1), (("a", 1), ("a", 2), "u", 2), (("a", 2), None, "d", 3), (None, ("b", 1), "c", 4), (("b", 1), ("b", 5), "u", 5)]
    for order in ([4, 3, 2, 1, 0], [2, 0, 1, 4, 3], [0, 1, 2, 3, 4]):
        store = TableStore(spark, f"{tmp_path}/{''.join(map(str, order))}")
        for batch, i in enumerate(order):
            feeds.apply_changes(store, "t", spark.createDataFrame([changes[i]], envelope), "id", "seq", "feed", batch, buckets=4)
        assert rows(feeds.live_rows(store.read("t"))) == [("b", 5)]
    feeds.forget_tombstones(store, "t", 4)
    assert store.read("t").count() == 1


def test_groups_see_their_columns_only(spark):
    people = spark.createDataFrame([("1", "Ann", "ann@x.vn", "0912345678")], "id string, name string, email string, phone string")
    policy = spark.createDataFrame([("a", "people", "id", "hash"), ("a", "people", "email", "email"), ("b", "people", "phone", "tail"),
                                    ("b", "people", "name", "keep"), ("b", "people", "email", "drop"), ("b", "other", "x", "keep")],
                                   "consumer_group string, table_name string, column_name string, rule string")
    views = views_by_group({"people": people}, policy)
    assert {k: v.columns for k, v in views.items()} == {("a", "people"): ["id", "email"], ("b", "people"): ["name", "phone"]}
    assert rows(views["b", "people"]) == [("Ann", "*******678")]


def test_observed_checks_equal_a_scan_of_their_own(spark, tmp_path):
    df = frame(spark, (1, 1, "p"), (1, None, "q"), (2, -5, None))
    checks = [Check.row_count(), Check.missing("v"), Check.in_range("v", low=0), Check.duplicates("id"), Check.metric("avg(v)", "<", 2.0)]
    watched, seen = observed(df, checks)
    watched.write.parquet(f"{tmp_path}/t")
    written = spark.read.parquet(f"{tmp_path}/t")
    report = observed_report(written, checks, seen)
    assert rows(report) == rows(run_checks(df, checks))
    # The duplicates alone read the table: one scan, shown in the tree and again below it.
    assert plan_of(observed_report(written, checks, seen)).count("Scan parquet") == 2

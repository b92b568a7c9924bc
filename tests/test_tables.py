import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from martloom import schemas, session
from martloom.sources import landing, messages, tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def days(spark, *values):
    return spark.createDataFrame([(i, v, dt.date(2024, 1, d)) for i, v, d in values], "id int, v int, dt date")


def test_overwriting_a_day_twice_leaves_other_days(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.append_table(days(spark, (1, 1, 1), (2, 2, 2)), path, ["dt"])
    for _ in range(2):
        tables.overwrite_partitions(days(spark, (3, 3, 2)), path, ["dt"])
    assert rows(spark.read.parquet(path).select("id")) == [(1,), (3,)]


def test_replace_drops_everything_else(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.append_table(days(spark, (1, 1, 1), (2, 2, 2)), path, ["dt"])
    tables.replace_table(days(spark, (3, 3, 2)), path, ["dt"])
    assert rows(spark.read.parquet(path).select("id")) == [(3,)]


def test_insert_if_absent_is_idempotent(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.append_table(days(spark, (1, 1, 1)), path)
    for _ in range(2):
        tables.insert_if_absent(path, days(spark, (1, 9, 1), (2, 2, 1), (2, 2, 1)), "id")
    assert rows(spark.read.parquet(path).select("id", "v")) == [(1, 1), (2, 2)]


def test_csv_rows_that_do_not_fit_are_kept_aside(spark, tmp_path):
    folder = tmp_path / "pos" / "2024-01-01"
    folder.mkdir(parents=True)
    header = ",".join(schemas.POS_TRANSACTIONS.names)
    good = "T1,S1,,E1,P1,2,500,0,0,cash,2024-01-01T10:00:00Z"
    bad = "T2,S1,,E1,P1,two,500,0,0,cash,2024-01-01T10:00:00Z"
    (folder / "a.csv").write_text(f"{header}\n{good}\n{bad}\n")
    got = landing.read_csv_landing(spark, str(tmp_path), "pos", "2024-01-01", schemas.POS_TRANSACTIONS).cache()
    assert rows(got.where("_corrupt_record IS NULL").select("txn_id")) == [("T1",)]
    assert rows(got.where("_corrupt_record IS NOT NULL").select("txn_id")) == [("T2",)]
    assert landing.CORRUPT not in schemas.POS_TRANSACTIONS.names


def test_malformed_json_goes_to_quarantine(spark):
    bodies = ['{"event_id":1,"event_type":"a","user_id":2}', '{"event_id":1,', '{"event_id":"x","event_type":"a"}', "", None,
              '{"event_id":3}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    good, bad = messages.split_malformed(df, "body", schemas.CLIENT_PAYLOAD)
    assert rows(good.select("event_id")) == [(1,), (3,)]
    assert bad.count() == 4


def test_message_key_is_first_filled_id(spark):
    df = spark.createDataFrame([(None, "e1", 1.5), ("o1", "e2", None), ("", "e3", 0.0)], "order_id string, event_id string, v double")
    got = {r["key"]: r["value"] for r in messages.kafka_encode(df).collect()}
    assert set(got) == {"e1", "o1", "e3"}
    assert got["o1"] == '{"order_id":"o1","event_id":"e2","v":null}'


def test_updated_day_is_half_open(spark):
    times = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2)]
    df = spark.createDataFrame([(t,) for t in times], "updated_at timestamp")
    assert landing.updated_on(df, dt.date(2024, 1, 1)).count() == 2


def test_compaction_rewrites_only_the_chosen_partitions(spark, tmp_path):
    path = f"{tmp_path}/a"
    days(spark, *[(i, i, 1 + i % 2) for i in range(40)]).repartition(8).write.partitionBy("dt").parquet(path)
    before = rows(spark.read.parquet(path).select("id", "dt"))
    files = dict(rows(spark.read.parquet(path).select("dt", F.input_file_name()).distinct().groupBy("dt").count()))
    chosen, other = sorted(files)
    tables.compact(spark, path, "dt", F.col("dt") == F.lit(chosen))
    after = dict(rows(spark.read.parquet(path).select("dt", F.input_file_name()).distinct().groupBy("dt").count()))
    assert rows(spark.read.parquet(path).select("id", "dt")) == before
    assert after[chosen] == 1 and after[other] == files[other] > 1


def test_backfill_opens_only_the_days_it_needs(spark, tmp_path):
    source, out = f"{tmp_path}/source", f"{tmp_path}/out"
    days(spark, (1, 1, 1), (2, 1, 2), (3, 1, 3)).withColumn("ts", F.col("dt").cast("timestamp")).write.partitionBy("dt").parquet(source)
    seen = []
    tables.backfill(spark.read.parquet(source), lambda df: seen.append(plan_of(df)) or df, out, "ts", dt.date(2024, 1, 2), dt.date(2024, 1, 2), "dt")
    assert "PartitionFilters: [isnotnull(dt" in seen[0]
    assert rows(spark.read.parquet(out).select("id")) == [(2,)]


def test_scratch_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.workspace(spark, "x").startswith(root)
    assert spark.sparkContext.getCheckpointDir().startswith(("file:" + root, root))


def test_a_cluster_without_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.shared_root(Session())

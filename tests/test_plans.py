"""Shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from martloom.operators import joins, ranking
from martloom.operators.dedup import latest_per_key
from martloom.operators.quality import Check, run_checks
from martloom.plans.lake import MODELS
from martloom.sources import tables
from martloom.sources.landing import read_partition
from tests.conftest import plan_of

BAD_JOINS = ("BroadcastNestedLoopJoin", "CartesianProduct")
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("model", sorted(MODELS))
def test_models_have_no_pairwise_join_python_or_single_task(lake, model):
    plan = plan_of(lake[model])
    assert not [node for node in (*BAD_JOINS, *PYTHON_NODES) if node in plan]
    # The monthly series has one row per month, so ordering it in one task is fine; the calendar
    # takes the first and last day of each task.
    assert model in ("fct_revenue_monthly", "dim_date") or "SinglePartition" not in plan


def test_no_join_is_hinted_to_broadcast(spark, lake):
    """With Spark's size limit at zero every lookup shuffles, so none is forced."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from martloom.plans.lake import Lake
        fresh = Lake.over_sample(spark, "/root/testdata/sf0.001")
        for model in ("int_customers_unified", "int_orders_all_channels", "fct_inventory_alerts"):
            assert "BroadcastExchange" not in plan_of(fresh[model])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_dedup_drops_copies_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS t")
    plan = plan_of(latest_per_key(df, ["k"], "t", []))
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2  # one on each side of the exchange
    below = tree[tree.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_unused_columns_are_not_read(lake):
    plan = plan_of(lake["int_orders_all_channels"].groupBy("channel").count())
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    assert not [s for s in schemas if "o_orderpriority" in s or "c_acctbal" in s or "l_linestatus" in s]


def test_day_filter_prunes_partitions(spark, tmp_path):
    df = spark.range(4).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("dt"))
    tables.append_table(df, f"{tmp_path}/t", ["dt"])
    plan = plan_of(read_partition(spark, str(tmp_path), "t", "2024-01-02"))
    assert re.search(r"PartitionFilters: \[[^\]]*dt", plan)
    assert read_partition(spark, str(tmp_path), "t", "2024-01-02").count() == 1


def test_plain_checks_share_one_scan(spark, lake):
    report = run_checks(lake["stg_clickstream__events"], [
        Check.row_count(), Check.missing("event_id"), Check.in_range("duration_ms", low=0), Check.matches("city", "^H")])
    assert plan_of(report).split("\n\n")[0].count("Scan parquet") == 1


def test_tiles_move_only_narrow_rows(spark, lake):
    wide = spark.range(50).select("id", *[F.lit("x" * 20).alias(f"c{i}") for i in range(5)])
    scored = ranking.global_ntile(wide, 5, {"tile": "id"}, ["id"])
    tree = plan_of(scored).split("\n\n")[0]
    assert "Exchange" not in tree and "Window" not in tree


@pytest.mark.parametrize("how", ["orders to customers", "any key"])
def test_hot_key_is_split(spark, how):
    """A third of the rows share one phone; the skewed shuffle partition is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("phone"),
            F.md5(F.col("id").cast("string")).alias("mail"))
        right = spark.range(1_000).select(
            F.col("id").alias("rid"), F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("rp"),
            F.md5(F.col("id").cast("string")).alias("rm"))
        if how == "any key":
            joined = joins.left_join_any_key(left, right, [("phone", "rp"), ("mail", "rm")], ["rid"], "id")
        else:
            joined = joins.left_lookup(left, right.select("rp", "rid"), "phone", "rp", spread_by="id")
        assert joined.count() >= 60_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_any_key_join_shuffles_each_side_once(spark):
    """The anti join reuses the exploded left rows; of the right side it moves distinct keys only."""
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in limits}
    for k in limits:
        spark.conf.set(k, "-1")
    try:
        left = spark.range(0, 500, 1, 4).select("id", *[F.md5((F.col("id") % m).cast("string")).alias(f"l{m}") for m in (7, 50, 90)])
        right = spark.range(1000, 1400, 1, 4).select(F.col("id").alias("rid"), *[F.md5((F.col("id") % m).cast("string")).alias(f"r{m}") for m in (9, 60, 80)])
        joined = joins.left_join_any_key(left, right, [("l7", "r9"), ("l50", "r60"), ("l90", "r80")], ["rid"], "id")
        joined.collect()
        tree = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "ReusedExchange" in tree
        assert tree.count("Range (0, 500") == 1 and tree.count("Range (1000, 1400") == 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_null_keys_are_scattered(spark):
    keys = spark.range(1000).select(joins.spread_nulls(F.lit(None).cast("string"), F.col("id")).alias("k"))
    assert keys.distinct().count() > 500


def test_star_lookup_scatters_rows_without_a_key(spark):
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
              "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in zip(limits, ("-1", "-1", "false")):
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 900, 1, 4).select("id", F.when(F.col("id") % 3 != 0, (F.col("id") % 50).cast("string")).alias("store_id"))
        stores = spark.range(40).select(F.col("id").cast("string").alias("store_id"), F.concat(F.lit("s"), "id").alias("store_name"))
        stores = stores.unionByName(spark.createDataFrame([(None, "nobody's")], "store_id string, store_name string"))
        found = joins.with_dims(fact, (stores, "store_id")).withColumn("part", F.spark_partition_id()).collect()
        assert len(found) == 900
        assert all(r.store_name == (f"s{r.store_id}" if r.store_id and int(r.store_id) < 40 else None) for r in found)
        assert len({r.part for r in found if r.store_id is None}) > 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

"""The models wired together over one set of raw entities."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.quality import Check, gate, observed, observed_report, run_checks
from martloom.plans import intermediate, marts, staging
from martloom.plans.daily import PERIOD, fact_dates, partition_of, with_period
from martloom.session import write_once
from martloom.sources import sample
from martloom.sources.store import TableStore

# Fixed date for age calculations over the sample, whose newest sale is in 2001.
SAMPLE_AS_OF = dt.date(2001, 12, 31)

MODELS: dict[str, Callable[[Lake], DataFrame]] = {
    "stg_pos__transactions": lambda x: staging.stg_pos_transactions(x.raw("pos_transactions")),
    "stg_ecommerce__orders": lambda x: staging.stg_ecommerce_orders(x.raw("ecom_orders")),
    "stg_ecommerce__customers": lambda x: staging.stg_ecommerce_customers(x.raw("ecom_customers")),
    "stg_payments__vnpay": lambda x: staging.stg_payments_vnpay(x.raw("payments_vnpay")),
    "stg_payments__momo": lambda x: staging.stg_payments_momo(x.raw("payments_momo")),
    "stg_payments__card": lambda x: staging.stg_payments_card(x.raw("payments_card")),
    "stg_payments__consolidated": lambda x: staging.stg_payments_consolidated(
        x["stg_payments__vnpay"], x["stg_payments__momo"], x["stg_payments__card"]),
    "stg_clickstream__events": lambda x: staging.stg_clickstream_events(x.raw("clickstream_events")),
    "stg_inventory__stock_levels": lambda x: staging.stg_inventory_stock_levels(x.raw("stock_levels")),
    "stg_loyalty__members": lambda x: staging.stg_loyalty_members(x.raw("loyalty_members")),
    "int_customers_unified": lambda x: intermediate.int_customers_unified(
        x["stg_ecommerce__customers"], x["stg_loyalty__members"], x["stg_pos__transactions"]),
    "int_orders_all_channels": lambda x: intermediate.int_orders_all_channels(
        x["stg_pos__transactions"], x["stg_ecommerce__orders"], x["int_customers_unified"]),
    "int_customer_metrics": lambda x: intermediate.int_customer_metrics(
        x["int_orders_all_channels"], F.lit(x.as_of)),
    "int_sessions": lambda x: intermediate.int_sessions(x["stg_clickstream__events"]),
    # One plan, in which customers and order lookups share the shuffles of the till sales.
    "dim_customers": lambda x: marts.dim_customers(x["int_customers_unified"], x["int_customer_metrics"]),
    "dim_stores": lambda x: marts.dim_stores(x.raw("stores")),
    "dim_products": lambda x: marts.dim_products(x.raw("products")),
    "dim_date": lambda x: marts.dim_date_over(*fact_dates(x.raw)),
    "fct_revenue_daily": lambda x: marts.fct_revenue_daily(x["int_orders_all_channels"]),
    "fct_revenue_monthly": lambda x: marts.fct_revenue_monthly(x["fct_revenue_daily"]),
    "fct_reconciliation": lambda x: marts.fct_reconciliation(
        x["stg_pos__transactions"], x["stg_ecommerce__orders"], x["stg_payments__consolidated"]),
    "fct_campaign_performance": lambda x: marts.fct_campaign_performance(x["int_sessions"]),
    "fct_funnel_daily": lambda x: marts.fct_funnel_daily(x["int_sessions"]),
    "fct_inventory_alerts": lambda x: marts.fct_inventory_alerts(
        x["stg_inventory__stock_levels"], x["dim_products"], x["dim_stores"]),
    "fct_store_performance": lambda x: marts.fct_store_performance(x["fct_revenue_daily"], x["dim_stores"]),
}

# Tables of the full build, in order; their layout is the daily load's. Staging stays lazy
# except for the till sales, whose deduplication several models would repeat.
BUILD = ("stg_pos__transactions", "int_customers_unified", "int_orders_all_channels", "int_customer_metrics", "int_sessions",
         "dim_customers", "dim_stores", "dim_products", "dim_date", "fct_revenue_daily", "fct_revenue_monthly", "fct_reconciliation",
         "fct_campaign_performance", "fct_funnel_daily", "fct_inventory_alerts", "fct_store_performance")


class Lake:
    """Raw entities plus the models over them. Frames are lazy and built once."""

    def __init__(self, spark: SparkSession, raw: Callable[[str], DataFrame], as_of: dt.date):
        self.spark = spark
        self.as_of = as_of
        self._raw = raw
        self._frames: dict[str, DataFrame] = {}
        self._tables: set[str] = set()

    @classmethod
    def over_sample(cls, spark: SparkSession, folder: str, as_of: dt.date = SAMPLE_AS_OF) -> Lake:
        return cls(spark, lambda name: sample.raw_view(spark, folder, name), as_of)

    def raw(self, entity: str) -> DataFrame:
        key = f"raw.{entity}"
        if key not in self._frames:
            self._frames[key] = self._raw(entity)
        return self._frames[key]

    def __getitem__(self, model: str) -> DataFrame:
        if model not in self._frames:
            self._frames[model] = MODELS[model](self)
        return self._frames[model]

    def materialise(self, model: str) -> DataFrame:
        """Write a model once; later models read the table instead of recomputing it."""
        if model not in self._tables:
            self.use_table(model, write_once(self[model], model))
        return self._frames[model]

    def use_table(self, model: str, table: DataFrame) -> None:
        self._frames[model] = table
        self._tables.add(model)

    def register_views(self, prefix: str = "") -> list[str]:
        """Temp views of all models for ad-hoc SQL."""
        for model in MODELS:
            self[model].createOrReplaceTempView(prefix + model)
        return [prefix + model for model in MODELS]


def checked_build(lake: Lake, checks: dict[str, list[Check]]) -> dict[str, DataFrame]:
    """Write every checked model once and report on it; plain checks are gathered by the pass that writes."""
    reports = {}
    for model in dict.fromkeys([*(m for m in checks if m not in BUILD), *BUILD]):
        if model not in checks:
            lake.materialise(model)
            continue
        frame, seen = observed(lake[model], checks[model])
        lake.use_table(model, write_once(frame, model))
        reports[model] = observed_report(lake[model], checks[model], seen)
    return {model: reports[model] for model in checks}


def build_all(lake: Lake, store: TableStore, checks: dict[str, list[Check]] | None = None,
              grain: str = "day") -> int:
    """Full build: write every table in order and show all of them in one commit.

    Later models read the tables built before. Plain checks are observed while a table is written aside; a failed check
    stops the build and leaves what is published as it is. Checks of staging models that are not built themselves run
    first. Returns the store's new version.
    """
    for model in (m for m in checks or {} if m not in BUILD and m in MODELS):
        gate(model, run_checks(lake.materialise(model), checks[model]))
    work = store.begin()
    for model in BUILD:
        wanted = (checks or {}).get(model, [])
        frame, seen = observed(with_period(model, lake[model], grain), wanted)
        work.replace(model, frame, partition_of(model))
        lake.use_table(model, work.read(model).drop(PERIOD))
        if wanted:
            gate(model, observed_report(lake[model], wanted, seen))
    return work.commit()

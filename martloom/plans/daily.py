"""The daily load: only what arrived since the last one, carried to exactly the days and months it changes.

Sources are landing tables with a ``landed`` day. The newest day taken of each source is its high-water mark; a load reads
the days above it and no others. Keyed staging tables keep the newest row of each key, so a late correction reaches the day it
belongs to. From the partitions those merges touched follow the days, months and sessions to compute again, and
from customers that changed the days on which they bought. All tables and marks show in one commit, so a load
that dies changes nothing, and running it again takes the same rows. The first load into an empty store is a full build.
Tables that need nothing of each other are computed side by side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.dedup import latest_per_key, latest_snapshot
from martloom.operators.quality import Check, gate, run_checks
from martloom.operators.shaping import union_all
from martloom.plans import intermediate, marts, staging
from martloom.session import scratch_removed, side_by_side, write_once
from martloom.sources.store import TableStore, Transaction, among

SOURCES = ("pos_transactions", "ecom_orders", "ecom_customers", "loyalty_members", "payments_vnpay", "payments_momo",
           "payments_card", "clickstream_events", "stock_levels")

# Day column of every table the load keeps, whose day, month or year names its partition; tables without one are replaced whole.
LAYOUT = {
    "stg_pos__transactions": "txn_date", "stg_ecommerce__orders": "order_day", "stg_payments__consolidated": "payment_date",
    "stg_ecommerce__customers": None, "stg_loyalty__members": None, "newest_stock": None,
    "phone_days": "txn_date", "orderer_days": "order_day",
    "int_customers_unified": None, "int_orders_all_channels": "order_date", "int_customer_metrics": None,
    "int_sessions": "session_date", "dim_customers": None, "dim_stores": None, "dim_products": None, "dim_date": None,
    "fct_revenue_daily": "date_key", "fct_revenue_monthly": None, "fct_reconciliation": "date_key",
    "fct_campaign_performance": "date_key", "fct_funnel_daily": "date_key", "fct_inventory_alerts": None,
    "fct_store_performance": "date_key",
}


PERIOD = "period"
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


def with_period(table: str, rows: DataFrame, grain: str) -> DataFrame:
    """The rows with the partition column that their table's layout asks for."""
    day = LAYOUT[table]
    return rows.withColumn(PERIOD, F.date_format(day, GRAINS[grain])) if day else rows


def partition_of(table: str) -> str | None:
    return PERIOD if LAYOUT[table] else None


def mark_of(source: str) -> str:
    return f"landed:{source}"


def arrived(landing: DataFrame, mark: str | None, until: dt.date) -> DataFrame:
    """Rows that landed above the mark, up to a day. The plain partition column is compared, so other days are pruned."""
    rows = landing.where(F.col("landed") <= F.lit(until))
    return (rows if mark is None else rows.where(F.col("landed") > F.lit(dt.date.fromisoformat(mark)))).drop("landed")


class Load:
    """One load; ``landing(source)`` has a ``landed`` day, ``whole(name)`` gives the small tables that come whole."""

    def __init__(self, store: TableStore, landing: Callable[[str], DataFrame], whole: Callable[[str], DataFrame],
                 until: dt.date, as_of: dt.date, grain: str = "day"):
        self.work: Transaction = store.begin()
        self.grain = grain
        self.gather = grain != "year"  # years are few: tasks write them without a shuffle, and files stay few
        self.until, self.as_of, self.whole = until, as_of, whole
        marks = self.work.contents.marks
        self.new = {s: arrived(landing(s), marks.get(mark_of(s)), until) for s in SOURCES}
        self.marks = {mark_of(s): until.isoformat() for s in SOURCES}

    # -- helpers -------------------------------------------------------------

    def read(self, table: str) -> DataFrame:
        return self.work.read(table).drop(PERIOD)

    def days(self, table: str, periods: Iterable) -> DataFrame:
        """Some partitions of a table, chosen before any other file is opened."""
        return self.work.read(table).where(among(PERIOD, periods)).drop(PERIOD)

    def put(self, table: str, rows: DataFrame) -> None:
        self.work.replace(table, with_period(table, rows, self.grain), partition_of(table), self.gather)

    def fold(self, table: str, updates: DataFrame, key: Sequence[str], fold: Callable[[DataFrame], DataFrame]) -> set:
        """Fold updates into their keys' rows; the periods touched. Updates of one load are folded among themselves before."""
        if not self.work.exists(table):
            self.put(table, updates)
            return set(self.work.contents.runs[table])
        rows = with_period(table, write_once(updates, table), self.grain)
        again = lambda found: with_period(table, fold(found.drop(PERIOD)), self.grain)
        return self.work.regroup(table, rows, key, partition_of(table), again, gather=self.gather).touched

    def keep(self, table: str, updates: DataFrame, key: Sequence[str], version: str, ties: Sequence) -> set:
        return self.fold(table, updates, key, lambda rows: latest_per_key(rows, list(key), version, ties))

    def rewrite(self, table: str, rows: DataFrame, periods: set) -> None:
        if not self.work.exists(table):
            self.put(table, rows)
        elif periods:
            self.work.rewrite(table, with_period(table, rows, self.grain), PERIOD, periods, self.gather)

    # -- staging -------------------------------------------------------------

    def staging(self) -> None:
        new = self.new
        orders = staging.stg_ecommerce_orders(new["ecom_orders"]).withColumn("order_day", F.to_date("order_date"))
        repeated = union_all(staging.stg_payments_vnpay(new["payments_vnpay"]), staging.stg_payments_momo(new["payments_momo"]))
        cards = staging.stg_payments_card(new["payments_card"])
        payments = union_all(*[p.select(*staging.PAYMENT_COLUMNS) for p in (repeated, cards)])
        newest = lambda rows: latest_snapshot(rows, staging.SNAPSHOT_TIES)
        sessions = intermediate.int_sessions(staging.stg_clickstream_events(new["clickstream_events"]))
        # Members and card payments are not deduplicated, as their models say, so they are added to what there is.
        self.pos_days, self.order_days, self.pay_days, self.session_days, *_ = side_by_side(
            lambda: self.keep("stg_pos__transactions", staging.stg_pos_transactions(new["pos_transactions"]), ["txn_id"],
                              "txn_timestamp", staging.pos_ties()),
            lambda: self.keep("stg_ecommerce__orders", orders, ["order_id"], "updated_at", staging.ORDER_TIES),
            lambda: self.fold("stg_payments__consolidated", payments, ["gateway", "payment_id"], _newest_payments),
            lambda: self.fold("int_sessions", sessions, intermediate.SESSION_KEYS, intermediate.joined_sessions),
            lambda: self.fold("newest_stock", newest(staging.stg_inventory_stock_levels(new["stock_levels"])), ["store_id", "sku"], newest),
            lambda: self.keep("stg_ecommerce__customers", staging.stg_ecommerce_customers(new["ecom_customers"]), ["ecom_customer_id"],
                              "updated_at", staging.CUSTOMER_TIES),
            lambda: self.work.append("stg_loyalty__members", staging.stg_loyalty_members(new["loyalty_members"])))

    # -- customers and orders ------------------------------------------------

    def customers(self) -> None:
        """Unify customers, and find the days on which somebody whose identity changed has bought."""
        work = self.work
        phones = self.days("stg_pos__transactions", self.pos_days).where("customer_phone IS NOT NULL").select("customer_phone", "txn_date")
        orderers = self.days("stg_ecommerce__orders", self.order_days).where("ecom_customer_id IS NOT NULL").select("ecom_customer_id", "order_day")
        side_by_side(lambda: self.rewrite("phone_days", phones.distinct(), self.pos_days),
                     lambda: self.rewrite("orderer_days", orderers.distinct(), self.order_days))
        known = work.exists("int_customers_unified")
        self.put("int_customers_unified", intermediate.int_customers_unified(
            self.read("stg_ecommerce__customers"), self.read("stg_loyalty__members"), self.read("phone_days")))
        self.days_sold = self.pos_days | self.order_days
        all_days = {d for index in ("phone_days", "orderer_days") for d in work.contents.runs[index]}
        if known and not self.days_sold >= all_days:  # otherwise there is no day left to find
            now, before = work.read("int_customers_unified"), work.read_before("int_customers_unified")
            for index, key, of in (("phone_days", "customer_phone", "phone_normalized"), ("orderer_days", "ecom_customer_id", "ecom_customer_id")):
                pairs = [side.select(F.col(of).alias(key), "customer_uid") for side in (now, before)]
                moved = pairs[0].exceptAll(pairs[1]).union(pairs[1].exceptAll(pairs[0])).select(key).distinct()
                met = work.read(index).join(moved, key, "left_semi").select(F.col(PERIOD).alias("d")).distinct()
                self.days_sold |= {r.d for r in met.toLocalIterator()}

    def orders(self) -> None:
        work, days = self.work, self.days_sold
        orders = intermediate.int_orders_all_channels(
            self.days("stg_pos__transactions", days), self.days("stg_ecommerce__orders", days).drop("order_day"),
            work.read("int_customers_unified"))
        self.rewrite("int_orders_all_channels", orders, days)

    def scores(self) -> None:
        self.put("int_customer_metrics", intermediate.int_customer_metrics(self.read("int_orders_all_channels"), F.lit(self.as_of)))
        self.put("dim_customers", marts.dim_customers(self.read("int_customers_unified"), self.read("int_customer_metrics")))

    # -- dimensions and facts ------------------------------------------------

    def dimensions(self) -> None:
        work, new = self.work, self.new
        known = work.exists("dim_stores")
        work.replace("dim_stores", marts.dim_stores(self.whole("stores")))
        work.replace("dim_products", marts.dim_products(self.whole("products")))
        now = work.read("dim_stores")
        self.stores_changed = not known or not now.exceptAll(work.read_before("dim_stores")).isEmpty() or not (
            work.read_before("dim_stores").exceptAll(now).isEmpty())
        dates = fact_dates(new.__getitem__)
        if work.exists("dim_date"):
            dates.append(work.read("dim_date").select("date_key"))
        work.replace("dim_date", write_once(marts.dim_date_over(*dates), "dim_date"))

    def facts(self) -> None:
        side_by_side(self.revenue, self.scores, self.settled, self.visits, lambda: self.put("fct_inventory_alerts", marts.fct_inventory_alerts(
            self.work.read("newest_stock"), self.work.read("dim_products"), self.work.read("dim_stores"))))

    def revenue(self) -> None:
        days = self.days_sold
        self.rewrite("fct_revenue_daily", marts.fct_revenue_daily(self.days("int_orders_all_channels", days)), days)
        side_by_side(self.monthly, self.performance)

    def monthly(self) -> None:
        work, days = self.work, self.days_sold
        width = min(len(GRAINS["month"]), len(GRAINS[self.grain]))  # a month's days, or the whole year a partition holds
        months = {d and d[:width] for d in days}
        in_months = {d for d in work.contents.runs["fct_revenue_daily"] if (d and d[:width]) in months}
        sums = marts.monthly_sums(self.days("fct_revenue_daily", in_months))
        if work.exists("fct_revenue_monthly"):
            other = ~among(F.substring(F.col("month_key").cast("string"), 1, width), months)
            sums = sums.unionByName(work.read("fct_revenue_monthly").where(other).select(*sums.columns))
        self.put("fct_revenue_monthly", marts.monthly_growth(sums))

    def performance(self) -> None:
        work, days = self.work, self.days_sold
        scored = set(work.contents.runs["fct_revenue_daily"]) | days if self.stores_changed else days
        self.rewrite("fct_store_performance", marts.fct_store_performance(
            self.days("fct_revenue_daily", scored), work.read("dim_stores")), scored)

    def settled(self) -> None:
        settled = self.pos_days | self.order_days | self.pay_days
        self.rewrite("fct_reconciliation", marts.fct_reconciliation(
            self.days("stg_pos__transactions", settled), self.days("stg_ecommerce__orders", settled),
            self.days("stg_payments__consolidated", settled)), settled)

    def visits(self) -> None:
        sessions = self.days("int_sessions", self.session_days)
        side_by_side(lambda: self.rewrite("fct_campaign_performance", marts.fct_campaign_performance(sessions), self.session_days),
                     lambda: self.rewrite("fct_funnel_daily", marts.fct_funnel_daily(sessions), self.session_days))

    def run(self, checks: dict[str, list[Check]] | None = None) -> int:
        """Compute everything aside, check it, and show it in one commit. What was written on the way goes."""
        with scratch_removed(self.work.spark):
            self.staging()
            side_by_side(lambda: (self.customers(), self.orders()), self.dimensions)
            self.facts()
            for table in checks or {}:
                if table in LAYOUT:
                    gate(table, run_checks(self.read(table), checks[table]))
            return self.work.commit(self.marks)


def _newest_payments(rows: DataFrame) -> DataFrame:
    repeated = staging.newest_payment(rows.where("gateway <> 'card'"))
    return repeated.unionByName(rows.where("gateway = 'card'"))


def fact_dates(raw: Callable[[str], DataFrame]) -> list[DataFrame]:
    """One-column frames of the day of every fact a source leads to: sales, orders, payments, sessions and stock."""
    stamps = {"pos_transactions": "txn_timestamp", "ecom_orders": "order_date", "payments_vnpay": "vnp_pay_date", "payments_momo": "response_time",
              "payments_card": "settled_at", "clickstream_events": "event_time", "stock_levels": "snapshot_time"}
    return [raw(source).select(F.col(ts).try_cast("date")) for source, ts in stamps.items()]


def load_until(store: TableStore, landing: Callable[[str], DataFrame], whole: Callable[[str], DataFrame], until: dt.date,
               as_of: dt.date, checks: dict[str, list[Check]] | None = None, grain: str = "day", keep: int | None = None) -> int:
    """Bring the store up to what landed until a day. Days taken before are not taken again.

    ``grain`` is the time a partition holds; take a coarser one where days are small. With ``keep``, folders that none of so many
    newest versions needs are removed after the commit; otherwise all stay.
    """
    version = Load(store, landing, whole, until, as_of, grain).run(checks)
    if keep:
        store.expire(keep)
    return version

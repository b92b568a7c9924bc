"""Marts: dimensions and the finance, marketing and operations facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import rules
from martloom.functions.columns import calendar_parts, count_where, exact_mean, month_start, packed_key, safe_ratio
from martloom.operators.dedup import latest_snapshot
from martloom.operators.joins import with_dims
from martloom.operators.ranking import global_ntile, with_growth
from martloom.operators.shaping import pivot_sum, union_all
from martloom.plans.staging import SNAPSHOT_TIES
from martloom.session import write_once

RFM_ORDERS = {"recency_score": "days_since_last_order", "frequency_score": "total_orders",
              "monetary_score": "lifetime_revenue_vnd"}


# --- dimensions -------------------------------------------------------------

def dim_customers(unified: DataFrame, metrics: DataFrame, recency_best: str = "low",
                  require_orders: bool = False) -> DataFrame:
    """Customers with RFM scores and segment.

    As defined, recency score 1 is the most recent order, and customers without
    orders rank last. ``recency_best="high"`` turns the recency scale round;
    ``require_orders`` leaves customers without orders out.
    """
    profile = unified.join(metrics, "customer_uid", "inner" if require_orders else "left")
    base = write_once(profile, "rfm")
    scored = global_ntile(base, 5, RFM_ORDERS, ["customer_uid", "loyalty_member_id"])
    if recency_best == "high":
        scored = scored.withColumn("recency_score", 6 - F.col("recency_score"))
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.withColumn("rfm_total", total).withColumn("rfm_segment", rules.rfm_segment())


def dim_stores(stores: DataFrame) -> DataFrame:
    return stores.withColumns({"region_vi": rules.region_vi(), "store_size": rules.store_size()})


def dim_products(products: DataFrame) -> DataFrame:
    price, cost = F.col("price_vnd").try_cast("bigint"), F.col("cost_vnd").try_cast("bigint")
    return products.withColumns({
        "price_vnd": price, "cost_vnd": cost,
        "margin_vnd": price - cost, "margin_pct": safe_ratio(price - cost, price)})


def dim_date_over(*dates: DataFrame) -> DataFrame:
    """Calendar of the whole years that one-column frames of fact dates span; no date, no rows."""
    ends = union_all(*[d.toDF("d") for d in dates]).agg(
        F.trunc(F.min("d"), "year").alias("first"), F.add_months(F.trunc(F.max("d"), "year"), 12).alias("after"))
    days = ends.select(F.explode(F.sequence("first", F.date_sub("after", 1))).alias("date_key"))
    return days.withColumns(calendar_parts("date_key"))


# --- finance ----------------------------------------------------------------

def fct_revenue_daily(orders: DataFrame) -> DataFrame:
    """Sales per day, store and channel.

    Orders are shuffled once, by their group, as a group is a store's day and hardly smaller than its orders. The distinct
    count forms its groups of customers there, in memory or on disk, and needs no second shuffle.
    """
    keys = ("date_key", "store_id", "channel")
    kept = orders.where(~rules.is_cancelled("status")).withColumnRenamed("order_date", "date_key")
    kept = kept.withColumn("customer", packed_key("customer_uid")).repartition(*keys)
    daily = kept.groupBy(*keys).agg(
        F.count("*").alias("total_orders"),
        F.countDistinct("customer").alias("unique_customers"),
        F.sum("total_amount_vnd").alias("total_revenue_vnd"),
        F.sum("discount_amount_vnd").alias("total_discount_vnd"),
        F.sum("tax_amount_vnd").alias("total_tax_vnd"),
        exact_mean("total_amount_vnd").alias("avg_order_value_vnd"),
        F.sum("num_items").alias("total_items_sold"))
    return daily.withColumn("net_revenue_vnd", F.col("total_revenue_vnd") - F.col("total_discount_vnd"))


def fct_revenue_monthly(daily: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Monthly totals and growth. ``unique_customers`` adds the daily distinct counts up,
    as defined; pass ``orders`` to add the true monthly distinct count."""
    monthly = monthly_sums(daily)
    if orders is not None:
        true_count = (orders.where(~rules.is_cancelled("status")).groupBy(month_start("order_date").alias("month_key"))
                      .agg(F.countDistinct(packed_key("customer_uid")).alias("monthly_distinct_customers")))
        monthly = monthly.join(true_count, "month_key", "left")
    return monthly_growth(monthly)


def fct_revenue_monthly_distinct(orders: DataFrame) -> DataFrame:
    """``fct_revenue_monthly`` over ``fct_revenue_daily`` with the true distinct count, from one pass over the orders.

    Orders are shuffled by day, store and channel as there. A customer's row in such a group then carries their month, and the first row of
    a group its totals, so the months follow without computing the orders twice. Totals go on in rows without a customer, which
    each task sums up before the second shuffle; that moves a month and a customer only.
    """
    keys = ("date_key", "store_id", "channel")
    kept = orders.where(~rules.is_cancelled("status")).withColumnRenamed("order_date", "date_key")
    kept = kept.withColumn("customer", packed_key("customer_uid")).repartition(*keys)
    each = kept.groupBy(*keys, "customer").agg(F.count("*").alias("total_orders"), F.sum("total_amount_vnd").alias("revenue"),
                                               F.sum("discount_amount_vnd").alias("discount"))
    group = Window.partitionBy(*keys)
    first = F.row_number().over(group.orderBy("customer")) == 1
    net = F.sum("revenue").over(group) - F.sum("discount").over(group)
    totals = {"orders": F.col("total_orders"), "known": F.col("customer").isNotNull().cast("bigint"), "revenue": F.col("revenue"), "net": F.when(first, net)}
    rows = each.select(month_start("date_key").alias("month_key"), "customer", *[c.alias(f"_{name}") for name, c in totals.items()])
    parts = rows.select("month_key", F.inline(F.array(
        F.struct("customer", *[F.lit(None).cast("bigint").alias(name) for name in totals]),
        F.struct(F.lit(None).cast("binary").alias("customer"), *[F.col(f"_{name}").alias(name) for name in totals]))))
    months = parts.groupBy("month_key").agg(
        F.sum("orders").alias("total_orders"), F.sum("known").alias("unique_customers"),
        F.sum("revenue").alias("total_revenue_vnd"), F.sum("net").alias("net_revenue_vnd"),
        F.countDistinct("customer").alias("monthly_distinct_customers"))
    # As a lookup of the month gives it: orders without a day have no month to look up.
    true_count = F.when(F.col("month_key").isNotNull(), F.col("monthly_distinct_customers")).alias("monthly_distinct_customers")
    sums = ("month_key", "total_orders", "unique_customers", "total_revenue_vnd", "net_revenue_vnd")
    return monthly_growth(months.select(*sums, safe_ratio("total_revenue_vnd", "total_orders").alias("avg_order_value_vnd"), true_count))


def monthly_sums(daily: DataFrame) -> DataFrame:
    """Totals of whole months."""
    sums = daily.groupBy(month_start("date_key").alias("month_key")).agg(
        *[F.sum(c).alias(c) for c in ("total_orders", "unique_customers", "total_revenue_vnd", "net_revenue_vnd")])
    return sums.withColumn("avg_order_value_vnd", safe_ratio("total_revenue_vnd", "total_orders"))


def monthly_growth(monthly: DataFrame) -> DataFrame:
    return with_growth(monthly, "month_key", "total_revenue_vnd", "prev_month_revenue_vnd", "mom_growth_rate")


def fct_reconciliation(pos: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Till and online revenue against payments received, per day.

    The three sources are tagged and summed in one aggregate.
    """
    amount = F.col("total_amount_vnd")
    tagged = union_all(
        _tagged(pos, "txn_date", "pos", amount),
        _tagged(orders.where(~rules.is_cancelled("status")), F.to_date("order_date"), "ecommerce", amount),
        _tagged(payments.where("status = 'success'"), "payment_date", "payments", F.col("amount_vnd")))
    wide = pivot_sum(tagged, "date_key", "source", {
        "pos": "pos_revenue_vnd", "ecommerce": "ecom_revenue_vnd", "payments": "payment_revenue_vnd"}, "total_vnd")
    wide = wide.withColumn("expected_total_vnd", F.col("pos_revenue_vnd") + F.col("ecom_revenue_vnd"))
    gap = F.col("expected_total_vnd") - F.col("payment_revenue_vnd")
    share = safe_ratio(F.abs(gap), "expected_total_vnd")
    return wide.withColumns({
        "discrepancy_vnd": gap, "discrepancy_pct": share,
        "reconciliation_status": F.when(share > 0.01, "ALERT").otherwise("OK")})


def _tagged(df: DataFrame, day: str | Column, source: str, amount: Column) -> DataFrame:
    day = F.col(day) if isinstance(day, str) else day
    return df.select(day.alias("date_key"), F.lit(source).alias("source"), amount.alias("total_vnd"))


# --- marketing --------------------------------------------------------------

def fct_campaign_performance(sessions: DataFrame) -> DataFrame:
    return (
        sessions.where("utm_campaign IS NOT NULL")
        .groupBy(F.col("utm_campaign").alias("campaign"), F.col("utm_source").alias("source"),
                 F.col("utm_medium").alias("medium"), F.col("session_date").alias("date_key"))
        .agg(F.count("*").alias("total_sessions"),
             F.countDistinct("ecom_customer_id").alias("unique_visitors"),
             F.sum("page_views").alias("total_page_views"),
             count_where(F.col("has_conversion")).alias("conversions"),
             exact_mean("session_duration_sec").alias("avg_session_duration_sec"),
             exact_mean("page_views").alias("avg_pages_per_session"),
             count_where(F.col("add_to_carts") > 0).alias("sessions_with_cart"))
        .withColumn("conversion_rate", safe_ratio("conversions", "total_sessions"))
    )


def fct_funnel_daily(sessions: DataFrame) -> DataFrame:
    funnel = sessions.groupBy(F.col("session_date").alias("date_key"), "referrer", "device_type", "country").agg(
        F.count("*").alias("total_sessions"),
        count_where(F.col("page_views") > 0).alias("sessions_with_view"),
        count_where(F.col("searches") > 0).alias("sessions_with_search"),
        count_where(F.col("add_to_carts") > 0).alias("sessions_with_cart"),
        count_where(F.col("has_conversion")).alias("sessions_with_purchase"))
    return funnel.withColumns({
        "view_to_cart_rate": safe_ratio("sessions_with_cart", "sessions_with_view"),
        "cart_to_purchase_rate": safe_ratio("sessions_with_purchase", "sessions_with_cart"),
        "overall_conversion_rate": safe_ratio("sessions_with_purchase", "total_sessions")})


# --- operations -------------------------------------------------------------

def fct_inventory_alerts(stock: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    newest = latest_snapshot(stock, SNAPSHOT_TIES)
    short = newest.where(F.col("qty_available") < F.col("reorder_point"))
    levels = ("qty_available", "safety_stock_threshold", "reorder_point")
    return with_dims(
        short,
        (products.select("product_id", "product_name", "category_l1"), "product_id"),
        (stores.select("store_id", "store_name", "region"), "store_id"),
    ).select(
        F.col("snapshot_date").alias("date_key"), "store_id", "store_name", "region", "sku", "product_name",
        "category_l1", "qty_on_hand", "qty_reserved", *levels,
        rules.stock_status(*levels).alias("stock_status"),
        rules.stock_severity(*levels).alias("alert_severity"))


RATIOS = ("revenue_per_staff_vnd", "revenue_per_sqm_vnd", "orders_per_staff")
RANKS = ("rank_in_region", "rank_overall")


def fct_store_performance(daily: DataFrame, stores: DataFrame) -> DataFrame:
    """Daily scorecard per store, ranked by revenue in its region and overall."""
    shop = daily.where("channel = 'pos'").select(
        "date_key", "store_id", "total_orders", "unique_customers", "total_revenue_vnd", "net_revenue_vnd",
        "avg_order_value_vnd", "total_items_sold")
    details = stores.select("store_id", "store_name", "region", "region_vi", "city", "store_size", "staff_count", "sqm")
    # A day has one row per store, so its group is as small as the list of stores. Both ranks share one shuffle by day;
    # the ratios follow after it.
    best = F.col("total_revenue_vnd").desc_nulls_last()
    ranked = with_dims(shop, (details, "store_id")).withColumns({
        "rank_in_region": F.rank().over(Window.partitionBy("date_key", "region").orderBy(best)),
        "rank_overall": F.rank().over(Window.partitionBy("date_key").orderBy(best))})
    scored = ranked.withColumns({
        "revenue_per_staff_vnd": safe_ratio("total_revenue_vnd", "staff_count"),
        "revenue_per_sqm_vnd": safe_ratio("total_revenue_vnd", "sqm"),
        "orders_per_staff": safe_ratio("total_orders", "staff_count")})
    return scored.select(*[c for c in ranked.columns if c not in ("sqm", *RANKS)], *RATIOS, *RANKS)


# --- finer revenue grains ---------------------------------------------------

def revenue_by_category(pos: DataFrame, products: DataFrame) -> DataFrame:
    """Item revenue per day, store, channel and product category.

    Items are summed per product before the lookup, so the join handles one row per
    product, store and day instead of one per item.
    """
    items = pos.select(F.col("txn_date").alias("date_key"), "store_id", F.explode("items").alias("item"))
    per_product = items.groupBy("date_key", "store_id", F.col("item.product_id").alias("product_id")).agg(
        F.sum("item.quantity").alias("quantity"), F.sum("item.amount_vnd").alias("revenue_vnd"))
    looked_up = with_dims(per_product, (products.select("product_id", "category_l1"), "product_id"))
    return (looked_up.groupBy("date_key", "store_id", F.lit("pos").alias("channel"), "category_l1")
            .agg(F.sum("quantity").alias("quantity"), F.sum("revenue_vnd").alias("revenue_vnd")))


def revenue_monthly_region(daily: DataFrame, stores: DataFrame) -> DataFrame:
    """Online revenue has no store and is reported as region ``Online``."""
    placed = with_dims(daily, (stores.select("store_id", "region"), "store_id"))
    region = F.when(F.col("channel") == "ecommerce", "Online").otherwise(F.col("region")).alias("region")
    return placed.groupBy(month_start("date_key").alias("month_key"), region).agg(
        F.sum("total_orders").alias("total_orders"), F.sum("total_revenue_vnd").alias("total_revenue_vnd"),
        F.sum("net_revenue_vnd").alias("net_revenue_vnd"))


def delivery_sla(shipments: DataFrame, hours: int) -> DataFrame:
    """Share delivered within the limit per partner and order day; undelivered is late."""
    limit = F.col("ordered_at") + F.expr(f"INTERVAL {int(hours)} HOURS")
    on_time = count_where(F.coalesce(F.col("delivered_at") <= limit, F.lit(False)))
    return (shipments.groupBy("partner", F.to_date("ordered_at").alias("date_key"))
            .agg(F.count("*").alias("shipments"), on_time.alias("on_time"))
            .withColumn("on_time_rate", safe_ratio("on_time", "shipments")))

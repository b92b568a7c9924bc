import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.functions import columns as C
from martloom.functions import rules
from martloom.functions.sql_functions import register_functions
from martloom.operators.shaping import aggregate_rule, date_spine


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_phone_forms(spark):
    phones = ["0912345678", "+84912345678", "84912345678", "0912 345 678", "0912-345-678", "8412345678", None]
    df = spark.createDataFrame([(p,) for p in phones], "p string")
    assert values(df, C.phone_digits("p")) == [
        "0912345678", "0912345678", "0912345678", "0912345678", "0912345678", "012345678", None]
    # A ten-digit number starting with 84 is a local one for this rule.
    assert values(df, C.phone_normalize("p")) == [
        "0912345678", "0912345678", "0912345678", "0912345678", "0912345678", "8412345678", None]


def test_order_filter_drops_null_zero_and_negative(spark):
    rows = [("a", "c", 1.0), (None, "c", 1.0), ("b", None, 1.0), ("c", "c", 0.0), ("d", "c", -1.0), ("e", "c", None)]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, amount double")
    assert values(df.where(rules.order_filter()), "order_id") == ["a"]


def test_cancelled_filter_drops_null_status(spark):
    df = spark.createDataFrame([("cancelled",), ("returned",), ("pending",), (None,)], "status string")
    assert values(df.where(~rules.is_cancelled()), "status") == ["pending"]


@pytest.mark.parametrize("gateway, code, status", [
    ("vnpay", "00", "success"), ("vnpay", "07", "fraud_suspected"), ("vnpay", "99", "unknown"), ("vnpay", None, "unknown"),
    ("momo", "0", "success"), ("momo", "1006", "user_cancelled"), ("momo", "1", "failed"),
    ("card", "DECLINED", "failed"), ("card", "REFUNDED", "refunded"), ("card", "x", "pending")])
def test_gateway_status(spark, gateway, code, status):
    df = spark.createDataFrame([(code,)], "code string")
    assert values(df, rules.gateway_status(gateway, "code")) == [status]


def test_stock_bounds_differ_between_mart_and_shared_rule(spark):
    df = spark.createDataFrame([(q, 10, 20) for q in (-1, 0, 10, 20, 21)], "q int, s int, r int")
    assert values(df, rules.stock_status("q", "s", "r")) == [
        "OUT_OF_STOCK", "OUT_OF_STOCK", "REORDER_NEEDED", "OK", "OK"]
    assert values(df, rules.inventory_alert("q", "s", "r")) == [
        "OUT_OF_STOCK", "OUT_OF_STOCK", "LOW_STOCK", "REORDER", None]


def test_drift(spark):
    df = spark.createDataFrame([(0, 0), (0, 5), (200, 198), (100, 97), (100, 50), (100, 0)], "b bigint, s bigint")
    drift = df.select(rules.drift_pct("b", "s").alias("discrepancy_pct"))
    assert values(drift, "discrepancy_pct") == [0.0, 100.0, 1.0, 3.0, 50.0, 100.0]
    assert values(drift, rules.reconciliation_alert()) == ["OK", "CRITICAL", "OK", "WARNING", "CRITICAL", "CRITICAL"]


def test_band_overlap_goes_to_first_band(spark):
    scores = [(2, 4, 4), (3, 3, 3), (1, 1, 3), (5, 1, 1), (5, 1, 5), (2, 1, 1)]
    df = spark.createDataFrame(scores, "recency_score int, frequency_score int, monetary_score int")
    assert values(df, rules.rfm_band_segment()) == ["Champion", "Loyal", "New", "Hibernating", "Lost", None]


def test_bands_stay_inside_the_scale():
    for ranges in rules.RFM_BANDS.values():
        assert all(1 <= low <= high <= 5 for low, high in ranges)


def test_dates(spark):
    df = spark.createDataFrame([("2024-12-31",), ("31/12/2024",), ("31-12",), ("",), (None,)], "d string")
    day = dt.datetime(2024, 12, 31)
    assert values(df, C.parse_any_date("d")) == [day, day, None, None, None]
    local = spark.createDataFrame([(dt.datetime(2024, 1, 1, 6),)], "t timestamp")
    assert values(local, C.to_utc("t")) == [dt.datetime(2023, 12, 31, 23)]


def test_calendar_has_every_day_and_iso_weeks(spark):
    days = date_spine(spark, dt.date(2022, 1, 1), dt.date(2026, 12, 31))
    assert days.count() == 1826
    new_year = days.where("date_key = '2023-01-01'").withColumns(C.calendar_parts("date_key")).first()
    assert (new_year["day_of_week"], new_year["week_of_year"], new_year["is_weekend"]) == (7, 52, True)
    assert (new_year["year_quarter"], new_year["year_month"], new_year["day_name"]) == ("2023-Q1", "2023-01", "Sunday")


def test_ratios_and_means(spark):
    df = spark.createDataFrame([(3, 2), (1, 0), (1, None)], "n bigint, d bigint")
    assert values(df, C.safe_ratio("n", "d")) == [1.5, None, None]
    assert df.agg(C.exact_mean("d")).first()[0] == 1.0


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    assert len(set(values(df, C.surrogate_key("x", "y")))) == 3


def test_rule_driven_aggregate(spark):
    rows = [("2024-01-01", "s", "pos", 10.0, 1.0), ("2024-01-01", "s", "pos", 30.0, 2.0), ("2024-01-01", "s", "web", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "revenue_date string, store_id string, channel string, amount double, discount double")
    (row,) = aggregate_rule(df, rules.REVENUE_DAILY, "amount > 0").collect()
    assert (row["order_count"], row["gross_revenue"], row["net_revenue"], row["avg_order_value"]) == (2, 40.0, 37.0, 20.0)


def test_sql_functions_agree_with_columns(spark):
    register_functions(spark)
    df = spark.createDataFrame([("+84 912-345678", " A@B.c ", 3, 5.0)], "phone string, email string, q int, pct double")
    row = df.select(
        (F.expr("phone_digits(phone)") == C.phone_digits("phone")).alias("a"),
        (F.expr("email_normalize(email)") == C.email_normalize("email")).alias("b"),
        (F.expr("inventory_alert(q, 3, 9)") == rules.inventory_alert("q", F.lit(3), F.lit(9))).alias("c"),
        (F.expr("reconciliation_alert(pct)") == rules.reconciliation_alert("pct")).alias("d")).first()
    assert all(row)


def test_segments_need_every_score_they_ask_for(spark):
    def segment(r, f, m):
        """The mart's definition; a comparison with null is no match."""
        least = lambda x, n: x is not None and x >= n
        most = lambda x, n: x is not None and x <= n
        cases = [("Champion", least(r, 4) and least(f, 4) and least(m, 4)), ("Loyal", least(r, 3) and least(f, 3)),
                 ("New Customer", least(r, 4) and most(f, 2)), ("At Risk", most(r, 2) and least(f, 3)),
                 ("Hibernating", most(r, 2) and most(f, 2) and least(m, 3)), ("Lost", most(r, 1))]
        return next((name for name, fits in cases if fits), "Regular")

    scores = [None, 1, 2, 3, 4, 5]
    every = [(r, f, m) for r in scores for f in scores for m in scores]
    df = spark.createDataFrame(every, "recency_score int, frequency_score int, monetary_score int")
    got = df.withColumn("s", rules.rfm_segment()).collect()
    assert all(x.s == segment(*x[:3]) for x in got)


def test_every_sql_function_equals_its_column(spark):
    register_functions(spark)
    numbers = [None, -1, 0, 1, 2, 3, 4, 5]
    grid = spark.createDataFrame([(a, b, c) for a in numbers for b in numbers for c in numbers], "a int, b int, c int")
    for name, column in (("rfm_segment", rules.rfm_segment), ("rfm_band_segment", rules.rfm_band_segment), ("stock_status", rules.stock_status),
                         ("stock_severity", rules.stock_severity), ("inventory_alert", rules.inventory_alert)):
        assert grid.where(~F.expr(f"{name}(a, b, c)").eqNullSafe(column("a", "b", "c"))).count() == 0, name
    texts = [None, "", "00", "07", "09", "0", "1006", "SETTLED", "DECLINED", "REFUNDED", "x", "0912345678", "+84912345678", "84912345678", "0912-345 678",
             "8412345678", "/flash-sale?x=1", " A@B.c "]
    words = spark.createDataFrame([(t, s) for t in texts for s in (True, False, None)], "t string, s boolean")
    pairs = [("phone_digits(t)", C.phone_digits("t")), ("phone_normalize(t)", C.phone_normalize("t")), ("is_flash_sale(t)", rules.is_flash_sale("t")),
             ("customer_type(t, s)", rules.customer_type("t", "s"))]
    for gateway in rules.GATEWAY_STATUS:
        pairs += [(f"{gateway}_status(t)", rules.gateway_status(gateway, "t")), (f"is_{gateway}_success(t)", rules.is_success_code(gateway, "t"))]
    for call, column in pairs:
        assert words.where(~F.expr(call).eqNullSafe(column)).count() == 0, call

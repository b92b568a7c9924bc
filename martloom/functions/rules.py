"""Business rules shared by the batch models and the live windows.

Each rule is a constant plus a function that compiles it to a Column, so both
paths evaluate the same expression.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.columns import ColumnLike, as_col

# --- fixed values: statuses, codes, thresholds, bands -----------------------

COMPLETED_STATUSES = ["delivered", "completed"]
CANCELLED_STATUSES = ["cancelled", "returned"]

SUCCESS_CODES = {"vnpay": "00", "momo": "0", "card": "SETTLED"}

GATEWAY_STATUS = {
    "vnpay": ({"00": "success", "07": "fraud_suspected", "09": "failed"}, "unknown"),
    "momo": ({"0": "success", "1006": "user_cancelled"}, "failed"),
    "card": ({"SETTLED": "success", "DECLINED": "failed", "REFUNDED": "refunded"}, "pending"),
}

RECONCILIATION_THRESHOLD_PCT = 1.0

SESSION_TIMEOUT_MINUTES = 30
FLASH_SALE_PAGE = "flash-sale"

# stock at or below nothing, below the safety stock, below the reorder point, above
STOCK_STATUS_LABELS = ("OUT_OF_STOCK", "LOW_STOCK", "REORDER_NEEDED", "OK")
STOCK_SEVERITY_LABELS = ("Critical", "High", "Medium", "Low")

# the alert that holds where stock is at or below the limit, first fit first; None is nothing left
STOCK_ALERTS = {"OUT_OF_STOCK": None, "LOW_STOCK": "safety", "REORDER": "reorder"}

# the alert that holds beyond so many times the threshold, first fit first
RECONCILIATION_ALERTS = {"CRITICAL": 3, "WARNING": 1}
RECONCILIATION_FINE = "OK"

# what a valid order's columns must satisfy
ORDER_VALIDATIONS = {"order_id": "IS NOT NULL", "customer_id": "IS NOT NULL", "amount": "> 0"}

REGION_VI = {"North": "Miền Bắc", "Central": "Miền Trung", "South": "Miền Nam"}

# segment -> (recency, frequency, monetary) score ranges; earlier segments win
RFM_BANDS = {
    "Champion": ((1, 2), (4, 5), (4, 5)),
    "Loyal": ((2, 4), (3, 5), (3, 5)),
    "New": ((1, 1), (1, 1), (1, 5)),
    "At Risk": ((3, 5), (3, 5), (3, 5)),
    "Hibernating": ((4, 5), (1, 2), (1, 2)),
    "Lost": ((5, 5), (1, 5), (1, 5)),
}

# segment -> (recency, frequency, monetary) score ranges of the customer mart, an open end being None;
# earlier segments win, all others are Regular
RFM_SEGMENTS = {
    "Champion": ((4, None), (4, None), (4, None)),
    "Loyal": ((3, None), (3, None), None),
    "New Customer": ((4, None), (None, 2), None),
    "At Risk": ((None, 2), (3, None), None),
    "Hibernating": ((None, 2), (None, 2), (3, None)),
    "Lost": ((None, 1), None, None),
}


@dataclass(frozen=True)
class AggregateRule:
    """Grouping keys and named metric expressions (SQL text)."""

    name: str
    keys: tuple[str, ...]
    metrics: Mapping[str, str]


REVENUE_DAILY = AggregateRule(
    name="revenue_daily",
    keys=("revenue_date", "store_id", "channel"),
    metrics={
        "order_count": "count(*)",
        "gross_revenue": "sum(amount)",
        "net_revenue": "sum(amount - discount)",
        "avg_order_value": "avg(amount)",
    },
)


# --- orders -----------------------------------------------------------------

def order_filter() -> Column:
    """An order counts when it has an id, a customer and a positive amount."""
    return reduce(Column.__and__, [F.expr(f"{name} {test}") for name, test in ORDER_VALIDATIONS.items()])


def is_completed(status: ColumnLike = "status") -> Column:
    return as_col(status).isin(COMPLETED_STATUSES)


def is_cancelled(status: ColumnLike = "status") -> Column:
    return as_col(status).isin(CANCELLED_STATUSES)


def is_flash_sale(url: ColumnLike = "page_url") -> Column:
    return as_col(url).contains(FLASH_SALE_PAGE)


# --- payments ---------------------------------------------------------------

def gateway_status(gateway: str, code: ColumnLike) -> Column:
    """Gateway-specific result code to the common status."""
    mapping, fallback = GATEWAY_STATUS[gateway]
    raw = as_col(code).cast("string")
    hits = [F.when(raw == key, F.lit(status)) for key, status in mapping.items()]
    return F.coalesce(*hits, F.lit(fallback))


def is_success_code(gateway: str, code: ColumnLike) -> Column:
    return as_col(code).cast("string") == F.lit(SUCCESS_CODES[gateway])


# --- customers --------------------------------------------------------------

def is_omnichannel(member_id: ColumnLike, in_store: ColumnLike) -> Column:
    return as_col(member_id).isNotNull() & as_col(in_store)


def customer_type(member_id: ColumnLike, in_store: ColumnLike) -> Column:
    member, store = as_col(member_id).isNotNull(), as_col(in_store)
    return (
        F.when(store, F.when(member, "omnichannel").otherwise("offline_online"))
        .otherwise(F.when(member, "online_loyalty").otherwise("online_only"))
    )


def rfm_segment(r: ColumnLike = "recency_score", f: ColumnLike = "frequency_score",
                m: ColumnLike = "monetary_score") -> Column:
    """Segment of the customer mart. A score that a segment asks for and that is null keeps the segment off."""
    return F.coalesce(_first_band(RFM_SEGMENTS, (r, f, m)), F.lit("Regular"))


def rfm_band_segment(r: ColumnLike = "recency_score", f: ColumnLike = "frequency_score",
                     m: ColumnLike = "monetary_score") -> Column:
    """Segment by score bands; overlaps go to the earlier band, no band gives null.

    The band table is a constant of six rows, so the range join folds into one
    expression: no shuffle and no row growth.
    """
    return _first_band(RFM_BANDS, (r, f, m))


def _first_band(bands: Mapping[str, tuple], scores: tuple[ColumnLike, ...]) -> Column:
    hits = []
    for name, ranges in bands.items():
        inside = F.lit(True)
        for score, (low, high) in ((as_col(s), ends) for s, ends in zip(scores, ranges) if ends):
            if low is not None:
                inside = inside & (score >= low)
            if high is not None:
                inside = inside & (score <= high)
        hits.append(F.when(inside, F.lit(name)))
    return F.coalesce(*hits)


# --- stock ------------------------------------------------------------------

def stock_status(qty: ColumnLike, safety: ColumnLike, reorder: ColumnLike) -> Column:
    """Mart rule: thresholds are exclusive."""
    return _stock_ladder(qty, safety, reorder, STOCK_STATUS_LABELS)


def stock_severity(qty: ColumnLike, safety: ColumnLike, reorder: ColumnLike) -> Column:
    return _stock_ladder(qty, safety, reorder, STOCK_SEVERITY_LABELS)


def _stock_ladder(qty: ColumnLike, safety: ColumnLike, reorder: ColumnLike,
                  labels: tuple[str, str, str, str]) -> Column:
    available = as_col(qty)
    empty, low, soon, fine = map(F.lit, labels)
    return (
        F.when(available <= 0, empty)
        .when(available < as_col(safety), low)
        .when(available < as_col(reorder), soon)
        .otherwise(fine)
    )


def inventory_alert(qty: ColumnLike = "qty_available", safety: ColumnLike = "safety_stock",
                    reorder: ColumnLike = "reorder_point") -> Column:
    """Shared rule: thresholds are inclusive, healthy stock gives null."""
    available = as_col(qty)
    limits = {None: F.lit(0), "safety": as_col(safety), "reorder": as_col(reorder)}
    return F.coalesce(*[F.when(available <= limits[limit], F.lit(label)) for label, limit in STOCK_ALERTS.items()])


# --- reconciliation ---------------------------------------------------------

def reconciliation_alert(pct: ColumnLike = "discrepancy_pct",
                         threshold: float = RECONCILIATION_THRESHOLD_PCT) -> Column:
    drift = as_col(pct)
    alerts = [F.when(drift > threshold * times, F.lit(label)) for label, times in RECONCILIATION_ALERTS.items()]
    return F.coalesce(*alerts, F.lit(RECONCILIATION_FINE))


def drift_pct(batch: ColumnLike, stream: ColumnLike) -> Column:
    """|batch - stream| in percent of batch, 4 decimals; 0/0 is 0 and x/0 is 100."""
    b, s = as_col(batch).cast("double"), as_col(stream).cast("double")
    share = F.abs(b - s) / F.nullif(b, F.lit(0.0)) * 100
    return F.round(F.coalesce(share, F.when(s == 0, F.lit(0.0)).otherwise(F.lit(100.0))), 4)


# --- stores -----------------------------------------------------------------

def region_vi(region: ColumnLike = "region") -> Column:
    return F.coalesce(*[F.when(as_col(region) == en, F.lit(vi)) for en, vi in REGION_VI.items()])


def store_size(sqm: ColumnLike = "sqm") -> Column:
    area = as_col(sqm)
    return F.when(area >= 1000, "Large").when(area >= 500, "Medium").otherwise("Small")

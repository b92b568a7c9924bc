"""The shared rules as SQL functions for analysts who query in SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from martloom.functions import rules

_QUOTED = {name: ", ".join(f"'{s}'" for s in values) for name, values in
           {"completed": rules.COMPLETED_STATUSES, "cancelled": rules.CANCELLED_STATUSES}.items()}

def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _first(cases: list[tuple[str, str]], fallback: str | None) -> str:
    """The label of the first test that holds, as one CASE."""
    whens = " ".join(f"WHEN {test} THEN {_text(label)}" for test, label in cases)
    return f"CASE {whens} ELSE {_text(fallback)} END"


def _gateway(name: str) -> str:
    """The gateway's code table as one CASE."""
    codes, fallback = rules.GATEWAY_STATUS[name]
    return _first([(f"code = {_text(code)}", status) for code, status in codes.items()], fallback)


def _bands(bands: Mapping[str, tuple], scores: tuple[str, ...], fallback: str | None) -> str:
    """A table of score ranges as one CASE, first fit first."""
    cases = []
    for label, ranges in bands.items():
        tests = [f"{score} {sign} {end}" for score, ends in zip(scores, ranges) if ends
                 for sign, end in zip((">=", "<="), ends) if end is not None]
        cases.append((" AND ".join(tests), label))
    return _first(cases, fallback)


_SCORES = "r INT, f INT, m INT"
_STOCK = "qty INT, safety INT, reorder INT"


def _stock(labels: tuple[str, str, str, str]) -> str:
    empty, low, soon, fine = map(_text, labels)
    return f"CASE WHEN qty <= 0 THEN {empty} WHEN qty < safety THEN {low} WHEN qty < reorder THEN {soon} ELSE {fine} END"


# name -> (typed arguments, return type, body); Spark inlines the body in the plan
SQL_FUNCTIONS = {
    "is_valid_order": (
        "order_id STRING, customer_id STRING, amount DECIMAL(18,2)", "BOOLEAN",
        " AND ".join(f"coalesce({name} {test}, false)" for name, test in rules.ORDER_VALIDATIONS.items())),
    "is_completed": ("status STRING", "BOOLEAN", f"status IN ({_QUOTED['completed']})"),
    "is_cancelled": ("status STRING", "BOOLEAN", f"status IN ({_QUOTED['cancelled']})"),
    "inventory_alert": (
        _STOCK, "STRING", _first([(f"qty <= {limit or 0}", label) for label, limit in rules.STOCK_ALERTS.items()], None)),
    "reconciliation_alert": (
        "pct DOUBLE", "STRING",
        _first([(f"pct > {rules.RECONCILIATION_THRESHOLD_PCT * times}D", label) for label, times in rules.RECONCILIATION_ALERTS.items()],
               rules.RECONCILIATION_FINE)),
    "phone_digits": (
        "phone STRING", "STRING",
        "regexp_replace(regexp_replace(phone, '[^0-9]', ''), '^84', '0')"),
    "phone_normalize": (
        "phone STRING", "STRING",
        "CASE WHEN startswith(phone, '+84') THEN '0' || substr(translate(phone, ' -', ''), 4) "
        "WHEN startswith(phone, '84') AND length(translate(phone, ' -', '')) >= 11 THEN '0' || substr(translate(phone, ' -', ''), 3) "
        "ELSE translate(phone, ' -', '') END"),
    **{f"{name}_status": ("code STRING", "STRING", _gateway(name)) for name in rules.GATEWAY_STATUS},
    **{f"is_{name}_success": ("code STRING", "BOOLEAN", f"code = {_text(code)}") for name, code in rules.SUCCESS_CODES.items()},
    "customer_type": (
        "member_id STRING, in_store BOOLEAN", "STRING",
        "if(in_store, if(member_id IS NULL, 'offline_online', 'omnichannel'), if(member_id IS NULL, 'online_only', 'online_loyalty'))"),
    "rfm_segment": (_SCORES, "STRING", _bands(rules.RFM_SEGMENTS, ("r", "f", "m"), "Regular")),
    "rfm_band_segment": (_SCORES, "STRING", _bands(rules.RFM_BANDS, ("r", "f", "m"), None)),
    "stock_status": (_STOCK, "STRING", _stock(rules.STOCK_STATUS_LABELS)),
    "stock_severity": (_STOCK, "STRING", _stock(rules.STOCK_SEVERITY_LABELS)),
    "is_flash_sale": ("url STRING", "BOOLEAN", f"contains(url, {_text(rules.FLASH_SALE_PAGE)})"),
    "email_normalize": ("email STRING", "STRING", "lower(trim(email))"),
    "safe_ratio": ("n DOUBLE, d DOUBLE", "DOUBLE", "n / nullif(d, 0D)"),
}


def register_functions(spark: SparkSession) -> list[str]:
    for name, (arguments, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) "
                  f"RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)

"""M rows: the 25 models."""

from __future__ import annotations

from martloom.catalog.registry import lake_query

# The items array has no counterpart in the flat check table.
_LEFT_OUT = {"stg_pos__transactions": "items"}

_MODELS = {
    "m1": "stg_pos__transactions", "m2": "stg_ecommerce__orders", "m3": "stg_ecommerce__customers",
    "m4": "stg_payments__vnpay", "m5": "stg_payments__momo", "m6": "stg_payments__card",
    "m7": "stg_payments__consolidated", "m8": "stg_clickstream__events", "m9": "stg_inventory__stock_levels",
    "m10": "stg_loyalty__members", "m11": "int_customers_unified", "m12": "int_orders_all_channels",
    "m13": "int_customer_metrics", "m14": "int_sessions", "m15": "dim_customers", "m16": "dim_stores",
    "m17": "dim_products", "m18": "dim_date", "m19": "fct_revenue_monthly", "m20": "fct_reconciliation",
    "m21": "fct_revenue_daily", "m22": "fct_campaign_performance", "m23": "fct_funnel_daily",
    "m24": "fct_inventory_alerts", "m25": "fct_store_performance",
}


def _register(number: str, model: str) -> None:
    hidden = _LEFT_OUT.get(model)
    columns = "* EXCLUDE (product_id)" if hidden else "*"

    @lake_query(f"{number}_{model}", f"SELECT {columns} FROM {model}")
    def run(lake):
        frame = lake[model]
        return frame.drop(hidden) if hidden else frame


for _number, _model in _MODELS.items():
    _register(_number, _model)

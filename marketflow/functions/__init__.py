"""Column expressions shared by the staging models and marts."""

from marketflow.functions.exact import idiv, round_div, to_decimal
from marketflow.functions.prices import (
    est_hours_to_fill,
    max_profit_per_limit,
    price_age_minutes,
    profit_per_item,
    spread_gp,
    spread_pct,
    tax_gp,
)
from marketflow.functions.time import as_of_column, instant, micros_between, ts_literal

__all__ = [
    "idiv", "round_div", "to_decimal",
    "spread_gp", "spread_pct", "tax_gp", "profit_per_item", "max_profit_per_limit",
    "est_hours_to_fill", "price_age_minutes",
    "instant", "micros_between", "as_of_column", "ts_literal",
]

"""Price, spread, tax and age expressions of the staging models and the flip mart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketflow.functions.exact import _c, idiv, round_div, round_ratio, to_decimal
from marketflow.functions.time import micros_between

# Fixed values of the sale-tax rule: 2 % of the sale price (price div 50),
# untaxed below 50 gp, capped at 5,000,000 gp per item.
TAX_PRICE_DIVISOR = 50
TAX_FREE_BELOW_GP = 50
TAX_CAP_GP = 5_000_000

# Defaults of the tunable flip-mart thresholds.
HIGH_VALUE_THRESHOLD_GP = 1_000_000
STALE_SPREAD_PCT = 50
STALE_VOLUME_FLOOR = 5


def spread_gp(high, low) -> Column:
    """``high - low``; NULL unless both sides are present (NULL propagation)."""
    return _c(high) - _c(low)


def spread_pct(high, low) -> Column:
    """``round((high - low) / low * 100, 2)`` as DECIMAL(14,2); NULL unless low > 0
    and high is present.  Negative spreads keep their sign."""
    high, low = _c(high).cast("long"), _c(low).cast("long")
    return F.when((low > 0) & high.isNotNull(), round_ratio((high - low) * 100, low, 2, 14))


def tax_gp(high, is_exempt, free_below: int = TAX_FREE_BELOW_GP,
           cap: int = TAX_CAP_GP) -> Column:
    """Sale tax per item (LONG): 0 when exempt or high < 50, else
    ``least(high div 50, cap)``.  ``least`` skips NULLs, as in the reference."""
    high = _c(high)
    return (F.when(_c(is_exempt), F.lit(0).cast("long"))
            .when(high < free_below, F.lit(0).cast("long"))
            .otherwise(F.least(idiv(high, TAX_PRICE_DIVISOR), F.lit(cap).cast("long"))))


def profit_per_item(spread, tax) -> Column:
    return _c(spread).cast("long") - _c(tax)


def max_profit_per_limit(profit, buy_limit) -> Column:
    return _c(profit) * F.coalesce(_c(buy_limit), F.lit(0)).cast("long")


def est_hours_to_fill(buy_limit, volume_per_hour) -> Column:
    """``round(buy_limit / nullif(volume_per_hour, 0), 2)`` as DECIMAL(12,2)."""
    vph = _c(volume_per_hour)
    return F.when(vph != 0, round_ratio(_c(buy_limit), vph, 2, 12))


def price_age_minutes(as_of: Column, high_time, low_time) -> Column:
    """Minutes since the staler of the two last trades, ``round(.., 1)`` as
    DECIMAL(18,1).  ``least`` ignores a NULL side; NULL when both are NULL."""
    oldest = F.least(_c(high_time), _c(low_time))
    delta = micros_between(as_of, oldest)
    # minutes * 10 = delta / 6,000,000 µs
    return to_decimal(round_div(delta, 6_000_000), 1, 18)


def is_high_value(high, threshold: int = HIGH_VALUE_THRESHOLD_GP) -> Column:
    return _c(high) >= threshold


def is_stale(spread_pct_col, volume_per_hour, spread_limit=STALE_SPREAD_PCT,
             volume_floor=STALE_VOLUME_FLOOR) -> Column:
    """Wide spread not backed by trading: a flag, never a filter."""
    return ((_c(spread_pct_col) > F.lit(spread_limit))
            & (F.coalesce(_c(volume_per_hour), F.lit(0)) < F.lit(volume_floor)))

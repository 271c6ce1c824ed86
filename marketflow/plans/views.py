"""Persistent views over the stored tables, as SQL text (W-6).

A view names the catalog's tables, so it is resolved when it is read: a query in any session, on
any later day, sees the newest version of every table it stands on.  ``now()`` is the time of the
read, unless the parameters fix an evaluation time.  The text computes what ``marts`` computes on
DataFrames, and a test holds the two against each other.
"""

from __future__ import annotations

from marketflow import schemas
from marketflow.functions.prices import TAX_CAP_GP, TAX_FREE_BELOW_GP, TAX_PRICE_DIVISOR
from marketflow.functions.time import as_of_text
from marketflow.plans.marts import MartParams


def rounded(num: str, den: str) -> str:
    """num / den, half away from zero, on BIGINT."""
    n, d = f"CAST({num} AS BIGINT)", f"CAST({den} AS BIGINT)"
    return f"((abs({n}) * 2 + abs({d})) div (abs({d}) * 2) * CAST(sign({n}) * sign({d}) AS BIGINT))"


def decimal(n: str, scale: int, precision: int) -> str:
    unit = f"CAST('{10 ** -scale:.{scale}f}' AS DECIMAL({scale},{scale}))"
    return f"CAST(CAST({n} AS DECIMAL(20,0)) * {unit} AS DECIMAL({precision},{scale}))"


def empty(schema) -> str:
    """A view's text before the first load of its table."""
    return "SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields) + " WHERE FALSE"


def appended(path: str, columns: list[str]) -> str:
    """All rows under a folder of an append-only table, listed when the view is read."""
    return f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM parquet.`{path}`"


def flips(db: str, params: MartParams) -> str:
    """F-1 over the per-item states and marts: each side has one row an item, and tables bucketed
    by item are joined as they lie."""
    now = as_of_text(params.as_of)
    bound = f"WHERE {{}} <= {now}" if params.as_of is not None else ""
    high = "q.high_price"
    return f"""
SELECT item_id, item_name, buy_limit, is_members, high_price, low_price, spread_gp,
  CASE WHEN low_price > 0 THEN {decimal(rounded("CAST(spread_gp AS BIGINT) * 10000", "low_price"), 2, 14)} END AS spread_pct,
  high_price_volume, low_price_volume, price_updated_at, volume_timestamp, tax_gp,
  spread_gp - tax_gp AS profit_per_item, (spread_gp - tax_gp) * coalesce(buy_limit, 0) AS max_profit_per_limit,
  is_tax_exempt, volume_per_hour, avg_volume_per_hour_24h,
  CASE WHEN volume_per_hour <> 0 THEN {decimal(rounded("CAST(buy_limit AS BIGINT) * 100", "volume_per_hour"), 2, 12)} END AS est_hours_to_fill_limit,
  mid_volatility_1h, mid_volatility_pct_1h, high_price >= {params.high_value_threshold_gp} AS is_high_value,
  {decimal(rounded(f"unix_micros({now}) - unix_micros(least(high_time, low_time))", "6000000"), 1, 18)} AS price_age_minutes,
  CASE WHEN low_price > 0 THEN {decimal(rounded("CAST(spread_gp AS BIGINT) * 10000", "low_price"), 2, 14)} END > {params.stale_spread_pct}
    AND coalesce(volume_per_hour, 0) < {params.stale_volume_floor} AS is_stale
FROM (
  SELECT q.item_id, d.item_name, d.buy_limit, d.is_members, {high}, q.low_price, {high} - q.low_price AS spread_gp,
    q.high_time, q.low_time, v.high_price_volume, v.low_price_volume, q.loaded_at AS price_updated_at,
    v.price_timestamp AS volume_timestamp, d.is_tax_exempt,
    CASE WHEN d.is_tax_exempt OR {high} < {TAX_FREE_BELOW_GP} THEN 0L
         ELSE least({high} div {TAX_PRICE_DIVISOR}, {TAX_CAP_GP}L) END AS tax_gp,
    l.volume_per_hour, l.avg_volume_per_hour_24h, s.mid_volatility_1h, s.mid_volatility_pct_1h
  FROM (SELECT * FROM {db}.latest_price {bound.format("loaded_at")}) q
  JOIN {db}.dim_items d ON q.item_id = d.item_id
  LEFT JOIN {db}.agg_item_liquidity l ON q.item_id = l.item_id
  LEFT JOIN (SELECT * FROM {db}.latest_5m {bound.format("price_timestamp")}) v ON q.item_id = v.item_id
  LEFT JOIN {db}.agg_item_volatility s ON q.item_id = s.item_id)
WHERE spread_gp > tax_gp AND low_price > 100 AND volume_per_hour > 0"""


def realized_fills(db: str) -> str:
    """R-1 over the stored fill log."""
    micros = "unix_micros(f.filled_at) - unix_micros(f.offer_placed_at)"
    cancelled = ", ".join(f"'{e}'" for e in schemas.CANCEL_EVENTS)
    return f"""
SELECT f.event_id, f.flip_id, f.leg, f.item_id, d.item_name, f.bot_version, f.event, f.requested_qty, f.filled_qty,
  CASE WHEN f.requested_qty > 0 THEN {decimal(rounded("CAST(f.filled_qty AS BIGINT) * 10000", "f.requested_qty"), 4, 14)} END AS fill_ratio,
  f.offer_price, f.avg_fill_price, CAST(f.avg_fill_price - f.offer_price AS DECIMAL(18,4)) AS slippage_gp, f.tax_paid,
  f.realized_profit, f.offer_placed_at, f.filled_at, {decimal(micros, 6, 20)} AS time_to_fill_seconds,
  {decimal(rounded(micros, "360000"), 4, 20)} AS time_to_fill_hours, f.monitor_ms, f.tolerance_ms, f.relist_count,
  f.event = 'filled' AS is_filled, f.event = 'partial' AS is_partial, f.event IN ({cancelled}) AS is_cancelled, f.recorded_at
FROM {db}.fill_events f LEFT JOIN {db}.dim_items d ON f.item_id = d.item_id"""

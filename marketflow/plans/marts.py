"""Marts (D-1 … D-4, F-1, R-1).

Every mart is a function from DataFrames to a lazy DataFrame; nothing is
collected.  All per-item marts are keyed by ``item_id``: their aggregations
shuffle once on ``item_id`` and the flip mart's joins reuse that partitioning.
``as_of`` replaces the reference's ``now()`` (``None`` = live); with a fixed
``as_of`` every feed is also bounded by ``<= as_of`` so history replays exactly.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions.exact import round_div, to_decimal
from marketflow.functions.prices import (
    HIGH_VALUE_THRESHOLD_GP,
    STALE_SPREAD_PCT,
    STALE_VOLUME_FLOOR,
    est_hours_to_fill,
    is_high_value,
    is_stale,
    max_profit_per_limit,
    price_age_minutes,
    profit_per_item,
    tax_gp,
)
from marketflow.functions.time import as_of_column, lower_bound, upper_bound
from marketflow.operators.latest import latest_per_key


@dataclasses.dataclass(frozen=True)
class MartParams:
    """Tunables of the marts; defaults are the reference's."""

    as_of: dt.datetime | None = None
    volatility_lookback: dt.timedelta = dt.timedelta(hours=1)
    liquidity_lookback: dt.timedelta = dt.timedelta(hours=24)
    # The reference's "latest hour" has no age bound (an item's last *active*
    # hour, however old).  Set this to bound it.
    latest_hour_max_age: dt.timedelta | None = None
    high_value_threshold_gp: int = HIGH_VALUE_THRESHOLD_GP
    stale_spread_pct: float = STALE_SPREAD_PCT
    stale_volume_floor: int = STALE_VOLUME_FLOOR


FLIP_COLUMNS = [
    # positions 1..15 are frozen; later columns are only ever appended
    "item_id", "item_name", "buy_limit", "is_members", "high_price", "low_price",
    "spread_gp", "spread_pct", "high_price_volume", "low_price_volume",
    "price_updated_at", "volume_timestamp", "tax_gp", "profit_per_item",
    "max_profit_per_limit", "is_tax_exempt", "volume_per_hour", "avg_volume_per_hour_24h",
    "est_hours_to_fill_limit", "mid_volatility_1h", "mid_volatility_pct_1h",
    "is_high_value", "price_age_minutes", "is_stale",
]


def dim_items(stg_mapping: DataFrame, tax_exempt: DataFrame,
              buy_limit_overrides: DataFrame) -> DataFrame:
    """D-1: mapping + seed flags.  Seeds join left on ``item_id`` (Catalyst
    broadcasts them when their size is under the broadcast threshold)."""
    te = tax_exempt.select("item_id", F.lit(True).alias("_exempt"))
    blo = buy_limit_overrides.select("item_id", F.col("buy_limit").alias("_override"))
    j = stg_mapping.join(te, "item_id", "left").join(blo, "item_id", "left")
    return j.select(
        "item_id", "item_name", "examine", "is_members", "low_alch_value", "high_alch_value",
        F.coalesce("_override", "buy_limit").alias("buy_limit"),
        "shop_value", "icon",
        F.col("_exempt").isNotNull().alias("is_tax_exempt"),
        F.col("loaded_at").alias("last_refreshed_at"))


def fct_prices(stg_5m: DataFrame, dim: DataFrame) -> DataFrame:
    """D-2: 5-minute facts of known items only (a semi join: adds no columns,
    never duplicates a fact row)."""
    return (stg_5m.join(dim.select("item_id"), "item_id", "left_semi")
            .select("item_id", "price_timestamp", "avg_high_price", "high_price_volume",
                    "avg_low_price", "low_price_volume", "spread_gp", "spread_pct", "loaded_at"))


def agg_item_liquidity(stg_1h: DataFrame, params: MartParams = MartParams()) -> DataFrame:
    """D-3: last active hour per item plus the trailing-window average.

    One scan and one shuffle: a single ``groupBy(item_id)`` computes both the
    latest hour (``max_by`` on the timestamp) and the windowed sum/count, with
    partial aggregation before the shuffle (a hot item costs one row per task).
    """
    hourly = stg_1h.filter(upper_bound(stg_1h, "price_timestamp", params.as_of))
    in_window = lower_bound(hourly, "price_timestamp", params.as_of, params.liquidity_lookback)
    # (item_id, price_timestamp) is the feed's key, so the three max_by pick the
    # same row; primitive buffers keep this a (partial) HashAggregate
    ts = "price_timestamp"
    agg = hourly.groupBy("item_id").agg(
        F.max(ts).alias("latest_hour_ts"),
        F.max_by("total_volume", ts).alias("volume_per_hour"),
        F.max_by("high_price_volume", ts).alias("high_volume_per_hour"),
        F.max_by("low_price_volume", ts).alias("low_volume_per_hour"),
        F.sum(F.when(in_window, F.col("total_volume"))).alias("_sum24"),
        F.count_if(in_window).alias("_n24"))
    out = agg.select(
        "item_id", "latest_hour_ts", "volume_per_hour", "high_volume_per_hour",
        "low_volume_per_hour",
        F.when(F.col("_n24") > 0, round_div("_sum24", "_n24")).alias("avg_volume_per_hour_24h"),
        F.when(F.col("_n24") > 0, F.col("_n24")).alias("hours_observed_24h"))
    if params.latest_hour_max_age is not None:
        keep = lower_bound(out, "latest_hour_ts", params.as_of, params.latest_hour_max_age)
        out = out.filter(keep)
    return out


def _stddev_hundredths(n, s, q):
    """round(100 * stddev_samp(mid)) for mid = s/2, exactly, from n, Σs, Σs².

    var(mid) = (n Σs² − (Σs)²) / (4 n (n−1)); a double square root gives the
    candidate r, then one exact DECIMAL comparison on each side moves it to the
    integer with (2r−1)²·D ≤ 40000·v < (2r+1)²·D (HALF_UP).  Runs once per item,
    after the aggregation.
    """
    dec = T.DecimalType(38, 0)
    v = n.cast(dec) * q - s.cast(dec) * s.cast(dec)
    d = (F.lit(4) * n * (n - 1)).cast(dec)
    r0 = F.floor(F.sqrt(v.cast("double") / d.cast("double")) * 100 + 0.5).cast("long")
    lhs = v * F.lit(40000).cast(dec)
    up = (F.lit(2) * r0 + 1).cast(dec)
    dn = (F.lit(2) * r0 - 1).cast(dec)
    r = (F.when(lhs >= up * up * d, r0 + 1)
         .when((r0 > 0) & (lhs < dn * dn * d), r0 - 1)
         .otherwise(r0))
    return F.when(n >= 2, r)


def agg_item_volatility(fct: DataFrame, params: MartParams = MartParams()) -> DataFrame:
    """D-4: trailing-window mean and sample stddev of the mid price per item."""
    h, l = F.col("avg_high_price"), F.col("avg_low_price")
    snaps = (fct.filter(h.isNotNull() & l.isNotNull()
                        & lower_bound(fct, "price_timestamp", params.as_of,
                                      params.volatility_lookback)
                        & upper_bound(fct, "price_timestamp", params.as_of))
             .select("item_id", "price_timestamp",
                     (h.cast("long") + l.cast("long")).alias("s")))
    agg = snaps.groupBy("item_id").agg(
        F.max("price_timestamp").alias("latest_snapshot_ts"),
        F.count(F.lit(1)).alias("n"),
        F.sum("s").alias("S"),
        F.sum(F.col("s").cast("decimal(19,0)") * F.col("s").cast("decimal(19,0)")).alias("Q"))
    n, S, Q = F.col("n"), F.col("S"), F.col("Q")
    mean100 = round_div(S * 50, n)           # round(100 * S / (2n))
    vol100 = _stddev_hundredths(n, S, Q)
    return (agg.select("item_id", "latest_snapshot_ts", n.alias("snapshots_used_1h"),
                       mean100.alias("_m"), vol100.alias("_v"))
            .select("item_id", "latest_snapshot_ts", "snapshots_used_1h",
                    to_decimal("_m", 2, 14).alias("mid_mean_1h"),
                    to_decimal("_v", 2, 14).alias("mid_volatility_1h"),
                    F.when((F.col("_m") > 0) & F.col("_v").isNotNull(),
                           to_decimal(round_div(F.col("_v") * 100_000, F.col("_m")), 3, 16))
                    .alias("mid_volatility_pct_1h")))


def current_prices(stg_latest: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Most recent /latest row per item (A-1 on ``loaded_at``)."""
    rows = stg_latest.filter(upper_bound(stg_latest, "loaded_at", as_of))
    return latest_per_key(rows, "item_id", "loaded_at",
                          ["high_price", "low_price", "spread_gp", "spread_pct",
                           "high_time", "low_time"])


def recent_volume(fct: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Most recent 5-minute volume per item (A-1 on ``price_timestamp``)."""
    rows = fct.filter(upper_bound(fct, "price_timestamp", as_of))
    return (latest_per_key(rows, "item_id", "price_timestamp",
                           ["high_price_volume", "low_price_volume"])
            .withColumnRenamed("price_timestamp", "volume_timestamp"))


def five_minute_summary(stg_5m: DataFrame, params: MartParams = MartParams()) -> DataFrame:
    """Newest volumes (A-1) and trailing volatility (D-4) per item from one scan and one
    aggregation of the 5-minute feed: the two 5-minute sides of the flip mart."""
    h, l, at = F.col("avg_high_price"), F.col("avg_low_price"), F.col("price_timestamp")
    s = h.cast("long") + l.cast("long")
    used = s.isNotNull() & lower_bound(stg_5m, "price_timestamp", params.as_of, params.volatility_lookback)
    square = s.cast("decimal(19,0)") * s.cast("decimal(19,0)")
    agg = stg_5m.filter(upper_bound(stg_5m, "price_timestamp", params.as_of)).groupBy("item_id").agg(
        F.max(at).alias("volume_timestamp"),
        F.max_by("high_price_volume", at).alias("high_price_volume"),
        F.max_by("low_price_volume", at).alias("low_price_volume"),
        F.count_if(used).alias("n"), F.sum(F.when(used, s)).alias("S"), F.sum(F.when(used, square)).alias("Q"))
    n, S, Q = F.col("n"), F.col("S"), F.col("Q")
    v = agg.select("*", F.when(n > 0, round_div(S * 50, n)).alias("_m"), _stddev_hundredths(n, S, Q).alias("_v"))
    return v.select(
        "item_id", "high_price_volume", "low_price_volume", "volume_timestamp",
        to_decimal("_v", 2, 14).alias("mid_volatility_1h"),
        F.when((F.col("_m") > 0) & F.col("_v").isNotNull(),
               to_decimal(round_div(F.col("_v") * 100_000, F.col("_m")), 3, 16)).alias("mid_volatility_pct_1h"))


def flip_opportunities(stg_latest: DataFrame, fct: DataFrame | None, dim: DataFrame,
                       liquidity: DataFrame, volatility: DataFrame | None,
                       params: MartParams = MartParams(), summary: DataFrame | None = None) -> DataFrame:
    """F-1: after-tax flip opportunities (24 columns, unordered; order at the consumer).

    The 5-minute sides are either ``fct`` and ``volatility`` (the jobs' small stored tables)
    or a ``five_minute_summary`` of the whole feed."""
    now = as_of_column(params.as_of)
    cp = current_prices(stg_latest, params.as_of)
    items = dim.select("item_id", "item_name", "buy_limit", "is_members", "is_tax_exempt")
    liq = liquidity.select("item_id", "volume_per_hour", "avg_volume_per_hour_24h")
    j = cp.join(items, "item_id", "inner").join(liq, "item_id", "left")
    if summary is not None:
        j = j.join(summary, "item_id", "left")
    else:
        vol = volatility.select("item_id", "mid_volatility_1h", "mid_volatility_pct_1h")
        j = j.join(recent_volume(fct, params.as_of), "item_id", "left").join(vol, "item_id", "left")
    tax = tax_gp("high_price", "is_tax_exempt")
    priced = j.select(
        "*",
        F.col("loaded_at").alias("price_updated_at"),
        tax.alias("tax_gp"),
        is_high_value("high_price", params.high_value_threshold_gp).alias("is_high_value"),
        price_age_minutes(now, "high_time", "low_time").alias("price_age_minutes"),
        is_stale("spread_pct", "volume_per_hour", params.stale_spread_pct,
                 params.stale_volume_floor).alias("is_stale"))
    profit = profit_per_item("spread_gp", "tax_gp")
    out = priced.select(
        *[c for c in FLIP_COLUMNS[:13]],
        profit.alias("profit_per_item"),
        max_profit_per_limit(profit, "buy_limit").alias("max_profit_per_limit"),
        "is_tax_exempt", "volume_per_hour", "avg_volume_per_hour_24h",
        est_hours_to_fill("buy_limit", "volume_per_hour").alias("est_hours_to_fill_limit"),
        "mid_volatility_1h", "mid_volatility_pct_1h", "is_high_value",
        "price_age_minutes", "is_stale")
    return out.filter((F.col("profit_per_item") > 0) & (F.col("low_price") > 100)
                      & (F.coalesce("volume_per_hour", F.lit(0)) > 0))


def realized_fills(stg_fills: DataFrame, dim: DataFrame) -> DataFrame:
    """R-1: fill events with item names and fill time in hours."""
    names = dim.select("item_id", "item_name")
    delta_us = (F.col("time_to_fill_seconds") * F.lit(1_000_000)).cast("long")
    j = stg_fills.join(names, "item_id", "left")
    return j.select(
        "event_id", "flip_id", "leg", "item_id", "item_name", "bot_version", "event",
        "requested_qty", "filled_qty", "fill_ratio", "offer_price", "avg_fill_price",
        "slippage_gp", "tax_paid", "realized_profit", "offer_placed_at", "filled_at",
        "time_to_fill_seconds",
        to_decimal(round_div(delta_us, 360_000), 4, 20).alias("time_to_fill_hours"),
        "monitor_ms", "tolerance_ms", "relist_count", "is_filled", "is_partial",
        "is_cancelled", "recorded_at")


def liquidity_from_parts(latest_hours: DataFrame, window_rows: DataFrame,
                         params: MartParams = MartParams()) -> DataFrame:
    """D-3 from a per-item state of the last active hour plus the rows of the
    trailing window only (the incremental job's form; same result as
    ``agg_item_liquidity`` over the full history)."""
    in_window = (window_rows.filter(lower_bound(window_rows, "price_timestamp", params.as_of,
                                                params.liquidity_lookback)
                                    & upper_bound(window_rows, "price_timestamp", params.as_of))
                 .groupBy("item_id")
                 .agg(F.sum("total_volume").alias("_s"), F.count(F.lit(1)).alias("_n")))
    latest = latest_hours.select(
        "item_id", F.col("price_timestamp").alias("latest_hour_ts"),
        F.col("total_volume").alias("volume_per_hour"),
        F.col("high_price_volume").alias("high_volume_per_hour"),
        F.col("low_price_volume").alias("low_volume_per_hour"))
    out = latest.join(in_window, "item_id", "left").select(
        "item_id", "latest_hour_ts", "volume_per_hour", "high_volume_per_hour",
        "low_volume_per_hour", round_div("_s", "_n").alias("avg_volume_per_hour_24h"),
        F.col("_n").alias("hours_observed_24h"))
    if params.latest_hour_max_age is not None:
        out = out.filter(lower_bound(out, "latest_hour_ts", params.as_of, params.latest_hour_max_age))
    return out

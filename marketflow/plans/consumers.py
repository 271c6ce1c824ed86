"""Consumer queries over the marts (O-1 … O-3, A-5, C-1 … C-8).

The reference documents these as capabilities (lane rules, feedback-loop
analyses) rather than SQL; the definitions chosen here are written next to each
function.  All are single aggregations or filters over the marts: every
``groupBy`` aggregates partially before its shuffle, so a hot item or flip id
costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.exact import round_div, to_decimal
from marketflow.functions.time import micros_between
from marketflow.operators.latest import latest_per_key


# --- sorts / limits ---------------------------------------------------------

def top_flips(flips: DataFrame, n: int = 20) -> DataFrame:
    """O-1/O-2: best opportunities by ``max_profit_per_limit DESC NULLS LAST``
    (``item_id`` breaks ties).  Plans as ``TakeOrderedAndProject``: each task
    keeps its own top ``n`` and only those reach the driver."""
    return flips.orderBy(F.col("max_profit_per_limit").desc_nulls_last(), "item_id").limit(n)


def recent_fills(fills: DataFrame, n: int = 10) -> DataFrame:
    """O-3: the latest fill events by ``recorded_at`` (``event_id`` breaks ties)."""
    return (fills.orderBy(F.col("recorded_at").desc(), F.col("event_id").desc()).limit(n)
            .select("event_id", "flip_id", "leg", "item_name", "event", "fill_ratio",
                    "slippage_gp", "time_to_fill_hours", "realized_profit", "recorded_at"))


def fills_count(raw_fills: DataFrame) -> DataFrame:
    """A-5: how many fill events have landed."""
    return raw_fills.agg(F.count(F.lit(1)).alias("n_events"))


# --- lanes (C-1 … C-3) ------------------------------------------------------

def _fresh(max_price_age_minutes):
    """C-3: drop quotes whose staler side is older than the limit (NULL age kept)."""
    if max_price_age_minutes is None:
        return F.lit(True)
    age = F.col("price_age_minutes")
    return age.isNull() | (age <= F.lit(max_price_age_minutes))


def standard_lane(flips: DataFrame, min_5m_volume: int = 50,
                  max_price_age_minutes: float | None = None) -> DataFrame:
    """C-1: regular items with recent two-sided 5-minute volume, not stale."""
    return flips.filter(
        ~F.col("is_high_value")
        & (F.coalesce("high_price_volume", F.lit(0)) > min_5m_volume)
        & (F.coalesce("low_price_volume", F.lit(0)) > min_5m_volume)
        & ~F.coalesce("is_stale", F.lit(False))
        & _fresh(max_price_age_minutes))


def high_value_lane(flips: DataFrame, min_volume_per_hour: int = 1,
                    max_est_hours: float = 24.0,
                    max_price_age_minutes: float | None = None) -> DataFrame:
    """C-2: expensive items gated on hourly liquidity and time-to-fill, never on
    5-minute volume; stale quotes skipped."""
    return flips.filter(
        F.col("is_high_value")
        & (F.coalesce("volume_per_hour", F.lit(0)) >= min_volume_per_hour)
        & (F.col("est_hours_to_fill_limit") <= F.lit(max_est_hours))
        & ~F.coalesce("is_stale", F.lit(False))
        & _fresh(max_price_age_minutes))


# --- feedback loop (C-4 … C-8) ----------------------------------------------

def _rate(part, whole):
    """round(part / whole, 4) as DECIMAL(10,4)."""
    return to_decimal(round_div(F.col(part) * 10_000, F.col(whole)), 4, 10)


def fill_rates_by_cadence(fills: DataFrame) -> DataFrame:
    """C-4: outcome rates per cadence (monitor interval, tolerance, relists) and
    bot build.  Deadline cancels are reported apart from manual and price-move
    cancels.  ``avg_fill_ratio`` averages the per-event ratio (events with a
    requested quantity only)."""
    ev = F.col("event")
    agg = fills.groupBy("monitor_ms", "tolerance_ms", "relist_count", "bot_version").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("is_filled")).alias("filled"),
        F.count_if(F.col("is_partial")).alias("partial"),
        F.count_if(F.col("is_cancelled")).alias("cancelled"),
        F.count_if(ev == "cancelled_deadline").alias("deadline_cancels"),
        F.count_if(ev == "cancelled_pricemove").alias("pricemove_cancels"),
        F.count_if(ev == "cancelled_manual").alias("manual_cancels"),
        F.sum((F.col("fill_ratio") * 10_000).cast("long")).alias("_ratio_sum"),
        F.count("fill_ratio").alias("_ratio_n"))
    return agg.select(
        "monitor_ms", "tolerance_ms", "relist_count", "bot_version", "events", "filled",
        "partial", "cancelled", "deadline_cancels", "pricemove_cancels", "manual_cancels",
        _rate("filled", "events").alias("fill_rate"),
        _rate("partial", "events").alias("partial_rate"),
        _rate("cancelled", "events").alias("cancel_rate"),
        _rate("deadline_cancels", "events").alias("deadline_cancel_rate"),
        F.when(F.col("_ratio_n") > 0,
               to_decimal(round_div("_ratio_sum", "_ratio_n"), 4, 14)).alias("avg_fill_ratio"))


def fill_time_vs_estimate(fills: DataFrame, flips: DataFrame) -> DataFrame:
    """C-5: actual mean time to fill (completed fills) against the mart's
    current ``est_hours_to_fill_limit`` for the same item."""
    done = fills.filter(F.col("is_filled") & F.col("time_to_fill_seconds").isNotNull())
    delta = micros_between("filled_at", "offer_placed_at")
    agg = done.groupBy("item_id").agg(F.count(F.lit(1)).alias("filled_events"),
                                      F.sum(delta).alias("_us"))
    avg_h = to_decimal(round_div(F.col("_us"), F.col("filled_events") * 360_000), 4, 20)
    est = flips.select("item_id", "item_name", "est_hours_to_fill_limit")
    return (agg.join(est, "item_id", "inner")
            .select("item_id", "item_name", "filled_events",
                    avg_h.alias("avg_time_to_fill_hours"), "est_hours_to_fill_limit")
            .withColumn("fill_time_gap_hours",
                        (F.col("avg_time_to_fill_hours") - F.col("est_hours_to_fill_limit"))
                        .cast("decimal(20,4)")))


def profit_realized_vs_predicted(fills: DataFrame, flips: DataFrame) -> DataFrame:
    """C-6: realized profit of closing (sell) legs against the mart's current
    ``profit_per_item`` times the units actually sold; NULL prediction when the
    item is not in the mart now."""
    sells = fills.filter(F.col("leg") == "sell")
    agg = sells.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("sell_events"),
        F.sum(F.col("filled_qty").cast("long")).alias("units_sold"),
        F.sum("realized_profit").alias("realized_profit"))
    pred = flips.select("item_id", "profit_per_item")
    predicted = F.col("profit_per_item") * F.col("units_sold")
    return (agg.join(pred, "item_id", "left")
            .select("item_id", "sell_events", "units_sold", "realized_profit", "profit_per_item",
                    predicted.alias("predicted_profit"),
                    (F.col("realized_profit") - predicted).alias("profit_gap")))


def buy_slippage(fills: DataFrame) -> DataFrame:
    """C-7: per-item buy-side slippage (negative = filled below the bid)."""
    buys = fills.filter((F.col("leg") == "buy") & F.col("slippage_gp").isNotNull())
    agg = buys.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("buy_fills"),
        F.sum((F.col("slippage_gp") * 10_000).cast("long")).alias("_s"),
        F.min("slippage_gp").alias("min_slippage_gp"),
        F.max("slippage_gp").alias("max_slippage_gp"),
        F.count_if(F.col("slippage_gp") < 0).alias("favourable_fills"))
    return agg.select("item_id", "buy_fills",
                      to_decimal(round_div("_s", "buy_fills"), 4, 18).alias("avg_slippage_gp"),
                      "min_slippage_gp", "max_slippage_gp", "favourable_fills")


_LEG_FIELDS = ["event_id", "item_id", "event", "filled_qty", "avg_fill_price",
               "offer_placed_at", "filled_at", "realized_profit"]


def flip_round_trips(fills: DataFrame) -> DataFrame:
    """C-8: both legs of a flip on one row.  Per leg the latest event (highest
    ``event_id``) is kept, limited before the shuffle, and the two legs are then put side by
    side with primitive aggregates.  ``hold_seconds`` runs from the buy offer to the sell
    fill; complete means both legs ended ``filled``."""
    last = latest_per_key(fills, ["flip_id", "leg"], "event_id", _LEG_FIELDS)
    agg = last.groupBy("flip_id").agg(*[F.max(F.when(F.col("leg") == leg, F.col(c))).alias(f"{leg}_{c}")
                                        for leg in ("buy", "sell") for c in _LEG_FIELDS])
    b, s = ({c: F.col(f"{leg}_{c}") for c in _LEG_FIELDS} for leg in ("buy", "sell"))
    hold = micros_between(s["filled_at"], b["offer_placed_at"])
    return agg.select(
        "flip_id",
        F.coalesce(b["item_id"], s["item_id"]).alias("item_id"),
        b["event_id"].alias("buy_event_id"), s["event_id"].alias("sell_event_id"),
        b["event"].alias("buy_event"), s["event"].alias("sell_event"),
        b["filled_qty"].alias("buy_filled_qty"), s["filled_qty"].alias("sell_filled_qty"),
        b["avg_fill_price"].alias("buy_fill_price"), s["avg_fill_price"].alias("sell_fill_price"),
        s["realized_profit"].alias("realized_profit"),
        (hold.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(6,6)"))
        .cast("decimal(20,6)").alias("hold_seconds"),
        (F.coalesce(b["event"] == "filled", F.lit(False))
         & F.coalesce(s["event"] == "filled", F.lit(False))).alias("is_complete"))

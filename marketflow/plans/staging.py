"""Staging models (P-1 … P-5): renames, derived columns, row filters over raw tables.

Each is a lazy projection + filter; Catalyst pushes the filter and the pruned
column list into the Parquet scan of the raw table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow import schemas
from marketflow.functions.exact import round_ratio
from marketflow.functions.prices import spread_gp, spread_pct
from marketflow.functions.time import micros_between


def stg_item_mapping(raw: DataFrame) -> DataFrame:
    return raw.select(
        "item_id",
        F.col("name").alias("item_name"),
        "examine",
        F.col("members").alias("is_members"),
        F.col("lowalch").alias("low_alch_value"),
        F.col("highalch").alias("high_alch_value"),
        "buy_limit",
        F.col("value").alias("shop_value"),
        "icon",
        "loaded_at")


def stg_prices_5m(raw: DataFrame) -> DataFrame:
    """Spreads per snapshot; rows with both prices NULL are dropped."""
    h, l = F.col("avg_high_price"), F.col("avg_low_price")
    return (raw.filter(h.isNotNull() | l.isNotNull())
            .select("item_id", "avg_high_price", "high_price_volume", "avg_low_price",
                    "low_price_volume", F.col("timestamp").alias("price_timestamp"), "loaded_at",
                    spread_gp(h, l).alias("spread_gp"),
                    spread_pct(h, l).alias("spread_pct")))


def stg_prices_latest(raw: DataFrame) -> DataFrame:
    h, l = F.col("high_price"), F.col("low_price")
    return (raw.filter(h.isNotNull() | l.isNotNull())
            .select("item_id", "high_price", "high_time", "low_price", "low_time", "loaded_at",
                    spread_gp(h, l).alias("spread_gp"),
                    spread_pct(h, l).alias("spread_pct")))


def stg_prices_1h(raw: DataFrame) -> DataFrame:
    """Hourly volume; hours with no volume on either side are dropped."""
    hv = F.coalesce(F.col("high_price_volume"), F.lit(0))
    lv = F.coalesce(F.col("low_price_volume"), F.lit(0))
    return (raw.filter((hv > 0) | (lv > 0))
            .select("item_id", "avg_high_price", "high_price_volume", "avg_low_price",
                    "low_price_volume", F.col("timestamp").alias("price_timestamp"), "loaded_at",
                    (hv + lv).alias("total_volume")))


def stg_realized_fills(raw: DataFrame) -> DataFrame:
    req, filled = F.col("requested_qty"), F.col("filled_qty")
    placed, done = F.col("offer_placed_at"), F.col("filled_at")
    delta = micros_between(done, placed)
    seconds = (delta.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(20,6)")
    return raw.select(
        *[c for c in schemas.REALIZED_FILLS.fieldNames()],
        F.when(req > 0, round_ratio(filled, req, 4, 14)).alias("fill_ratio"),
        (F.col("avg_fill_price") - F.col("offer_price")).cast("decimal(18,4)").alias("slippage_gp"),
        F.when(placed.isNotNull() & done.isNotNull(), seconds).alias("time_to_fill_seconds"),
        (F.col("event") == "filled").alias("is_filled"),
        (F.col("event") == "partial").alias("is_partial"),
        F.col("event").isin(*schemas.CANCEL_EVENTS).alias("is_cancelled"))

"""Declared schemas of the raw layer, the landed payloads and the seeds.

Nothing is ever schema-inferred: every reader passes one of these.  Timestamp
columns are ``TimestampType`` (instants); readers also accept ``timestamp_ntz``
input, which the library interprets as UTC wall time.
"""

from __future__ import annotations

from pyspark.sql import types as T

ITEM_MAPPING = T.StructType([
    T.StructField("item_id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("examine", T.StringType()),
    T.StructField("members", T.BooleanType()),
    T.StructField("lowalch", T.IntegerType()),
    T.StructField("highalch", T.IntegerType()),
    T.StructField("buy_limit", T.IntegerType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("icon", T.StringType()),
    T.StructField("loaded_at", T.TimestampType(), False),
])

# /5m and /1h share one shape
WINDOW_PRICES = T.StructType([
    T.StructField("item_id", T.IntegerType(), False),
    T.StructField("avg_high_price", T.IntegerType()),
    T.StructField("high_price_volume", T.IntegerType()),
    T.StructField("avg_low_price", T.IntegerType()),
    T.StructField("low_price_volume", T.IntegerType()),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("loaded_at", T.TimestampType(), False),
])

PRICES_LATEST = T.StructType([
    T.StructField("item_id", T.IntegerType(), False),
    T.StructField("high_price", T.IntegerType()),
    T.StructField("high_time", T.TimestampType()),
    T.StructField("low_price", T.IntegerType()),
    T.StructField("low_time", T.TimestampType()),
    T.StructField("loaded_at", T.TimestampType(), False),
])

REALIZED_FILLS = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("flip_id", T.StringType(), False),
    T.StructField("leg", T.StringType(), False),
    T.StructField("item_id", T.IntegerType(), False),
    T.StructField("bot_version", T.StringType()),
    T.StructField("event", T.StringType(), False),
    T.StructField("requested_qty", T.IntegerType()),
    T.StructField("filled_qty", T.IntegerType()),
    T.StructField("offer_price", T.IntegerType()),
    T.StructField("avg_fill_price", T.DecimalType(18, 4)),
    T.StructField("tax_paid", T.IntegerType()),
    T.StructField("realized_profit", T.LongType()),
    T.StructField("offer_placed_at", T.TimestampType()),
    T.StructField("filled_at", T.TimestampType()),
    T.StructField("monitor_ms", T.IntegerType()),
    T.StructField("tolerance_ms", T.IntegerType()),
    T.StructField("relist_count", T.IntegerType()),
    T.StructField("recorded_at", T.TimestampType(), False),
])

# Columns a fill producer sends (event_id / recorded_at are stamped on write).
FILL_EVENT_COLUMNS = [f.name for f in REALIZED_FILLS.fields
                      if f.name not in ("event_id", "recorded_at")]

TAX_EXEMPT_SEED = T.StructType([
    T.StructField("item_id", T.IntegerType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("reason", T.StringType()),
])

BUY_LIMIT_OVERRIDE_SEED = T.StructType([
    T.StructField("item_id", T.IntegerType()),
    T.StructField("buy_limit", T.IntegerType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("reason", T.StringType()),
])

# --- landed payloads (one JSON document per file) -------------------------

LATEST_ENTRY = T.StructType([
    T.StructField("high", T.IntegerType()),
    T.StructField("highTime", T.LongType()),
    T.StructField("low", T.IntegerType()),
    T.StructField("lowTime", T.LongType()),
])
LATEST_PAYLOAD = T.StructType([
    T.StructField("data", T.MapType(T.StringType(), LATEST_ENTRY)),
])

WINDOW_ENTRY = T.StructType([
    T.StructField("avgHighPrice", T.IntegerType()),
    T.StructField("highPriceVolume", T.IntegerType()),
    T.StructField("avgLowPrice", T.IntegerType()),
    T.StructField("lowPriceVolume", T.IntegerType()),
])
WINDOW_PAYLOAD = T.StructType([
    T.StructField("data", T.MapType(T.StringType(), WINDOW_ENTRY)),
    T.StructField("timestamp", T.LongType()),
])

MAPPING_RECORD = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("examine", T.StringType()),
    T.StructField("members", T.BooleanType()),
    T.StructField("lowalch", T.IntegerType()),
    T.StructField("highalch", T.IntegerType()),
    T.StructField("limit", T.IntegerType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("icon", T.StringType()),
])
MAPPING_PAYLOAD = T.ArrayType(MAPPING_RECORD)

# accepted values of the fill event log (fixed values of the event contract)
FILL_LEGS = ("buy", "sell")
FILL_EVENTS = ("filled", "partial", "cancelled_deadline", "cancelled_pricemove",
               "cancelled_manual")
CANCEL_EVENTS = ("cancelled_deadline", "cancelled_pricemove", "cancelled_manual")

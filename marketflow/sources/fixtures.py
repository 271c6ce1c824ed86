"""Raw price-feed tables derived from the driver's TPC-H-like tables.

The test tables hold no price feed, so the raw layer is *derived* from them with
DataFrame expressions (one Spark job each, growing with the input):

* ``part``      -> item mapping and the two seeds
* ``lineitem``  -> 5-minute, hourly and instant price snapshots
* ``events``    -> a stream of ``/latest`` polls (change-detection input)
* ``orders``    -> the bot's fill-event log

The modulo predicates below are part of the *data definition* (which prices come
under an unknown item, which parts are tax exempt, which fills are buys); they never
subset the rows a query works on.  Timestamps stay ``timestamp_ntz`` as in the driver
Parquet, read as UTC wall time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NTZ = T.TimestampNTZType()

# Fixed values of the fixture definition.
MAPPING_LOADED_AT = "2001-11-01 00:00:00"
ORPHAN_PART_MODULUS = 7          # prices of parts with key % 7 == 0 come under an unknown item id
ORPHAN_OFFSET = 1_000_000_000    # ... which is the key plus this
TAX_EXEMPT_PART_MODULUS = 97     # parts with key % 97 == 0 are tax exempt
LIMIT_OVERRIDE_PART_MODULUS = 89  # parts with key % 89 == 0 get buy limit 1
PAYLOAD_PAGE_ITEMS = 1000        # item ids of a page of landed documents
ORDERS_PER_FLIP = 8              # this many consecutive order keys are the events of one flip


_READS: dict[tuple[int, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  The reader (resolved schema, file index) is reused per
    session: the inputs are read-only, and re-resolving the Parquet footer for
    every derived table dominated query set-up time."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def raw_item_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    retail = F.floor("p_retailprice").cast("int")
    return (p.select(F.col("p_partkey").cast("int").alias("item_id"),
                    F.col("p_name").alias("name"),
                    F.col("p_brand").alias("examine"),
                    (F.col("p_size") % 2 == 0).alias("members"),
                    F.col("p_size").cast("int").alias("lowalch"),
                    retail.alias("highalch"),
                    F.when(F.col("p_size") % 10 != 0, F.col("p_size")).cast("int").alias("buy_limit"),
                    retail.alias("value"),
                    F.col("p_type").alias("icon"),
                    F.lit(MAPPING_LOADED_AT).cast(NTZ).alias("loaded_at")))


def seed_tax_exempt_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (p.filter(F.col("p_partkey") % TAX_EXEMPT_PART_MODULUS == 0)
            .select(F.col("p_partkey").cast("int").alias("item_id"),
                    F.col("p_name").alias("item_name"), F.lit("tool").alias("reason")))


def seed_buy_limit_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (p.filter(F.col("p_partkey") % LIMIT_OVERRIDE_PART_MODULUS == 0)
            .select(F.col("p_partkey").cast("int").alias("item_id"),
                    F.lit(1).alias("buy_limit"),
                    F.col("p_name").alias("item_name"), F.lit("x").alias("reason")))


def _lineitem(spark, sf_dir):
    part = F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        F.when(part % ORPHAN_PART_MODULUS == 0, part + ORPHAN_OFFSET).otherwise(part).cast("int").alias("item_id"),
        F.floor("l_extendedprice").alias("px"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").alias("shipdate"),
        F.date_trunc("quarter", "l_shipdate").cast(NTZ).alias("quarter"))


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the price feeds are made of; stored by item, it is their ``lines``."""
    return _lineitem(spark, sf_dir)


def _page() -> F.Column:
    return F.floor(F.col("item_id") / PAYLOAD_PAGE_ITEMS)


def _grouped(spark: SparkSession, sf_dir: str, time_col: str, lines: DataFrame | None):
    """Line items grouped by item and ``time_col``: ``lines`` as they lie, or those of ``sf_dir`` dealt for documents."""
    return _by_page(_lineitem(spark, sf_dir), time_col) if lines is None else lines.groupBy("item_id", time_col)


def _by_page(li: DataFrame, time_col: str):
    """Line items grouped by item and ``time_col``, dealt by page and ``time_col``: the documents of
    a page (below) are then built where its rows are, without a shuffle of their entries.  A group
    has one or two lines, so aggregates before the shuffle would be no fewer than the lines."""
    return li.repartition(time_col, _page()).groupBy("item_id", time_col, _page().alias("page"))


def raw_prices_5m(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """One snapshot per (part, ship quarter): 'A' lines are the high side, 'R' the low."""
    is_a, is_r = F.col("flag") == "A", F.col("flag") == "R"
    agg = _grouped(spark, sf_dir, "quarter", lines).agg(
        F.sum(F.when(is_a, F.col("px").cast("int"))).alias("sa"),
        F.count_if(is_a).alias("na"),
        F.sum(F.when(is_a, F.col("qty"))).alias("va"),
        F.sum(F.when(is_r, F.col("px").cast("int"))).alias("sr"),
        F.count_if(is_r).alias("nr"),
        F.sum(F.when(is_r, F.col("qty"))).alias("vr"))
    return agg.select(
        "item_id",
        F.when(F.col("na") > 0, F.floor(F.col("sa") / F.col("na"))).cast("int").alias("avg_high_price"),
        F.col("va").cast("int").alias("high_price_volume"),
        F.when(F.col("nr") > 0, F.floor(F.col("sr") / F.col("nr"))).cast("int").alias("avg_low_price"),
        F.col("vr").cast("int").alias("low_price_volume"),
        F.col("quarter").alias("timestamp"),
        F.col("quarter").alias("loaded_at"))


def raw_prices_1h(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """One bucket per (part, ship date); zero-volume buckets occur ('N' lines only)."""
    agg = _grouped(spark, sf_dir, "shipdate", lines).agg(
        F.max("px").cast("int").alias("avg_high_price"),
        F.sum(F.when(F.col("flag") == "A", F.col("qty")).otherwise(0)).cast("int").alias("high_price_volume"),
        F.min("px").cast("int").alias("avg_low_price"),
        F.sum(F.when(F.col("flag") == "R", F.col("qty")).otherwise(0)).cast("int").alias("low_price_volume"))
    return agg.select("item_id", "avg_high_price", "high_price_volume", "avg_low_price",
                      "low_price_volume", F.col("shipdate").alias("timestamp"),
                      F.col("shipdate").alias("loaded_at"))


def raw_prices_latest(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Stored /latest history: one row per (part, quarter) with last trade times."""
    agg = _grouped(spark, sf_dir, "quarter", lines).agg(
        F.max("px").cast("int").alias("high_price"),
        F.max(F.when(F.col("flag") == "A", F.col("shipdate"))).alias("high_time"),
        F.min("px").cast("int").alias("low_price"),
        F.max(F.when(F.col("flag") == "R", F.col("shipdate"))).alias("low_time"))
    return agg.select("item_id", "high_price", "high_time", "low_price", "low_time",
                      F.col("quarter").alias("loaded_at"))


def poll_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every /latest poll as it arrived (before change detection)."""
    ev = table(spark, sf_dir, "events")
    et, v = F.col("event_type"), F.col("value")
    return ev.select(
        F.col("user_id").cast("int").alias("item_id"),
        F.when(et != "error", F.floor(v / 40) * 40 + 200).cast("int").alias("high_price"),
        F.when(et.isin("purchase", "view"), F.col("ts")).alias("high_time"),
        F.when(~et.isin("error", "signup"), F.floor(v / 80) * 40 + 150).cast("int").alias("low_price"),
        F.when(et.isin("click", "view"), F.col("ts")).alias("low_time"),
        F.col("ts").alias("loaded_at"))


def raw_realized_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fill/cancel event per order; even keys are buy legs, odd keys sell legs, and a run of
    keys is one flip, so a leg has several events and the latest one counts."""
    o = table(spark, sf_dir, "orders")
    ship = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
            .agg(F.max("l_shipdate").alias("ship")))
    j = o.join(ship, o.o_orderkey == ship.l_orderkey, "left")
    k, st, pr = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    total = F.floor("o_totalprice")
    sell = k % 2 == 1
    return j.select(
        k.alias("event_id"),
        F.concat(F.lit("f"), F.floor(k / ORDERS_PER_FLIP).cast("long").cast("string")).alias("flip_id"),
        F.when(k % 2 == 0, "buy").otherwise("sell").alias("leg"),
        F.col("o_custkey").cast("int").alias("item_id"),
        F.concat(F.lit("v1."), (F.col("o_custkey") % 3).cast("string")).alias("bot_version"),
        F.when(st == "F", "filled").when(st == "P", "partial")
         .when(pr.startswith("1"), "cancelled_deadline")
         .when(pr.startswith("2"), "cancelled_pricemove")
         .otherwise("cancelled_manual").alias("event"),
        (k % 50).cast("int").alias("requested_qty"),
        F.when(st == "F", k % 50).otherwise(F.floor((k % 50) / 2)).cast("int").alias("filled_qty"),
        total.cast("int").alias("offer_price"),
        F.when(k % 50 >= 2, (total + k % 7 - 3).cast(T.DecimalType(18, 4))).alias("avg_fill_price"),
        F.when(sell, F.floor(F.col("o_totalprice") / 50).cast("int")).alias("tax_paid"),
        F.when(sell, F.floor(F.col("o_totalprice") / 50).cast("long") * (k % 5 - 2)).alias("realized_profit"),
        F.col("o_orderdate").alias("offer_placed_at"),
        F.when(st != "O", F.col("ship")).alias("filled_at"),
        (F.substring(pr, 1, 1).cast("int") * 1000).alias("monitor_ms"),
        ((F.col("o_custkey") % 4).cast("int") * 250).alias("tolerance_ms"),
        (k % 3).cast("int").alias("relist_count"),
        F.col("o_orderdate").alias("recorded_at"))


RAW_TABLES = {
    "item_mapping": raw_item_mapping,
    "prices_5m": raw_prices_5m,
    "prices_1h": raw_prices_1h,
    "prices_latest": raw_prices_latest,
    "realized_fills": raw_realized_fills,
}


# --- landed payload documents built from the raw fixtures ---------------------------
#
# One document per (poll time, page of item ids): pages bound every document to
# PAYLOAD_PAGE_ITEMS entries, like an API page, so no group grows with the data.


def _epoch(col: str) -> F.Column:
    return F.unix_seconds(F.col(col).cast(T.TimestampType()))


def latest_payloads(raw_latest: DataFrame) -> DataFrame:
    """``/latest`` documents: ``(payload_id, value, loaded_at)``."""
    entry = F.struct(F.col("item_id").cast("string"),
                     F.struct(F.col("high_price").alias("high"), _epoch("high_time").alias("highTime"),
                              F.col("low_price").alias("low"), _epoch("low_time").alias("lowTime")))
    docs = raw_latest.groupBy("loaded_at", _page().alias("page")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("data"))
    return docs.select(
        F.concat_ws("/", F.lit("latest"), F.col("loaded_at").cast("string"), F.col("page").cast("string"))
        .alias("payload_id"),
        F.to_json(F.struct("data")).alias("value"), "loaded_at")


def window_payloads(raw_window: DataFrame, feed: str = "5m") -> DataFrame:
    """``/5m`` or ``/1h`` documents: ``(payload_id, value, loaded_at)``."""
    entry = F.struct(F.col("item_id").cast("string"),
                     F.struct(F.col("avg_high_price").alias("avgHighPrice"),
                              F.col("high_price_volume").alias("highPriceVolume"),
                              F.col("avg_low_price").alias("avgLowPrice"),
                              F.col("low_price_volume").alias("lowPriceVolume")))
    docs = raw_window.groupBy("timestamp", "loaded_at", _page().alias("page")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("data"))
    return docs.select(
        F.concat_ws("/", F.lit(feed), F.col("timestamp").cast("string"), F.col("page").cast("string"))
        .alias("payload_id"),
        F.to_json(F.struct(_epoch("timestamp").alias("timestamp"), "data")).alias("value"),
        "loaded_at")


def mapping_payloads(raw_mapping: DataFrame, name: str = "mapping") -> DataFrame:
    """``/mapping`` documents (arrays of records): ``(payload_id, value, loaded_at)``."""
    rec = F.struct(F.col("item_id").alias("id"), "name", "examine", "members", "lowalch",
                   "highalch", F.col("buy_limit").alias("limit"), "value", "icon")
    docs = raw_mapping.groupBy("loaded_at", _page().alias("page")).agg(
        F.sort_array(F.collect_list(rec)).alias("records"))
    return docs.select(
        F.concat_ws("/", F.lit(name), F.lpad(F.col("page").cast("string"), 6, "0")).alias("payload_id"),
        F.to_json("records").alias("value"), "loaded_at")


# --- write-mode inputs ---------------------------------------------------------------

UPSERT_LOADED_AT = "2001-11-02 00:00:00"


UPSERT_SHIFT = 100


def mapping_update_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping refresh for W-1 over all parts, as two landed pages.  Page ``a`` holds every
    part under an item id ``UPSERT_SHIFT`` higher, so the first items are absent from the batch
    and the last are new; page ``b``, later in the batch, holds every part under an id twice as
    much higher, in capitals, and clears ``examine`` of sizes not divisible by 3."""
    p = table(spark, sf_dir, "part")
    retail = F.floor("p_retailprice").cast("int")
    base = p.select((F.col("p_partkey") + UPSERT_SHIFT).cast("int").alias("item_id"),
                    F.concat(F.lit("stale "), F.col("p_name")).alias("name"),
                    F.col("p_brand").alias("examine"), (F.col("p_size") % 2 == 0).alias("members"),
                    F.col("p_size").cast("int").alias("lowalch"), retail.alias("highalch"),
                    F.col("p_size").cast("int").alias("buy_limit"), retail.alias("value"),
                    F.col("p_type").alias("icon"),
                    F.lit(UPSERT_LOADED_AT).cast(NTZ).alias("loaded_at"),
                    F.col("p_size").alias("_size"))
    later = (base.withColumn("item_id", F.col("item_id") + UPSERT_SHIFT)
             .withColumn("name", F.upper(F.substring("name", 7, 1000)))
             .withColumn("examine", F.when(F.col("_size") % 3 == 0, F.col("examine"))))
    a = mapping_payloads(base.drop("_size"), "mapping-a")
    b = mapping_payloads(later.drop("_size"), "mapping-b")
    return a.unionByName(b)


MAPPING_VERSIONS = {"second": "2001-11-02 00:00:00", "third": "2001-11-03 00:00:00"}


def mapping_versions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Three polls of the mapping at different times, each with items that the others lack: the
    mapping itself, and the two pages of its update, a day apart."""
    update = mapping_update_batch(spark, sf_dir)
    out = {"first": mapping_payloads(raw_item_mapping(spark, sf_dir))}
    for (name, at), page in zip(MAPPING_VERSIONS.items(), ("mapping-a", "mapping-b")):
        out[name] = update.filter(F.col("payload_id").startswith(page)).withColumn("loaded_at", F.lit(at).cast(NTZ))
    return out


def dirty_mapping_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping as documents in which some records hold values that their columns do not take:
    a number beyond the integers, a fraction, a text, and records without a name."""
    p = table(spark, sf_dir, "part")
    key, number = F.col("p_partkey"), F.floor("p_retailprice").cast("int").cast("string")
    name = F.regexp_extract(F.to_json(F.struct(F.col("p_name").alias("v"))), '^\\{"v":(.*)\\}$', 1)  # as a JSON text
    record = F.concat(
        F.lit('{"id":'), key.cast("string"),
        F.when(key % 50 != 4, F.concat(F.lit(',"name":'), name)).otherwise(F.lit("")),
        F.lit(',"members":'), (F.col("p_size") % 2 == 0).cast("string"),
        F.lit(',"limit":'), F.when(key % 50 == 1, F.lit("3000000000")).otherwise(F.col("p_size").cast("string")),
        F.lit(',"highalch":'), F.when(key % 50 == 2, F.concat(number, F.lit(".5"))).otherwise(number),
        F.lit(',"value":'), F.when(key % 50 == 3, F.lit('"x"')).otherwise(number), F.lit("}"))
    rows = p.select(key.alias("item_id"), record.alias("record"))
    docs = rows.groupBy(_page().alias("page")).agg(F.concat(
        F.lit("["), F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("item_id", "record"))), lambda r: r["record"])), F.lit("]")).alias("value"))
    return docs.select(F.concat_ws("/", F.lit("dirty"), F.col("page").cast("string")).alias("payload_id"), "value",
                       F.lit(MAPPING_LOADED_AT).cast(NTZ).alias("loaded_at"))


def prices_5m_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored 5-minute history before 2000 (W-2 target)."""
    raw = raw_prices_5m(spark, sf_dir)
    return raw.filter(F.col("timestamp") < F.lit("2000-01-01 00:00:00").cast(NTZ))


def prices_5m_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-poll from mid-1999 on with prices shifted by +1 gp: overlapping keys
    must keep the stored values (first write wins)."""
    raw = raw_prices_5m(spark, sf_dir)
    return (raw.filter(F.col("timestamp") >= F.lit("1999-07-01 00:00:00").cast(NTZ))
            .withColumn("avg_high_price", F.col("avg_high_price") + 1)
            .withColumn("avg_low_price", F.col("avg_low_price") + 1))


FILLS_BATCH_RECORDED_AT = "2001-11-05 00:00:00"


def fills_completion_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill events a bot sends later (W-5): every partial leg completes; the
    batch arrives twice (a retry), and also repeats every event already stored."""
    fills = raw_realized_fills(spark, sf_dir)
    cols = [c for c in fills.columns if c not in ("event_id", "recorded_at")]
    done = (fills.filter(F.col("event") == "partial")
            .withColumn("event", F.lit("filled"))
            .withColumn("filled_qty", F.col("requested_qty"))
            .withColumn("filled_at", F.coalesce("filled_at", "offer_placed_at"))
            .select(*cols))
    resent = fills.select(*cols)
    return done.unionByName(done).unionByName(resent)


# --- raw tables with planted defects, for the checks -----------------------------------

def _twice(df: DataFrame, condition: str) -> DataFrame:
    """``df`` with the rows of ``condition`` stored twice, each where it lies."""
    copies = F.when(F.expr(condition), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def dirty_raw_tables(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """The raw tables with defects that every kind of check must count: items without a name,
    5-minute rows stored twice, fills stored twice, of an unknown leg or event or without a
    flip, and feeds of different ages (fresh, late, overdue).  ``lines`` are ``line_items`` as stored."""
    raw = {n: f(spark, sf_dir, lines) if n.startswith("prices") else f(spark, sf_dir) for n, f in RAW_TABLES.items()}
    item, five, fills = raw["item_mapping"], raw["prices_5m"], raw["realized_fills"]
    raw["item_mapping"] = item.withColumn("name", F.when(F.col("item_id") % 60 != 0, F.col("name")))
    raw["prices_5m"] = _twice(five, "item_id % 40 = 0").withColumn("loaded_at", F.lit(DIRTY_LOADED_AT["prices_5m"]).cast(NTZ))
    raw["prices_latest"] = raw["prices_latest"].withColumn("loaded_at", F.when(
        F.col("loaded_at") >= F.lit("2001-07-01 00:00:00").cast(NTZ), F.lit(DIRTY_LOADED_AT["prices_latest"]).cast(NTZ)).otherwise(F.col("loaded_at")))
    fills = fills.withColumn("leg", F.when(F.col("event_id") % 30 == 0, "hold").otherwise(F.col("leg"))) \
        .withColumn("event", F.when(F.col("event_id") % 45 == 0, "lost").otherwise(F.col("event"))) \
        .withColumn("flip_id", F.when(F.col("event_id") % 35 != 0, F.col("flip_id")))
    raw["realized_fills"] = _twice(fills, "event_id % 50 = 0")
    return raw


DIRTY_LOADED_AT = {"prices_5m": "2001-11-04 23:50:00", "prices_latest": "2001-11-04 23:50:00"}

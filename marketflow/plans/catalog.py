"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each runs the library over the raw layer derived from the driver tables at
``sf_dir`` (whole tables, no sampling), with ``FIXTURE_PARAMS``.  The DuckDB
twin of every key is in ``marketflow.oracle``.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions.prices import tax_gp
from marketflow.operators import quality, writers
from marketflow.operators.store import TableStore
from marketflow.plans import consumers, marts, staging
from marketflow.plans.jobs import SLICE_ROWS, Refresh, read_landed
from marketflow.plans.models import FIXTURE_PARAMS, Models, RawTables, fixture_models
from marketflow.session import checkpoint_dir, configure
from marketflow.sources import fixtures, payloads, seeds
from marketflow.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[Models], DataFrame] | Query):
        QUERIES[name] = fn
        return fn
    return deco


def _model(attr: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return getattr(fixture_models(spark, sf_dir), attr)
    run.__name__ = attr
    return run


for _attr in ["stg_item_mapping", "stg_prices_5m", "stg_prices_latest", "stg_prices_1h",
              "stg_realized_fills", "dim_items", "fct_prices", "agg_item_liquidity",
              "agg_item_volatility", "flip_opportunities", "realized_fills"]:
    QUERIES[_attr] = _model(_attr)


# --- operators and consumers --------------------------------------------------


# Consumer thresholds used on the fixtures (volumes there are per quarter).
LANE_PARAMS = dict(min_5m_volume=20, max_price_age_minutes=300_000)
HIGH_VALUE_LANE_PARAMS = dict(min_volume_per_hour=10, max_est_hours=2.0,
                              max_price_age_minutes=300_000)


def _q(fn):
    """Register ``fn(models) -> DataFrame`` under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(fixture_models(spark, sf_dir))
    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


@_q
def latest_per_key(m: Models) -> DataFrame:
    return marts.current_prices(m.stg_prices_latest, m.params.as_of)


@_q
def sale_tax(m: Models) -> DataFrame:
    dim = m.dim_items.select("item_id", "is_tax_exempt")
    return (m.stg_prices_latest.join(dim, "item_id", "inner")
            .select("item_id", "loaded_at", "high_price", "is_tax_exempt",
                    tax_gp("high_price", "is_tax_exempt").alias("tax_gp")))


@_q
def top_flips(m: Models) -> DataFrame:
    return consumers.top_flips(m.flip_opportunities, 20)


@_q
def recent_fills(m: Models) -> DataFrame:
    return consumers.recent_fills(m.realized_fills, 10)


@_q
def fills_count(m: Models) -> DataFrame:
    return consumers.fills_count(m.raw.realized_fills)


@_q
def standard_lane(m: Models) -> DataFrame:
    return consumers.standard_lane(m.flip_opportunities, **LANE_PARAMS)


@_q
def high_value_lane(m: Models) -> DataFrame:
    return consumers.high_value_lane(m.flip_opportunities, **HIGH_VALUE_LANE_PARAMS)


@_q
def fill_rates_by_cadence(m: Models) -> DataFrame:
    return consumers.fill_rates_by_cadence(m.realized_fills)


@_q
def fill_time_vs_estimate(m: Models) -> DataFrame:
    return consumers.fill_time_vs_estimate(m.realized_fills, m.flip_opportunities)


@_q
def profit_realized_vs_predicted(m: Models) -> DataFrame:
    return consumers.profit_realized_vs_predicted(m.realized_fills, m.flip_opportunities)


@_q
def buy_slippage(m: Models) -> DataFrame:
    return consumers.buy_slippage(m.realized_fills)


@_q
def flip_round_trips(m: Models) -> DataFrame:
    return consumers.flip_round_trips(m.realized_fills)


@_q
def dq_not_null(m: Models) -> DataFrame:
    return quality.not_null_suite(m)


@_q
def dq_unique(m: Models) -> DataFrame:
    return quality.unique_suite(m)


@_q
def dq_accepted_values(m: Models) -> DataFrame:
    return quality.accepted_values_suite(m)


@_q
def dq_unique_combination(m: Models) -> DataFrame:
    return quality.unique_combination_suite(m)


@_q
def dq_price_inversions(m: Models) -> DataFrame:
    return quality.price_inversions(m.fct_prices)


@_q
def dq_freshness(m: Models) -> DataFrame:
    return quality.freshness_suite(m, m.params.as_of)


@_q
def dq_orphans(m: Models) -> DataFrame:
    return quality.orphans(m.stg_prices_5m, m.dim_items)


@_q
def dq_report(m: Models) -> DataFrame:
    return quality.report(m, m.params.as_of)


# --- sources and write modes --------------------------------------------------------


def wall_clock(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock ``timestamp_ntz`` (the driver tables' type),
    so results compare 1:1 with the fixture tables."""
    return df.select(*[F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _src(fn):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return wall_clock(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


@_src
def ingest_latest_payload(spark, sf_dir):
    docs = fixtures.latest_payloads(fixtures.raw_prices_latest(spark, sf_dir))
    return payloads.parse_latest_payload(docs, loaded_at="loaded_at")


@_src
def ingest_window_payload(spark, sf_dir):
    docs = fixtures.window_payloads(fixtures.raw_prices_5m(spark, sf_dir), "5m")
    return payloads.parse_window_payload(docs, loaded_at="loaded_at")


@_src
def ingest_mapping_payload(spark, sf_dir):
    docs = fixtures.mapping_payloads(fixtures.raw_item_mapping(spark, sf_dir))
    return payloads.parse_mapping_payload(docs, loaded_at="loaded_at")


@_src
def ingest_mapping_dirty(spark, sf_dir):
    """S-3 with dead letters: every record once, typed or with the reason why it is not loaded."""
    rows = payloads.mapping_records(fixtures.dirty_mapping_payloads(spark, sf_dir), loaded_at="loaded_at")
    sent = F.coalesce("item_id", F.get_json_object("rejected", "$.id").cast("int"))
    return rows.select(sent.alias("item_id"), "reason", *[F.when(F.col("reason").isNull(), F.col(c)).alias(c) for c in (
        "name", "members", "buy_limit", "highalch", "value")])


@_src
def upsert_items(spark, sf_dir):
    target = fixtures.raw_item_mapping(spark, sf_dir)
    docs = fixtures.mapping_update_batch(spark, sf_dir)
    batch = payloads.parse_mapping_payload(docs, loaded_at="loaded_at", keep_position=True)
    return writers.upsert(target, batch, "item_id", position=["payload_id", "pos"])


@_src
def insert_ignore_prices(spark, sf_dir):
    target = fixtures.prices_5m_target(spark, sf_dir)
    batch = fixtures.prices_5m_batch(spark, sf_dir)
    return target.unionByName(writers.insert_ignore(target, batch, ["item_id", "timestamp"]))


@_src
def insert_if_changed(spark, sf_dir):
    polls = fixtures.poll_latest(spark, sf_dir)
    polls = polls.filter(F.col("high_price").isNotNull() | F.col("low_price").isNotNull())
    return writers.changed_rows(polls, "item_id", "loaded_at")


@_src
def append_fills(spark, sf_dir):
    existing = fixtures.raw_realized_fills(spark, sf_dir)
    batch = fixtures.fills_completion_batch(spark, sf_dir)
    return writers.append_fills(existing, batch, order=writers.NATURAL_KEY,
                                recorded_at=dt.datetime.fromisoformat(fixtures.FILLS_BATCH_RECORDED_AT))


# --- streaming operators and refresh jobs --------------------------------------------


# Fixed window sizes for the fixtures (their rows are quarterly / daily).
HOPPING_VOLATILITY = dict(size="360 days", slide="90 days")
HOPPING_LIQUIDITY = dict(size="30 days", slide="10 days")
# Slices or micro-batches of a streamed fixture, two or more.
STREAM_FILES = 4
# Documents from here on come by the streams in the mixed refresh.
MIXED_CUT = "1997-01-01 00:00:00"


def run_root(spark: SparkSession) -> str:
    """A fresh folder for one run, inside the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/marketflow-runs/{uuid.uuid4().hex}"


@_src
def hopping_volatility(spark, sf_dir):
    m = fixture_models(spark, sf_dir)
    return ingest.hopping_volatility(m.fct_prices, **HOPPING_VOLATILITY)


@_src
def hopping_liquidity(spark, sf_dir):
    m = fixture_models(spark, sf_dir)
    return ingest.hopping_liquidity(m.stg_prices_1h, **HOPPING_LIQUIDITY)


@_src
def stream_dedupe(spark, sf_dir):
    """T-2: the 5-minute feed landed twice (a re-poll) and streamed in several micro-batches;
    the first write of a key wins against the stored keys, so the stored table is complete."""
    root = run_root(spark)
    docs = fixtures.window_payloads(fixtures.raw_prices_5m(spark, sf_dir))
    ingest.land_payloads(docs, f"{root}/landing")
    ingest.land_payloads(docs, f"{root}/landing", mode="append")
    r = _refresh(spark, sf_dir, root)
    # landed and read by as many tasks as the documents need; the files of a micro-batch grow with them
    files = len(spark.read.text(f"{root}/landing").inputFiles())
    q = ingest.start_refresh_stream(spark, f"{root}/landing", f"{root}/checkpoint",
                                    lambda df, bid: r.load_window("5m", df, bid),
                                    max_files_per_trigger=-(-files // STREAM_FILES))
    q.awaitTermination()
    return r.raw("prices_5m")


def _store(spark, root: str, buckets: int = 8) -> TableStore:
    return TableStore(spark, f"{root}/store", "run_" + re.sub(r"\W", "_", root.rstrip("/").rsplit("/", 1)[-1]), buckets)


def _refresh(spark, sf_dir, root) -> Refresh:
    return Refresh(spark, _store(spark, root), FIXTURE_PARAMS,
                   tax_exempt=fixtures.seed_tax_exempt_items(spark, sf_dir),
                   buy_limit_overrides=fixtures.seed_buy_limit_overrides(spark, sf_dir))


def _land_all(spark, sf_dir, root) -> dict[str, str]:
    feeds = {
        "mapping": fixtures.mapping_payloads(fixtures.raw_item_mapping(spark, sf_dir)),
        "latest": fixtures.latest_payloads(fixtures.raw_prices_latest(spark, sf_dir)),
        "5m": fixtures.window_payloads(fixtures.raw_prices_5m(spark, sf_dir), "5m"),
        "1h": fixtures.window_payloads(fixtures.raw_prices_1h(spark, sf_dir), "1h"),
    }
    paths = {}
    for feed, docs in feeds.items():
        paths[feed] = f"{root}/landing/{feed}"
        ingest.land_payloads(docs, paths[feed])
    return paths


@_src
def refresh_daily(spark, sf_dir):
    """B-4 end to end: landed files → raw tables → state → marts → flips view."""
    root = run_root(spark)
    land = _land_all(spark, sf_dir, root)
    r = _refresh(spark, sf_dir, root)
    return r.refresh_daily(*(read_landed(spark, land[f]) for f in ("mapping", "latest", "5m", "1h")),
                           batch_id=1)


def _streamed(spark, sf_dir, feed: str, job: str):
    root = run_root(spark)
    land = _land_all(spark, sf_dir, root)
    r = _refresh(spark, sf_dir, root)
    r.load_mapping(read_landed(spark, land["mapping"]))
    if feed != "latest":
        r.load_latest(read_landed(spark, land["latest"]), 0)
    if feed != "5m":
        r.load_window("5m", read_landed(spark, land["5m"]), 0)
        r.rebuild_volatility()
    if feed != "1h":
        r.load_window("1h", read_landed(spark, land["1h"]), 0)
        r.rebuild_liquidity()
    q = ingest.start_refresh_stream(spark, land[feed], f"{root}/checkpoint/{feed}",
                                    getattr(r, job))
    q.awaitTermination()
    return r.flip_opportunities()


@_src
def refresh_latest(spark, sf_dir):
    """B-1 driven by T-1: the /latest landing folder as a stream."""
    return _streamed(spark, sf_dir, "latest", "refresh_latest")


@_src
def refresh_5m(spark, sf_dir):
    """B-2 driven by T-1: the /5m landing folder as a stream."""
    return _streamed(spark, sf_dir, "5m", "refresh_5m")


@_src
def refresh_1h(spark, sf_dir):
    """B-3 driven by T-1: the /1h landing folder as a stream."""
    return _streamed(spark, sf_dir, "1h", "refresh_1h")


def _mixed(spark, sf_dir) -> Refresh:
    """One store loaded by the daily job (documents before a cut) and by three streams (the
    rest), whose batch ids overlap with the daily job's and each other's."""
    root = run_root(spark)
    cut = F.lit(MIXED_CUT).cast(T.TimestampNTZType())
    feeds = {"latest": fixtures.latest_payloads(fixtures.raw_prices_latest(spark, sf_dir)),
             "5m": fixtures.window_payloads(fixtures.raw_prices_5m(spark, sf_dir), "5m"),
             "1h": fixtures.window_payloads(fixtures.raw_prices_1h(spark, sf_dir), "1h")}
    for feed, docs in feeds.items():
        ingest.land_payloads(docs.filter(F.col("loaded_at") < cut), f"{root}/early/{feed}")
        ingest.land_payloads(docs.filter(F.col("loaded_at") >= cut), f"{root}/late/{feed}")
    ingest.land_payloads(fixtures.mapping_payloads(fixtures.raw_item_mapping(spark, sf_dir)), f"{root}/early/mapping")
    r = _refresh(spark, sf_dir, root)
    r.refresh_daily(*(read_landed(spark, f"{root}/early/{f}") for f in ("mapping", "latest", "5m", "1h")), batch_id=0)
    for feed in feeds:
        ingest.start_refresh_stream(spark, f"{root}/late/{feed}", f"{root}/checkpoint/{feed}",
                                    getattr(r, f"refresh_{feed}")).awaitTermination()
    return r


@_src
def refresh_mixed(spark, sf_dir):
    """B-4 and B-1 … B-3 over one store: no writer touches another's rows."""
    return _mixed(spark, sf_dir).flip_opportunities()


@_src
def views_over_store(spark, sf_dir):
    """W-4 and W-6: the stored fact table by the view's name, after a daily load and three
    streamed refreshes, with the flips that each item has in the view of the opportunities."""
    r = _mixed(spark, sf_dir)
    flips = r.table("agg_flip_opportunities").select("item_id", "profit_per_item")
    return r.table("fct_prices").select("item_id", "price_timestamp", "spread_gp").join(flips, "item_id", "left")


@_src
def views_two_sessions(spark, sf_dir):
    """W-6: a second session reads the facts and the opportunities by name after each of three
    loads of all feeds; nothing is published in between, there or here."""
    root = run_root(spark)
    r = _refresh(spark, sf_dir, root)
    r.load_mapping(_landed(spark, root, "mapping", fixtures.mapping_payloads(fixtures.raw_item_mapping(spark, sf_dir))))
    reader = configure(spark.newSession())
    feeds = {"latest": fixtures.latest_payloads(fixtures.raw_prices_latest(spark, sf_dir)),
             "5m": fixtures.window_payloads(fixtures.raw_prices_5m(spark, sf_dir), "5m"),
             "1h": fixtures.window_payloads(fixtures.raw_prices_1h(spark, sf_dir), "1h")}
    bounds = [None, *VIEW_CUTS, None]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        for feed, docs in feeds.items():
            at = F.col("loaded_at")
            cut = [c for c in (low and (at >= _ntz(low)), high and (at < _ntz(high))) if c is not None]
            for c in cut:
                docs = docs.filter(c)
            getattr(r, f"refresh_{feed}")(_landed(spark, root, f"{feed}-{i}", docs), i)
        flips = r.table("agg_flip_opportunities", reader).select("item_id", "profit_per_item", "volume_per_hour")
        seen = r.table("fct_prices", reader).select("item_id", "price_timestamp", "spread_gp").join(flips, "item_id", "left")
        seen.select(F.lit(i).alias("load"), "*").write.parquet(f"{root}/seen/load-{i}")
    return spark.read.parquet(*[f"{root}/seen/load-{i}" for i in range(len(bounds) - 1)])


# The loads that a second session looks at end at these times.
VIEW_CUTS = ["1997-01-01 00:00:00", "2000-01-01 00:00:00"]


def _ntz(text: str):
    return F.lit(text).cast(T.TimestampNTZType())


def _landed(spark, root: str, name: str, docs: DataFrame) -> DataFrame:
    ingest.land_payloads(docs, f"{root}/landing/{name}")
    return read_landed(spark, f"{root}/landing/{name}")


@_src
def fct_prices_incremental(spark, sf_dir):
    """W-4 / D-2 maintained as a join: prices before any mapping, two mapping loads that each name
    a part of the items, prices between and after them."""
    root = run_root(spark)
    r = _refresh(spark, sf_dir, root)
    prices = fixtures.window_payloads(fixtures.raw_prices_5m(spark, sf_dir), "5m")
    mapping = fixtures.mapping_payloads(fixtures.raw_item_mapping(spark, sf_dir))
    page = F.substring_index("payload_id", "/", -1).cast("int")
    at = F.col("loaded_at")
    first, second = (_ntz(c) for c in VIEW_CUTS)
    r.load_window("5m", _landed(spark, root, "5m-0", prices.filter(at < first)), 0)
    r.load_mapping(_landed(spark, root, "mapping-0", mapping.filter(page == 0)), 0)
    r.load_window("5m", _landed(spark, root, "5m-1", prices.filter((at >= first) & (at < second))), 1)
    r.load_mapping(_landed(spark, root, "mapping-1", mapping.filter(page > 0)), 1)
    r.load_window("5m", _landed(spark, root, "5m-2", prices.filter(at >= second)), 2)
    return r.fct_prices()


@_src
def upsert_any_order(spark, sf_dir):
    """W-1 in the job path: three polls of the mapping, of which the newest is loaded first and the
    oldest stands behind a newer one in its file; the newest document of an item wins."""
    root = run_root(spark)
    r = _refresh(spark, sf_dir, root)
    polls = fixtures.mapping_versions(spark, sf_dir)
    r.load_mapping(_landed(spark, root, "0", polls["third"]), 0)
    # one task writes both polls to a file, the newer first
    late = polls["second"].unionByName(polls["first"]).coalesce(1).sortWithinPartitions(F.col("loaded_at").desc())
    r.load_mapping(_landed(spark, root, "1", late), 1)
    return r.raw("item_mapping")


@_src
def flip_from_buckets(spark, sf_dir):
    """J-5: the opportunities from state and mart tables bucketed by item, read by the view's name;
    with them as they lie, no join and no window of the view shuffles."""
    root = run_root(spark)
    land = _land_all(spark, sf_dir, root)
    r = _refresh(spark, sf_dir, root)
    r.refresh_daily(*(read_landed(spark, land[f]) for f in ("mapping", "latest", "5m", "1h")), batch_id=1)
    return r.table("agg_flip_opportunities")


@_src
def dq_failing_rows(spark, sf_dir):
    """Q-8 in rows: each row of the tables with planted defects, once for every check it fails."""
    # what the feeds are made of is stored by item once: the marts and the repeated keys of each check
    # come from it as it lies, instead of dealing all lines for each of them
    lines = fixtures.line_items(spark, sf_dir)
    store = _store(spark, run_root(spark), max(8, -(-lines.count() // SLICE_ROWS)))
    store.write_version(lines, "input/lines", bucket_by="item_id")
    return quality.failing_rows(_dirty_models(spark, sf_dir, store.read("input/lines")))


@_src
def dq_report_incremental(spark, sf_dir):
    """Q-8 from check states: a report after the first half of all feeds, and one after the rest,
    which reads only the parts that changed."""
    root = run_root(spark)
    r = _refresh(spark, sf_dir, root)
    feeds = {"latest": fixtures.latest_payloads(fixtures.raw_prices_latest(spark, sf_dir)),
             "5m": fixtures.window_payloads(fixtures.raw_prices_5m(spark, sf_dir), "5m"),
             "1h": fixtures.window_payloads(fixtures.raw_prices_1h(spark, sf_dir), "1h")}
    fills = fixtures.raw_realized_fills(spark, sf_dir).drop("event_id", "recorded_at")
    r.load_mapping(_landed(spark, root, "mapping", fixtures.mapping_payloads(fixtures.raw_item_mapping(spark, sf_dir))))
    cut = _ntz(MIXED_CUT)
    for i, late in enumerate((False, True)):
        for feed, docs in feeds.items():
            docs = _landed(spark, root, f"{feed}-{i}", docs.filter((F.col("loaded_at") >= cut) == late))
            r.load_latest(docs, i) if feed == "latest" else r.load_window(feed, docs, i)
        r.append_fill_events(fills.filter((F.col("offer_placed_at") >= cut) == late), i)
        r.rebuild_volatility()
        r.rebuild_liquidity()
        report = r.quality_report()
    return report


@_src
def stream_change_detect(spark, sf_dir):
    """T-3: the /latest poll log streamed through ``foreachBatch`` change
    detection against the per-item state table; returns the stored rows."""
    root = run_root(spark)
    polls = fixtures.poll_latest(spark, sf_dir).filter(
        F.col("high_price").isNotNull() | F.col("low_price").isNotNull())
    # the polls arrive in order of time: landed in one scan, a folder and a pass of the stream for
    # each slice, written and read by as many tasks as its rows need
    first, last = polls.agg(F.min("loaded_at"), F.max("loaded_at")).first()
    cuts = [F.lit(first + (last - first) * i / STREAM_FILES).cast(T.TimestampNTZType()) for i in range(1, STREAM_FILES)]
    slices = sum((F.coalesce((F.col("loaded_at") >= c).cast("int"), F.lit(0)) for c in cuts), F.lit(0))
    polls.withColumn("slice", slices).write.partitionBy("slice").parquet(f"{root}/landing/polls")
    r = _refresh(spark, sf_dir, root)
    for i in sorted(d.split("=")[1] for d in TableStore(spark, f"{root}/landing")._periods("polls")):
        stream = spark.readStream.schema(polls.schema).parquet(f"{root}/landing/polls/slice={i}")
        q = (stream.writeStream.foreachBatch(lambda df, bid, i=i: r.store_latest_rows(df, f"{i}-{bid}"))
             .option("checkpointLocation", f"{root}/checkpoint/{i}").trigger(availableNow=True).start())
        q.awaitTermination()
    return r.raw("prices_latest")


@_src
def seed_tax_exempt(spark, sf_dir):
    """S-5: the item dimension with the packaged seed lists, maintained as CSV files and read
    with their declared schemas, over the fixture mapping."""
    root = run_root(spark)
    seeds.tax_exempt_items(spark).write.option("header", True).csv(f"{root}/seeds/tax_exempt")
    seeds.buy_limit_overrides(spark).write.option("header", True).csv(f"{root}/seeds/buy_limits")
    mapping = staging.stg_item_mapping(fixtures.raw_item_mapping(spark, sf_dir))
    return marts.dim_items(mapping, seeds.tax_exempt_items(spark, f"{root}/seeds/tax_exempt"),
                           seeds.buy_limit_overrides(spark, f"{root}/seeds/buy_limits"))


@_src
def dq_report_dirty(spark, sf_dir):
    """Q-1 … Q-8 over raw tables with planted defects: every kind of check counts some."""
    m = _dirty_models(spark, sf_dir)
    return quality.report(m, m.params.as_of)


def _dirty_models(spark, sf_dir, lines: DataFrame | None = None) -> Models:
    raw = fixtures.dirty_raw_tables(spark, sf_dir, lines)
    return Models(RawTables(**raw, tax_exempt_items=fixtures.seed_tax_exempt_items(spark, sf_dir),
                            buy_limit_overrides=fixtures.seed_buy_limit_overrides(spark, sf_dir)), FIXTURE_PARAMS)


@_src
def hopping_liquidity_stream(spark, sf_dir):
    """T-4 on a stream: the hourly feed in slices of time, every tenth item's rows a slice late,
    through stateful panes in update mode; returns the upserted windows."""
    root = run_root(spark)
    hours = fixture_models(spark, sf_dir).stg_prices_1h
    at = F.col("price_timestamp")
    slices = sum(((at >= _ntz(c)).cast("int") for c in (MIXED_CUT, *VIEW_CUTS[1:])), F.lit(0))
    arrives = slices + (F.pmod("item_id", F.lit(10)) == 0).cast("int")
    hours.withColumn("slice", arrives).write.partitionBy("slice").parquet(f"{root}/slices")
    store = TableStore(spark, f"{root}/store")
    for i in range(4):
        spark.read.schema(hours.schema).parquet(f"{root}/slices/slice={i}").write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(hours.schema).parquet(f"{root}/landing")
        ingest.start_hopping_liquidity(stream, store, f"{root}/checkpoint", **HOPPING_LIQUIDITY, delay=LATE_WITHIN).awaitTermination()
    return ingest.liquidity_windows(store)


# How late the hourly rows of the streamed fixture come, a slice at most.
LATE_WITHIN = "2000 days"


@_src
def stream_ingest(spark, sf_dir):
    """T-1: landed /5m documents streamed into the raw table (``foreachBatch``
    → insert-ignore → idempotent batch directory); returns the stored rows."""
    root = run_root(spark)
    path = f"{root}/landing/5m"
    ingest.land_payloads(fixtures.window_payloads(fixtures.raw_prices_5m(spark, sf_dir)), path)
    r = _refresh(spark, sf_dir, root)
    q = ingest.start_refresh_stream(spark, path, f"{root}/checkpoint",
                                    lambda df, bid: r.load_window("5m", df, bid))
    q.awaitTermination()
    return r.raw("prices_5m")

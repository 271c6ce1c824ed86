"""T-1 … T-4: streaming ingest and stream-side operators.

* **T-1** ``start_refresh_stream``: a file stream of landed payload documents
  drives a refresh job through ``foreachBatch``.  Exactly-once comes from the
  checkpoint (offsets) plus idempotent writes: each micro-batch writes only its
  own directory, named by its id and its documents, so a replayed batch
  replaces itself and no other.
* **T-2** ``start_refresh_stream`` with ``Refresh.load_window``: first write wins
  on ``(item_id, timestamp)`` against the stored keys, complete however late a
  row comes.  ``dedupe_within_watermark`` is the option for a sink without
  stored keys: bounded state, but rows beyond the watermark are dropped.
* **T-3** change detection runs in ``Refresh.load_latest`` inside
  ``foreachBatch`` against the per-item state table (no Python per row).
* **T-4** ``hopping_volatility`` / ``hopping_liquidity``: the trailing windows
  as hopping event-time windows (batch or streaming input).  A batch is first
  aggregated into panes, the longest stretches that no window border cuts, and
  windows are combined from panes, so no row is copied into the windows over it.
  ``start_hopping_liquidity`` keeps the panes as the state of a stream and
  upserts the windows that a micro-batch changes.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketflow.functions.exact import round_div, to_decimal
from marketflow.functions.time import instant
from marketflow.operators.latest import latest_per_key
from marketflow.operators.store import TableStore
from marketflow.plans.jobs import period_start, with_payload_id


def land_payloads(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write payload documents in the landing layout: JSON lines
    ``{"poll_time": <epoch s>, "payload": <document>}`` (the poller's load
    time travels with its document, so folders stay flat).  The files are
    compressed, as they are most of what a load writes; a task reads a whole file, so
    documents should come in as many files as tasks should read them."""
    line = F.concat(F.lit('{"poll_time":'), F.unix_seconds(instant("loaded_at")).cast("string"),
                    F.lit(',"payload":'), F.col("value"), F.lit("}"))
    docs.select(line.alias("value")).write.mode(mode).option("compression", "gzip").text(path)


def payload_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   wholetext: bool = False) -> DataFrame:
    """Streaming DataFrame of landed documents with a ``payload_id`` each."""
    schema = T.StructType([T.StructField("value", T.StringType())])
    r = spark.readStream.format("text").schema(schema).option("wholetext", wholetext)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_payload_id(r.load(path))


def start_refresh_stream(spark: SparkSession, landing_path: str, checkpoint: str,
                         handler: Callable[[DataFrame, int], object],
                         available_now: bool = True, processing_time: str | None = None,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """T-1: run ``handler(batch_df, batch_id)`` for every micro-batch of newly
    landed documents (e.g. ``Refresh.load_latest``)."""
    stream = payload_stream(spark, landing_path, max_files_per_trigger)
    w = (stream.writeStream.foreachBatch(lambda df, batch_id: handler(df, batch_id))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "1 minute")
    return w.start()


def dedupe_within_watermark(rows: DataFrame, keys=("item_id", "timestamp"),
                            time_col: str = "timestamp", delay: str = "60 minutes") -> DataFrame:
    """T-2: drop repeats of a key; state is kept only while the event time is
    within ``delay`` of the watermark (rows older than that are dropped as
    late)."""
    rows = rows.withColumn(time_col, instant(time_col))
    return rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


_UNIT_MICROS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}


def micros_of(interval: str) -> int:
    """``"90 days"`` in microseconds; months and years have no fixed length."""
    n, unit = interval.split()
    return int(n) * _UNIT_MICROS[unit.rstrip("s")]


def pane_length(size: str, slide: str) -> int:
    """Microseconds of the longest pane that no window border cuts."""
    return math.gcd(micros_of(size), micros_of(slide))


def to_panes(rows: DataFrame, size: str, slide: str, aggregates: dict[str, Column]) -> DataFrame:
    """(item_id, pane, ...): partial aggregates of ``rows`` (item_id, ts, ...) per item and pane."""
    pane = F.window("ts", f"{pane_length(size, slide)} microseconds")
    agg = rows.groupBy(pane.alias("w"), "item_id").agg(*[a.alias(n) for n, a in aggregates.items()])
    return agg.select("item_id", F.col("w.start").alias("pane"), *aggregates)


def windows_over(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """``panes`` once for each window over them, with its ``window_start`` in microseconds."""
    step, at = F.lit(micros_of(slide)), F.unix_micros("pane")
    earliest = at + F.lit(pane_length(size, slide) - micros_of(size))
    first, last = earliest + F.pmod(-earliest, step), at - F.pmod(at, step)
    starts = F.when(first <= last, F.sequence(first, last, step)).otherwise(F.array().cast("array<bigint>"))
    return panes.select("*", F.explode(starts).alias("_start"))


def hop(rows: DataFrame, size: str, slide: str, aggregates: dict[str, Column], delay: str | None) -> DataFrame:
    """(item_id, window_start, window_end, ...): aggregates (sums and counts) per item and hopping
    window of ``rows``.  A batch goes through panes; a stream, whose result is emitted when the
    watermark passes a window, through the engine's own windows."""
    if delay is not None:
        rows = rows.withWatermark("ts", delay)
    if rows.isStreaming:
        agg = rows.groupBy(F.window("ts", size, slide).alias("w"), "item_id").agg(*[a.alias(n) for n, a in aggregates.items()])
        return agg.select("item_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggregates)
    return combine_panes(to_panes(rows, size, slide, aggregates), size, slide, list(aggregates))


def combine_panes(panes: DataFrame, size: str, slide: str, sums: list[str]) -> DataFrame:
    agg = windows_over(panes, size, slide).groupBy("item_id", "_start").agg(*[F.sum(c).alias(c) for c in sums])
    return agg.select("item_id", F.timestamp_micros("_start").alias("window_start"),
                      F.timestamp_micros(F.col("_start") + micros_of(size)).alias("window_end"), *sums)


def hopping_volatility(fct: DataFrame, size: str = "1 hour", slide: str = "5 minutes",
                       delay: str | None = None) -> DataFrame:
    """T-4: mid-price mean / stddev per item per hopping window
    ``[window_start, window_end)``; same exact rounding as the volatility mart."""
    from marketflow.plans.marts import _stddev_hundredths

    h, l = F.col("avg_high_price"), F.col("avg_low_price")
    rows = (fct.filter(h.isNotNull() & l.isNotNull())
            .select("item_id", instant("price_timestamp").alias("ts"),
                    (h.cast("long") + l.cast("long")).alias("s")))
    square = F.col("s").cast("decimal(19,0)") * F.col("s").cast("decimal(19,0)")
    agg = hop(rows, size, slide, {"n": F.count(F.lit(1)), "S": F.sum("s"), "Q": F.sum(square)}, delay)
    n, S, Q = F.col("n"), F.col("S"), F.col("Q")
    m, v = round_div(S * 50, n), _stddev_hundredths(n, S, Q)
    return (agg.select("item_id", "window_start", "window_end", n.alias("snapshots"), m.alias("_m"), v.alias("_v"))
            .select("item_id", "window_start", "window_end", "snapshots",
                    to_decimal("_m", 2, 14).alias("mid_mean"),
                    to_decimal("_v", 2, 14).alias("mid_volatility"),
                    F.when((F.col("_m") > 0) & F.col("_v").isNotNull(),
                           to_decimal(round_div(F.col("_v") * 100_000, F.col("_m")), 3, 16))
                    .alias("mid_volatility_pct")))


def _hourly_volume(stg_1h: DataFrame) -> DataFrame:
    return stg_1h.select("item_id", instant("price_timestamp").alias("ts"), F.col("total_volume").cast("long").alias("total_volume"))


def _average_volume(windows: DataFrame) -> DataFrame:
    return windows.select("item_id", "window_start", "window_end",
                          round_div("_s", "hours_observed").alias("avg_volume_per_hour"), "hours_observed")


_VOLUME = {"_s": F.sum, "hours_observed": F.count}


def hopping_liquidity(stg_1h: DataFrame, size: str = "24 hours", slide: str = "1 hour",
                      delay: str | None = None) -> DataFrame:
    """T-4: average active-hour volume per item per hopping window."""
    return _average_volume(hop(_hourly_volume(stg_1h), size, slide, {n: f("total_volume") for n, f in _VOLUME.items()}, delay))


# Volumes before their last change stay in the log of a streamed table; the newest batch wins.
PANES, WINDOWS = "stream/liquidity_panes", "stream/liquidity_windows"

# The panes within ``delay`` are the state, a row for each item and pane: on the executors' disks and in
# a bounded part of their memory, as the heap would have to hold them all.  Old panes leave with the next
# micro-batch that brings rows; an empty one would go through the whole state for that alone.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # a count for the progress report alone, which looks every row up once more
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """``conf`` while a query is started, which keeps the settings that it started with."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_hopping_liquidity(stg_1h: DataFrame, store: TableStore, checkpoint: str, size: str = "24 hours",
                            slide: str = "1 hour", delay: str = "2 hours", available_now: bool = True,
                            processing_time: str = "1 hour") -> StreamingQuery:
    """T-4 on a stream: panes are the state of a windowed aggregation in update mode; each
    micro-batch upserts the panes that changed and every window over them.

    A row counts while its pane is within ``delay`` of the watermark, so ``delay`` must cover how
    late rows come; the state holds that many panes and no more."""
    panes = to_panes(_hourly_volume(stg_1h).withWatermark("ts", delay), size, slide,
                     {n: f("total_volume") for n, f in _VOLUME.items()})
    w = panes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: upsert_windows(store, df, batch_id, size, slide))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    with session_conf(stg_1h.sparkSession, STATE_CONF):
        return w.start()


def upsert_windows(store: TableStore, changed: DataFrame, batch_id: int, size: str, slide: str) -> None:
    """Write the changed panes of a micro-batch, then the windows over them, each computed from the
    newest panes.  Both go to folders of the batch's own, so a replay replaces itself."""
    key, unit = f"b{batch_id:012d}", "month"
    # the query of a stream with state plans without AQE, which takes no rebalance: dealt by period
    # and item, or every task of the state would write a file for every period
    dealt = changed.withColumn("event_date", period_start("pane", unit)).repartition(
        "event_date", F.pmod(F.xxhash64("item_id"), F.lit(store.buckets)))
    seen = store.append_batch(dealt, PANES, key, "event_date",
                              {"first": F.min(F.unix_micros("pane")), "last": F.max(F.unix_micros("pane"))}, rebalance=False)
    if seen["first"] is None:
        return
    periods = store._periods(PANES)
    reach = micros_of(size)
    low, high = (period_start(F.timestamp_micros(F.lit(t)), unit) for t in (seen["first"] - reach, seen["last"] + reach))
    near = store.read_appends_with_period(PANES, periods).filter(
        (F.col("event_date") >= low) & (F.col("event_date") <= high) & (F.col("batch") <= key))
    # dealt by item once, for the newest panes and the windows over them; an item has a row a pane
    newest = latest_per_key(near.drop("event_date").repartition("item_id"), ["item_id", "pane"], "batch")
    # of a pane that this batch changed the newest row is this batch's
    newest = newest.withColumn("_changed", (F.col("batch") == key).cast("long")).drop("batch")
    windows = combine_panes(newest, size, slide, [*_VOLUME, "_changed"]).filter("_changed > 0")
    store.append_batch(_average_volume(windows).withColumn("event_date", period_start("window_start", unit)), WINDOWS, key, "event_date")


def liquidity_windows(store: TableStore) -> DataFrame:
    """The upserted windows: of each the row of the newest batch."""
    rows = store.read_appends_with_period(WINDOWS).drop("event_date")
    return latest_per_key(rows, ["item_id", "window_start"], "batch").drop("batch")

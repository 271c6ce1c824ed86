"""Streaming operators and refresh jobs: stream = batch, replays, late and bad data."""

import datetime as dt
import os

from pyspark.sql import functions as F

from marketflow import schemas
from marketflow.operators import writers
from marketflow.operators.store import TableStore
from marketflow.plans import catalog
from marketflow.plans.jobs import Refresh, read_landed
from marketflow.plans.marts import MartParams
from marketflow.sources import fixtures, payloads
from marketflow.streaming import ingest

T0 = dt.datetime(2024, 1, 1)


def _land(spark, path, docs):
    """Each call lands one file batch of (value, loaded_at) documents."""
    df = spark.createDataFrame(docs, "value string, loaded_at timestamp").coalesce(1)
    ingest.land_payloads(df, path, mode="append")


def _doc(items):
    inner = ", ".join(f'"{i}": {{"high": {h}, "low": {lo}}}' for i, h, lo in items)
    return '{"data": {' + inner + "}}"


def test_stream_change_detection_over_micro_batches(spark, scratch):
    """T-1/T-3: three landed polls, one file each, one micro-batch each; the
    first batch lands two polls of item 3 at once."""
    landing = os.path.join(scratch, "latest")
    polls = [([(1, 10, 5), (2, 7, 7)], T0),
             ([(1, 10, 5), (2, 8, 7)], T0 + dt.timedelta(minutes=1)),
             ([(1, 11, 5), (2, 8, 7)], T0 + dt.timedelta(minutes=2))]
    r = Refresh(spark, TableStore(spark, os.path.join(scratch, "store")), MartParams(as_of=T0))
    for i, (items, at) in enumerate(polls):
        _land(spark, landing, [(_doc(items), at)])
        q = ingest.start_refresh_stream(spark, landing, os.path.join(scratch, "ckpt"),
                                        r.load_latest, max_files_per_trigger=1)
        q.awaitTermination()
    stored = sorted((x.item_id, x.high_price, x.loaded_at) for x in r.raw("prices_latest").collect())
    assert stored == [(1, 10, T0), (1, 11, T0 + dt.timedelta(minutes=2)),
                      (2, 7, T0), (2, 8, T0 + dt.timedelta(minutes=1))]
    # replaying from the same checkpoint processes nothing new
    q = ingest.start_refresh_stream(spark, landing, os.path.join(scratch, "ckpt"), r.load_latest)
    q.awaitTermination()
    assert r.raw("prices_latest").count() == 4
    state = r.store.read("state/latest_price").collect()
    assert sorted((x.item_id, x.high_price) for x in state) == [(1, 11), (2, 8)]  # one row per item


def test_watermark_drops_late_rows_reference_keeps_them(spark, scratch):
    """T-2: the watermarked option drops a row older than the watermark; the load
    against stored keys (first write wins) stores it."""
    landing = os.path.join(scratch, "5m")

    def doc(ts, price):
        return f'{{"timestamp": {int(ts.replace(tzinfo=dt.timezone.utc).timestamp())}, "data": {{"1": {{"avgHighPrice": {price}}}}}}}'

    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    batches = [[(doc(T0 + dt.timedelta(hours=3), 1), T0)],
               [(doc(T0 + dt.timedelta(hours=3), 2), T0), (doc(T0, 3), T0)]]
    for docs in batches:
        _land(spark, landing, docs)
        rows = ingest.payload_stream(spark, landing, max_files_per_trigger=1)
        from marketflow.sources import payloads as pl
        parsed = pl.parse_window_payload(rows, last_key_wins=False, envelope=True)
        q = (ingest.dedupe_within_watermark(parsed, delay="60 minutes").writeStream
             .format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted((r.timestamp, r.avg_high_price) for r in spark.read.parquet(out).collect())
    assert got == [(T0 + dt.timedelta(hours=3), 1)]   # repeat deduped, 00:00 row late
    # the stream that loads against the stored keys keeps it
    r = Refresh(spark, TableStore(spark, os.path.join(scratch, "store")), MartParams(as_of=T0))
    ingest.start_refresh_stream(spark, landing, os.path.join(scratch, "ckpt2"),
                                lambda df, b: r.load_window("5m", df, b), max_files_per_trigger=1).awaitTermination()
    assert {x.timestamp for x in r.raw("prices_5m").collect()} == {T0, T0 + dt.timedelta(hours=3)}


def test_hopping_windows_cover_each_row(spark):
    rows = [(1, 100, 1, 90, 1, T0 + dt.timedelta(minutes=m), T0) for m in (0, 5, 10, 62)]
    fct = spark.createDataFrame(rows, schemas.WINDOW_PRICES).withColumnRenamed("timestamp", "price_timestamp")
    out = ingest.hopping_volatility(fct, "1 hour", "5 minutes")
    per_window = {r.window_start: r.snapshots for r in out.collect()}
    assert sum(per_window.values()) == 4 * 12          # each row in 12 windows
    assert per_window[T0] == 3                          # [00:00, 01:00) holds 0, 5, 10


def test_idempotent_batch_rewrite(spark, scratch):
    """W-2 append: rewriting the same batch id replaces it (no duplicates)."""
    store = TableStore(spark, scratch)
    rows = spark.createDataFrame([(1, 1, 1, 1, 1, T0, T0)], schemas.WINDOW_PRICES)
    for _ in range(2):
        store.append_batch(rows.withColumn("event_date", F.to_date("timestamp")),
                           "raw/prices_5m", 7, "event_date")
    assert store.read("raw/prices_5m", schemas.WINDOW_PRICES).count() == 1
    v1 = store.write_version(rows, "marts/x")
    v2 = store.write_version(rows.union(rows), "marts/x")
    assert (v1, v2) == (1, 2) and store.read("marts/x").count() == 2
    assert writers.insert_ignore(store.read("raw/prices_5m", schemas.WINDOW_PRICES), rows).count() == 0


def test_fill_log_ids_continue_and_retries_are_exact(spark, scratch):
    """W-5 through the job: ids continue across batches from the stored
    high-water mark; a retried batch and a re-sent event add nothing."""
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=T0))
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.REALIZED_FILLS.fields
                     if f.name in schemas.FILL_EVENT_COLUMNS)

    def ev(flip, leg, month):
        placed = dt.datetime(2024, month, 3)
        return (flip, leg, 1, "v", "filled", 2, 2, 10, None, None, None, placed, placed, 1, 1, 0)

    b1 = spark.createDataFrame([ev("a", "buy", 1), ev("a", "sell", 2)], cols)
    b2 = spark.createDataFrame([ev("a", "sell", 2), ev("b", "buy", 3)], cols)
    r.append_fill_events(b1, 1)
    r.append_fill_events(b1, 1)          # retry of batch 1: same directories rewritten
    r.append_fill_events(b2, 2)          # re-sends one event of batch 1
    got = sorted((x.event_id, x.flip_id, x.leg) for x in r.raw("realized_fills").collect())
    # ids rise from batch to batch; inside a batch they follow the hash of the event
    assert [g[0] for g in got] == [1, 2, 3] and {g[1:] for g in got[:2]} == {("a", "buy"), ("a", "sell")} and got[2][1:] == ("b", "buy")


def test_quality_report_over_stored_tables(spark, scratch):
    """Q-8 in the job path: freshness comes from the per-feed load marks."""
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=T0 + dt.timedelta(minutes=10)))
    mapping = ('{"poll_time": %d, "payload": [{"id": 1, "name": "a", "limit": 5}]}'
               % int(T0.replace(tzinfo=dt.timezone.utc).timestamp()))
    latest = ('{"poll_time": %d, "payload": {"data": {"1": {"high": 300, "low": 200}}}}'
              % int(T0.replace(tzinfo=dt.timezone.utc).timestamp()))
    r.load_mapping(spark.createDataFrame([("m", mapping)], "payload_id string, value string"))
    r.load_latest(spark.createDataFrame([("l", latest), ("bad", "{oops")],
                                        "payload_id string, value string"), 1)
    rep = {(x.check_name, x.model): x for x in r.quality_report().collect()}
    assert rep[("source_freshness", "raw.prices_latest")].status == "warn"   # 10 min > 5 min
    assert rep[("source_freshness", "raw.prices_5m")].status == "fail"       # never loaded
    assert rep[("not_null", "dim_items")].status == "pass"
    assert rep[("payload_quarantine", "quarantine.latest")].failures == 1


def test_hopping_liquidity_on_a_stream_equals_batch(spark, scratch):
    """T-4 in streaming form: windowed aggregation with a watermark, append
    mode; on in-order input it emits exactly the batch windows."""
    rows = [(i % 3, 10, 1 + i, 9, 2, T0 + dt.timedelta(hours=i), T0 + dt.timedelta(hours=i))
            for i in range(60)]
    src = os.path.join(scratch, "hourly")
    spark.createDataFrame(rows, schemas.WINDOW_PRICES).write.parquet(src)
    from marketflow.plans import staging
    batch = ingest.hopping_liquidity(
        staging.stg_prices_1h(spark.read.parquet(src)), "6 hours", "2 hours")
    stream = ingest.hopping_liquidity(
        staging.stg_prices_1h(spark.readStream.schema(schemas.WINDOW_PRICES).parquet(src)),
        "6 hours", "2 hours", delay="1 hour")
    out = os.path.join(scratch, "out")
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(out).collect()}
    want = {tuple(r) for r in batch.collect()}
    # append mode emits a window once the watermark passes its end: all but the
    # windows still open at the end of the input
    assert got and got <= want
    last = max(r.window_end for r in batch.collect())
    assert {w for w in want if w[2] < last - dt.timedelta(hours=6)} <= got


def test_versions_stay_until_expired(spark, scratch):
    store = TableStore(spark, scratch)
    df = spark.range(3)
    for _ in range(5):
        store.write_version(df, "state/x")
    assert store.versions("state/x") == [1, 2, 3, 4, 5]
    assert store.expire("state/x", dt.timedelta(hours=1)) == []
    assert store.expire("state/x", dt.timedelta(0)) == [1, 2, 3, 4]
    assert store.versions("state/x") == [5] and store.read("state/x").count() == 3


def _window_doc(at, items):
    epoch = int(at.replace(tzinfo=dt.timezone.utc).timestamp())
    inner = ", ".join(f'"{i}": {{"avgHighPrice": {p}}}' for i, p in items)
    return f'{{"poll_time": {epoch}, "payload": {{"timestamp": {epoch}, "data": {{{inner}}}}}}}'


def _latest_doc(at, items):
    return f'{{"poll_time": {int(at.replace(tzinfo=dt.timezone.utc).timestamp())}, "payload": {_doc(items)}}}'


def _docs(spark, *values):
    return spark.createDataFrame([(str(hash(v)), v) for v in values], "payload_id string, value string")


def test_a_reused_batch_id_keeps_the_other_rows(spark, scratch):
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=T0))
    one = r.load_window("5m", _docs(spark, _window_doc(T0, [(1, 10), (2, 20)])), 1)
    two = r.load_window("5m", _docs(spark, _window_doc(T0 + dt.timedelta(minutes=5), [(3, 30)])), 1)
    assert one == {"documents": 1, "attempted": 2, "rejected": 0, "inserted": 2} and two["inserted"] == 1
    assert sorted(x.item_id for x in r.raw("prices_5m").collect()) == [1, 2, 3]
    r.load_window("5m", _docs(spark, _window_doc(T0, [(1, 10), (2, 20)])), 1)
    assert r.raw("prices_5m").count() == 3


def test_replayed_change_detection_stores_the_same_rows(spark, scratch):
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=T0))
    minute = dt.timedelta(minutes=1)
    first = _docs(spark, _latest_doc(T0, [(1, 10, 5)]))
    second = _docs(spark, _latest_doc(T0 + minute, [(1, 10, 5)]), _latest_doc(T0 + 2 * minute, [(1, 11, 5)]))
    third = _docs(spark, _latest_doc(T0 + 3 * minute, [(1, 12, 5)]))
    rows = lambda: sorted((x.high_price, x.loaded_at) for x in r.raw("prices_latest").collect())
    r.load_latest(first, 0)
    assert r.load_latest(second, 1) == {"documents": 2, "attempted": 2, "inserted": 1, "rejected": 0}
    want = rows()
    r.load_latest(second, 1)  # the stream's commit was lost
    assert rows() == want == [(10, T0), (11, T0 + 2 * minute)]
    r.load_latest(third, 2)
    r.load_latest(second, 1)
    assert rows() == [*want, (12, T0 + 3 * minute)]
    assert [x.high_price for x in r.store.read("state/latest_price").collect()] == [12]


def test_a_late_poll_is_compared_with_the_latest_row(spark, scratch):
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=T0))
    hour = dt.timedelta(hours=1)
    r.load_latest(_docs(spark, _latest_doc(T0 + hour, [(1, 10, 5)])), 0)
    r.load_latest(_docs(spark, _latest_doc(T0, [(1, 10, 5)])), 1)           # older and equal: nothing new
    r.load_latest(_docs(spark, _latest_doc(T0 + hour / 2, [(1, 9, 5)])), 2)  # older and different: stored
    assert sorted((x.high_price, x.loaded_at) for x in r.raw("prices_latest").collect()) == [(9, T0 + hour / 2), (10, T0 + hour)]
    assert [x.high_price for x in r.store.read("state/latest_price").collect()] == [10]


def test_values_that_do_not_fit_are_dead_letters(spark, scratch):
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=T0))
    bad = '{"poll_time": 0, "payload": {"data": {"1": {"high": 3000000000}, "2": {"high": 12.5, "low": 3}, "x": {"high": 1}, "4": {"high": 5, "low": null}}}}'
    assert r.load_latest(_docs(spark, bad, "{oops"), 0) == {"documents": 2, "attempted": 1, "inserted": 1, "rejected": 4}
    letters = r.store.read_appends("quarantine/latest").collect()
    assert sorted(x.reason for x in letters) == ["document", "item", "value", "value"]
    assert any("3000000000" in x.value for x in letters)
    null_time = '{"poll_time": 0, "payload": {"timestamp": null, "data": {"1": {"avgHighPrice": 1}}}}'
    no_time = '{"poll_time": 0, "payload": {"data": {"2": {"avgHighPrice": 1}}}}'
    counts = r.load_window("5m", _docs(spark, null_time, no_time), 0)
    assert counts["rejected"] == 1 and [(x.item_id, x.timestamp) for x in r.raw("prices_5m").collect()] == [(2, dt.datetime(1970, 1, 1))]
    for name in ("a", "b"):  # two mapping loads of one day keep both dead letters
        r.load_mapping(_docs(spark, '{"poll_time": 0, "payload": [{"id": 1, "name": "%s"}, {"id": 2}]}' % name))
    assert r.store.read_appends("quarantine/mapping_records").count() == 2


def test_views_show_the_newest_data_and_old_reads_stay(spark, scratch):
    r = Refresh(spark, TableStore(spark, scratch, database="newest"), MartParams(as_of=T0 + dt.timedelta(days=1)))
    r.load_mapping(_docs(spark, '{"poll_time": 0, "payload": [{"id": 1, "name": "a", "limit": 5}]}'))
    r.refresh_5m(_docs(spark, _window_doc(T0, [(1, 10)])), 0)
    held = r.store.read("state/latest_5m")
    for i in range(1, 5):
        r.refresh_5m(_docs(spark, _window_doc(T0 + dt.timedelta(minutes=5 * i), [(1, 10 + i)])), i)
    assert r.table("fct_prices").count() == 5
    assert [x.avg_high_price for x in held.collect()] == [10]
    assert r.table("agg_flip_opportunities").count() == 0


def test_raw_documents_get_one_load_time(spark, scratch):
    """Raw API documents (no envelope): every row of a load carries the same
    load time, fixed once per load."""
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=T0), landing_envelope=False)
    docs = spark.createDataFrame([("a", _doc([(1, 5, 4), (2, 6, 5)])), ("b", _doc([(3, 7, 6)]))],
                                 "payload_id string, value string")
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    r.load_latest(docs, 1)
    times = {x.loaded_at for x in r.raw("prices_latest").collect()}
    assert len(times) == 1
    (t,) = times
    assert abs((t - before).total_seconds()) < 600
    assert r.store.read("state/latest_price").count() == 3


def test_window_loads_first_write_wins_across_batches(spark, scratch):
    """W-2 in the job path: a later batch re-sending a stored (item, timestamp)
    keeps the stored values; new keys land."""
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=T0))
    epoch = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())

    def line(ts, items):
        inner = ", ".join(f'"{i}": {{"avgHighPrice": {p}}}' for i, p in items)
        return f'{{"poll_time": {ts}, "payload": {{"timestamp": {ts}, "data": {{{inner}}}}}}}'

    first = spark.createDataFrame([("a", line(epoch, [(1, 10), (2, 20)]))], "payload_id string, value string")
    second = spark.createDataFrame([("b", line(epoch, [(1, 99), (3, 30)])),
                                    ("c", line(epoch + 300, [(1, 11)]))], "payload_id string, value string")
    r.load_window("5m", first, 1)
    r.load_window("5m", second, 2)
    got = sorted((x.item_id, x.timestamp, x.avg_high_price) for x in r.raw("prices_5m").collect())
    t1 = T0 + dt.timedelta(minutes=5)
    assert got == [(1, T0, 10), (1, t1, 11), (2, T0, 20), (3, T0, 30)]
    latest = {x.item_id: x.avg_high_price for x in r.store.read("state/latest_5m").collect()}
    assert latest == {1: 11, 2: 20, 3: 30}


def test_mapping_load_quarantines_invalid_records(spark, scratch):
    """S-3 in the job path: records without id/name are dead-lettered, the rest
    upserted; the report counts them."""
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=T0))
    epoch = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    line = ('{"poll_time": %d, "payload": [{"id": 1, "name": "a"}, {"id": 2}, '
            '{"name": "nameless"}, {"id": 3, "name": "c", "limit": 7}]}' % epoch)
    r.load_mapping(spark.createDataFrame([("m", line)], "payload_id string, value string"))
    assert sorted(x.item_id for x in r.raw("item_mapping").collect()) == [1, 3]
    assert r.store.read_appends("quarantine/mapping_records").count() == 2
    rep = {(x.check_name, x.model): x for x in r.quality_report().collect()}
    assert rep[("payload_quarantine", "quarantine.mapping_records")].failures == 2


def test_poll_slices_spread_over_tasks(spark, scratch, monkeypatch):
    """Every slice of the poll log is landed by several tasks, also with nearly all rows in one
    slice, and the stored rows are those of one batch."""
    start = dt.datetime(2024, 1, 1)
    times = [start] * 5 + [start + dt.timedelta(days=100, minutes=i) for i in range(200)]
    rows = [(i % 5, 100 + i // 20, at, 50, at, at) for i, at in enumerate(times)]
    polls = spark.createDataFrame(rows, "item_id int, high_price int, high_time timestamp_ntz, low_price int, low_time timestamp_ntz, "
                                        "loaded_at timestamp_ntz").repartition(4)
    monkeypatch.setattr(catalog.fixtures, "poll_latest", lambda *_: polls)
    monkeypatch.setattr(catalog, "run_root", lambda _: scratch)
    stored = {(x.item_id, x.high_price, x.loaded_at) for x in catalog.QUERIES["stream_change_detect"](spark, "/root/testdata/sf0.001").collect()}
    assert stored == {(x.item_id, x.high_price, x.loaded_at) for x in writers.changed_rows(polls, "item_id", "loaded_at").collect()}
    landed = spark.read.parquet(f"{scratch}/landing/polls")
    assert landed.count() == len(rows)
    late = landed.filter(F.col("loaded_at") > start).select(F.input_file_name()).distinct().count()
    assert late == 4


def test_documents_are_built_in_one_shuffle_and_landed_compressed(spark, scratch):
    """The entries of a page's document are where its rows are aggregated; landed text is small."""
    sf = "/root/testdata/sf0.001"
    raw = {"5m": fixtures.raw_prices_5m(spark, sf), "1h": fixtures.raw_prices_1h(spark, sf)}
    docs = {f: fixtures.window_payloads(r, f) for f, r in raw.items()} | {"latest": fixtures.latest_payloads(fixtures.raw_prices_latest(spark, sf))}
    for df in docs.values():
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    ingest.land_payloads(docs["5m"], f"{scratch}/land")
    files = spark.read.text(f"{scratch}/land").inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
    columns = [c for c in schemas.WINDOW_PRICES.fieldNames() if c not in ("timestamp", "loaded_at")]
    rows = payloads.parse_window_payload(read_landed(spark, f"{scratch}/land"), envelope=True)
    assert sorted(map(str, rows.select(*columns).collect())) == sorted(map(str, raw["5m"].select(*columns).collect()))


def test_repolled_stream_is_landed_by_as_many_tasks_as_needed(spark, monkeypatch):
    landed, asked = [], []
    monkeypatch.setattr(ingest, "land_payloads", lambda docs, path, mode="errorifexists", land=ingest.land_payloads: (
        landed.append(docs._jdf.queryExecution().executedPlan().toString()), land(docs, path, mode)))
    monkeypatch.setattr(ingest, "start_refresh_stream", lambda *a, start=ingest.start_refresh_stream, **k: (
        asked.append(k["max_files_per_trigger"]), start(*a, **k))[1])
    rows = catalog.QUERIES["stream_dedupe"](spark, "/root/testdata/sf0.001")
    assert rows.count() == fixtures.raw_prices_5m(spark, "/root/testdata/sf0.001").count()
    assert len(landed) == 2 and not any("REPARTITION_BY_NUM" in p for p in landed) and asked[0] >= 1


def test_a_streamed_batch_writes_few_files_a_period(spark, scratch):
    """T-4 on a stream: the state's tasks do not each write a file for every period, and of the
    windows only those over changed panes are written again."""
    store = TableStore(spark, f"{scratch}/store", buckets=2)
    for batch in range(2):
        # the second slice has every third item
        rows = [(i, T0 + dt.timedelta(days=31 * m + batch), i + batch) for m in range(4) for i in range(0, 60, 1 + 2 * batch)]
        spark.createDataFrame(rows, "item_id int, price_timestamp timestamp_ntz, total_volume int").write.mode("append").parquet(f"{scratch}/rows")
        stream = spark.readStream.schema("item_id int, price_timestamp timestamp_ntz, total_volume int").parquet(f"{scratch}/rows")
        ingest.start_hopping_liquidity(stream, store, f"{scratch}/ckpt", "20 days", "10 days", delay="400 days").awaitTermination()
    panes = store.read_appends_with_period(ingest.PANES)
    files = panes.select("event_date", "batch", F.input_file_name().alias("f")).distinct().groupBy("event_date", "batch").count()
    assert max(r["count"] for r in files.collect()) <= 2
    windows = store.read_appends_with_period(ingest.WINDOWS)
    late = {r["item_id"] for r in windows.filter(F.col("batch") != windows.agg(F.min("batch")).first()[0]).collect()}
    assert late == set(range(0, 60, 3))
    batch = ingest.hopping_liquidity(spark.read.parquet(f"{scratch}/rows"), "20 days", "10 days")
    got = ingest.liquidity_windows(store)
    assert {tuple(r) for r in got.select(*batch.columns).collect()} == {tuple(r) for r in batch.collect()}


def test_the_state_of_streamed_windows_is_not_held_by_the_heap(spark, scratch):
    """T-4 on a stream: the panes' state is RocksDB's, no empty batch follows to clear it, rows of a pane
    that is long in it still count, and the session keeps its own settings."""
    store, before = TableStore(spark, f"{scratch}/store", buckets=2), {k: spark.conf.get(k, None) for k in ingest.STATE_CONF}
    for first in (0, 300, 5):  # the last slice comes late, within the delay
        rows = [(i, T0 + dt.timedelta(days=first + d), i + d) for d in (0, 7) for i in range(20)]
        spark.createDataFrame(rows, "item_id int, price_timestamp timestamp_ntz, total_volume int").write.mode("append").parquet(f"{scratch}/rows")
        stream = spark.readStream.schema("item_id int, price_timestamp timestamp_ntz, total_volume int").parquet(f"{scratch}/rows")
        ingest.start_hopping_liquidity(stream, store, f"{scratch}/ckpt", "20 days", "10 days", delay="400 days").awaitTermination()
    files = [f for _, _, names in os.walk(f"{scratch}/ckpt/state") for f in names]
    assert any(f.endswith((".changelog", ".zip")) for f in files) and not any(f.endswith((".delta", ".snapshot")) for f in files)
    assert len([f for f in os.listdir(f"{scratch}/ckpt/commits") if f.isdigit()]) == 3
    assert {k: spark.conf.get(k, None) for k in ingest.STATE_CONF} == before
    batch = ingest.hopping_liquidity(spark.read.parquet(f"{scratch}/rows"), "20 days", "10 days")
    assert {tuple(r) for r in ingest.liquidity_windows(store).select(*batch.columns).collect()} == {tuple(r) for r in batch.collect()}

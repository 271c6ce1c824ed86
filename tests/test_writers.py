"""Write modes: upsert, insert-ignore, change detection, fill append (FIXTURES §3
rows 12, 14, 15) plus idempotence and the skew-safe bucketing."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow import schemas
from marketflow.operators import writers
from marketflow.plans.catalog import QUERIES

T0 = dt.datetime(2024, 1, 1)


def _t(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_upsert_overwrites_with_nulls_and_keeps_absent(spark):
    target = spark.createDataFrame(
        [(1, "a", "old", True, 1, 1, 10, 1, "i", T0), (2, "b", "keep", True, 1, 1, 10, 1, "i", T0)],
        schemas.ITEM_MAPPING)
    batch = spark.createDataFrame(
        [(1, "a1", "x", None, None, None, None, None, None, _t(1), "p", 0),
         (1, "a2", None, None, None, None, None, None, None, _t(1), "p", 1),
         (3, "c", "new", None, None, None, None, None, None, _t(1), "p", 2)],
        T.StructType(schemas.ITEM_MAPPING.fields + [T.StructField("payload_id", T.StringType()),
                                                    T.StructField("pos", T.IntegerType())]))
    out = {r.item_id: r for r in writers.upsert(target, batch, "item_id", ["payload_id", "pos"]).collect()}
    assert out[1].name == "a2" and out[1].examine is None  # last wins, NULL overwrites
    assert out[2].examine == "keep"                         # absent id kept
    assert out[3].name == "c"
    again = writers.upsert(writers.upsert(target, batch, "item_id", ["payload_id", "pos"]),
                           batch, "item_id", ["payload_id", "pos"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.values()))


def test_insert_ignore_first_write_wins(spark):
    target = spark.createDataFrame([(1, 10, 1, 9, 1, T0, T0)], schemas.WINDOW_PRICES)
    batch = spark.createDataFrame(
        [(1, 99, 1, 9, 1, T0, _t(5), 0), (2, 50, 1, 40, 1, T0, _t(5), 0),
         (2, 77, 1, 40, 1, T0, _t(5), 1)],
        T.StructType(schemas.WINDOW_PRICES.fields + [T.StructField("pos", T.IntegerType())]))
    new = writers.insert_ignore(target, batch, ["item_id", "timestamp"], position="pos")
    assert [(r.item_id, r.avg_high_price) for r in new.collect()] == [(2, 50)]  # row 14
    table = target.unionByName(new.drop("pos"))
    assert writers.insert_ignore(table, batch.drop("pos"), ["item_id", "timestamp"]).count() == 0


def _polls(spark, rows):
    return spark.createDataFrame(
        [(i, h, None, l, None, t) for i, h, l, t in rows], schemas.PRICES_LATEST)


def test_change_detection_sequence(spark):
    # row 12: (10,NULL) then (10,NULL) later -> skipped; then (10,9) -> stored
    polls = _polls(spark, [(1, 10, None, _t(0)), (1, 10, None, _t(1)), (1, 10, 9, _t(2)),
                           (2, 5, 5, _t(0))])
    got = sorted((r.item_id, r.loaded_at) for r in writers.changed_rows(polls).collect())
    assert got == [(1, _t(0)), (1, _t(2)), (2, _t(0))]


def test_change_detection_across_buckets_and_hot_key(spark):
    # one hot key spread over many day buckets, with unchanged runs crossing midnight
    rows, prev, want = [], None, []
    for k in range(600):
        t = T0 + dt.timedelta(hours=7 * k)
        price = (k // 5) % 4          # runs of 5 equal polls, crossing day boundaries
        rows.append((7, price, price, t))
        if price != prev:
            want.append(t)
        prev = price
    got = sorted(r.loaded_at for r in writers.changed_rows(_polls(spark, rows)).collect())
    assert got == want


def test_change_detection_incremental_equals_batch(spark):
    rows = [(1, 10, 1, _t(0)), (1, 10, 1, _t(1)), (1, 11, 1, _t(2)), (2, None, 3, _t(0)),
            (2, None, 3, _t(3)), (1, 11, 1, _t(4)), (1, 10, 1, _t(5))]
    full = sorted(map(tuple, writers.changed_rows(_polls(spark, rows)).collect()))
    first = writers.changed_rows(_polls(spark, rows[:3]))
    state = writers.next_state(first.limit(0), first)
    second = writers.changed_vs_state(state, _polls(spark, rows[3:]))
    assert sorted(map(tuple, first.unionByName(second).collect())) == full


def test_append_fills_idempotent_and_dense(spark):
    existing = spark.createDataFrame(
        [(41, "f1", "buy", 1, "v", "filled", 1, 1, 1, None, None, None, T0, T0, 1, 1, 0, T0)],
        schemas.REALIZED_FILLS)
    cols = schemas.FILL_EVENT_COLUMNS
    ev = [("f1", "buy", 1, "v", "filled", 1, 1, 1, None, None, None, T0, T0, 1, 1, 0),  # stored
          ("f1", "sell", 1, "v", "partial", 5, 2, 3, None, 1, 2, T0, None, 1, 1, 0),
          ("f2", "buy", 2, "v", "filled", 5, 5, 3, None, None, None, T0, _t(3), 1, 1, 0)]
    batch = spark.createDataFrame(ev + ev, ", ".join(f"{c} {t}" for c, t in [
                                      ("flip_id", "string"), ("leg", "string"), ("item_id", "int"),
                                      ("bot_version", "string"), ("event", "string"),
                                      ("requested_qty", "int"), ("filled_qty", "int"),
                                      ("offer_price", "int"), ("avg_fill_price", "decimal(18,4)"),
                                      ("tax_paid", "int"), ("realized_profit", "long"),
                                      ("offer_placed_at", "timestamp"), ("filled_at", "timestamp"),
                                      ("monitor_ms", "int"), ("tolerance_ms", "int"),
                                      ("relist_count", "int")]))
    assert batch.columns == cols
    appended = writers.append_fills(existing, batch, recorded_at=_t(10))
    out = appended.collect()
    assert sorted(r.event_id for r in out) == [42, 43]
    assert [r.event_uid for r in sorted(out, key=lambda r: r.event_id)] == sorted(
        (r.event_uid for r in out), key=lambda u: hashlib.sha256(u.encode()).hexdigest())
    stored = existing.unionByName(appended.drop("event_uid").select(*existing.columns))
    assert writers.append_fills(stored, batch).count() == 0   # a retried batch adds nothing


def test_append_fills_numbers_by_natural_key(spark):
    """The query's ids follow the whole natural key, over all events, as its SQL says."""
    out = QUERIES["append_fills"](spark, "/root/testdata/sf0.001").collect()
    first = min(r.event_id for r in out)
    low = dt.datetime.min  # NULL comes first
    want = sorted(out, key=lambda r: (r.flip_id, r.leg, r.event, r.filled_qty, r.offer_placed_at, r.filled_at or low, r.event_uid))
    assert [(r.event_id, r.event_uid) for r in want] == [(first + i, r.event_uid) for i, r in enumerate(want)]
    assert len(out) > 50


def test_ordered_index_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    got = sorted(writers.ordered_index(df, ["g", "k"]).collect(), key=lambda r: r._idx)
    assert [(r.g, r.k) for r in got] == sorted((r.g, r.k) for r in got)
    assert [r._idx for r in got] == list(range(1, 5001))
    assert writers.ordered_index(df.limit(0), ["g", "k"]).count() == 0


def test_ranged_index_matches_row_number(spark):
    """Numbers follow the hash of the key, without gaps, whatever the partitions; nothing runs and
    nothing is sorted globally when the result is built."""
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).cast("string").alias("k"))
    want = sorted((str(i * 7919 % 5003) for i in range(5000)), key=lambda k: hashlib.sha256(k.encode()).hexdigest())
    for parts, ranges in ((7, 4096), (3, 5), (1, 1)):
        idx = writers.ranged_index(df.repartition(parts), "k", ranges=ranges)
        assert "rangepartitioning" not in idx._jdf.queryExecution().executedPlan().toString()
        assert [r.k for r in sorted(idx.collect(), key=lambda r: r._idx)] == want
        assert sorted(r._idx for r in idx.collect()) == list(range(1, 5001))


def test_upsert_newest_in_any_order(spark):
    """The newest document of an item wins, whichever load or line it comes by."""
    rows = [(1, f"v{m}", None, None, None, None, None, None, None, _t(m)) for m in range(4)]
    target = spark.createDataFrame(rows[2:3], schemas.ITEM_MAPPING)
    for order in ([0, 3, 1], [3, 1, 0], [0, 1], [2]):
        batch = spark.createDataFrame([(*rows[m], i) for i, m in enumerate(order)],
                                      T.StructType(schemas.ITEM_MAPPING.fields + [T.StructField("line", T.IntegerType())]))
        got = writers.upsert_newest(target, batch, position=["line"]).collect()
        assert [r.name for r in got] == [f"v{max(2, *order)}" if len(order) > 1 else "v2"]
    same = spark.createDataFrame([(1, n, *[None] * 7, _t(2), i) for i, n in enumerate("ab")],
                                 T.StructType(schemas.ITEM_MAPPING.fields + [T.StructField("line", T.IntegerType())]))
    assert [r.name for r in writers.upsert_newest(target, same, position=["line"]).collect()] == ["b"]


def test_change_detection_matches_sequential_replay(spark):
    """Randomized: the bucketed, shuffle-parallel change detection equals the
    reference's poll-by-poll replay (insert when the price pair differs,
    null-safely, from the item's latest stored row)."""
    import random
    rnd = random.Random(11)
    rows = []
    for item in range(6):
        t = T0
        for _ in range(rnd.randint(20, 120)):
            t += dt.timedelta(minutes=rnd.choice([1, 7, 60, 600, 2000]))   # crosses day buckets
            h = rnd.choice([None, 10, 10, 11])
            lo = rnd.choice([None, 5, 5, 6])
            if h is None and lo is None:
                continue                      # both-NULL polls are dropped before detection
            rows.append((item, h, lo, t))
    want, stored = [], {}
    for item, h, lo, t in sorted(rows, key=lambda r: (r[3], r[0])):
        if stored.get(item, ("x", "x")) != (h, lo):
            want.append((item, t))
            stored[item] = (h, lo)
    got = sorted((r.item_id, r.loaded_at) for r in writers.changed_rows(_polls(spark, rows)).collect())
    assert got == sorted(want)


def test_upsert_matches_dict_replay(spark):
    """Randomized W-1: equals applying the batch row by row to a dict keyed by
    item_id (last row wins, absent ids kept, NULLs overwrite)."""
    import random
    rnd = random.Random(5)
    target = [(i, f"n{i}", rnd.choice([None, "e"]), True, 1, 1, 10, 1, "i", T0) for i in range(0, 40, 2)]
    batch = [(rnd.randint(0, 50), f"b{k}", rnd.choice([None, "x"]), None, None, None,
              rnd.choice([None, 3]), None, None, _t(1), "p", k) for k in range(60)]
    state = {r[0]: r for r in target}
    for r in sorted(batch, key=lambda r: r[11]):
        state[r[0]] = r[:10]
    schema = T.StructType(schemas.ITEM_MAPPING.fields + [T.StructField("payload_id", T.StringType()),
                                                         T.StructField("pos", T.IntegerType())])
    out = writers.upsert(spark.createDataFrame(target, schemas.ITEM_MAPPING),
                         spark.createDataFrame(batch, schema), "item_id", ["payload_id", "pos"])
    assert sorted(map(tuple, out.collect())) == sorted(state.values())


def test_insert_ignore_matches_first_write_replay(spark):
    """Randomized W-2: equals inserting row by row with ON CONFLICT DO NOTHING."""
    import random
    rnd = random.Random(9)
    stamps = [T0 + dt.timedelta(minutes=5 * k) for k in range(6)]
    target = [(i, rnd.randint(1, 9), 1, 1, 1, s, T0) for i in range(5) for s in stamps[:3]]
    batch = [(rnd.randint(0, 7), rnd.randint(10, 99), 1, 1, 1, rnd.choice(stamps), _t(9), k)
             for k in range(80)]
    table = {(r[0], r[5]): r for r in target}
    for r in sorted(batch, key=lambda r: r[7]):
        table.setdefault((r[0], r[5]), r[:7])
    schema = T.StructType(schemas.WINDOW_PRICES.fields + [T.StructField("pos", T.IntegerType())])
    tdf = spark.createDataFrame(target, schemas.WINDOW_PRICES)
    new = writers.insert_ignore(tdf, spark.createDataFrame(batch, schema),
                                ["item_id", "timestamp"], position="pos")
    out = tdf.unionByName(new.drop("pos"))
    assert sorted(map(tuple, out.collect())) == sorted(table.values())


def test_distinct_fill_events_have_distinct_identities(spark):
    """NULL is not skipped, every sent column counts, and a producer's uid wins."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.REALIZED_FILLS.fields
                     if f.name in schemas.FILL_EVENT_COLUMNS)
    base = ("f", "buy", 1, "v", "filled", 2, 2, 10, None, None, None, _t(1), None, 1, 1, 0)
    swap = (*base[:11], None, _t(1), *base[13:])
    relist, priced = (*base[:15], 1), (*base[:7], 11, *base[8:])
    empty = spark.createDataFrame([], schemas.REALIZED_FILLS)
    batch = spark.createDataFrame([base, swap, relist, priced, base], cols)
    assert writers.append_fills(empty, batch, recorded_at=_t(10)).count() == 4
    sent = batch.withColumn("event_uid", F.lit("same"))
    assert [r.event_uid for r in writers.append_fills(empty, sent, recorded_at=_t(10)).collect()] == ["same"]


def test_insert_first_matches_replay_in_one_shuffle(spark):
    """W-2 as the jobs do it: repeats within a batch and stored keys go in the same shuffle, and the
    rows come as they are stored, so the write needs none of its own."""
    schema = "item_id int, ts int, price int, pos int"
    stored = [(i, t, 1, 0) for i in range(0, 40, 3) for t in (1, 2)]
    batch = [(i, t, 10 * i + pos, pos) for pos in (2, 1, 3) for i in range(40) for t in (1, 2, 3) if (i + t + pos) % 2]
    want = {}
    for r in sorted(batch, key=lambda r: r[3]):
        if (r[0], r[1]) not in {s[:2] for s in stored}:
            want.setdefault(r[:2], r)
    target = spark.createDataFrame(stored, schema).select("item_id", "ts")
    block = F.pmod(F.xxhash64(F.shiftright("item_id", 2)), F.lit(3))
    new = writers.insert_first(target, spark.createDataFrame(batch, schema), ["item_id", "ts"], ["pos"], [F.col("ts"), block])
    assert {tuple(r) for r in new.collect()} == set(want.values()) and new.count() == len(want)
    assert new._jdf.queryExecution().sparkPlan().toString().count("Exchange") <= 1
    assert new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange ") == 1
    alone = writers.insert_first(None, spark.createDataFrame(batch, schema), ["item_id", "ts"], ["pos"], [F.col("ts")])
    assert alone.count() == len({r[:2] for r in batch})


def test_window_batches_are_stored_by_the_shuffle_that_finds_repeats(spark, scratch, monkeypatch):
    """A load deals its rows once, by period and items: the write that follows moves none."""
    from marketflow.operators.store import TableStore
    from marketflow.plans.jobs import Refresh
    from marketflow.plans.marts import MartParams

    moved, append = [], TableStore.append_batch

    def spied(self, df, name, *args, **kwargs):
        if name == "raw/prices_5m":
            plan = df.hint("rebalance", "event_date") if (args[3:] or [kwargs.get("rebalance", True)])[0] else df
            moved.append(plan._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return append(self, df, name, *args, **kwargs)

    monkeypatch.setattr(TableStore, "append_batch", spied)
    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=dt.datetime(2024, 1, 2)))
    line = '{"poll_time": %d, "payload": {"timestamp": %d, "data": {"1": {"avgHighPrice": 5}, "2": {"avgHighPrice": 6}}}}'
    for batch_id in range(2):
        docs = spark.createDataFrame([(line % (t, t), f"{batch_id}-{t}") for t in (1704067200, 1704067500)], "value string, payload_id string")
        r.load_mapping(spark.createDataFrame([], "value string, payload_id string"), batch_id)
        r.load_window("5m", docs, batch_id)
    assert moved == [1, 1] and r.raw("prices_5m").count() == 4


def test_a_batch_is_parsed_into_as_many_files_as_tasks(spark, scratch, monkeypatch):
    """The scratch table of a load has no folder and file of its own for each period and task."""
    import os

    from marketflow.operators.store import TableStore
    from marketflow.plans import jobs
    from marketflow.plans.marts import MartParams

    monkeypatch.setattr(TableStore, "drop_scratch", lambda *a: None)
    monkeypatch.setattr(jobs, "SLICE_ROWS", 10)
    r = jobs.Refresh(spark, TableStore(spark, scratch), MartParams(as_of=dt.datetime(2024, 1, 2)))
    line = '{"poll_time": %d, "payload": {"timestamp": %d, "data": {%s}}}'
    entries = ", ".join(f'"{i}": {{"avgHighPrice": 5}}' for i in range(0, 10_000, 250))
    times = [1704067200 + 86400 * d for d in range(12)]
    docs = spark.createDataFrame([(line % (t, t, entries), str(t)) for t in times], "value string, payload_id string").coalesce(1)
    counts = r.load_window("1h", docs, 0)
    files = [f for _, _, names in os.walk(f"{scratch}/_scratch/1h") for f in names if f.endswith(".parquet")]
    assert counts["inserted"] == 12 * 40 and len(files) == 1
    # 480 rows of one month in slices of about 10
    assert r._slices(r.raw("prices_1h").withColumn("event_date", F.lit("m")), 480) == 48


def test_fill_events_are_sorted_without_the_text_of_their_uid(spark, monkeypatch):
    """A uid that is computed is no column of the sorted rows; ties still follow it, and a uid that
    the producer sent stays."""
    events = QUERIES["stg_realized_fills"](spark, "/root/testdata/sf0.001").limit(200)
    cols = [c for c in schemas.FILL_EVENT_COLUMNS if c in events.columns]
    batch = events.select(*cols).withColumn("filled_qty", F.lit(1)).withColumn("flip_id", F.lit("f")).withColumn("leg", F.lit("buy"))
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    seen, index = [], writers.ordered_index
    monkeypatch.setattr(writers, "ordered_index", lambda df, order: (seen.append(df.columns), index(df, order))[1])
    log = spark.createDataFrame([], schemas.REALIZED_FILLS)
    new = writers.append_fills(log, batch, T0, order=writers.NATURAL_KEY).collect()
    assert "event_uid" not in seen[0] and len(new) > 50
    key = [(tuple((r[c] is not None, r[c]) for c in writers.NATURAL_KEY), r["event_uid"]) for r in sorted(new, key=lambda r: r["event_id"])]
    assert key == sorted(key)
    sent = batch.limit(3).withColumn("event_uid", F.lit("A"))
    assert [r["event_uid"] for r in writers.append_fills(log, sent, T0, order=writers.NATURAL_KEY).collect()] == ["A"]

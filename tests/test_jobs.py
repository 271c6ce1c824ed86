"""Refresh jobs over a store: views in every session, facts when items come late, order of mapping
documents, check states, pins, buckets and the number of Spark jobs of a load."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from marketflow import schemas
from marketflow.operators import quality
from marketflow.operators.store import TableStore
from marketflow.plans import marts, staging, views
from marketflow.plans.jobs import Refresh, read_landed
from marketflow.plans.marts import MartParams
from marketflow.session import configure

T0 = dt.datetime(2024, 1, 1)
STEP = dt.timedelta(minutes=5)


def epoch(at):
    return int(at.replace(tzinfo=dt.timezone.utc).timestamp())


def line(at, payload):
    return json.dumps({"poll_time": epoch(at), "payload": payload})


def window(at, *items):
    return line(at, {"timestamp": epoch(at), "data": {
        str(i): {"avgHighPrice": h, "avgLowPrice": lo, "highPriceVolume": 30, "lowPriceVolume": 40} for i, h, lo in items}})


def latest(at, *items):
    return line(at, {"data": {str(i): {"high": h, "low": lo, "highTime": epoch(at), "lowTime": epoch(at)} for i, h, lo in items}})


def mapping(at, *items):
    return line(at, [{"id": i, "name": n, "limit": 10} for i, n in items])


def docs(spark, *values):
    return spark.createDataFrame([(f"doc{hash(v)}", v) for v in values], "payload_id string, value string")


@pytest.fixture()
def refresh(spark, scratch):
    store = TableStore(spark, scratch, "t" + uuid.uuid4().hex, buckets=4)
    return Refresh(spark, store, MartParams(as_of=T0 + dt.timedelta(hours=1)))


def facts(r):
    return sorted((x.item_id, x.price_timestamp) for x in r.fct_prices().collect())


# --- views ---------------------------------------------------------------------------

def test_other_sessions_see_every_refresh(spark, refresh):
    r, reader = refresh, configure(spark.newSession())
    assert r.table("agg_flip_opportunities", reader).count() == 0 and r.table("fct_prices", reader).count() == 0
    r.load_mapping(docs(spark, mapping(T0, (1, "one"), (2, "two"))), 0)
    held = r.table("fct_prices", reader)
    for k in range(2):
        at = T0 + k * STEP
        r.refresh_5m(docs(spark, window(at, (1, 1000 + k, 900), (2, 500, 400))), k)
        r.refresh_latest(docs(spark, latest(at, (1, 1000 + k, 800), (2, 500, 300 + k))), k)
        r.refresh_1h(docs(spark, window(at, (1, 1000, 900), (2, 500, 400))), k)
        assert r.table("fct_prices", reader).count() == 2 * (k + 1)
        seen = {x.item_id: (x.item_name, x.high_price, x.low_price) for x in r.table("agg_flip_opportunities", reader).collect()}
        assert seen == {1: ("one", 1000 + k, 800), 2: ("two", 500, 300 + k)}
    assert held.count() == 0  # a read that began earlier keeps what it saw


def test_sql_views_equal_the_models(spark, refresh):
    r = refresh
    r.load_mapping(docs(spark, mapping(T0, *((i, f"n{i}") for i in range(1, 9)))), 0)
    prices = [(1, 1000, 800), (2, None, 300), (3, 49, 20), (4, 900_000_000, 1), (5, 130, 101), (6, 5000, 4990), (7, 260, None), (9, 10_000, 200)]
    r.refresh_5m(docs(spark, window(T0, *prices), window(T0 + STEP, *((i, h and h + 7, lo) for i, h, lo in prices))), 0)
    r.refresh_latest(docs(spark, latest(T0, *prices)), 0)
    r.refresh_1h(docs(spark, window(T0, *prices)), 0)
    view, model = r.table("agg_flip_opportunities"), r.flip_opportunities()
    assert [(f.name, f.dataType) for f in view.schema.fields] == [(f.name, f.dataType) for f in model.schema.fields]
    assert sorted(map(tuple, view.collect())) == sorted(map(tuple, model.collect())) and view.count() > 1
    cols = [f for f in schemas.REALIZED_FILLS.fields if f.name in schemas.FILL_EVENT_COLUMNS]
    event = ("a", "buy", 1, "v", "filled", 3, 2, 10, None, None, None, T0, T0 + dt.timedelta(seconds=4000.5), 1, 1, 0)
    events = [event, (*event[:1], "sell", 99, "v", "partial", 0, 2, 10, None, 1, 5, T0, None, 1, 1, 0)]
    r.append_fill_events(spark.createDataFrame(events, ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in cols)), 0)
    fills, want = r.table("realized_fills"), marts.realized_fills(staging.stg_realized_fills(r.raw("realized_fills")), r.dim_items())
    assert [(f.name, f.dataType) for f in fills.schema.fields] == [(f.name, f.dataType) for f in want.schema.fields]
    assert sorted(map(str, fills.collect())) == sorted(map(str, want.collect()))


def test_live_views_take_the_time_of_the_read(spark):
    text = views.flips("db", MartParams())
    assert "current_timestamp()" in text and "TIMESTAMP '" not in text and "loaded_at <=" not in text


def test_a_new_application_finds_the_stored_tables(spark, refresh):
    r = refresh
    r.load_mapping(docs(spark, mapping(T0, (1, "one"))), 0)
    r.refresh_5m(docs(spark, window(T0, (1, 10, 9))), 0)
    spark.sql(f"DROP DATABASE {r.store.database} CASCADE")
    again = Refresh(spark, TableStore(spark, r.store.root, r.store.database, buckets=4), r.params)
    assert again.table("dim_items").count() == 1 and again.table("fct_prices").count() == 1
    again.load_mapping(docs(spark, mapping(T0 + STEP, (2, "two"))), 1)
    assert again.table("dim_items").count() == 2


# --- the stored fact table ------------------------------------------------------------

def test_facts_of_items_that_come_late(spark, refresh):
    """Prices before any mapping, a mapping, prices, a mapping with more items, prices."""
    r = refresh
    load = lambda k: r.load_window("5m", docs(spark, window(T0 + k * STEP, (1, 10, 9), (2, 20, 19), (3, 30, 29))), k)
    load(0)
    assert facts(r) == []
    r.load_mapping(docs(spark, mapping(T0, (1, "one"))), 10)
    assert facts(r) == [(1, T0)]
    load(1)
    r.load_mapping(docs(spark, mapping(T0 + STEP, (1, "one"), (2, "two"))), 11)
    load(2)
    want = [(i, T0 + k * STEP) for i in (1, 2) for k in range(3)]
    assert facts(r) == want
    model = r.models().fct_prices
    assert sorted(map(tuple, r.fct_prices().collect())) == sorted(map(tuple, model.select(*r.FACT_COLUMNS).collect()))
    for k in (0, 1, 2):  # replays after the mapping took their rows
        load(k)
    r.load_mapping(docs(spark, mapping(T0, (1, "one"))), 10)
    r.load_mapping(docs(spark, mapping(T0 + STEP, (1, "one"), (2, "two"))), 11)
    assert facts(r) == want


def test_a_mapping_load_that_fails_half_way_is_made_good(spark, refresh, monkeypatch):
    r = refresh
    r.load_window("5m", docs(spark, window(T0, (1, 10, 9), (2, 20, 19))), 0)
    with monkeypatch.context() as m:
        m.setattr(r, "_catch_up_facts", lambda key: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            r.load_mapping(docs(spark, mapping(T0, (1, "one"))), 1)
    r.load_window("5m", docs(spark, window(T0 + STEP, (1, 11, 9))), 2)
    assert facts(r) == [(1, T0 + STEP)]
    r.load_mapping(docs(spark, mapping(T0 + STEP, (2, "two"))), 3)
    assert facts(r) == [(1, T0), (1, T0 + STEP), (2, T0)]


def test_a_mapping_load_reads_only_the_periods_of_its_items(spark, refresh):
    r = refresh
    day = dt.timedelta(days=1)
    for k in range(4):
        r.load_window("5m", docs(spark, window(T0 + k * day, (1 if k < 2 else 2, 10, 9))), k)
    r.load_mapping(docs(spark, mapping(T0, (1, "one"))), 10)
    assert facts(r) == [(1, T0), (1, T0 + day)]
    read = []
    original = r.store.read_appends_with_period
    r.store.read_appends_with_period = lambda name, periods=None, schema=None: read.append((name, periods)) or original(name, periods, schema)
    r.store.write_version(r.dim_items().select("item_id"), "state/fact_items")
    r.load_mapping(docs(spark, mapping(T0 + STEP, (2, "two"))), 11)
    dates = {f"event_date={(T0 + k * day).date()}" for k in (2, 3)}
    assert [set(p) for n, p in read if n == r.FACTS] == [dates]
    assert facts(r) == [(1, T0), (1, T0 + day), (2, T0 + 2 * day), (2, T0 + 3 * day)]


# --- mapping ----------------------------------------------------------------------------

def test_the_newest_mapping_document_wins(spark, refresh, scratch):
    """One landed file with the older document first or last, and loads in either order."""
    for trial in range(2):
        for newer_first in (True, False):
            path = f"{scratch}/land-{trial}-{newer_first}"
            at = T0 + (2 * trial + (not newer_first)) * dt.timedelta(hours=1)
            lines = [mapping(at, (1, f"old{trial}")), mapping(at + STEP, (1, f"new{trial}{newer_first}"))]
            spark.createDataFrame([(x,) for x in (lines[::-1] if newer_first else lines)], "value string").coalesce(1).write.text(path)
            refresh.load_mapping(read_landed(spark, path), f"{trial}{newer_first}")
            assert [x.name for x in refresh.raw("item_mapping").collect()] == [f"new{trial}{newer_first}"]
    refresh.load_mapping(docs(spark, mapping(T0, (1, "ancient"), (2, "two"))), "late")
    assert {x.item_id: x.name for x in refresh.raw("item_mapping").collect()} == {1: "new1False", 2: "two"}


def test_records_of_one_poll_time_follow_their_file(spark, refresh, scratch):
    names = [f"n{i}" for i in range(30)]
    spark.createDataFrame([(mapping(T0, (1, n)),) for n in names], "value string").coalesce(1).write.text(f"{scratch}/land")
    refresh.load_mapping(read_landed(spark, f"{scratch}/land"), 0)
    assert [x.name for x in refresh.raw("item_mapping").collect()] == ["n29"]


def test_bad_mapping_values_are_dead_letters(spark, refresh):
    bad = line(T0, [{"id": 1, "name": "a", "limit": 3000000000}, {"id": 2, "name": "b", "highalch": 12.5},
                    {"id": 3, "name": "c", "lowalch": "x"}, {"id": 4}, {"id": 5, "name": "e"}])
    assert refresh.load_mapping(docs(spark, bad, "{oops"), 0) == {"documents": 2, "processed": 1, "rejected": 5}
    letters = refresh.store.read_appends("quarantine/mapping_records").collect()
    assert sorted(x.reason for x in letters) == ["required", "value", "value", "value"]
    assert [x.reason for x in refresh.store.read_appends("quarantine/mapping").collect()] == ["document"]
    assert [x.item_id for x in refresh.raw("item_mapping").collect()] == [5]


# --- checks -------------------------------------------------------------------------------

def test_report_from_states_counts_planted_defects(spark, refresh):
    r = refresh
    r.load_mapping(docs(spark, mapping(T0, (1, "one"), (2, "two"))), 0)
    r.load_window("5m", docs(spark, window(T0, (1, 10, 9), (2, 5, 9), (7, 1, 1))), 0)
    r.load_latest(docs(spark, latest(T0, (1, 10, 9))), 0)
    cols = [f for f in schemas.REALIZED_FILLS.fields if f.name in schemas.FILL_EVENT_COLUMNS]
    event = ("a", "buy", 1, "v", "filled", 3, 2, 10, None, None, None, T0, T0, 1, 1, 0)
    ddl = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in cols)
    r.append_fill_events(spark.createDataFrame([event, ("b", "hold", *event[2:]), ("c", "hold", *event[2:]), (None, *event[1:])], ddl), 0)

    def failures():
        return {(x.check_name, x.model, x.column_name): x.failures for x in r.quality_report().collect() if x.failures}

    first = {("assert_price_high_gte_low", "fct_prices", "avg_high_price,avg_low_price"): 1, ("orphan_prices", "fct_prices", "item_id"): 1,
             ("accepted_values", "raw.realized_fills", "leg"): 1, ("not_null", "raw.realized_fills", "flip_id"): 1,
             ("not_null", "realized_fills", "flip_id"): 1, ("source_freshness", "raw.prices_5m", "loaded_at"): 1,
             ("source_freshness", "raw.prices_latest", "loaded_at"): 1, ("source_freshness", "raw.prices_1h", "loaded_at"): 1}
    assert failures() == first
    # a writer that breaks the rules: facts stored twice, ids given twice, an unknown event, no item
    fact = r.fct_prices().filter("item_id = 1").withColumn("event_date", F.to_date("price_timestamp")).withColumn("known", F.lit(True))
    r.store.append_batch(fact, "marts/fct_prices", "again", ["known", "event_date"])
    fills = r.raw("realized_fills").filter("flip_id = 'a'").withColumn("event", F.lit("lost")).withColumn("event_date", F.lit(dt.date(2024, 2, 1)))
    r.store.append_batch(fills, "raw/realized_fills", "again", "event_date")
    raw = r.raw("prices_5m").limit(1).withColumn("item_id", F.lit(None).cast("int")).withColumn("event_date", F.lit(dt.date(2024, 3, 1)))
    r.store.append_batch(raw, "raw/prices_5m", "again", "event_date")
    read = []
    take = quality.part_states
    try:
        quality.part_states = lambda rows, model, unit, *a, **k: read.append((model, sorted(str(x[0]) for x in rows.select(unit).distinct().collect()))) or take(rows, model, unit, *a, **k)
        assert failures() == first | {("unique_combination_of_columns", "fct_prices", "item_id,price_timestamp"): 1,
                                      ("unique", "realized_fills", "event_id"): 1, ("accepted_values", "raw.realized_fills", "event"): 1,
                                      ("not_null", "raw.prices_5m", "item_id"): 1}
        assert sorted(read) == [("fct_prices", ["2024-01-01"]), ("raw.prices_5m", ["2024-03-01"]), ("raw.realized_fills", ["again"])]
        read.clear()
        failures()
        assert read == []  # nothing changed, nothing read
    finally:
        quality.part_states = take


def test_failing_rows_name_every_check(spark):
    df = spark.createDataFrame([(1, None, T0), (1, "x", None), (None, "b", T0), (None, "b", T0), (2, "b", T0)], "id int, leg string, at timestamp")
    checks = {("not_null", "leg"): F.col("leg").isNull(), ("accepted_values", "leg"): ~F.col("leg").isin("b")}
    rows = quality.table_failing_rows(df, "m", checks, ["id"], "unique").collect()
    micros = epoch(T0) * 10**6
    assert sorted((r.check_name, r.column_name, r.row) for r in rows) == [
        ("accepted_values", "leg", "id=1|leg=x|at=NULL"), ("not_null", "leg", f"id=1|leg=NULL|at={micros}"),
        ("unique", "id", f"id=1|leg=NULL|at={micros}"), ("unique", "id", "id=1|leg=x|at=NULL")]
    pairs = quality.table_failing_rows(df, "m", {}, ["id", "leg"], "unique_combination_of_columns").collect()
    assert [r.row for r in pairs] == [f"id=NULL|leg=b|at={micros}"] * 2
    assert quality.table_failing_rows(df.limit(0), "m", checks, ["id"], "unique").count() == 0


# --- store and plans ------------------------------------------------------------------------

def test_pins_expire_with_their_versions(spark, refresh):
    r = refresh
    for k in range(4):
        r.load_latest(docs(spark, latest(T0 + k * STEP, (1, 10 + k, 5))), k)
    base = f"{r.store.path('state/latest_price')}/_base"
    assert len(r.store._children(base, "")) == 4
    assert r.store.expire("state/latest_price", dt.timedelta(hours=1)) == [] and len(r.store._children(base, "")) == 4
    # versions that a young pin names stay, whatever their age
    fs, _ = r.store._fs_path(base)
    old = epoch(dt.datetime(2020, 1, 1)) * 1000
    for v in r.store.versions("state/latest_price"):
        fs.setTimes(r.store._fs_path(f"{r.store.path('state/latest_price')}/version={v}/_SUCCESS")[1], old, -1)
    assert r.store.expire("state/latest_price", dt.timedelta(hours=1)) == []
    for key in r.store._children(base, ""):
        fs.setTimes(r.store._fs_path(f"{base}/{key}")[1], old, -1)
    assert r.maintain(dt.timedelta(hours=1))["state/latest_price"] == [1, 2, 3]
    assert r.store._children(base, "") == [] and [x.high_price for x in r.table("latest_price").collect()] == [13]


def test_bucketed_flips_do_not_shuffle(spark, refresh):
    r = refresh
    r.load_mapping(docs(spark, mapping(T0, (1, "one"))), 0)
    r.refresh_5m(docs(spark, window(T0, (1, 1000, 900))), 0)
    r.refresh_latest(docs(spark, latest(T0, (1, 1000, 800))), 0)
    r.refresh_1h(docs(spark, window(T0, (1, 1000, 900))), 0)
    reader = configure(spark.newSession())
    reader.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    view = r.table("agg_flip_opportunities", reader)
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan and "Bucketed: true" in plan
    assert [x.item_id for x in view.collect()] == [1]


def jobs_of(spark, action):
    """Spark jobs, those of query stages too, that ``action`` runs."""
    def number():
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "")
        spark.sparkContext.parallelize([0], 1).count()
        return max(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    before = number()
    action()
    return number() - before - 1


def test_a_load_runs_few_jobs(spark, refresh):
    r = refresh
    r.load_mapping(docs(spark, mapping(T0, (1, "one"), (2, "two"))), 0)
    for k in range(2):
        at = T0 + k * STEP
        prices = [(1, 1000 + k, 900), (2, 500 + k, 400)]
        counts = {
            "5m": jobs_of(spark, lambda: r.load_window("5m", docs(spark, window(at, *prices)), k)),
            "1h": jobs_of(spark, lambda: r.load_window("1h", docs(spark, window(at, *prices)), k)),
            "latest": jobs_of(spark, lambda: r.load_latest(docs(spark, latest(at, *prices)), k)),
            "mapping": jobs_of(spark, lambda: r.load_mapping(docs(spark, mapping(at, (1, "one"), (2, "two"))), k))}
        print(counts)
    assert max(counts.values()) <= 10, counts

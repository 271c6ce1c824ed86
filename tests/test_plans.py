"""Physical-plan properties the scale design relies on."""

import datetime as dt

from marketflow import schemas
from marketflow.operators.latest import latest_per_key
from marketflow.plans import marts, staging
from marketflow.plans.marts import MartParams

NOW = dt.datetime(2024, 1, 1, 12)


def _plan(df) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated PushedFilters
    return df._jdf.queryExecution().executedPlan().toString()


def _raw_5m(spark, scratch):
    rows = [(i % 50, 100 + i, 1, 90, 1, NOW - dt.timedelta(minutes=5 * (i % 40)), NOW)
            for i in range(2000)]
    path = f"{scratch}/prices_5m"
    spark.createDataFrame(rows, schemas.WINDOW_PRICES).write.parquet(path)
    return spark.read.schema(schemas.WINDOW_PRICES).parquet(path)


def test_trailing_window_pushed_to_scan_and_columns_pruned(spark, scratch):
    raw = _raw_5m(spark, scratch)
    fct = staging.stg_prices_5m(raw)
    vol = marts.agg_item_volatility(fct, MartParams(as_of=NOW))
    plan = _plan(vol)
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan
    assert "high_price_volume" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_latest_per_key_limits_before_shuffle(spark, scratch):
    raw = _raw_5m(spark, scratch)
    plan = _plan(latest_per_key(raw, "item_id", "timestamp", ["avg_high_price"]))
    # partial WindowGroupLimit under the Exchange: one row per key per task is shuffled
    head, _, tail = plan.partition("Exchange hashpartitioning(item_id")
    assert "WindowGroupLimit" in tail and "WindowGroupLimit" in head


def test_liquidity_is_one_partial_hash_aggregate(spark, scratch):
    raw = _raw_5m(spark, scratch)
    liq = marts.agg_item_liquidity(staging.stg_prices_1h(raw), MartParams(as_of=NOW))
    plan = _plan(liq)
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert plan.count("Exchange") == 1


def test_flip_mart_has_no_cartesian_product(spark):
    import __spark_entry__ as entry
    plan = _plan(entry.queries()["flip_opportunities"](spark, "/root/testdata/sf0.001"))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert bad not in plan


def test_job_window_reads_only_its_periods(spark, scratch):
    """The volatility rebuild's read lists and scans only the day partitions of
    its trailing hour, with the timestamp bound pushed into the scan."""
    from marketflow.operators.store import TableStore
    from marketflow.plans.jobs import Refresh

    r = Refresh(spark, TableStore(spark, scratch), MartParams(as_of=NOW))
    for day, batch in ((3, 1), (1, 2), (0, 3)):
        t = NOW - dt.timedelta(days=day)
        rows = spark.createDataFrame([(1, 10, 1, 9, 1, t, t)], schemas.WINDOW_PRICES)
        r._append(rows, "prices_5m", batch, "timestamp")
    df = r._window_rows("prices_5m", dt.timedelta(hours=1))
    plan = _plan(df)
    assert f"event_date={NOW.date().isoformat()}" in plan
    assert f"event_date={(NOW - dt.timedelta(days=1)).date().isoformat()}" not in plan
    assert "GreaterThanOrEqual(timestamp" in plan
    assert df.count() == 1
    assert r.models().fct_prices.count() == 0   # no mapping loaded: no known items


def test_latest_per_key_matches_python(spark):
    import random

    from marketflow.operators.latest import latest_per_key
    rnd = random.Random(21)
    rows = [(rnd.randint(0, 30), NOW - dt.timedelta(minutes=rnd.randint(0, 10_000)), rnd.randint(0, 9))
            for _ in range(3000)]
    rows = list({(k, t): (k, t, v) for k, t, v in rows}.values())   # (key, time) is the key
    want = {}
    for k, t, v in rows:
        if k not in want or t > want[k][0]:
            want[k] = (t, v)
    df = spark.createDataFrame(rows, "k int, t timestamp, v int").repartition(7)
    got = {r.k: (r.t, r.v) for r in latest_per_key(df, "k", "t").collect()}
    assert got == want

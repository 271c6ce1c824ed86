"""Marts on hand-written rows (FIXTURES §3) with the reference defaults."""

import datetime as dt
from decimal import Decimal

from marketflow import schemas
from marketflow.plans import marts, staging
from marketflow.plans.marts import MartParams
from marketflow.sources import seeds

NOW = dt.datetime(2024, 1, 10, 12, 0)


def _win(spark, rows):
    return spark.createDataFrame(rows, schemas.WINDOW_PRICES)


def test_stg_filters(spark):
    t = NOW
    five = _win(spark, [(1, None, 1, 5, 1, t, t), (2, None, 1, None, 1, t, t)])
    out = staging.stg_prices_5m(five).collect()
    assert [(r.item_id, r.spread_gp, r.spread_pct) for r in out] == [(1, None, None)]  # row 8
    hour = _win(spark, [(1, 10, 0, 9, None, t, t), (2, 10, None, 9, 3, t, t)])
    out = staging.stg_prices_1h(hour).collect()
    assert [(r.item_id, r.total_volume) for r in out] == [(2, 3)]  # row 9


def test_volatility_window_edges(spark):
    p = MartParams(as_of=NOW)
    one_h = NOW - dt.timedelta(hours=1)
    rows = [(1, 100, 1, 90, 1, one_h, one_h),            # exactly 1 h old: included
            (1, 110, 1, 100, 1, NOW, NOW),
            (2, 500, 1, 400, 1, NOW, NOW),                  # single snapshot: NULL vol
            (3, 100, 1, 90, 1, one_h - dt.timedelta(seconds=1), NOW)]  # outside window
    fct = staging.stg_prices_5m(_win(spark, rows))
    out = {r.item_id: r for r in marts.agg_item_volatility(fct, p).collect()}
    assert set(out) == {1, 2}
    assert out[1].snapshots_used_1h == 2
    assert out[1].mid_mean_1h == Decimal("100.00")
    assert out[1].mid_volatility_1h == Decimal("7.07")  # stddev_samp(95, 105) = sqrt(50)
    assert out[1].mid_volatility_pct_1h == Decimal("7.070")
    assert out[2].mid_volatility_1h is None and out[2].mid_volatility_pct_1h is None


def test_volatility_matches_builtin_stddev(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for item in range(200):
        for k in range(rnd.randint(1, 12)):
            ts = NOW - dt.timedelta(minutes=5 * k)
            rows.append((item, rnd.randint(1, 3_000_000_000 // 2), 1,
                         rnd.randint(1, 3_000_000_000 // 2), 1, ts, ts))
    fct = staging.stg_prices_5m(_win(spark, rows))
    ours = {r.item_id: r.mid_volatility_1h for r in
            marts.agg_item_volatility(fct, MartParams(as_of=NOW)).collect()}
    from pyspark.sql import functions as F
    mid = (F.col("avg_high_price").cast("decimal(20,0)") + F.col("avg_low_price")) / 2
    ref = {r.item_id: r.v for r in fct.groupBy("item_id").agg(
        F.round(F.stddev_samp(mid), 2).alias("v")).collect()}
    assert all((ours[k] is None) == (ref[k] is None) for k in ref)
    diffs = [k for k in ref if ref[k] is not None and abs(Decimal(str(ref[k])) - ours[k]) > Decimal("0.01")]
    assert not diffs


def test_liquidity_latest_hour_unbounded(spark):
    # row 11: last active hour 5 days ago -> volume_per_hour set, 24h average NULL
    old = NOW - dt.timedelta(days=5)
    hour = staging.stg_prices_1h(_win(spark, [(1, 1, 4, 1, 3, old, old)]))
    r = marts.agg_item_liquidity(hour, MartParams(as_of=NOW)).first()
    assert (r.volume_per_hour, r.avg_volume_per_hour_24h, r.hours_observed_24h) == (7, None, None)
    bounded = marts.agg_item_liquidity(hour, MartParams(as_of=NOW,
                                                        latest_hour_max_age=dt.timedelta(days=1)))
    assert bounded.count() == 0


def test_dim_items_packaged_seeds(spark):
    # row 18: item 13190 with mapping limit 100 -> buy_limit 1 and tax exempt
    mapping = spark.createDataFrame(
        [(13190, "Old school bond", None, True, 1, 2, 100, 3, None, NOW),
         (1, "Other", None, False, 1, 2, 100, 3, None, NOW)], schemas.ITEM_MAPPING)
    dim = marts.dim_items(staging.stg_item_mapping(mapping), seeds.tax_exempt_items(spark),
                          seeds.buy_limit_overrides(spark))
    got = {r.item_id: (r.buy_limit, r.is_tax_exempt) for r in dim.collect()}
    assert got == {13190: (1, True), 1: (100, False)}


def _latest(spark, rows):
    return spark.createDataFrame(rows, schemas.PRICES_LATEST)


def test_flip_gates_and_tax(spark):
    p = MartParams(as_of=NOW)
    mapping = spark.createDataFrame(
        [(i, f"item{i}", None, False, 1, 2, bl, 3, None, NOW)
         for i, bl in [(1, 10), (2, 10), (3, None), (4, 10)]], schemas.ITEM_MAPPING)
    dim = marts.dim_items(staging.stg_item_mapping(mapping), seeds.tax_exempt_items(spark),
                          seeds.buy_limit_overrides(spark))
    t = NOW - dt.timedelta(minutes=1)
    latest = staging.stg_prices_latest(_latest(spark, [
        (1, 1000, t, 100, t, t),    # row 4: low 100 -> dropped
        (2, 1000, t, 101, t, t),    # kept
        (3, 1000, None, 500, t, t),  # row 5: NULL buy limit kept, max profit 0
        (4, 1000, t, 990, t, t)]))  # spread 10 < tax 20 -> dropped
    hour = staging.stg_prices_1h(_win(spark, [(i, 1, 2, 1, 2, t, t) for i in (1, 2, 3, 4)]))
    liq = marts.agg_item_liquidity(hour, p)
    empty5 = staging.stg_prices_5m(_win(spark, []))
    fct = marts.fct_prices(empty5, dim)
    vol = marts.agg_item_volatility(fct, p)
    flips = {r.item_id: r for r in marts.flip_opportunities(latest, fct, dim, liq, vol, p).collect()}
    assert set(flips) == {2, 3}
    assert flips[2].tax_gp == 20 and flips[2].profit_per_item == 879
    assert flips[2].max_profit_per_limit == 8790
    assert flips[3].max_profit_per_limit == 0 and flips[3].est_hours_to_fill_limit is None
    assert flips[2].price_age_minutes == Decimal("1.0")
    assert flips[2].volume_per_hour == 4 and flips[2].est_hours_to_fill_limit == Decimal("2.50")


def test_realized_fills_edges(spark):
    rows = [(1, "f1", "buy", 99, "v1", "cancelled_deadline", 10, 4, 100, None, None, None,
             NOW, None, 1000, 250, 0, NOW)]
    raw = spark.createDataFrame(rows, schemas.REALIZED_FILLS)
    r = marts.realized_fills(staging.stg_realized_fills(raw),
                             spark.createDataFrame([], "item_id int, item_name string")).first()
    # row 16 and row 17: partial-then-cancelled; unknown item kept with NULL name
    assert r.fill_ratio == Decimal("0.4000") and r.is_cancelled and not r.is_filled
    assert r.time_to_fill_seconds is None and r.time_to_fill_hours is None
    assert r.item_name is None


def test_views_run_reference_sql(spark):
    from marketflow.plans.models import fixture_models
    m = fixture_models(spark, "/root/testdata/sf0.001")
    assert "agg_flip_opportunities" in m.register_views()
    top = spark.sql("select item_id from agg_flip_opportunities "
                    "order by max_profit_per_limit desc nulls last, item_id limit 20").collect()
    ours = [r.item_id for r in m.flip_opportunities.orderBy(
        m.flip_opportunities.max_profit_per_limit.desc_nulls_last(), "item_id").limit(20).collect()]
    assert [r.item_id for r in top] == ours

"""Edge rows of the price expressions and the exact rounding recipe."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from marketflow.functions.exact import round_div, round_ratio
from marketflow.functions.prices import (
    est_hours_to_fill,
    is_stale,
    max_profit_per_limit,
    price_age_minutes,
    spread_gp,
    spread_pct,
    tax_gp,
)
from marketflow.functions.time import as_of_column


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_tax_edges(spark):
    # FIXTURES §3 rows 1-3: 49/50 gp, 149 gp, the 5,000,000 cap, exemption
    rows = [(49, False), (50, False), (149, False), (2_147_483_647, False), (1000, True),
            (None, False)]
    got = _one(spark, tax_gp("h", "ex"), rows, "h int, ex boolean")
    assert got == [0, 1, 2, 5_000_000, 0, 5_000_000]  # NULL high: least() skips NULL


def test_spread_pct_signs_and_nulls(spark):
    rows = [(150, 100), (100, 150), (None, 5), (5, 0), (5, None), (101, 3)]
    got = _one(spark, spread_pct("h", "l"), rows, "h int, l int")
    assert got == [Decimal("50.00"), Decimal("-33.33"), None, None, None, Decimal("3266.67")]
    assert _one(spark, spread_gp("h", "l"), rows, "h int, l int")[:3] == [50, -50, None]


def test_est_hours_and_profit(spark):
    rows = [(None, 10, 7), (10, 3, 7), (10, 0, 7)]
    df = spark.createDataFrame(rows, "bl int, vph int, profit long")
    out = df.select(est_hours_to_fill("bl", "vph").alias("e"),
                    max_profit_per_limit("profit", "bl").alias("m")).collect()
    assert [r.e for r in out] == [None, Decimal("3.33"), None]
    assert [r.m for r in out] == [0, 70, 70]  # row 5: NULL buy limit -> 0, row kept


def test_price_age_least_ignores_null(spark):
    as_of = dt.datetime(2024, 1, 1, 12, 0)
    rows = [(None, dt.datetime(2024, 1, 1, 10, 30)), (None, None),
            (dt.datetime(2024, 1, 1, 11, 0), dt.datetime(2024, 1, 1, 11, 59, 57))]
    got = _one(spark, price_age_minutes(as_of_column(as_of), "h", "l"), rows,
               "h timestamp, l timestamp")
    assert got == [Decimal("90.0"), None, Decimal("60.0")]


def test_is_stale_boundary(spark):
    rows = [(Decimal("50.00"), 4), (Decimal("50.01"), 4), (Decimal("80.00"), None),
            (Decimal("80.00"), 5)]
    got = _one(spark, is_stale("p", "v"), rows, "p decimal(14,2), v int")
    assert got == [False, True, True, False]


def test_round_div_matches_decimal_half_up(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        a = rnd.randint(-10**12, 10**12)
        b = rnd.choice([rnd.randint(1, 10**6), -rnd.randint(1, 10**6), 2, 4, 8, 3])
        rows.append((a, b))
    got = _one(spark, round_div("a", "b"), rows, "a long, b long")
    want = [int((Decimal(a) / Decimal(b)).quantize(Decimal(1), rounding=ROUND_HALF_UP))
            for a, b in rows]
    assert got == want


def test_round_ratio_half_up_at_boundary(spark):
    rows = [(1, 8), (-1, 8), (5, 2000), (-5, 2000)]
    got = _one(spark, round_ratio("a", "b", 2, 10), rows, "a long, b long")
    assert got == [Decimal("0.13"), Decimal("-0.13"), Decimal("0.00"), Decimal("0.00")]
    got = _one(spark, round_ratio("a", "b", 3, 10), rows, "a long, b long")
    assert got == [Decimal("0.125"), Decimal("-0.125"), Decimal("0.003"), Decimal("-0.003")]


def test_ansi_guards_division(spark):
    # nullif-style guard: zero volume gives NULL instead of a division error
    df = spark.createDataFrame([(5, 0)], "bl int, vph int")
    assert df.select(est_hours_to_fill("bl", "vph")).first()[0] is None
    assert df.select(F.lit(1)).count() == 1

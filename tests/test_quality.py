"""Quality checks: accepted values / not-null interplay and freshness (rows 19-20)."""

import datetime as dt

from pyspark.sql import functions as F

from marketflow import schemas
from marketflow.operators import quality
from marketflow.plans import catalog

NOW = dt.datetime(2024, 1, 1, 12, 0)


def test_accepted_values_null_passes_but_not_null_fails(spark):
    rows = [(1, "f", "buy", 1, None, "fillled", 1, 1, 1, None, None, None, NOW, NOW, 1, 1, 0, NOW),
            (2, "f", "buy", 1, None, "filled", 1, 1, 1, None, None, None, NOW, NOW, 1, 1, 0, NOW)]
    df = spark.createDataFrame(rows, schemas.REALIZED_FILLS)
    r = quality.accepted_values(df, "raw.realized_fills", "event", schemas.FILL_EVENTS).first()
    assert (r.failing_values, r.failing_rows) == (1, 1)
    nulls = df.selectExpr("CAST(NULL AS STRING) AS event")
    assert quality.accepted_values(nulls, "m", "event", schemas.FILL_EVENTS).first().failing_values == 0
    assert quality.not_null(nulls, "m", ["event"]).first().failures == 2


def test_freshness_thresholds(spark):
    lim = quality.FRESHNESS["raw.prices_latest"]
    for age, status in [(4, "pass"), (10, "warn"), (31, "error")]:
        df = spark.createDataFrame([(NOW - dt.timedelta(minutes=age),)], "loaded_at timestamp")
        assert quality.freshness(df, "latest", lim, NOW).first().status == status
    empty = spark.createDataFrame([], "loaded_at timestamp")
    assert quality.freshness(empty, "latest", lim, NOW).first().status == "error"


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert quality.unique(df, "m", "k").first().failures == 1
    assert quality.unique_combination(df, "m", ["k"]).first().failures == 2


def test_only_failing_rows_are_made_into_text(spark):
    """The text of a row is made above the join with the repeated keys, of the rows that fail."""
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c"), (None, "d"), (3, None)], "k int, v string")
    rows = quality.table_failing_rows(df, "m", {("not_null", "v"): F.col("v").isNull()}, ["k"], "unique")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join", 1)
    assert "concat_ws" in above and "concat_ws" not in below
    assert sorted((r.check_name, r.column_name, r.row) for r in rows.collect()) == [
        ("not_null", "v", "k=1|v=NULL"), ("not_null", "v", "k=3|v=NULL"), ("unique", "k", "k=1|v=NULL"), ("unique", "k", "k=1|v=a")]
    plain = quality.table_failing_rows(df, "m", {("not_null", "v"): F.col("v").isNull()}).collect()
    assert sorted(r.row for r in plain) == ["k=1|v=NULL", "k=3|v=NULL"]


def test_failing_rows_deal_no_lines_for_each_check(spark):
    """The lines of the feeds are stored by item once; no check shuffles them again, and rows are the
    same as over feeds that are derived anew for each."""
    sf = "/root/testdata/sf0.001"
    rows = catalog.dq_failing_rows(spark, sf)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" not in plan and "Exchange hashpartitioning(quarter" not in plan
    plain = quality.failing_rows(catalog._dirty_models(spark, sf))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, plain.collect()))


def test_repeated_null_keys_fail_a_combination_but_not_unique(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 1), (3, None)], "k int, v int")
    once = quality.table_failing_rows(df, "m", {}, ["k"], "unique").collect()
    both = quality.table_failing_rows(df, "m", {}, ["k", "v"], "unique_combination_of_columns").collect()
    assert sorted(r.row for r in once) == ["k=2|v=1"] * 2
    assert sorted(r.row for r in both) == ["k=2|v=1"] * 2 + ["k=NULL|v=1"] * 2

"""Wiring of the model graph: raw tables -> staging -> marts.

``Models`` is the analogue of the reference's ``ref()`` graph: each property is a
lazy DataFrame built from the ones it depends on.  Nothing is materialized
here; jobs decide what to write (see ``plans.jobs``).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession

from marketflow.plans import marts, staging
from marketflow.plans.marts import MartParams
from marketflow.sources import fixtures


@dataclasses.dataclass(frozen=True)
class RawTables:
    item_mapping: DataFrame
    prices_5m: DataFrame
    prices_1h: DataFrame
    prices_latest: DataFrame
    realized_fills: DataFrame
    tax_exempt_items: DataFrame
    buy_limit_overrides: DataFrame


class FixtureRaw:
    """Raw layer derived from the driver tables at ``sf_dir``; each table is
    built only when a model first needs it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _get(self, fn):
        return fn(self.spark, self.sf_dir)

    item_mapping = functools.cached_property(lambda self: self._get(fixtures.raw_item_mapping))
    prices_5m = functools.cached_property(lambda self: self._get(fixtures.raw_prices_5m))
    prices_1h = functools.cached_property(lambda self: self._get(fixtures.raw_prices_1h))
    prices_latest = functools.cached_property(lambda self: self._get(fixtures.raw_prices_latest))
    realized_fills = functools.cached_property(lambda self: self._get(fixtures.raw_realized_fills))
    tax_exempt_items = functools.cached_property(
        lambda self: self._get(fixtures.seed_tax_exempt_items))
    buy_limit_overrides = functools.cached_property(
        lambda self: self._get(fixtures.seed_buy_limit_overrides))


def fixture_raw(spark: SparkSession, sf_dir: str) -> FixtureRaw:
    """Raw layer derived from the driver tables at ``sf_dir`` (lazy)."""
    return FixtureRaw(spark, sf_dir)


# Parameters used against the fixtures: the driver data ends 2001-11-04 and is
# sparse per item (quarterly / daily buckets), so the trailing windows are
# widened; the fixture prices stay far below the production thresholds, so the
# high-value and stale thresholds are scaled down.  Defaults are tested on
# hand-written rows in tests/.
FIXTURE_PARAMS = MartParams(
    as_of=dt.datetime(2001, 11, 5),
    volatility_lookback=dt.timedelta(days=730),
    liquidity_lookback=dt.timedelta(days=365),
    high_value_threshold_gp=50_000,
    stale_spread_pct=10,
    stale_volume_floor=30,
)


class Models:
    def __init__(self, raw: RawTables | FixtureRaw, params: MartParams = MartParams()):
        self.raw = raw
        self.params = params

    # staging --------------------------------------------------------------
    @functools.cached_property
    def stg_item_mapping(self) -> DataFrame:
        return staging.stg_item_mapping(self.raw.item_mapping)

    @functools.cached_property
    def stg_prices_5m(self) -> DataFrame:
        return staging.stg_prices_5m(self.raw.prices_5m)

    @functools.cached_property
    def stg_prices_1h(self) -> DataFrame:
        return staging.stg_prices_1h(self.raw.prices_1h)

    @functools.cached_property
    def stg_prices_latest(self) -> DataFrame:
        return staging.stg_prices_latest(self.raw.prices_latest)

    @functools.cached_property
    def stg_realized_fills(self) -> DataFrame:
        return staging.stg_realized_fills(self.raw.realized_fills)

    # marts ----------------------------------------------------------------
    @functools.cached_property
    def dim_items(self) -> DataFrame:
        return marts.dim_items(self.stg_item_mapping, self.raw.tax_exempt_items,
                               self.raw.buy_limit_overrides)

    @functools.cached_property
    def fct_prices(self) -> DataFrame:
        return marts.fct_prices(self.stg_prices_5m, self.dim_items)

    @functools.cached_property
    def agg_item_liquidity(self) -> DataFrame:
        return marts.agg_item_liquidity(self.stg_prices_1h, self.params)

    @functools.cached_property
    def agg_item_volatility(self) -> DataFrame:
        return marts.agg_item_volatility(self.fct_prices, self.params)

    @functools.cached_property
    def flip_opportunities(self) -> DataFrame:
        return marts.flip_opportunities(self.stg_prices_latest, None, self.dim_items,
                                        self.agg_item_liquidity, None, self.params,
                                        summary=marts.five_minute_summary(self.stg_prices_5m, self.params))

    @functools.cached_property
    def realized_fills(self) -> DataFrame:
        return marts.realized_fills(self.stg_realized_fills, self.dim_items)

    VIEW_NAMES = {
        "stg_item_mapping": "stg_item_mapping", "stg_prices_5m": "stg_prices_5m",
        "stg_prices_1h": "stg_prices_1h", "stg_prices_latest": "stg_prices_latest",
        "stg_realized_fills": "stg_realized_fills", "dim_items": "dim_items",
        "fct_prices": "fct_prices", "agg_item_liquidity": "agg_item_liquidity",
        "agg_item_volatility": "agg_item_volatility",
        "flip_opportunities": "agg_flip_opportunities", "realized_fills": "realized_fills",
    }

    def register_views(self) -> list[str]:
        """W-6: expose every model as a temp view under its reference name, so
        SQL consumers run unchanged (``spark.sql("select ... from
        agg_flip_opportunities order by max_profit_per_limit desc limit 20")``).
        Views are lazy: each read recomputes from the current inputs."""
        for attr, view in self.VIEW_NAMES.items():
            getattr(self, attr).createOrReplaceTempView(view)
        return list(self.VIEW_NAMES.values())


_GRAPHS: dict[tuple, Models] = {}


def fixture_models(spark: SparkSession, sf_dir: str, params: MartParams = FIXTURE_PARAMS) -> Models:
    """The model graph over the fixtures, built once per (session, folder,
    parameters).  DataFrames are immutable and lazy, so queries share the
    built plans; every query still executes in full."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), params)
    if key not in _GRAPHS:
        _GRAPHS[key] = Models(fixture_raw(spark, sf_dir), params)
    return _GRAPHS[key]

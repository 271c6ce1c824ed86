"""Independent DuckDB SQL for every registered query (the correctness oracle).

It computes the same results by other means than the Spark code and imports nothing from
it: keyed stacks (``union all by name`` and one ``group by``) instead of joins, ``max_by``
structs instead of ranked windows, centred sums of squares instead of raw ones, quotient and
remainder for rounding.  It runs on the driver tables registered as views.
"""

from __future__ import annotations

import datetime as dt

# The fixture's parameters (see FIXTURES.md).
AS_OF_TIME = dt.datetime(2001, 11, 5)
VOLATILITY_DAYS, LIQUIDITY_DAYS = 730, 365
HIGH_VALUE_GP, STALE_SPREAD_PCT, STALE_VOLUME = 50000, 10, 30
STANDARD_LANE = {"min_5m_volume": 20, "max_price_age_minutes": 300000}
HIGH_VALUE_LANE = {"min_volume_per_hour": 10, "max_est_hours": 2.0, "max_price_age_minutes": 300000}
# size and slide of the hopping windows, in days
HOP_VOLATILITY, HOP_LIQUIDITY = (360, 90), (30, 10)


def ts(value: dt.datetime) -> str:
    return f"TIMESTAMP '{value.isoformat(sep=' ')}'"


AS_OF = ts(AS_OF_TIME)
VOL_FROM = ts(AS_OF_TIME - dt.timedelta(days=VOLATILITY_DAYS))
LIQ_FROM = ts(AS_OF_TIME - dt.timedelta(days=LIQUIDITY_DAYS))


def rdiv(num: str, den: str) -> str:
    """num / den rounded half away from zero: the quotient, one more if twice the remainder
    reaches the divisor, and the sign."""
    n, d = f"cast({num} as bigint)", f"cast({den} as bigint)"
    return (f"(cast(sign({n}) * sign({d}) as bigint) * (abs({n}) // abs({d})"
            f" + cast(2 * (abs({n}) % abs({d})) >= abs({d}) as bigint)))")


def dec(n: str, scale: int, precision: int) -> str:
    if scale == 0:
        return f"cast({n} as decimal({precision},0))"
    unit = f"cast('{10 ** -scale:.{scale}f}' as decimal({scale},{scale}))"
    return f"cast(cast({n} as decimal(20,0)) * {unit} as decimal({precision},{scale}))"


# --- raw layer (driver tables -> raw price-feed tables) ------------------------

RAW = {
    "raw_item_mapping": """
select cast(p_partkey as int) item_id, p_name as name, p_brand examine, (p_size % 2 = 0) members,
  cast(p_size as int) lowalch, cast(floor(p_retailprice) as int) highalch,
  case when p_size % 10 = 0 then null else cast(p_size as int) end buy_limit,
  cast(floor(p_retailprice) as int) value, p_type icon, TIMESTAMP '2001-11-01 00:00:00' loaded_at
from part""",
    "seed_tax_exempt_items": """
select cast(p_partkey as int) item_id, p_name item_name, 'tool' reason from part where p_partkey % 97 = 0""",
    "seed_buy_limit_overrides": """
select cast(p_partkey as int) item_id, 1 buy_limit, p_name item_name, 'x' reason from part where p_partkey % 89 = 0""",
    "raw_prices_5m": """
select cast(l_partkey + case when l_partkey % 7 = 0 then 1000000000 else 0 end as int) item_id,
  cast(floor(sum(cast(floor(l_extendedprice) as int)) filter (where l_returnflag='A') / count(*) filter (where l_returnflag='A')) as int) avg_high_price,
  cast(sum(cast(l_quantity as int)) filter (where l_returnflag='A') as int) high_price_volume,
  cast(floor(sum(cast(floor(l_extendedprice) as int)) filter (where l_returnflag='R') / count(*) filter (where l_returnflag='R')) as int) avg_low_price,
  cast(sum(cast(l_quantity as int)) filter (where l_returnflag='R') as int) low_price_volume,
  cast(date_trunc('quarter', l_shipdate) as timestamp) as "timestamp",
  cast(date_trunc('quarter', l_shipdate) as timestamp) loaded_at
from lineitem group by l_partkey, cast(date_trunc('quarter', l_shipdate) as timestamp)""",
    "raw_prices_1h": """
select cast(l_partkey + case when l_partkey % 7 = 0 then 1000000000 else 0 end as int) item_id,
  cast(max(floor(l_extendedprice)) as int) avg_high_price,
  cast(sum(case when l_returnflag='A' then cast(l_quantity as int) else 0 end) as int) high_price_volume,
  cast(min(floor(l_extendedprice)) as int) avg_low_price,
  cast(sum(case when l_returnflag='R' then cast(l_quantity as int) else 0 end) as int) low_price_volume,
  l_shipdate as "timestamp", l_shipdate loaded_at
from lineitem group by l_partkey, l_shipdate""",
    "raw_prices_latest": """
select cast(l_partkey + case when l_partkey % 7 = 0 then 1000000000 else 0 end as int) item_id,
  cast(max(floor(l_extendedprice)) as int) high_price, max(l_shipdate) filter (where l_returnflag='A') high_time,
  cast(min(floor(l_extendedprice)) as int) low_price, max(l_shipdate) filter (where l_returnflag='R') low_time,
  cast(date_trunc('quarter', l_shipdate) as timestamp) loaded_at
from lineitem group by l_partkey, cast(date_trunc('quarter', l_shipdate) as timestamp)""",
    "poll_latest": """
select cast(user_id as int) item_id,
  case when event_type <> 'error' then cast(floor(value/40)*40+200 as int) end high_price,
  case when event_type in ('purchase','view') then ts end high_time,
  case when event_type not in ('error','signup') then cast(floor(value/80)*40+150 as int) end low_price,
  case when event_type in ('click','view') then ts end low_time, ts loaded_at
from events""",
    "raw_realized_fills": """
select o_orderkey event_id, concat('f', cast(o_orderkey // 8 as varchar)) flip_id,
  case when o_orderkey % 2 = 0 then 'buy' else 'sell' end leg, cast(o_custkey as int) item_id,
  concat('v1.', cast(o_custkey % 3 as varchar)) bot_version,
  case when o_orderstatus='F' then 'filled' when o_orderstatus='P' then 'partial'
       when o_orderpriority like '1%' then 'cancelled_deadline'
       when o_orderpriority like '2%' then 'cancelled_pricemove' else 'cancelled_manual' end event,
  cast(o_orderkey % 50 as int) requested_qty,
  cast(case when o_orderstatus='F' then o_orderkey % 50 else floor((o_orderkey % 50)/2) end as int) filled_qty,
  cast(floor(o_totalprice) as int) offer_price,
  case when o_orderkey % 50 < 2 then null else cast(floor(o_totalprice) + (o_orderkey % 7) - 3 as decimal(18,4)) end avg_fill_price,
  case when o_orderkey % 2 = 1 then cast(floor(o_totalprice/50) as int) end tax_paid,
  case when o_orderkey % 2 = 1 then cast(floor(o_totalprice/50) as bigint) * (o_orderkey % 5 - 2) end realized_profit,
  o_orderdate offer_placed_at, case when o_orderstatus <> 'O' then ship end filled_at,
  cast(substr(o_orderpriority,1,1) as int)*1000 monitor_ms, cast(o_custkey % 4 as int)*250 tolerance_ms,
  cast(o_orderkey % 3 as int) relist_count, o_orderdate recorded_at
from orders left join (select l_orderkey, max(l_shipdate) ship from lineitem group by l_orderkey) s
  on l_orderkey = o_orderkey""",
}


def spread_pct_sql(h: str, l: str) -> str:
    return (f"case when {l} > 0 and {h} is not null then "
            f"{dec(rdiv(f'(cast({h} as bigint) - {l}) * 10000', l), 2, 14)} end")


def _spread_sql(h: str, l: str) -> str:
    return f"{h} - {l}"   # NULL when either side is NULL


def _stddev_sql(n: str, v: str) -> str:
    """round(100 * stddev_samp(s / 2)) from the count and v = sum((n s - sum(s))^2), HUGEINT:
    the largest k near the floating root with (2k - 1)^2 n^2 (n - 1) <= 10000 v."""
    d = f"(cast({n} as hugeint) * {n} * ({n} - 1))"
    root = f"cast(floor((sqrt(10000 * cast({v} as double) / cast({d} as double)) + 1) / 2) as bigint)"
    near = ", ".join(f"case when cast(2 * ({root} + {k}) - 1 as hugeint) * (2 * ({root} + {k}) - 1) * {d} <= 10000 * {v} "
                     f"then {root} + {k} end" for k in (-1, 0, 1))
    return f"case when {n} >= 2 then case when {v} = 0 then 0 else greatest({near}) end end"


STAGING = {
    "stg_item_mapping": """
select item_id, name as item_name, examine, members as is_members, lowalch as low_alch_value,
  highalch as high_alch_value, buy_limit, value as shop_value, icon, loaded_at
from raw_item_mapping""",
    "stg_prices_5m": f"""
select item_id, avg_high_price, high_price_volume, avg_low_price, low_price_volume,
  "timestamp" as price_timestamp, loaded_at,
  {_spread_sql('avg_high_price', 'avg_low_price')} as spread_gp,
  {spread_pct_sql('avg_high_price', 'avg_low_price')} as spread_pct
from raw_prices_5m where avg_high_price is not null or avg_low_price is not null""",
    "stg_prices_latest": f"""
select item_id, high_price, high_time, low_price, low_time, loaded_at,
  {_spread_sql('high_price', 'low_price')} as spread_gp,
  {spread_pct_sql('high_price', 'low_price')} as spread_pct
from raw_prices_latest where high_price is not null or low_price is not null""",
    "stg_prices_1h": """
select item_id, avg_high_price, high_price_volume, avg_low_price, low_price_volume,
  "timestamp" as price_timestamp, loaded_at,
  coalesce(high_price_volume, 0) + coalesce(low_price_volume, 0) as total_volume
from raw_prices_1h where list_max([high_price_volume, low_price_volume]) > 0""",
    "stg_realized_fills": f"""
select * exclude (us),
  case when requested_qty > 0 then {dec(rdiv('filled_qty * 10000', 'requested_qty'), 4, 14)} end as fill_ratio,
  cast(avg_fill_price - offer_price as decimal(18,4)) as slippage_gp,
  cast(cast(us as decimal(20,0)) * cast('0.000001' as decimal(6,6)) as decimal(20,6)) as time_to_fill_seconds,
  event = 'filled' as is_filled, event = 'partial' as is_partial,
  event in ('cancelled_deadline', 'cancelled_pricemove', 'cancelled_manual') as is_cancelled
from (select *, epoch_us(filled_at) - epoch_us(offer_placed_at) as us from raw_realized_fills)""",
}

def _dim(exempt: str, limits: str) -> str:
    """Items, exemptions and limits stacked and grouped by item; a group without an item goes."""
    text = ["item_name", "examine", "low_alch_value", "high_alch_value", "shop_value", "icon"]
    return f"""
select item_id, {', '.join(f'max({c}) as {c}' for c in text)}, bool_or(is_members) as is_members,
  coalesce(max(fixed_limit), max(buy_limit)) as buy_limit,
  count(*) filter (where kind = 'exempt') > 0 as is_tax_exempt, max(loaded_at) as last_refreshed_at
from (select *, 'item' as kind from stg_item_mapping
      union all by name select item_id, 'exempt' as kind from {exempt}
      union all by name select item_id, buy_limit as fixed_limit, 'limit' as kind from {limits})
group by item_id having count(*) filter (where kind = 'item') > 0"""


def _flips(latest: str) -> str:
    """Each source as one struct per item, stacked and grouped by item."""
    return f"""
select item_id, d.item_name, d.buy_limit, d.is_members, q.high_price, q.low_price, q.spread_gp, q.spread_pct,
  v.high_price_volume, v.low_price_volume, q.loaded_at as price_updated_at, v.price_timestamp as volume_timestamp,
  tax_gp, q.spread_gp - tax_gp as profit_per_item,
  (q.spread_gp - tax_gp) * coalesce(d.buy_limit, 0) as max_profit_per_limit, d.is_tax_exempt,
  l.volume_per_hour, l.avg_volume_per_hour_24h,
  case when l.volume_per_hour <> 0 then {dec(rdiv('d.buy_limit * 100', 'l.volume_per_hour'), 2, 12)} end as est_hours_to_fill_limit,
  o.mid_volatility_1h, o.mid_volatility_pct_1h, q.high_price >= {HIGH_VALUE_GP} as is_high_value,
  {dec(rdiv(f'epoch_us({AS_OF}) - epoch_us(list_min([q.high_time, q.low_time]))', '6000000'), 1, 18)} as price_age_minutes,
  q.spread_pct > {STALE_SPREAD_PCT} and coalesce(l.volume_per_hour, 0) < {STALE_VOLUME} as is_stale
from (
  select *, list_min([q.high_price // 50, 5000000]) * cast(q.high_price >= 50 and not d.is_tax_exempt as bigint) as tax_gp
  from (
    select item_id, any_value(q) as q, any_value(d) as d, any_value(v) as v, any_value(l) as l, any_value(o) as o
    from (select item_id, max_by(x, loaded_at) as q from {latest} x where loaded_at <= {AS_OF} group by item_id
          union all by name select item_id, x as d from dim_items x
          union all by name select item_id, max_by(x, price_timestamp) as v from fct_prices x
            where price_timestamp <= {AS_OF} group by item_id
          union all by name select item_id, x as l from agg_item_liquidity x
          union all by name select item_id, x as o from agg_item_volatility x)
    group by item_id having any_value(q) is not null and any_value(d) is not null))
where q.spread_gp > tax_gp and q.low_price > 100 and l.volume_per_hour > 0"""


MARTS = {
    "dim_items": _dim("seed_tax_exempt_items", "seed_buy_limit_overrides"),
    "fct_prices": """
select item_id, price_timestamp, avg_high_price, high_price_volume, avg_low_price, low_price_volume,
  spread_gp, spread_pct, loaded_at
from stg_prices_5m where item_id in (select item_id from dim_items)""",
    "agg_item_liquidity": f"""
select item_id, newest.price_timestamp as latest_hour_ts, newest.total_volume as volume_per_hour,
  newest.high_price_volume as high_volume_per_hour, newest.low_price_volume as low_volume_per_hour,
  case when hours > 0 then {rdiv('volume', 'hours')} end as avg_volume_per_hour_24h, nullif(hours, 0) as hours_observed_24h
from (
  select item_id, max_by(x, price_timestamp) as newest,
    sum(total_volume) filter (where price_timestamp >= {LIQ_FROM}) as volume,
    count(*) filter (where price_timestamp >= {LIQ_FROM}) as hours
  from stg_prices_1h x where price_timestamp <= {AS_OF} group by item_id)""",
    "agg_item_volatility": f"""
select item_id, latest_snapshot_ts, n as snapshots_used_1h, {dec('m', 2, 14)} as mid_mean_1h,
  {dec('sd', 2, 14)} as mid_volatility_1h,
  case when m > 0 and sd is not null then {dec(rdiv('sd * 100000', 'm'), 3, 16)} end as mid_volatility_pct_1h
from (
  select item_id, latest_snapshot_ts, n, {rdiv('total * 50', 'n')} as m, {_stddev_sql('n', 'v')} as sd
  from (
    select item_id, max(seen) as latest_snapshot_ts, any_value(n) as n, any_value(total) as total,
      cast(sum(cast(n * s - total as hugeint) * (n * s - total)) as hugeint) as v
    from (
      select item_id, price_timestamp as seen, cast(avg_high_price as bigint) + avg_low_price as s,
        count(*) over item as n, cast(sum(cast(avg_high_price as bigint) + avg_low_price) over item as bigint) as total
      from fct_prices
      where avg_high_price is not null and avg_low_price is not null
        and price_timestamp between {VOL_FROM} and {AS_OF}
      window item as (partition by item_id))
    group by item_id))""",
    "flip_opportunities": _flips("stg_prices_latest"),
    "realized_fills": f"""
select f.event_id, f.flip_id, f.leg, f.item_id, d.item_name, f.bot_version, f.event, f.requested_qty,
  f.filled_qty, f.fill_ratio, f.offer_price, f.avg_fill_price, f.slippage_gp, f.tax_paid, f.realized_profit,
  f.offer_placed_at, f.filled_at, f.time_to_fill_seconds,
  {dec(rdiv('cast(f.time_to_fill_seconds * 1000000 as bigint)', '360000'), 4, 20)} as time_to_fill_hours,
  f.monitor_ms, f.tolerance_ms, f.relist_count, f.is_filled, f.is_partial, f.is_cancelled, f.recorded_at
from stg_realized_fills f left join dim_items d on d.item_id = f.item_id""",
}

# Dependency order of the named CTEs every query may use.
_CHAIN = [*RAW.items(), *STAGING.items(), *MARTS.items()]


def with_models(body: str, chain: list | None = None) -> str:
    """Prefix ``body`` with every model it (transitively) names, in order."""
    import re

    chain = _CHAIN if chain is None else chain

    needed: set[str] = set()

    def visit(text: str):
        for name, sql in chain:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(sql)

    visit(body)
    ctes = [f"{name} as ({sql}\n)" for name, sql in chain if name in needed]
    if not ctes:
        return body
    head = body.lstrip()
    if head[:5].lower() == "with ":
        return "with " + ",\n".join(ctes) + ",\n" + head[5:]
    return "with " + ",\n".join(ctes) + "\n" + body


QUERIES: dict[str, str] = {}
for _name in [*STAGING, *MARTS]:
    QUERIES[_name] = with_models(f"select * from {_name}")


# --- operators and consumers ---------------------------------------------------

_LP, _HP = STANDARD_LANE, HIGH_VALUE_LANE
# The checks of every model and source.
NOT_NULL = {
    "dim_items": ["item_id", "item_name", "is_tax_exempt"],
    "fct_prices": ["item_id", "price_timestamp"],
    "agg_flip_opportunities": ["item_id"],
    "agg_item_liquidity": ["item_id"],
    "agg_item_volatility": ["item_id"],
    "realized_fills": ["event_id", "flip_id", "item_id"],
    "raw.item_mapping": ["item_id", "name"],
    "raw.prices_5m": ["item_id", "timestamp"],
    "raw.prices_latest": ["item_id", "loaded_at"],
    "raw.prices_1h": ["item_id", "timestamp"],
    "raw.realized_fills": ["flip_id", "item_id", "leg", "event"],
}
UNIQUE = {"dim_items": "item_id", "agg_flip_opportunities": "item_id", "agg_item_liquidity": "item_id",
          "agg_item_volatility": "item_id", "realized_fills": "event_id", "raw.item_mapping": "item_id"}
ACCEPTED_VALUES = {
    ("raw.realized_fills", "leg"): ("buy", "sell"),
    ("raw.realized_fills", "event"): ("filled", "partial", "cancelled_deadline", "cancelled_pricemove", "cancelled_manual"),
}
UNIQUE_COMBINATION = {"fct_prices": ("item_id", "price_timestamp")}
# minutes after which a source warns and fails
FRESHNESS = {"raw.prices_5m": (15, 60), "raw.prices_latest": (5, 30), "raw.prices_1h": (90, 180)}
# model names used by the checks -> CTE names here
_CTE = {"agg_flip_opportunities": "flip_opportunities", "raw.item_mapping": "raw_item_mapping",
        "raw.prices_5m": "raw_prices_5m", "raw.prices_latest": "raw_prices_latest",
        "raw.prices_1h": "raw_prices_1h", "raw.realized_fills": "raw_realized_fills"}


def _t(model: str) -> str:
    return _CTE.get(model, model)


def _age_us(col: str) -> str:
    return f"(epoch_us({AS_OF}) - epoch_us({col}))"


def _rate(part: str) -> str:
    return dec(rdiv(f"{part} * 10000", "count(*)"), 4, 10)


_NOT_NULL = "\nunion all\n".join(
    f"select '{m}' as model, '{c}' as column_name, count(*) filter (where \"{c}\" is null) as failures from {_t(m)}"
    for m, cols in NOT_NULL.items() for c in cols)
_UNIQUE = "\nunion all\n".join(
    f"select '{m}' as model, '{c}' as column_name, count(*) as failures from "
    f"(select {c} from {_t(m)} where {c} is not null group by {c} having count(*) > 1)"
    for m, c in UNIQUE.items())
_ACCEPTED = "\nunion all\n".join(
    f"select '{m}' as model, '{c}' as column_name, count(*) as failing_values, "
    f"cast(coalesce(sum(n), 0) as bigint) as failing_rows from "
    f"(select {c}, count(*) n from {_t(m)} where {c} not in ({', '.join(repr(v) for v in vals)}) group by {c})"
    for (m, c), vals in ACCEPTED_VALUES.items())
_UNIQUE_COMB = "\nunion all\n".join(
    f"select '{m}' as model, '{','.join(cols)}' as column_name, count(*) as failures from "
    f"(select {', '.join(cols)} from {_t(m)} group by {', '.join(cols)} having count(*) > 1)"
    for m, cols in UNIQUE_COMBINATION.items())


def _fresh_sql(src: str, limits: tuple[int, int]) -> str:
    warn, error = limits
    age = _age_us("max(loaded_at)")
    return (f"select '{src}' as source_name, max(loaded_at) as max_loaded_at, "
            f"{dec(rdiv(age, '6000000'), 1, 18)} as age_minutes, "
            f"{warn} as warn_after_minutes, {error} as error_after_minutes, "
            f"case when {age} is null or {age} > {error * 60_000_000} then 'error' when {age} > {warn * 60_000_000} then 'warn' "
            f"else 'pass' end as status from {_t(src)}")


_FRESH = "\nunion all\n".join(_fresh_sql(s, lim) for s, lim in FRESHNESS.items())
_INVERSIONS = """select item_id, price_timestamp, avg_high_price, avg_low_price from fct_prices
where avg_high_price is not null and avg_low_price is not null and avg_high_price < avg_low_price"""
_ORPHANS = """select item_id, count(*) as orphan_rows, min(price_timestamp) as first_price_timestamp,
  max(price_timestamp) as last_price_timestamp
from stg_prices_5m p where not exists (select 1 from dim_items d where d.item_id = p.item_id)
group by item_id"""


def _report_rows(sql: str, check: str, severity: str, failures: str = "failures") -> str:
    bad = "'fail'" if severity == "error" else "'warn'"
    return (f"select '{check}' as check_name, model, column_name, '{severity}' as severity, "
            f"cast({failures} as bigint) as failures, "
            f"case when {failures} = 0 then 'pass' else {bad} end as status from ({sql})")


_REPORT = "\nunion all\n".join([
    _report_rows(_NOT_NULL, "not_null", "error"),
    _report_rows(_UNIQUE, "unique", "error"),
    _report_rows(_ACCEPTED, "accepted_values", "error", "failing_values"),
    _report_rows(_UNIQUE_COMB, "unique_combination_of_columns", "error"),
    _report_rows(f"select 'fct_prices' as model, 'avg_high_price,avg_low_price' as column_name, "
                 f"count(*) as failures from ({_INVERSIONS})", "assert_price_high_gte_low", "warn"),
    _report_rows(f"select 'fct_prices' as model, 'item_id' as column_name, count(*) as failures "
                 f"from ({_ORPHANS})", "orphan_prices", "warn"),
    f"""select 'source_freshness' as check_name, source_name as model, 'loaded_at' as column_name,
  case when status = 'error' then 'error' else 'warn' end as severity,
  cast(case when status = 'pass' then 0 else 1 end as bigint) as failures,
  case when status = 'error' then 'fail' else status end as status from ({_FRESH})""",
])

_LEG = ["event_id", "item_id", "event", "filled_qty", "avg_fill_price", "offer_placed_at",
        "filled_at", "realized_profit"]
_LEG_COLS = ",\n  ".join(f"max(case when leg = '{lg}' then {c} end) as {lg}_{c}"
                         for lg in ("buy", "sell") for c in _LEG)

CONSUMERS = {
    "latest_per_key": f"""
select distinct on (item_id) item_id, loaded_at, high_price, low_price, spread_gp, spread_pct, high_time, low_time
from stg_prices_latest where loaded_at <= {AS_OF} order by item_id, loaded_at desc""",
    "sale_tax": """
select s.item_id, s.loaded_at, s.high_price, d.is_tax_exempt,
  cast(case when d.is_tax_exempt then 0 when s.high_price < 50 then 0
       else least(s.high_price // 50, 5000000) end as bigint) as tax_gp
from stg_prices_latest s join dim_items d using (item_id)""",
    "top_flips": """
select * from flip_opportunities order by max_profit_per_limit desc nulls last, item_id limit 20""",
    "recent_fills": """
select event_id, flip_id, leg, item_name, event, fill_ratio, slippage_gp, time_to_fill_hours,
  realized_profit, recorded_at
from realized_fills order by recorded_at desc, event_id desc limit 10""",
    "fills_count": "select count(*) as n_events from raw_realized_fills",
    "standard_lane": f"""
select * from flip_opportunities
where not is_high_value and coalesce(high_price_volume, 0) > {_LP['min_5m_volume']}
  and coalesce(low_price_volume, 0) > {_LP['min_5m_volume']} and not coalesce(is_stale, false)
  and (price_age_minutes is null or price_age_minutes <= {_LP['max_price_age_minutes']})""",
    "high_value_lane": f"""
select * from flip_opportunities
where is_high_value and coalesce(volume_per_hour, 0) >= {_HP['min_volume_per_hour']}
  and est_hours_to_fill_limit <= {_HP['max_est_hours']} and not coalesce(is_stale, false)
  and (price_age_minutes is null or price_age_minutes <= {_HP['max_price_age_minutes']})""",
    "fill_rates_by_cadence": f"""
select monitor_ms, tolerance_ms, relist_count, bot_version, count(*) as events,
  count(*) filter (where is_filled) as filled, count(*) filter (where is_partial) as partial,
  count(*) filter (where is_cancelled) as cancelled,
  count(*) filter (where event = 'cancelled_deadline') as deadline_cancels,
  count(*) filter (where event = 'cancelled_pricemove') as pricemove_cancels,
  count(*) filter (where event = 'cancelled_manual') as manual_cancels,
  {_rate("count(*) filter (where is_filled)")} as fill_rate,
  {_rate("count(*) filter (where is_partial)")} as partial_rate,
  {_rate("count(*) filter (where is_cancelled)")} as cancel_rate,
  {_rate("count(*) filter (where event = 'cancelled_deadline')")} as deadline_cancel_rate,
  case when count(fill_ratio) > 0 then
    {dec(rdiv('sum(cast(fill_ratio * 10000 as bigint))', 'count(fill_ratio)'), 4, 14)} end as avg_fill_ratio
from realized_fills group by monitor_ms, tolerance_ms, relist_count, bot_version""",
    "fill_time_vs_estimate": f"""
with agg as (
  select item_id, count(*) as filled_events, sum(epoch_us(filled_at) - epoch_us(offer_placed_at)) as us
  from realized_fills where is_filled and time_to_fill_seconds is not null group by item_id),
j as (
  select a.item_id, f.item_name, a.filled_events,
    {dec(rdiv('a.us', 'a.filled_events * 360000'), 4, 20)} as avg_time_to_fill_hours,
    f.est_hours_to_fill_limit
  from agg a join flip_opportunities f using (item_id))
select *, cast(avg_time_to_fill_hours - est_hours_to_fill_limit as decimal(20,4)) as fill_time_gap_hours from j""",
    "profit_realized_vs_predicted": """
with agg as (
  select item_id, count(*) as sell_events, cast(sum(filled_qty) as bigint) as units_sold,
    cast(sum(realized_profit) as bigint) as realized_profit
  from realized_fills where leg = 'sell' group by item_id)
select a.item_id, a.sell_events, a.units_sold, a.realized_profit, f.profit_per_item,
  f.profit_per_item * a.units_sold as predicted_profit,
  a.realized_profit - f.profit_per_item * a.units_sold as profit_gap
from agg a left join flip_opportunities f using (item_id)""",
    "buy_slippage": f"""
select item_id, count(*) as buy_fills,
  {dec(rdiv('sum(cast(slippage_gp * 10000 as bigint))', 'count(*)'), 4, 18)} as avg_slippage_gp,
  min(slippage_gp) as min_slippage_gp, max(slippage_gp) as max_slippage_gp,
  count(*) filter (where slippage_gp < 0) as favourable_fills
from realized_fills where leg = 'buy' and slippage_gp is not null group by item_id""",
    "flip_round_trips": f"""
with legs as (
  select distinct on (flip_id, leg) * from realized_fills order by flip_id, leg, event_id desc),
p as (
  select flip_id,
  {_LEG_COLS}
  from legs group by flip_id)
select flip_id, coalesce(buy_item_id, sell_item_id) as item_id, buy_event_id, sell_event_id,
  buy_event, sell_event, buy_filled_qty, sell_filled_qty, buy_avg_fill_price as buy_fill_price,
  sell_avg_fill_price as sell_fill_price, sell_realized_profit as realized_profit,
  cast(cast(epoch_us(sell_filled_at) - epoch_us(buy_offer_placed_at) as decimal(20,0))
       * cast('0.000001' as decimal(6,6)) as decimal(20,6)) as hold_seconds,
  (coalesce(buy_event = 'filled', false) and coalesce(sell_event = 'filled', false)) as is_complete
from p""",
    "dq_not_null": _NOT_NULL,
    "dq_unique": _UNIQUE,
    "dq_accepted_values": _ACCEPTED,
    "dq_unique_combination": _UNIQUE_COMB,
    "dq_price_inversions": _INVERSIONS,
    "dq_freshness": _FRESH,
    "dq_orphans": _ORPHANS,
    "dq_report": _REPORT,
}

for _name, _sql in CONSUMERS.items():
    QUERIES[_name] = with_models(_sql)


# --- sources and write modes ----------------------------------------------------

_FILL_COLS = ("flip_id, leg, item_id, bot_version, event, requested_qty, filled_qty, offer_price, "
              "avg_fill_price, tax_paid, realized_profit, offer_placed_at, filled_at, monitor_ms, "
              "tolerance_ms, relist_count")
def _uid_part(col: str) -> str:
    text = f"epoch_us({col})" if col in ("offer_placed_at", "filled_at") else col
    text = f"cast({text} as varchar)"
    return f"coalesce(cast(length({text}) as varchar) || ':' || {text}, 'N')"


_UID = "sha256(concat_ws('|', " + ", ".join(_uid_part(c.strip()) for c in _FILL_COLS.split(",")) + "))"
_MAP_A = """select cast(p_partkey + 100 as int) item_id, 'stale ' || p_name as name, p_brand examine,
  (p_size % 2 = 0) members, cast(p_size as int) lowalch, cast(floor(p_retailprice) as int) highalch,
  cast(p_size as int) buy_limit, cast(floor(p_retailprice) as int) value, p_type icon,
  TIMESTAMP '2001-11-02 00:00:00' loaded_at, 'a' as pg from part"""
_MAP_B = """select cast(p_partkey + 200 as int) item_id, upper(p_name) as name,
  case when p_size % 3 = 0 then p_brand end examine,
  (p_size % 2 = 0) members, cast(p_size as int) lowalch, cast(floor(p_retailprice) as int) highalch,
  cast(p_size as int) buy_limit, cast(floor(p_retailprice) as int) value, p_type icon,
  TIMESTAMP '2001-11-02 00:00:00' loaded_at, 'b' as pg from part"""

WRITES = {
    "ingest_latest_payload": """
select item_id, high_price, high_time, low_price, low_time, loaded_at from raw_prices_latest
where high_price is not null or low_price is not null""",
    "ingest_window_payload": "select * from raw_prices_5m",
    "ingest_mapping_payload": "select * from raw_item_mapping",
    "upsert_items": f"""
with batch as ({_MAP_A}
  union all
  {_MAP_B}),
dedup as (select distinct on (item_id) * from batch order by item_id, pg desc)
select t.* from raw_item_mapping t where not exists (select 1 from dedup d where d.item_id = t.item_id)
union all
select item_id, name, examine, members, lowalch, highalch, buy_limit, value, icon, loaded_at from dedup""",
    "insert_ignore_prices": """
with target as (select * from raw_prices_5m where "timestamp" < TIMESTAMP '2000-01-01 00:00:00'),
batch as (
  select item_id, avg_high_price + 1 as avg_high_price, high_price_volume, avg_low_price + 1 as avg_low_price,
    low_price_volume, "timestamp", loaded_at
  from raw_prices_5m where "timestamp" >= TIMESTAMP '1999-07-01 00:00:00')
select * from target
union all
select * from batch b where not exists
  (select 1 from target t where t.item_id = b.item_id and t."timestamp" = b."timestamp")""",
    "insert_if_changed": """
with polls as (select * from poll_latest where high_price is not null or low_price is not null),
l as (
  select *, lag(high_price) over w as ph, lag(low_price) over w as pl, row_number() over w as rn
  from polls window w as (partition by item_id order by loaded_at))
select item_id, high_price, high_time, low_price, low_time, loaded_at from l
where rn = 1 or not (high_price is not distinct from ph and low_price is not distinct from pl)""",
    "append_fills": f"""
with done as (
  select flip_id, leg, item_id, bot_version, 'filled' as event, requested_qty, requested_qty as filled_qty,
    offer_price, avg_fill_price, tax_paid, realized_profit, offer_placed_at,
    coalesce(filled_at, offer_placed_at) as filled_at, monitor_ms, tolerance_ms, relist_count
  from raw_realized_fills where event = 'partial'),
batch as (
  select * from done union all select * from done
  union all select {_FILL_COLS} from raw_realized_fills),
uid as (select *, {_UID} as event_uid from batch),
stored as (select {_UID} as event_uid from raw_realized_fills),
new as (
  select distinct on (event_uid) * from uid
  where event_uid not in (select event_uid from stored) order by event_uid)
select (select coalesce(max(event_id), 0) from raw_realized_fills)
    + row_number() over (order by flip_id nulls first, leg nulls first, event nulls first,
      filled_qty nulls first, offer_placed_at nulls first, filled_at nulls first, event_uid nulls first)
    as event_id,
  {_FILL_COLS}, TIMESTAMP '2001-11-05 00:00:00' as recorded_at, event_uid
from new""",
}

for _name, _sql in WRITES.items():
    QUERIES[_name] = with_models(_sql)


# --- streaming operators and refresh jobs -------------------------------------------

_DAY_US = 86_400_000_000


def _hop(size_days: int, slide_days: int) -> tuple[int, int, int]:
    return size_days * _DAY_US, slide_days * _DAY_US, size_days // slide_days


_VS, _VL, _VK = _hop(*HOP_VOLATILITY)
_LS, _LL, _LK = _hop(*HOP_LIQUIDITY)

# change-detected /latest history, as the ingest jobs store it
_CHAIN.append(("detected_latest", """
select item_id, high_price, high_time, low_price, low_time, loaded_at from (
  select *, lag(high_price) over w as ph, lag(low_price) over w as pl, row_number() over w as rn
  from raw_prices_latest where high_price is not null or low_price is not null
  window w as (partition by item_id order by loaded_at))
where rn = 1 or not (high_price is not distinct from ph and low_price is not distinct from pl)"""))
_CHAIN.append(("stg_detected_latest",
               STAGING["stg_prices_latest"].replace("from raw_prices_latest", "from detected_latest")))
_CHAIN.append(("refreshed_flips", _flips("stg_detected_latest")))

STREAMS = {
    "hopping_volatility": f"""
select item_id, make_timestamp(ws) as window_start, make_timestamp(ws + {_VS}) as window_end,
  n as snapshots, {dec('m', 2, 14)} as mid_mean, {dec('sd', 2, 14)} as mid_volatility,
  case when m > 0 and sd is not null then {dec(rdiv('sd * 100000', 'm'), 3, 16)} end as mid_volatility_pct
from (
  select item_id, ws, n, {rdiv('total * 50', 'n')} as m, {_stddev_sql('n', 'v')} as sd
  from (
    select item_id, ws, any_value(n) as n, any_value(total) as total,
      cast(sum(cast(n * s - total as hugeint) * (n * s - total)) as hugeint) as v
    from (select *, count(*) over hop as n, cast(sum(s) over hop as bigint) as total
          from (select item_id, s, t - (t % {_VL}) - unnest(range(0, {_VK})) * {_VL} as ws
                from (select item_id, epoch_us(price_timestamp) as t,
                        cast(avg_high_price as bigint) + avg_low_price as s
                      from fct_prices where avg_high_price is not null and avg_low_price is not null))
          window hop as (partition by item_id, ws))
    group by item_id, ws))""",
    "hopping_liquidity": f"""
with win as (
  select item_id, total_volume,
    epoch_us(price_timestamp) - (epoch_us(price_timestamp) % {_LL}) - unnest(range(0, {_LK})) * {_LL} as ws
  from stg_prices_1h)
select item_id, make_timestamp(ws) as window_start, make_timestamp(ws + {_LS}) as window_end,
  {rdiv('sum(total_volume)', 'count(*)')} as avg_volume_per_hour, count(*) as hours_observed
from win group by item_id, ws""",
    "stream_dedupe": "select * from raw_prices_5m",
    "stream_change_detect": WRITES["insert_if_changed"],
    "refresh_daily": "select * from refreshed_flips",
    "refresh_latest": "select * from refreshed_flips",
    "refresh_5m": "select * from refreshed_flips",
    "refresh_1h": "select * from refreshed_flips",
    "refresh_mixed": "select * from refreshed_flips",
    "views_over_store": """
select p.item_id, p.price_timestamp, p.spread_gp, f.profit_per_item
from fct_prices p left join refreshed_flips f on f.item_id = p.item_id""",
}

for _name, _sql in STREAMS.items():
    QUERIES[_name] = with_models(_sql)


# --- seeds and plain stream ingest ------------------------------------------------

# The seed rows.
TAX_EXEMPT = (13190, 1755, 5325, 1785, 2347, 1733, 233, 5341, 8794, 5329, 5343, 1735, 952, 5331)
BUY_LIMITS = {13190: 1}

_CHAIN.append(("packaged_exempt", f"select unnest({list(TAX_EXEMPT)}) as item_id"))
_CHAIN.append(("packaged_limits", f"select unnest({list(BUY_LIMITS)}) as item_id, unnest({list(BUY_LIMITS.values())}) as buy_limit"))

EXTRA = {
    "seed_tax_exempt": "select * from (" + _dim("packaged_exempt", "packaged_limits") + ")",
    "stream_ingest": "select * from raw_prices_5m",
}

for _name, _sql in EXTRA.items():
    QUERIES[_name] = with_models(_sql)


# --- checks over raw tables with planted defects ----------------------------------

_DIRTY = {
    "raw_item_mapping": "select * replace (case when item_id % 60 <> 0 then name end as name) from sound_item_mapping",
    "raw_prices_5m": """
select * replace (TIMESTAMP '2001-11-04 23:50:00' as loaded_at)
from (select * from sound_prices_5m union all select * from sound_prices_5m where item_id % 40 = 0)""",
    "raw_prices_latest": """
select * replace (case when loaded_at >= TIMESTAMP '2001-07-01 00:00:00' then TIMESTAMP '2001-11-04 23:50:00' else loaded_at end as loaded_at)
from sound_prices_latest""",
    "raw_realized_fills": """
with f as (select * replace (case when event_id % 30 = 0 then 'hold' else leg end as leg,
                             case when event_id % 45 = 0 then 'lost' else event end as event,
                             case when event_id % 35 <> 0 then flip_id end as flip_id) from sound_realized_fills)
select * from f union all select * from f where event_id % 50 = 0""",
}
_DIRTY_CHAIN = []
for _name, _sql in _CHAIN:
    if _name in _DIRTY:
        _DIRTY_CHAIN += [(_name.replace("raw_", "sound_"), _sql), (_name, _DIRTY[_name])]
    else:
        _DIRTY_CHAIN.append((_name, _sql))
QUERIES["dq_report_dirty"] = with_models(_REPORT, _DIRTY_CHAIN)


# --- the rows behind the counts: name=value pairs, instants as epoch microseconds -------

_FEED = "item_id avg_high_price high_price_volume avg_low_price low_price_volume timestamp@ loaded_at@"
_FILL = ("event_id flip_id leg item_id {0}bot_version event requested_qty filled_qty {1}offer_price avg_fill_price {2}tax_paid "
         "realized_profit offer_placed_at@ filled_at@ {3}monitor_ms tolerance_ms relist_count {4}recorded_at@")
# The columns of every model and source, @ marks instants.
ROW_COLUMNS = {
    "dim_items": "item_id item_name examine is_members low_alch_value high_alch_value buy_limit shop_value icon is_tax_exempt last_refreshed_at@",
    "fct_prices": "item_id price_timestamp@ avg_high_price high_price_volume avg_low_price low_price_volume spread_gp spread_pct loaded_at@",
    "agg_flip_opportunities": "item_id item_name buy_limit is_members high_price low_price spread_gp spread_pct high_price_volume "
                              "low_price_volume price_updated_at@ volume_timestamp@ tax_gp profit_per_item max_profit_per_limit is_tax_exempt "
                              "volume_per_hour avg_volume_per_hour_24h est_hours_to_fill_limit mid_volatility_1h mid_volatility_pct_1h "
                              "is_high_value price_age_minutes is_stale",
    "agg_item_liquidity": "item_id latest_hour_ts@ volume_per_hour high_volume_per_hour low_volume_per_hour avg_volume_per_hour_24h hours_observed_24h",
    "agg_item_volatility": "item_id latest_snapshot_ts@ snapshots_used_1h mid_mean_1h mid_volatility_1h mid_volatility_pct_1h",
    "realized_fills": _FILL.format("item_name ", "fill_ratio ", "slippage_gp ", "time_to_fill_seconds time_to_fill_hours ", "is_filled is_partial is_cancelled "),
    "raw.item_mapping": "item_id name examine members lowalch highalch buy_limit value icon loaded_at@",
    "raw.prices_5m": _FEED, "raw.prices_1h": _FEED,
    "raw.prices_latest": "item_id high_price high_time@ low_price low_time@ loaded_at@",
    "raw.realized_fills": _FILL.format("", "", "", "", ""),
    "stg_prices_5m": "item_id avg_high_price high_price_volume avg_low_price low_price_volume price_timestamp@ loaded_at@ spread_gp spread_pct",
}


def _row_text(model: str) -> str:
    def text(c: str) -> str:
        value = f'cast(epoch_us("{c[:-1]}") as varchar)' if c.endswith("@") else f'cast("{c}" as varchar)'
        return f"'{c.rstrip('@')}=' || coalesce({value}, 'NULL')"
    return "concat_ws('|', " + ", ".join(text(c) for c in ROW_COLUMNS[model].split()) + ")"


def _failing(check: str, model: str, column: str, where: str, severity: str = "error", table: str | None = None) -> str:
    return (f"select '{check}' as check_name, '{model}' as model, '{column}' as column_name, '{severity}' as severity, "
            f"{_row_text(table or model)} as row from {_t(table or model)} t where {where}")


_FAILING = "\nunion all\n".join(
    [_failing("not_null", m, c, f'"{c}" is null') for m, cols in NOT_NULL.items() for c in cols]
    + [_failing("accepted_values", m, c, f"{c} not in ({', '.join(map(repr, v))})") for (m, c), v in ACCEPTED_VALUES.items()]
    + [_failing("unique", m, c, f"{c} in (select {c} from {_t(m)} group by {c} having count(*) > 1)") for m, c in UNIQUE.items()]
    + [_failing("unique_combination_of_columns", m, ",".join(cols),
                f"({', '.join(cols)}) in (select ({', '.join(cols)}) from {_t(m)} group by {', '.join(cols)} having count(*) > 1)")
       for m, cols in UNIQUE_COMBINATION.items()]
    + [_failing("assert_price_high_gte_low", "fct_prices", "avg_high_price,avg_low_price", "avg_high_price < avg_low_price", "warn"),
       _failing("orphan_prices", "fct_prices", "item_id", "not exists (select 1 from dim_items d where d.item_id = t.item_id)", "warn", "stg_prices_5m")])
QUERIES["dq_failing_rows"] = with_models(_FAILING, _DIRTY_CHAIN)


# --- stored tables over several loads ----------------------------------------------

# A second session looks after the documents before each of these times are loaded, and after all.
VIEW_CUTS = ("1997-01-01 00:00:00", "2000-01-01 00:00:00", "9999-01-01 00:00:00")


def _seen_by_then(load: int, cut: str) -> str:
    chain = []
    for name, sql in _CHAIN:
        if name in ("raw_prices_5m", "raw_prices_1h", "raw_prices_latest"):
            whole = name.replace("raw_", "whole_")
            chain += [(whole, sql), (name, f"select * from {whole} where loaded_at < TIMESTAMP '{cut}'")]
        else:
            chain.append((name, sql))
    return with_models(f"""
select {load} as load, p.item_id, p.price_timestamp, p.spread_gp, f.profit_per_item, f.volume_per_hour
from fct_prices p left join refreshed_flips f on f.item_id = p.item_id""", chain)


QUERIES["views_two_sessions"] = "\nunion all\n".join(f"select * from ({_seen_by_then(i, cut)})" for i, cut in enumerate(VIEW_CUTS))

LOADS = {
    "fct_prices_incremental": "select * from fct_prices",
    "flip_from_buckets": "select * from refreshed_flips",
    "dq_report_incremental": _REPORT,
    "hopping_liquidity_stream": STREAMS["hopping_liquidity"],
    "upsert_any_order": f"""
with polls as (
  select * from raw_item_mapping
  union all by name select * exclude (pg) from ({_MAP_A})
  union all by name select * exclude (pg) replace (TIMESTAMP '2001-11-03 00:00:00' as loaded_at) from ({_MAP_B}))
select p.item_id, p.name, p.examine, p.members, p.lowalch, p.highalch, p.buy_limit, p.value, p.icon, p.loaded_at
from polls p join (select item_id, max(loaded_at) as newest from polls group by item_id) n
  on n.item_id = p.item_id and n.newest = p.loaded_at""",
    "ingest_mapping_dirty": """
select cast(p_partkey as int) as item_id, reason, case when reason is null then p_name end as name,
  case when reason is null then p_size % 2 = 0 end as members, case when reason is null then cast(p_size as int) end as buy_limit,
  case when reason is null then cast(floor(p_retailprice) as int) end as highalch,
  case when reason is null then cast(floor(p_retailprice) as int) end as value
from (select *, case when p_partkey % 50 in (1, 2, 3) then 'value' when p_partkey % 50 = 4 then 'required' end as reason from part)""",
}

for _name, _sql in LOADS.items():
    QUERIES[_name] = with_models(_sql)

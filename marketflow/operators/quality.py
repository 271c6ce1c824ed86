"""Data-quality checks (Q-1 … Q-8).

A check returns a small DataFrame of results, never the rows of the table:
``not_null`` computes every column's NULL count in one ``agg`` pass per table,
uniqueness checks are one ``groupBy`` each (partial aggregation first), and
``report`` takes all checks of a table from one scan and unions them into
``(check_name, model, column_name, severity, failures, status)`` rows.  Nothing
runs before the result does.  Semantics follow the generic tests the reference
declares: NULLs pass ``unique`` and ``accepted_values``; a warn-severity test
never fails the run.  ``failing_rows`` returns the rows behind the counts.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions.exact import round_div, to_decimal
from marketflow.functions.time import as_of_column, instant, micros_between

# The tests the reference declares -------------------------------
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
UNIQUE = {
    "dim_items": "item_id",
    "agg_flip_opportunities": "item_id",
    "agg_item_liquidity": "item_id",
    "agg_item_volatility": "item_id",
    "realized_fills": "event_id",
    "raw.item_mapping": "item_id",
}
ACCEPTED_VALUES = {
    ("raw.realized_fills", "leg"): ("buy", "sell"),
    ("raw.realized_fills", "event"): ("filled", "partial", "cancelled_deadline",
                                      "cancelled_pricemove", "cancelled_manual"),
}
UNIQUE_COMBINATION = {"fct_prices": ("item_id", "price_timestamp")}


@dataclasses.dataclass(frozen=True)
class Freshness:
    warn_after: dt.timedelta
    error_after: dt.timedelta


FRESHNESS = {  # loaded_at age limits per source; the fill log has none
    "raw.prices_5m": Freshness(dt.timedelta(minutes=15), dt.timedelta(minutes=60)),
    "raw.prices_latest": Freshness(dt.timedelta(minutes=5), dt.timedelta(minutes=30)),
    "raw.prices_1h": Freshness(dt.timedelta(minutes=90), dt.timedelta(minutes=180)),
}


# --- individual checks -------------------------------------------------------

def not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Q-1: NULL count per column, all columns in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures").select(
        F.lit(model).alias("model"), "column_name", "failures")


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Q-2: number of non-NULL values that occur more than once."""
    dups = (df.filter(F.col(column).isNotNull()).groupBy(column).count()
            .filter(F.col("count") > 1))
    return dups.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), "failures")


def accepted_values(df: DataFrame, model: str, column: str, values: Sequence[str]) -> DataFrame:
    """Q-3: distinct unexpected values and the rows carrying them (NULL passes)."""
    bad = df.filter(~F.col(column).isin(*values)).groupBy(column).count()
    return bad.agg(F.count(F.lit(1)).alias("failing_values"),
                   F.coalesce(F.sum("count"), F.lit(0)).alias("failing_rows")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        "failing_values", "failing_rows")


def unique_combination(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Q-4: number of key combinations that occur more than once."""
    dups = df.groupBy(*columns).count().filter(F.col("count") > 1)
    return dups.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(",".join(columns)).alias("column_name"), "failures")


def price_inversions(fct: DataFrame) -> DataFrame:
    """Q-5 (warn): snapshots whose average high is below the average low."""
    h, l = F.col("avg_high_price"), F.col("avg_low_price")
    return (fct.filter(h.isNotNull() & l.isNotNull() & (h < l))
            .select("item_id", "price_timestamp", "avg_high_price", "avg_low_price"))


def freshness(source: DataFrame, name: str, limits: Freshness,
              as_of: dt.datetime | None = None) -> DataFrame:
    """Q-6: age of the newest ``loaded_at`` against warn / error limits."""
    newest = source.agg(F.max("loaded_at").alias("max_loaded_at"))
    age_us = micros_between(as_of_column(as_of), F.col("max_loaded_at"))
    warn_us = int(limits.warn_after.total_seconds() * 1_000_000)
    error_us = int(limits.error_after.total_seconds() * 1_000_000)
    return newest.select(
        F.lit(name).alias("source_name"), "max_loaded_at",
        to_decimal(round_div(age_us, 6_000_000), 1, 18).alias("age_minutes"),
        F.lit(int(limits.warn_after.total_seconds() // 60)).alias("warn_after_minutes"),
        F.lit(int(limits.error_after.total_seconds() // 60)).alias("error_after_minutes"),
        F.when(age_us.isNull() | (age_us > error_us), "error")
         .when(age_us > warn_us, "warn").otherwise("pass").alias("status"))


def orphans(stg_5m: DataFrame, dim: DataFrame) -> DataFrame:
    """Q-7: staged prices of items the dimension does not know (the fact table's
    inner join drops them silently)."""
    lost = stg_5m.join(dim.select("item_id"), "item_id", "left_anti")
    return lost.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("orphan_rows"),
        F.min("price_timestamp").alias("first_price_timestamp"),
        F.max("price_timestamp").alias("last_price_timestamp"))


# --- batched suites over a model graph ----------------------------------------

_MODELS = {"dim_items": "dim_items", "agg_flip_opportunities": "flip_opportunities",
           "agg_item_liquidity": "agg_item_liquidity", "agg_item_volatility": "agg_item_volatility",
           "fct_prices": "fct_prices", "realized_fills": "realized_fills"}


def _tables(models) -> dict[str, DataFrame]:
    """Check name -> (lazy) table of a model graph."""
    names = {*NOT_NULL, *UNIQUE, *UNIQUE_COMBINATION, *FRESHNESS, *(m for m, _ in ACCEPTED_VALUES)}
    return {n: getattr(models, _MODELS[n]) if n in _MODELS else getattr(models.raw, n.split(".", 1)[1]) for n in names}


def table_failures(df: DataFrame, model: str, columns: Sequence[str], unique_column: str | None = None,
                   combination: Sequence[str] | None = None, rows_where: dict | None = None) -> DataFrame:
    """(check_name, model, column_name, failures): NULL counts of ``columns``, values of
    ``unique_column`` or key combinations that occur more than once, and rows for which a
    named condition holds, all from one scan and at most one shuffle of the table."""
    keys = list(combination or ([unique_column] if unique_column else []))
    counts = {("not_null", c): F.count_if(F.col(c).isNull()) for c in columns}
    counts |= {k: F.count_if(c) for k, c in (rows_where or {}).items()}
    named = {f"_f{i}": k for i, k in enumerate(counts)}
    if keys:
        # per key first: the counts of its rows, then sums over the keys
        groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in zip(named, counts.values())])
        more = (F.col("_n") > 1) & (F.lit(True) if combination else F.col(keys[0]).isNotNull())
        totals = groups.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in named], F.count_if(more).alias("_dup"))
        named["_dup"] = ("unique_combination_of_columns" if combination else "unique", ",".join(keys))
    else:
        totals = df.agg(*[c.alias(n) for n, c in zip(named, counts.values())])
    return totals.select(F.inline(F.array(*[F.struct(
        F.lit(check).alias("check_name"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.col(n).alias("failures")) for n, (check, column) in named.items()])))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def not_null_suite(models) -> DataFrame:
    t = _tables(models)
    return _union([not_null(t[m], m, cols) for m, cols in NOT_NULL.items()])


def unique_suite(models) -> DataFrame:
    t = _tables(models)
    return _union([unique(t[m], m, c) for m, c in UNIQUE.items()])


def accepted_values_suite(models) -> DataFrame:
    t = _tables(models)
    return _union([accepted_values(t[m], m, c, v) for (m, c), v in ACCEPTED_VALUES.items()])


def unique_combination_suite(models) -> DataFrame:
    t = _tables(models)
    return _union([unique_combination(t[m], m, c) for m, c in UNIQUE_COMBINATION.items()])


def freshness_suite(models, as_of: dt.datetime | None = None) -> DataFrame:
    """Q-6 for every source.  A model graph may provide ``freshness_sources``
    (e.g. the jobs' per-feed high-water table) so the check never scans a feed."""
    t = getattr(models, "freshness_sources", None) or _tables(models)
    return _union([freshness(t[s], s, lim, as_of) for s, lim in FRESHNESS.items()])


INVERSION = ("assert_price_high_gte_low", "avg_high_price,avg_low_price")


def _inverted() -> Column:
    return F.col("avg_high_price") < F.col("avg_low_price")


def _severity(check: Column) -> Column:
    return F.when(check.isin(INVERSION[0], "orphan_prices", "payload_quarantine"), "warn").otherwise("error")


def assemble(counts: DataFrame, fresh: DataFrame) -> DataFrame:
    """The report from (check_name, model, column_name, failures) and the freshness rows."""
    severity, failures = _severity(F.col("check_name")), F.col("failures").cast("long")
    status = F.when(failures == 0, "pass").when(severity == "error", "fail").otherwise("warn")
    fresh = fresh.select(
        F.lit("source_freshness").alias("check_name"), F.col("source_name").alias("model"),
        F.lit("loaded_at").alias("column_name"),
        F.when(F.col("status") == "error", "error").otherwise("warn").alias("severity"),
        F.when(F.col("status") == "pass", 0).otherwise(1).cast("long").alias("failures"),
        F.when(F.col("status") == "error", "fail").otherwise(F.col("status")).alias("status"))
    return counts.select("check_name", "model", "column_name", severity.alias("severity"), failures.alias("failures"),
                         status.alias("status")).unionByName(fresh)


def counted(rows: DataFrame, check: str, model: str, column: str) -> DataFrame:
    """One row of the report: how many rows ``rows`` has."""
    return rows.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check).alias("check_name"), F.lit(model).alias("model"), F.lit(column).alias("column_name"), "failures")


def report(models, as_of: dt.datetime | None = None) -> DataFrame:
    """Q-8: every check as ``(check_name, model, column_name, severity, failures, status)``."""
    t = _tables(models)
    checks = [table_failures(t[m], m, cols, UNIQUE.get(m), UNIQUE_COMBINATION.get(m),
                             {INVERSION: _inverted()} if m == "fct_prices" else None) for m, cols in NOT_NULL.items()]
    accepted = accepted_values_suite(models).select(
        F.lit("accepted_values").alias("check_name"), "model", "column_name", F.col("failing_values").alias("failures"))
    lost = counted(orphans(models.stg_prices_5m, models.dim_items), "orphan_prices", "fct_prices", "item_id")
    return assemble(_union([*checks, accepted, lost]), freshness_suite(models, as_of))


# --- the rows behind the counts -------------------------------------------------------

def row_text(df: DataFrame) -> Column:
    """A row as ``name=value`` pairs: instants as epoch microseconds, NULL as ``NULL``."""
    def text(f: T.StructField) -> Column:
        c = F.col(f.name)
        c = F.unix_micros(instant(c)) if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else c
        return F.concat(F.lit(f"{f.name}="), F.coalesce(c.cast("string"), F.lit("NULL")))

    return F.concat_ws("|", *[text(f) for f in df.schema.fields])


def table_failing_rows(df: DataFrame, model: str, checks: dict[tuple[str, str], Column],
                       key: Sequence[str] = (), key_check: str = "") -> DataFrame:
    """(check_name, model, column_name, row): each row of ``df`` once for every check it fails.

    Row conditions are tagged in one pass.  ``key`` names columns whose repeated combinations
    fail ``key_check``: the repeated keys come from a partial aggregation and are joined to the
    rows, so a key that a third of all rows share is no group in one task."""
    found = df.select("*", *[F.coalesce(c, F.lit(False)).alias(f"_c{i}") for i, c in enumerate(checks.values())],
                      *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)])
    fails = {(check, column): F.col(f"_c{i}") for i, (check, column) in enumerate(checks)}
    if key:
        again = df.groupBy(*key).count().filter("count > 1").select(*[F.col(k).alias(f"_d{i}") for i, k in enumerate(key)],
                                                                     F.lit(True).alias("_again"))
        # NULL passes unique, so there it need not meet NULL and rows that lie by their key are joined so
        same = F.lit(True)
        for i in range(len(key)):
            k, d = F.col(f"_k{i}"), F.col(f"_d{i}")
            same = same & (k == d if key_check == "unique" else k.eqNullSafe(d))
        found = found.join(again, same, "left")
        missing = F.col("_k0").isNull() if key_check == "unique" else F.lit(False)  # NULL passes unique
        fails[(key_check, ",".join(key))] = F.coalesce("_again", F.lit(False)) & ~missing
    failed = F.filter(F.array(*[F.when(c, F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name")))
                                for (check, column), c in fails.items()]), lambda x: x.isNotNull())
    # only rows that fail are made into text, after the join
    found = found.filter(functools.reduce(Column.__or__, fails.values())).select(row_text(df).alias("row"), failed.alias("_failed"))
    return found.select("row", F.inline("_failed")).select("check_name", F.lit(model).alias("model"), "column_name", "row")


def failing_rows(models) -> DataFrame:
    """Q-8 in rows: ``(check_name, model, column_name, severity, row)`` for every row-level check
    (not null, accepted values, unique, unique combination, price inversions, orphan prices)."""
    t = _tables(models)
    parts = []
    for m, cols in NOT_NULL.items():
        checks = {("not_null", c): F.col(c).isNull() for c in cols}
        checks |= {("accepted_values", c): ~F.col(c).isin(*v) for (model, c), v in ACCEPTED_VALUES.items() if model == m}
        checks |= {INVERSION: _inverted()} if m == "fct_prices" else {}
        if m in UNIQUE_COMBINATION:
            parts.append(table_failing_rows(t[m], m, checks, UNIQUE_COMBINATION[m], "unique_combination_of_columns"))
        else:
            parts.append(table_failing_rows(t[m], m, checks, [UNIQUE[m]] if m in UNIQUE else (), "unique"))
    lost = models.stg_prices_5m.join(models.dim_items.select("item_id"), "item_id", "left_anti")
    parts.append(lost.select(F.lit("orphan_prices").alias("check_name"), F.lit("fct_prices").alias("model"),
                             F.lit("item_id").alias("column_name"), row_text(lost).alias("row")))
    found = _union(parts)
    return found.select("check_name", "model", "column_name", _severity(F.col("check_name")).alias("severity"), "row")


# --- check states: what a report needs of a table's part, kept until the part changes ------

STATE = "model string, unit string, content string, check_name string, column_name string, item string, failures bigint"


def part_states(rows: DataFrame, model: str, unit: str, columns: Sequence[str], combination: Sequence[str] = (),
                unique_id: str | None = None, accepted: dict | None = None, inversions: bool = False) -> DataFrame:
    """(model, unit, check_name, column_name, item, failures) of each part (``unit``, a column) of
    an append-only table, in one aggregation or two.  ``item`` holds what the parts cannot just
    add up: a value that is not accepted, or the range of ids of the part."""
    counts = {("not_null", c): F.count_if(F.col(c).isNull()) for c in columns}
    if inversions:
        counts[INVERSION] = F.count_if(_inverted())
    names = {f"_f{i}": k for i, k in enumerate(counts)}
    keys = list(combination or ([unique_id] if unique_id else []))
    groups = rows.groupBy(unit, *keys).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in zip(names, counts.values())])
    totals = [F.sum(n).alias(n) for n in names]
    if combination:
        totals.append(F.count_if(F.col("_n") > 1).alias("_dup"))
        names["_dup"] = ("unique_combination_of_columns", ",".join(keys))
    if unique_id:
        totals += [F.count_if((F.col("_n") > 1) & F.col(unique_id).isNotNull()).alias("_dup"),
                   F.concat_ws(":", F.min(unique_id), F.max(unique_id)).alias("_range")]
        names["_dup"] = ("unique", unique_id)
    agg = groups.groupBy(unit).agg(*totals)
    nothing = F.lit(None).cast("string")
    named = F.coalesce(F.col(unit).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("unit")  # as its folder
    parts = [agg.select(named, F.inline(F.array(*[F.struct(
        F.lit(check).alias("check_name"), F.lit(column).alias("column_name"),
        (F.col("_range") if check == "unique" else nothing).alias("item"), F.col(n).cast("long").alias("failures"))
        for n, (check, column) in names.items()])))]
    for column, values in (accepted or {}).items():
        odd = rows.filter(~F.col(column).isin(*values)).groupBy(unit, column).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(odd.select(named, F.lit("accepted_values").alias("check_name"),
                                F.lit(column).alias("column_name"), F.col(column).alias("item"), "failures"))
    return _union(parts).select(F.lit(model).alias("model"), "unit", "check_name", "column_name", "item", "failures")


def from_states(states: DataFrame, model: str, columns: Sequence[str], unique: str | None = None,
                combination: Sequence[str] = (), accepted: Sequence[str] = (), inversions: bool = False) -> DataFrame:
    """(check_name, model, column_name, failures) of a table from the states of its parts, a row for
    every check, also where no part is stored.  Ids of parts whose ranges meet are counted as
    failures of ``unique`` even if no id is in both: ids rise from part to part."""
    spark = states.sparkSession
    due = [("not_null", c) for c in columns] + ([("unique", unique)] if unique else [])
    due += [("unique_combination_of_columns", ",".join(combination))] if combination else []
    due += [INVERSION] if inversions else []
    due += [("accepted_values", c) for c in accepted]
    wanted = spark.createDataFrame([(model, *d) for d in due], "model string, check_name string, column_name string")
    summed = states.groupBy("check_name", "column_name").agg(
        F.sum("failures").alias("n"), F.count_distinct("item").alias("values"))
    failures = F.when(F.col("check_name") == "accepted_values", F.coalesce("values", F.lit(0))).otherwise(F.coalesce("n", F.lit(0)))
    out = wanted.join(summed, ["check_name", "column_name"], "left").select("check_name", "model", "column_name", failures.alias("failures"))
    if not unique:
        return out
    first = F.substring_index("item", ":", 1).cast("long")
    ranges = states.filter("check_name = 'unique' and item <> ''").select(first.alias("low"), F.substring_index("item", ":", -1).cast("long").alias("high"))
    # a row for each part; a running maximum needs them in one order
    ranges = ranges.select("low", F.expr("max(high) over (order by low, high rows between unbounded preceding and 1 preceding)").alias("before"))
    met = ranges.filter("before >= low").agg(F.count(F.lit(1)).alias("met"))
    return out.join(F.broadcast(met)).select("check_name", "model", "column_name", F.when(
        F.col("check_name") == "unique", F.col("failures") + F.col("met")).otherwise(F.col("failures")).alias("failures"))

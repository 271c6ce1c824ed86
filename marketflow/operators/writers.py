"""Write modes (W-1 … W-5) as DataFrame transformations.

Each function returns the rows to write (or the table after the write) as a
lazy DataFrame; ``operators.store`` persists them atomically.  All are joins,
windows and aggregations — no driver loops, no per-row Python.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions.time import as_of_column, instant
from marketflow.operators.latest import latest_per_key
from marketflow.schemas import FILL_EVENT_COLUMNS
from marketflow.session import checkpoint_dir


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# --- W-1: upsert ----------------------------------------------------------------

def dedupe_last(batch: DataFrame, keys, position) -> DataFrame:
    """Within one batch a later row replaces an earlier one with the same key
    (row-by-row upsert semantics).  ``position`` orders the batch."""
    out = latest_per_key(batch, keys, position)
    return out.drop(*[c for c in _cols(position) if c not in _cols(keys)])


def upsert(target: DataFrame, batch: DataFrame, keys="item_id",
           position: str | Sequence[str] | None = None) -> DataFrame:
    """W-1: the table after an upsert — batch rows replace *all* non-key columns
    of matching target rows (NULLs included); target rows absent from the batch
    are kept.  One shuffle on the key for the anti join (or a broadcast of the
    batch when Spark sees it is small)."""
    keys = _cols(keys)
    if position is not None:
        batch = dedupe_last(batch, keys, position)
    batch = batch.select(*target.columns)
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch)


def upsert_newest(target: DataFrame, batch: DataFrame, keys="item_id", time_col: str = "loaded_at",
                  position: Sequence[str] = ()) -> DataFrame:
    """W-1 for documents that arrive in any order: of a key's stored row and its batch rows the one
    of the latest ``time_col`` stays; among equal times a batch row replaces the stored one, and
    ``position`` orders the batch.  A rank-1 window: one shuffle, limited before it."""
    keys = _cols(keys)
    stored = target.select(*target.columns, F.lit(0).alias("_sent"))
    sent = batch.select(*target.columns, F.lit(1).alias("_sent"), *position)
    both = stored.unionByName(sent, allowMissingColumns=True)
    return latest_per_key(both, keys, [time_col, "_sent", *position]).select(*target.columns)


# --- W-2: insert-ignore -----------------------------------------------------------

def dedupe_first(batch: DataFrame, keys, position, drop: Sequence[str] = ()) -> DataFrame:
    """Within one batch the first row of a key wins (``ON CONFLICT DO NOTHING``).
    Like ``latest_per_key`` this is a rank-1 window, so a partial
    ``WindowGroupLimit`` runs before the shuffle."""
    keys = _cols(keys)
    pos = _cols(position)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in pos])
    return (batch.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .drop("_rn", *drop))


def insert_ignore(target: DataFrame, batch: DataFrame, keys=("item_id", "timestamp"),
                  position: str | Sequence[str] | None = None,
                  prune_on: str | None = None) -> DataFrame:
    """W-2: batch rows whose key is not in the target yet (first write wins).

    ``prune_on`` names a partition column (e.g. the event date) present in both
    sides: the target is then restricted to the batch's partitions by a semi
    join, so an append never scans the whole history.
    """
    keys = _cols(keys)
    if position is not None:
        batch = dedupe_first(batch, keys, position)
    existing = target.select(*keys, *([prune_on] if prune_on and prune_on not in keys else []))
    if prune_on is not None:
        existing = existing.join(batch.select(prune_on).distinct(), prune_on, "left_semi")
    return batch.join(existing.select(*keys), keys, "left_anti")


def insert_first(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], position: Sequence[str],
                 deal: Sequence[Column]) -> DataFrame:
    """W-2 in one shuffle: of each key the first row of ``batch`` by ``position``, unless ``target``
    (with the columns that ``keys`` and ``deal`` need) has the key.

    ``deal`` are functions of the keys by which the rows are dealt to tasks, so that a caller who
    deals them as they are stored writes them as they come."""
    names = [f"_deal{i}" for i in range(len(deal))]
    rows = batch.withColumn("_sent", F.lit(True))
    if target is not None:
        rows = rows.unionByName(target.withColumn("_sent", F.lit(False)), allowMissingColumns=True)
    rows = rows.select("*", *[c.alias(n) for n, c in zip(names, deal)]).repartition(*names)
    # a stored row comes before all that are sent
    w = Window.partitionBy(*names, *keys).orderBy("_sent", *[F.col(c).asc() for c in position])
    first = rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    return first.filter("_sent").select(*batch.columns)


# --- W-3: insert-if-changed ---------------------------------------------------------

def _changed(cur_h: Column, cur_l: Column, prev_h: Column, prev_l: Column, has_prev: Column):
    same = cur_h.eqNullSafe(prev_h) & cur_l.eqNullSafe(prev_l)
    return ~has_prev | ~same


def changed_rows(history: DataFrame, key: str = "item_id", time_col: str = "loaded_at",
                 compare: Sequence[str] = ("high_price", "low_price"),
                 bucket_unit: str = "day", before: Sequence[str] = (), apart: Sequence[str] = (),
                 always: Column | None = None) -> DataFrame:
    """W-3 over a batch of history: keep a row when its compared columns differ
    (null-safely) from the item's previous row; an item's first row always stays.

    Equal to replaying the polls one by one against the stored table, because a
    skipped poll always equals the stored row it was compared with.  Rows of one time are
    ordered by ``before`` and then by their values.  Rows that differ in ``apart`` are no
    neighbours; rows of ``always`` stay.

    Skew: a key's rows are split into time buckets.  One window per ``(key, bucket)`` finds
    each row's predecessor and marks the bucket's first and last row; of these edges, two rows
    a bucket, a second window gives the first ones theirs.  No task ever holds a whole hot key,
    and the history is shuffled once.
    """
    h, l = compare
    keys = [key, *apart]
    kept = F.lit(False) if always is None else always
    order = [time_col, *before, *[c for c in history.columns if c not in (key, time_col, *before)]]
    rows = history.withColumn("_b", F.date_trunc(bucket_unit, instant(time_col)))
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    rows = rows.select("*", F.lag(h).over(w).alias("_ph"), F.lag(l).over(w).alias("_pl"),
                       (F.row_number().over(w) == 1).alias("_first"),
                       F.lead(F.lit(True), 1, False).over(w).alias("_more"))
    edges = rows.filter(F.col("_first") | ~F.col("_more"))
    we = Window.partitionBy(*keys).orderBy("_b", F.col("_first").desc())
    edges = edges.select("*", F.lag(h).over(we).alias("_ph0"), F.lag(l).over(we).alias("_pl0"),
                         (F.row_number().over(we) > 1).alias("_has0"))
    firsts = edges.filter("_first").filter(kept | _changed(F.col(h), F.col(l), F.col("_ph0"), F.col("_pl0"), F.col("_has0")))
    rest = rows.filter(~F.col("_first")).filter(
        kept | _changed(F.col(h), F.col(l), F.col("_ph"), F.col("_pl"), F.lit(True)))
    cols = history.columns
    return firsts.select(*cols).unionByName(rest.select(*cols))


def changed_vs_state(state: DataFrame, batch: DataFrame, key: str = "item_id",
                     time_col: str = "loaded_at",
                     compare: Sequence[str] = ("high_price", "low_price")) -> DataFrame:
    """W-3 incremental: rows of a new batch to store, given the state before the batch (one
    row per key: the stored row of the latest time).

    A row is compared with the latest stored row at its turn.  Rows from the state's time on
    form a chain that starts at the state row; a row that arrives late, older than the state,
    is compared with the state row itself, which stays the latest.
    """
    cols = batch.columns
    h, l = compare
    marks = state.select(key, F.col(time_col).alias("_at"), F.col(h).alias("_sh"), F.col(l).alias("_sl"))
    late = F.coalesce(F.col(time_col) < F.col("_at"), F.lit(False))
    differs = _changed(F.col(h), F.col(l), F.col("_sh"), F.col("_sl"), F.lit(True))
    sent = batch.join(marks, key, "left").select(*cols, F.lit(1).alias("_after"), late.alias("_late"), (late & differs).alias("_kept"))
    known = state.select(*cols, F.lit(0).alias("_after"), F.lit(False).alias("_late"), F.lit(False).alias("_kept"))
    found = changed_rows(known.unionByName(sent), key, time_col, compare, before=["_after"], apart=["_late"], always=F.col("_kept"))
    return found.filter((F.col("_after") == 1) & (~F.col("_late") | F.col("_kept"))).select(*cols)


def next_state(state: DataFrame, inserted: DataFrame, key: str = "item_id",
               time_col: str = "loaded_at") -> DataFrame:
    """State after a batch: latest stored row per key."""
    return latest_per_key(state.unionByName(inserted.select(*state.columns)), key, time_col)


# --- W-5: append fill events -----------------------------------------------------------

NATURAL_KEY = ["flip_id", "leg", "event", "filled_qty", "offer_placed_at", "filled_at"]


def event_uid(df: DataFrame) -> Column:
    """Idempotency key of a fill event: the ``event_uid`` that the producer sends, where it
    does; else SHA-256 of every sent column, each with its length, and a mark for NULL, so
    only identical events share one (times as epoch microseconds, so every engine renders
    the same text)."""
    parts = []
    for f in FILL_EVENT_COLUMNS:
        col = F.col(f)
        text = (F.unix_micros(instant(f)) if f in ("offer_placed_at", "filled_at") else col).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N")))
    computed = F.sha2(F.concat_ws("|", *parts), 256)
    return F.coalesce(F.col("event_uid"), computed) if "event_uid" in df.columns else computed


# Ranges of the id space that a batch of events is dealt to: each is numbered by itself, so a
# batch may hold this many times the rows of one task.
ID_RANGES = 4096


def ranged_index(df: DataFrame, key: str, name: str = "_idx", ranges: int = ID_RANGES) -> DataFrame:
    """1-based row number over the rows in order of the hash of ``key`` (a unique text).

    Rows fall into ``ranges`` equal parts of the hash space.  One aggregation counts the rows of
    each part, a running sum over these few counts gives where its numbers begin, and each row is
    numbered within its part.  No global sort and nothing written: the numbers depend on the keys
    alone, so a retried task or a second evaluation gives the same ones.
    """
    hashed = df.withColumn("_h", F.sha2(F.col(key).cast("binary"), 256))
    # the leading 32 bits of the hash, scaled to the number of parts: in order of the hash
    part = F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") * ranges / (1 << 32)).cast("int")
    hashed = hashed.withColumn("_part", part)
    counts = hashed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # at most ``ranges`` rows meet in this window
    begins = counts.select("_part", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_begin"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_h"))
    return (hashed.withColumn("_place", place).join(F.broadcast(begins), "_part")
            .withColumn(name, (F.col("_begin") + F.col("_place")).cast("long")).drop("_h", "_part", "_place", "_begin"))


def ordered_index(df: DataFrame, order: Sequence[str | Column], name: str = "_idx") -> DataFrame:
    """1-based row number over the global ``order`` without a single-task window: equal to
    ``row_number() over (order by ...)`` for a unique ``order``.

    The sorted rows are written once, to the shared checkpoint folder, so their places are fixed
    and nothing before is evaluated again.  A row's place in its range is part of its id; one
    aggregation counts the ranges, and a running sum over these few counts gives where each begins.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/marketflow-runs/{uuid.uuid4().hex}/ordered"
    df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    # the id holds the range in the bits from 33 on, and the place in the range below
    ranked = spark.read.schema(df.withColumn("_mid", F.lit(0).cast("long")).schema).parquet(path)
    ranked = ranked.withColumn("_range", F.shiftright("_mid", 33))
    sizes = ranked.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    begins = sizes.select("_range", F.coalesce(F.sum("_n").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_begin"))
    return (ranked.join(F.broadcast(begins), "_range")
            .withColumn(name, F.col("_begin") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop("_mid", "_range", "_begin"))


def append_fills(existing: DataFrame, batch: DataFrame,
                 recorded_at: dt.datetime | None = None, id_base: Column | None = None,
                 order: Sequence[str] | None = None) -> DataFrame:
    """W-5: new fill events to append, with ``event_id`` and ``recorded_at``
    stamped on write.  Events already stored (same ``event_uid``) and repeats
    inside the batch are dropped, so a retried batch appends nothing twice.
    ``event_id`` continues from the stored maximum (or ``id_base``), densely, so
    ids rise from batch to batch; within a batch they follow ``order`` (ties: the
    ``event_uid``), or without one the hash of the ``event_uid``.  ``existing`` only
    needs the partitions a re-sent event can be in (see ``Refresh.append_fill_events``).
    """
    # a computed uid goes by its bytes while events are compared, and is computed again after: as a
    # text it is most of an event's shuffle
    uid, own = event_uid(batch), "event_uid" not in batch.columns
    sent = batch.withColumn("event_uid", F.unhex(uid) if own else uid)
    known = event_uid(existing)
    stored = existing.select((F.when(known.rlike("^[0-9a-f]{64}$"), F.unhex(known)) if own else known).alias("event_uid"))
    # stored events go first: repeats are then looked for among the new ones only, as the join
    # has dealt and sorted them
    new = sent.join(stored, "event_uid", "left_anti").dropDuplicates(["event_uid"])
    if own:
        new = new.drop("event_uid")
    # scalar subquery: evaluated once, no join.  ``id_base`` (the stored
    # high-water mark) avoids scanning the log for its maximum.
    base = (id_base if id_base is not None
            else existing.agg(F.coalesce(F.max("event_id"), F.lit(0)).cast("long")).scalar())
    if order:
        indexed = ordered_index(new, [*order, event_uid(new)])
    else:
        indexed = ranged_index(new.withColumn("event_uid", event_uid(new)), "event_uid")
    return indexed.select(
        (base + F.col("_idx")).alias("event_id"),
        *[c for c in batch.columns if c not in ("event_id", "recorded_at", "event_uid")],
        as_of_column(recorded_at).alias("recorded_at"),
        event_uid(indexed).alias("event_uid"))

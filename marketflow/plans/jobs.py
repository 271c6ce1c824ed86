"""Refresh jobs (B-1 … B-4): load landed payloads, write raw tables, rebuild marts.

Scale design (what each job reads):

* Raw feeds are append-only (``event_date=<period>/batch=<id>``).  An insert-ignore
  only reads the stored keys of the batch's own dates.
* Per-item "latest" lookups never scan history: the jobs keep three small
  state tables, one row per item — ``latest_price`` (last stored /latest row,
  also the change-detection state), ``latest_5m`` and ``latest_1h`` (last
  active hour) — updated from the batch alone.
* Trailing windows (1 h volatility, 24 h liquidity) read only the date
  partitions they touch.
* ``flip_opportunities`` stays a view over state + marts; marts are written as new
  versions, never overwritten.  In a store with a ``database`` the views are
  persistent and name the catalog's tables, so no reader needs a refresh.
* ``fct_prices`` is maintained as an incremental join: each 5-minute batch is split
  into facts of known items and pending rows of unknown ones, and a mapping load
  moves the pending rows of its new items, reading only their periods.
* A batch is parsed once, into a scratch table that its steps share.  Counts, the
  batch's identity, its range of times and its periods are metrics of that write.

Each ``refresh_*`` accepts the payload DataFrame of one batch and a batch id,
so the same code runs from a schedule (batch read of a landing folder) and
from ``foreachBatch`` of a stream (``streaming.ingest``).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
import uuid
from types import SimpleNamespace
from typing import ClassVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow import schemas
from marketflow.functions.time import instant, ts_literal
from marketflow.operators import quality, writers
from marketflow.operators.latest import latest_per_key
from marketflow.operators.store import TableStore
from marketflow.plans import marts, staging, views
from marketflow.plans.marts import MartParams
from marketflow.sources import payloads as pl
from marketflow.sources import seeds
from marketflow.session import checkpoint_dir, configure


def read_landed(spark: SparkSession, path: str, wholetext: bool = False) -> DataFrame:
    """Landed payload documents.  The landing format is JSON lines of
    ``{"poll_time": <epoch s>, "payload": <API document>}`` (split across
    tasks).  ``wholetext`` reads raw API documents, one per file, whose load
    time is the time of the load."""
    docs = spark.read.text(path, wholetext=wholetext)
    return with_payload_id(docs)


def with_payload_id(docs: DataFrame) -> DataFrame:
    """Identity of each landed document: its file plus a hash of its text, so
    duplicate keys are resolved per document.  Deterministic, so a retried task
    or a replayed micro-batch yields the same ids (works on streams too)."""
    # the file and the place of its split order the documents of one poll time
    return docs.withColumns({
        "payload_id": F.concat_ws(":", F.col("_metadata.file_path"), F.xxhash64("value").cast("string")),
        "payload_file": F.col("_metadata.file_path"), "payload_block": F.col("_metadata.file_block_start")})


# Partition period of each append-only raw table, sized by volume: the 5-minute
# feed is ~25k rows per tick (~7 M rows a day) and gets daily partitions; the
# hourly feed, the /latest change log and the fill log are a few MB a day and
# get monthly partitions (daily ones would be thousands of tiny files).
PARTITION_PERIOD = {"prices_5m": "day", "prices_1h": "month", "prices_latest": "month",
                    "realized_fills": "month"}


# A window feed is dealt to tasks, and stored, in slices of a period of about so many rows; 2 to the
# power of ITEM_BLOCK_BITS neighbouring items stay together.
SLICE_ROWS = 500_000
ITEM_BLOCK_BITS = 8


def period_start(col, unit: str):
    """Start date of the partition period holding ``col``."""
    return F.trunc(F.to_date(instant(col)), unit) if unit != "day" else F.to_date(instant(col))


@dataclasses.dataclass
class Refresh:
    spark: SparkSession
    store: TableStore
    params: MartParams = MartParams()
    tax_exempt: DataFrame | None = None
    buy_limit_overrides: DataFrame | None = None
    # landed lines carry a {"poll_time", "payload"} envelope; False = raw API
    # documents read whole, loaded at the time of the load
    landing_envelope: bool = True

    # the stored fact table: facts, and 5-minute rows of items that no mapping has named yet
    FACTS: ClassVar[str] = "marts/fct_prices/known=true"
    PENDING: ClassVar[str] = "marts/fct_prices/known=false"

    def __post_init__(self):
        configure(self.spark)
        checkpoint_dir(self.spark)
        self._listed: set[str] = set()
        if self.store.database:
            self.publish()

    # --- readers ------------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        schema = {"prices_5m": schemas.WINDOW_PRICES, "prices_1h": schemas.WINDOW_PRICES,
                  "prices_latest": schemas.PRICES_LATEST, "realized_fills": schemas.REALIZED_FILLS,
                  "item_mapping": schemas.ITEM_MAPPING}[name]
        return self.store.read(f"raw/{name}", schema)

    def _window_rows(self, name: str, lookback: dt.timedelta) -> DataFrame:
        """Rows of a feed inside a trailing window: only the period directories
        the window touches are listed and read; the timestamp bound is pushed
        to the scan."""
        as_of = self.params.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        since = as_of - lookback
        unit = PARTITION_PERIOD[name]
        first = since.date() if unit == "day" else since.date().replace(day=1)
        periods = [d for d in self.store._periods(f"raw/{name}")
                   if d.split("=", 1)[1] >= first.isoformat()]
        df = self.store.read_appends(f"raw/{name}", schemas.WINDOW_PRICES, periods)
        return df.filter(F.col("timestamp") >= ts_literal(since, df.schema["timestamp"].dataType))

    def _seeds(self):
        te = self.tax_exempt if self.tax_exempt is not None else seeds.tax_exempt_items(self.spark)
        blo = (self.buy_limit_overrides if self.buy_limit_overrides is not None
               else seeds.buy_limit_overrides(self.spark))
        return te, blo

    def dim_items(self) -> DataFrame:
        return self.store.read("marts/dim_items")

    # --- feed loaders ----------------------------------------------------------------
    @staticmethod
    def _identity(docs: DataFrame) -> dict:
        """Metrics that name a batch.  The key under which it is stored is its id *and* its content,
        so two writers, or a stream with a new checkpoint, that use the same id for other
        documents never share a folder, and a replay of the same documents does."""
        cols = [c for c in ("payload_id", "value") if c in docs.columns] or docs.columns
        return {"n": F.count(F.lit(1)), "h": F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))}

    @staticmethod
    def _key(batch_id, seen: dict) -> str:
        return f"{batch_id}-{seen['n']}-{seen['h'] or 0}"

    def _land(self, docs: DataFrame, parse, feed: str, batch_id, time_col: str, unit: str):
        """Parse a batch once, into a scratch table with the period (``event_date``) of ``time_col``.
        Returns the table, its name, the batch's key, its metrics and the periods it touches, all
        from the one write."""
        seen, parsed = Observation(), Observation()
        identity = self._identity(docs)
        docs = docs.observe(seen, *[m.alias(n) for n, m in identity.items()])
        records = parse(docs)
        good = F.col("reason").isNull()
        records = records.withColumn("event_date", F.when(good, period_start(time_col, unit))).observe(
            parsed, F.count_if(good).alias("attempted"), F.count_if(~good).alias("rejected"),
            F.min(F.when(good, F.unix_micros(instant(time_col)))).alias("first"),
            F.max(F.when(good, F.unix_micros(instant(time_col)))).alias("last"),
            F.transform(F.collect_set("event_date"), lambda d: d.cast("string")).alias("periods"))
        scratch = f"{feed}/{uuid.uuid4().hex}"
        table = self.store.write_scratch(records, scratch)
        counts = {"documents": seen.get["n"], **parsed.get}
        # written as it is parsed: no task sorts its rows by period for the sake of the folders
        periods = sorted(f"event_date={d}" for d in counts.pop("periods"))
        return table, scratch, self._key(batch_id, seen.get), counts, periods

    @staticmethod
    def _slices(records: DataFrame, rows: int) -> int:
        """In how many slices the largest period of a batch should be dealt and stored."""
        if rows <= SLICE_ROWS:
            return 1
        most = records.groupBy("event_date").count().agg(F.max("count")).first()[0]
        return -(-most // SLICE_ROWS)

    def _append(self, rows: DataFrame, name: str, key: str, time_col: str,
                periods: list[str] | None = None, rebalance: bool = True) -> tuple[DataFrame, dict]:
        """Append one batch and return the committed rows, read back from the
        batch's directories, with the write's metrics.  The written batch is the
        lineage cut: the state update sees exactly the stored rows (and the same
        load time), and a lost executor never recomputes the change detection."""
        schema = rows.drop("event_date").schema
        if "event_date" not in rows.columns:
            rows = rows.withColumn("event_date", period_start(time_col, PARTITION_PERIOD[name]))
        seen = self.store.append_batch(rows, f"raw/{name}", key, "event_date", {
            "inserted": F.count(F.lit(1)), "loaded": F.max(F.unix_micros(instant("loaded_at")))}, rebalance)
        # per-feed high-water mark of loaded_at, so the freshness check never scans a feed; each
        # feed has a mark of its own and a single writer
        if seen["loaded"] is not None:
            self.store.advance_mark(f"state/load_marks/{name}", seen["loaded"])
        return self.store.read_batch(f"raw/{name}", key, schema, periods), seen

    def _load_time(self):
        """Load time of raw (non-envelope) documents: one value per load, fixed
        on the driver, so every job of the load sees the same instant."""
        if self.landing_envelope:
            return None
        return F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")

    def _reject(self, records: DataFrame, table: str, key: str) -> None:
        """Dead letters (feed, reason, value), by the date on which they were loaded; a
        document without a readable load time goes to the epoch's, so a replay past midnight
        replaces its own."""
        at = F.coalesce(F.to_date(instant("loaded_at")), F.lit(dt.date(1970, 1, 1)))
        bad = records.filter(F.col("reason").isNotNull())
        self.store.append_batch(bad.select(F.lit(table).alias("feed"), "reason", F.col("rejected").alias("value"),
                                           at.alias("event_date")), f"quarantine/{table}", key, "event_date")

    def load_latest(self, docs: DataFrame, batch_id) -> dict[str, int]:
        """S-1 + W-3: store /latest rows whose price pair changed; advance the state.
        Returns the counts of documents, rows attempted, inserted and rejected."""
        records, scratch, key, counts, periods = self._land(docs, lambda d: pl.latest_records(
            d, loaded_at=self._load_time(), envelope=self.landing_envelope), "latest", batch_id,
            "loaded_at", PARTITION_PERIOD["prices_latest"])
        if counts["rejected"]:
            self._reject(records, "latest", key)
        inserted = self._store_changes(records.filter(F.col("reason").isNull()), key, periods)
        self.store.drop_scratch(scratch)
        return {k: counts[k] for k in ("documents", "attempted", "rejected")} | {"inserted": inserted}

    def store_latest_rows(self, batch: DataFrame, batch_id) -> dict[str, int]:
        """W-3 for flat /latest rows (T-3 calls this from ``foreachBatch``)."""
        rows = batch.select(*schemas.PRICES_LATEST.fieldNames())
        records, scratch, key, counts, periods = self._land(
            rows, lambda d: d.withColumn("reason", F.lit(None).cast("string")), "latest_rows", batch_id,
            "loaded_at", PARTITION_PERIOD["prices_latest"])
        inserted = self._store_changes(records, key, periods)
        self.store.drop_scratch(scratch)
        return {"attempted": counts["attempted"], "inserted": inserted}

    def _store_changes(self, batch: DataFrame, key: str, periods: list[str]) -> int:
        """A replayed batch (its key is known) is compared with the state from before its first
        run, so it stores the same rows again, in the same folders; the newest state takes
        them in and never goes back."""
        batch = batch.select(*schemas.PRICES_LATEST.fieldNames())
        base = self.store.base_version("state/latest_price", key)
        if base:
            state = self.store.read_version("state/latest_price", base, schemas.PRICES_LATEST)
            changed = writers.changed_vs_state(state, batch.select(*state.columns))
        else:
            changed = writers.changed_rows(batch)
        inserted, seen = self._append(changed, "prices_latest", key, "loaded_at", periods)
        newest = self._stored("state/latest_price", inserted.limit(0))
        self._write_state(writers.next_state(newest, inserted), "state/latest_price")
        return seen["inserted"]

    def _write_state(self, rows: DataFrame, name: str) -> None:
        self.store.write_version(rows, name, bucket_by="item_id")

    def load_window(self, feed: str, docs: DataFrame, batch_id) -> dict[str, int]:
        """S-2 + W-2 for ``prices_5m`` / ``prices_1h``; advances the feed's latest-row state
        and, for the 5-minute feed, the stored fact table.  Returns the counts of documents, rows
        attempted, inserted and rejected."""
        name = f"prices_{feed}"
        records, scratch, key, counts, periods = self._land(docs, lambda d: pl.window_records(
            d, loaded_at=self._load_time(), envelope=self.landing_envelope), feed, batch_id,
            "timestamp", PARTITION_PERIOD[name])
        if counts["rejected"]:
            self._reject(records, feed, key)
        batch = records.filter(F.col("reason").isNull()).drop("reason", "rejected")
        # stored keys of the batch's own periods and range of times only: neither the listing nor
        # the scan grows with the history
        target = self.store.read_appends_with_period(f"raw/{name}", periods, schemas.WINDOW_PRICES)
        if target is not None:
            at = F.col("timestamp")
            between = (at >= F.timestamp_micros(F.lit(counts["first"]))) & (at <= F.timestamp_micros(F.lit(counts["last"])))
            # a replay replaces its own rows, so they are not in its way
            target = target.filter(between & (F.col("batch") != key)).select("item_id", "timestamp", "event_date")
        # first write wins, also between documents of one batch (arrival order); dealt by period and
        # blocks of items, as the rows are stored, so the one shuffle serves the write too
        slices = self._slices(batch, counts["attempted"])
        block = F.pmod(F.xxhash64(F.shiftright("item_id", ITEM_BLOCK_BITS)), F.lit(slices))
        batch = writers.insert_first(target, batch, ["item_id", "timestamp"], ["loaded_at", "payload_id"],
                                     [F.col("event_date"), block]).drop("payload_id")
        replayed = bool(self.store.batch_periods(f"raw/{name}", key, periods))
        new, seen = self._append(batch, name, key, "timestamp", periods, rebalance=False)
        staged = (staging.stg_prices_5m(new) if feed == "5m" else staging.stg_prices_1h(new))
        if feed == "5m":
            self._append_facts(staged, key, periods if replayed else [])
        state_name = f"state/latest_{feed}"
        if self.store.exists(state_name):
            state = self.store.read(state_name)
            staged = state.unionByName(staged.select(*state.columns))
        self._write_state(latest_per_key(staged, "item_id", "price_timestamp"), state_name)
        self.store.drop_scratch(scratch)
        return {"documents": counts["documents"], "attempted": counts["attempted"], "rejected": counts["rejected"],
                "inserted": seen["inserted"]}

    # --- the stored fact table ----------------------------------------------------------
    #
    # marts/fct_prices/known=true has the facts, known=false the 5-minute rows of items that no
    # mapping load has named yet.  Facts are (rows ⋈ items): new rows meet all items when they are
    # loaded, new items meet the pending rows when the mapping is.

    def _append_facts(self, staged: DataFrame, key: str, stored_periods: list[str]) -> None:
        """Split a batch's rows by whether their item is known, in one write.  A replayed batch
        leaves out the facts that a mapping load has since taken from its pending rows."""
        rows = staged.withColumn("event_date", period_start("price_timestamp", "day"))
        if stored_periods and (facts := self._facts(stored_periods, without=key)) is not None:
            rows = rows.join(facts, ["item_id", "price_timestamp"], "left_anti")
        items = self._stored("marts/dim_items", self._empty_dim()).select("item_id", F.lit(True).alias("known"))
        rows = rows.join(items, "item_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
        # read from a file or two a period, so written as it comes
        self.store.append_batch(rows.select(*self.FACT_COLUMNS, "known", "event_date"), "marts/fct_prices", key,
                                ["known", "event_date"], rebalance=False)
        self._publish_folder("fct_prices")

    FACT_COLUMNS: ClassVar[list[str]] = ["item_id", "price_timestamp", "avg_high_price", "high_price_volume", "avg_low_price",
                    "low_price_volume", "spread_gp", "spread_pct", "loaded_at"]

    def _facts(self, periods: list[str], without: str) -> DataFrame | None:
        """(item_id, price_timestamp) of the facts of some periods that other batches stored."""
        facts = self.store.read_appends_with_period(self.FACTS, periods, self._fact_schema())
        return None if facts is None else facts.filter(F.col("batch") != without).select("item_id", "price_timestamp")

    def _catch_up_facts(self, key: str) -> list[str]:
        """Move the pending rows of items that are known now to the facts; returns the periods
        read.  ``state/fact_items`` holds the items for which that is done, and is written last:
        a load that fails before is made good by the next."""
        items = self.dim_items().select("item_id")
        pending = self.store._periods(self.PENDING)
        touched: list[str] = []
        if pending:
            done = self._stored("state/fact_items", items.limit(0))
            new_items = self.store.write_scratch(items.join(done, "item_id", "left_anti"), f"fact_items/{key}")
        if pending and not new_items.isEmpty():
            waiting = self.store.read_appends_with_period(self.PENDING, pending, self._fact_schema()).join(new_items, "item_id", "left_semi")
            # the periods that hold a row of a new item, at most as many as there are folders
            touched = [f"event_date={r[0].isoformat()}" for r in waiting.select("event_date").distinct().collect()]
            if touched:
                rows = self.store.read_appends_with_period(self.PENDING, touched, self._fact_schema()).join(new_items, "item_id", "left_semi")
                facts = self._facts(touched, without=key)
                if facts is not None:
                    rows = rows.join(facts, ["item_id", "price_timestamp"], "left_anti")
                self.store.append_batch(rows.select(*self.FACT_COLUMNS, F.lit(True).alias("known"), "event_date"),
                                        "marts/fct_prices", key, ["known", "event_date"])
                self._publish_folder("fct_prices")
        self.store.drop_scratch(f"fact_items/{key}")
        self.store.write_version(items, "state/fact_items")
        return touched

    def _fact_schema(self):
        return staging.stg_prices_5m(self._empty(schemas.WINDOW_PRICES)).select(*self.FACT_COLUMNS).schema

    def fct_prices(self) -> DataFrame:
        """The stored fact table."""
        return self.store.read_appends(self.FACTS, self._fact_schema())

    def load_mapping(self, docs: DataFrame, batch_id="mapping") -> dict[str, int]:
        """S-3 + W-1: upsert the mapping (new version), rebuild dim_items and complete the facts.
        The newest document of an item wins, in whatever order and by whichever load it comes: by
        poll time, then file, place in the file and place in the document.  Returns the counts of
        documents, records processed and rejected."""
        order = [c for c in ("payload_file", "payload_block") if c in docs.columns]
        records, scratch, key, counts, _ = self._land(
            docs.withColumn("payload_line", F.monotonically_increasing_id()),
            lambda d: pl.mapping_records(d, loaded_at=self._load_time(), envelope=self.landing_envelope,
                                         keep=(*order, "payload_line")), "mapping", batch_id, "loaded_at", "day")
        if counts["rejected"]:
            whole = F.col("reason").isin("document", "load_time")
            self._reject(records.filter(whole), "mapping", key)
            self._reject(records.filter(~whole), "mapping_records", key)
        batch = records.filter(F.col("reason").isNull())
        target = self._stored("raw/item_mapping", self._empty(schemas.ITEM_MAPPING)).select(*schemas.ITEM_MAPPING.fieldNames())
        table = writers.upsert_newest(target, batch, "item_id", "loaded_at", [*order, "payload_line", "pos"])
        self._write_state(table, "raw/item_mapping")
        self.store.drop_scratch(scratch)
        self.rebuild_dim()
        self._catch_up_facts(key)
        return {"documents": counts["documents"], "processed": counts["attempted"], "rejected": counts["rejected"]}

    def append_fill_events(self, events: DataFrame, batch_id) -> DataFrame:
        """W-5: append bot fill events, idempotent on ``event_uid``.

        The fill log is partitioned by the month of ``offer_placed_at`` — part
        of the event's identity — so a re-sent event always falls in the same
        partition: the duplicate check reads only the batch's own months and
        stays exact.  The id high-water mark is kept beside the log.
        """
        sent = events.columns
        batch, scratch, key, _, months = self._land(
            events, lambda d: d.withColumn("reason", F.lit(None).cast("string")), "fills", batch_id, "offer_placed_at", "month")
        # events without a time of the offer have the folder of no period
        undated = "event_date=__HIVE_DEFAULT_PARTITION__"
        log = T.StructType([*schemas.REALIZED_FILLS.fields, T.StructField("event_uid", T.StringType())])
        existing = self.store.read_appends_with_period("raw/realized_fills", [*months, undated], log)
        if existing is None:
            existing = self._empty(log)
        # the ids of a load that failed half-way are stored, though its mark is not
        base = F.greatest(existing.agg(F.coalesce(F.max("event_id"), F.lit(0)).cast("long")).scalar(),
                          F.lit(self.store.mark("state/fill_ids") or 0))
        rows = writers.append_fills(existing.drop("event_date", "batch"), batch.select(*sent), self.params.as_of, id_base=base,
                                    order=writers.NATURAL_KEY)
        rows = rows.withColumn("event_date", period_start("offer_placed_at", "month"))
        if "event_uid" not in sent:
            # the rows move to their months without the uid, which is computed where they are written
            rows = rows.drop("event_uid").hint("rebalance", "event_date")
            rows = rows.withColumn("event_uid", writers.event_uid(rows))
        seen = self.store.append_batch(rows, "raw/realized_fills", key, "event_date", {"high": F.max("event_id")},
                                       rebalance="event_uid" in sent)
        if seen["high"] is not None:
            self.store.advance_mark("state/fill_ids", seen["high"])
        self._publish_folder("fill_events")
        self.store.drop_scratch(scratch)
        return self.store.read_batch("raw/realized_fills", key, rows.drop("event_date").schema, [*months, undated])

    # --- mart rebuilds -------------------------------------------------------------------
    def rebuild_dim(self) -> None:
        te, blo = self._seeds()
        dim = marts.dim_items(staging.stg_item_mapping(self.raw("item_mapping")), te, blo)
        self._write_state(dim, "marts/dim_items")

    def rebuild_volatility(self) -> None:
        rows = staging.stg_prices_5m(self._window_rows("prices_5m", self.params.volatility_lookback))
        fct = marts.fct_prices(rows, self.dim_items())
        self._write_state(marts.agg_item_volatility(fct, self.params), "marts/agg_item_volatility")

    def rebuild_liquidity(self) -> None:
        latest = self.store.read("state/latest_1h")
        window = staging.stg_prices_1h(self._window_rows("prices_1h", self.params.liquidity_lookback))
        liq = marts.liquidity_from_parts(latest, window, self.params)
        self._write_state(liq, "marts/agg_item_liquidity")

    def models(self):
        """The full model graph (staging views and marts) over the stored raw
        layer — the lazy equivalent of the reference's views, for analysts."""
        from marketflow.plans.models import Models, RawTables

        te, blo = self._seeds()

        def raw_or_empty(name, schema):
            return self.raw(name) if self.store.exists(f"raw/{name}") else self._empty(schema)

        return Models(RawTables(
            item_mapping=raw_or_empty("item_mapping", schemas.ITEM_MAPPING),
            prices_5m=raw_or_empty("prices_5m", schemas.WINDOW_PRICES),
            prices_1h=raw_or_empty("prices_1h", schemas.WINDOW_PRICES),
            prices_latest=raw_or_empty("prices_latest", schemas.PRICES_LATEST),
            realized_fills=raw_or_empty("realized_fills", schemas.REALIZED_FILLS),
            tax_exempt_items=te, buy_limit_overrides=blo), self.params)

    # --- quality -----------------------------------------------------------------------
    #
    # The feeds' checks are kept as states of their parts: a day or month of a feed, a batch of the
    # fill log.  A report brings the states of changed parts up to date and adds them up.

    CHECKED: ClassVar[dict] = {  # model -> (folder, part, what part_states takes)
        "fct_prices": (FACTS, "event_date", dict(combination=quality.UNIQUE_COMBINATION["fct_prices"], inversions=True)),
        "raw.prices_5m": ("raw/prices_5m", "event_date", {}),
        "raw.prices_1h": ("raw/prices_1h", "event_date", {}),
        "raw.prices_latest": ("raw/prices_latest", "event_date", {}),
        "raw.realized_fills": ("raw/realized_fills", "batch", dict(
            unique_id="event_id", accepted={c: v for (m, c), v in quality.ACCEPTED_VALUES.items() if m == "raw.realized_fills"}))}

    def _parts(self, folder: str, unit: str) -> dict[str, tuple[str, list[str]]]:
        """part -> (content, folders): the batches that a period holds, or the periods of a batch."""
        found: dict[str, list[tuple[str, str]]] = {}
        for period in self.store._periods(folder):
            for batch in self.store._children(f"{self.store.path(folder)}/{period}", "batch="):
                part, other = (period, batch) if unit == "event_date" else (batch, period)
                found.setdefault(part.split("=", 1)[1], []).append((other, f"{period}/{batch}"))
        return {p: (hashlib.md5("|".join(sorted(o for o, _ in x)).encode()).hexdigest(), sorted(f for _, f in x)) for p, x in found.items()}

    def check_states(self, model: str) -> DataFrame:
        """The states of a table's parts; only parts that changed since their state was taken are
        read."""
        folder, unit, what = self.CHECKED[model]
        table = f"state/checks/{model.replace('.', '_')}"
        parts = self._parts(folder, unit)
        known = self._stored(table, self._empty(quality.STATE))
        # a row for each part, as many as its folders that were listed just now
        have = {(r["unit"], r["content"]) for r in known.select("unit", "content").distinct().collect()}
        stale = [(p, content) for p, (content, _) in parts.items() if (p, content) not in have]
        if stale:
            changed = F.broadcast(self.spark.createDataFrame(stale, "unit string, content string"))
            read = self.spark.read.option("basePath", self.store.path(folder)).schema(self._checked_schema(model)).parquet(
                *[f"{self.store.path(folder)}/{f}" for p, _ in stale for f in parts[p][1]])
            read = read.withColumn("batch", F.col("batch").cast("string"))
            columns = sorted({*quality.NOT_NULL[model], *(quality.NOT_NULL["realized_fills"] if unit == "batch" else ())})
            names = self._empty(quality.STATE).columns
            new = quality.part_states(read, model, unit, columns, **what).join(changed, "unit")
            kept = known.join(changed.select("unit"), "unit", "left_anti")
            self.store.write_version(kept.select(*names).unionByName(new.select(*names)), table)
            known = self.store.read(table)
        return known

    def _checked_schema(self, model: str):
        return {"fct_prices": self._fact_schema(), "raw.prices_latest": schemas.PRICES_LATEST,
                "raw.realized_fills": schemas.REALIZED_FILLS}.get(model, schemas.WINDOW_PRICES)

    def quality_report(self) -> DataFrame:
        """Q-8 over the stored tables: the rows of ``quality.report``, the feeds' from the states of
        their parts, freshness from the per-feed high-water marks, orphans from the pending rows of
        the fact table; per-item tables are small and checked as they are.  Dead letters are
        counted as ``payload_quarantine`` warnings."""
        q, dim = quality, self._stored("marts/dim_items", self._empty_dim())
        stg5 = staging.stg_prices_5m(self._empty(schemas.WINDOW_PRICES))
        stg1 = staging.stg_prices_1h(self._empty(schemas.WINDOW_PRICES))
        small = {"dim_items": dim, "agg_flip_opportunities": self.flip_opportunities(dim),
                 "agg_item_liquidity": self._stored("marts/agg_item_liquidity", marts.agg_item_liquidity(stg1, self.params)),
                 "agg_item_volatility": self._stored("marts/agg_item_volatility", marts.agg_item_volatility(
                     marts.fct_prices(stg5, dim), self.params)),
                 "raw.item_mapping": self._stored("raw/item_mapping", self._empty(schemas.ITEM_MAPPING))}
        parts = [q.table_failures(df, m, q.NOT_NULL[m], q.UNIQUE.get(m)) for m, df in small.items()]
        states = {m: self.check_states(m) for m in self.CHECKED}
        parts.append(q.from_states(states["fct_prices"], "fct_prices", q.NOT_NULL["fct_prices"],
                                   combination=q.UNIQUE_COMBINATION["fct_prices"], inversions=True))
        for m in ("raw.prices_5m", "raw.prices_1h", "raw.prices_latest"):
            parts.append(q.from_states(states[m], m, q.NOT_NULL[m]))
        fills = states["raw.realized_fills"]
        parts.append(q.from_states(fills, "raw.realized_fills", q.NOT_NULL["raw.realized_fills"],
                                   accepted=[c for m, c in q.ACCEPTED_VALUES if m == "raw.realized_fills"]))
        # R-1 keeps every fill event once, with the item's name
        parts.append(q.from_states(fills, "realized_fills", q.NOT_NULL["realized_fills"], unique=q.UNIQUE["realized_fills"]))
        pending = (self.store.read_appends(self.PENDING).select("item_id") if self.store._periods(self.PENDING)
                   else stg5.select("item_id"))
        parts.append(q.counted(pending.join(dim.select("item_id"), "item_id", "left_anti").distinct(),
                               "orphan_prices", "fct_prices", "item_id"))
        for name in ("latest", "5m", "1h", "mapping", "mapping_records"):
            if self.store._periods(f"quarantine/{name}"):
                parts.append(q.counted(self.store.read_appends(f"quarantine/{name}"), "payload_quarantine", f"quarantine.{name}", "value"))

        def mark(src):
            micros = self.store.mark(f"state/load_marks/{src.split('.', 1)[1]}")
            return self.spark.range(0, 1, 1, 1).select(F.timestamp_micros(F.lit(micros)).alias("loaded_at"))

        fresh = q.freshness_suite(SimpleNamespace(freshness_sources={s: mark(s) for s in q.FRESHNESS}), self.params.as_of)
        return q.assemble(q._union(parts), fresh)

    # --- views ------------------------------------------------------------------------------
    def _empty(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _stored(self, name: str, empty: DataFrame) -> DataFrame:
        """A stored table, or an empty one of the same shape before its first load."""
        return self.store.read(name) if self.store.exists(name) else empty

    def flip_opportunities(self, dim: DataFrame | None = None) -> DataFrame:
        """F-1 over the state tables and the stored marts (lazy)."""
        dim = self.dim_items() if dim is None else dim
        stg5 = staging.stg_prices_5m(self._empty(schemas.WINDOW_PRICES))
        stg1 = staging.stg_prices_1h(self._empty(schemas.WINDOW_PRICES))
        current = staging.stg_prices_latest(
            self._stored("state/latest_price", self._empty(schemas.PRICES_LATEST)))
        recent = marts.fct_prices(self._stored("state/latest_5m", stg5), dim)
        liq = self._stored("marts/agg_item_liquidity", marts.agg_item_liquidity(stg1, self.params))
        vol = self._stored("marts/agg_item_volatility",
                           marts.agg_item_volatility(marts.fct_prices(stg5, dim), self.params))
        return marts.flip_opportunities(current, recent, dim, liq, vol, self.params)

    def _empty_dim(self) -> DataFrame:
        te, blo = self._seeds()
        return marts.dim_items(staging.stg_item_mapping(self._empty(schemas.ITEM_MAPPING)), te, blo)

    def publish(self) -> None:
        """W-6: the persistent views of the store's database, for every session.

        ``agg_flip_opportunities`` and ``realized_fills`` are SQL over the tables' views, and
        ``fct_prices`` and ``fill_events`` list their folders when they are read, so they are
        defined once; a refresh moves the versioned tables' views to the newest version when it
        writes it (``TableStore.write_version``).  Tables that nothing has loaded yet show no rows."""
        db, stg5 = self.store.database, staging.stg_prices_5m(self._empty(schemas.WINDOW_PRICES))
        fct = marts.fct_prices(stg5, self._empty_dim())
        versioned = {
            "raw/item_mapping": schemas.ITEM_MAPPING, "state/latest_price": schemas.PRICES_LATEST, "state/latest_5m": stg5.schema,
            "state/latest_1h": staging.stg_prices_1h(self._empty(schemas.WINDOW_PRICES)).schema,
            "marts/dim_items": self._empty_dim().schema,
            "marts/agg_item_liquidity": marts.agg_item_liquidity(staging.stg_prices_1h(self._empty(schemas.WINDOW_PRICES)), self.params).schema,
            "marts/agg_item_volatility": marts.agg_item_volatility(fct, self.params).schema}
        for name, schema in versioned.items():
            if self.store.versions(name):
                self.store.attach(name, schema, "item_id")
            if not self.store.in_catalog(self.store.view(name)):
                self.store.define_view(self.store.view(name).split(".")[1], views.empty(schema))
        for view in ("fct_prices", "fill_events"):
            self._publish_folder(view, fresh=True)
        self.store.define_view("agg_flip_opportunities", views.flips(db, self.params))
        self.store.define_view("realized_fills", views.realized_fills(db))

    def _publish_folder(self, view: str, fresh: bool = False) -> None:
        """The view of an append-only table: its folder once there is one, no rows before."""
        if not self.store.database or view in self._listed and not fresh:
            return
        folder, schema = {"fct_prices": (self.FACTS, self.fct_prices().schema),
                          "fill_events": ("raw/realized_fills", schemas.REALIZED_FILLS)}[view]
        if self.store._periods(folder):
            self._listed.add(view)
            self.store.define_view(view, views.appended(self.store.path(folder), schema.fieldNames()))
        elif fresh:
            self.store.define_view(view, views.empty(schema))

    def table(self, name: str, session: SparkSession | None = None) -> DataFrame:
        """A view by its name, in any session."""
        return (session or self.spark).table(f"{self.store.database}.{name}")

    def maintain(self, older_than: dt.timedelta) -> dict[str, list[int]]:
        """Remove versions and pins that nothing can need any more."""
        names = ["raw/item_mapping", "state/latest_price", "state/latest_5m", "state/latest_1h", "state/fact_items",
                 "marts/dim_items", "marts/agg_item_liquidity", "marts/agg_item_volatility",
                 *[f"state/checks/{m.replace('.', '_')}" for m in self.CHECKED]]
        return {n: self.store.expire(n, older_than) for n in names if self.store.versions(n)}

    # --- schedules ------------------------------------------------------------------------
    def refresh_latest(self, docs: DataFrame, batch_id) -> DataFrame:
        """B-1 (every minute): /latest → change detection → flips view."""
        self.load_latest(docs, batch_id)
        return self.flip_opportunities()

    def refresh_5m(self, docs: DataFrame, batch_id) -> DataFrame:
        """B-2 (every 5 minutes): /5m → fact rows → volatility → flips view."""
        self.load_window("5m", docs, batch_id)
        self.rebuild_volatility()
        return self.flip_opportunities()

    def refresh_1h(self, docs: DataFrame, batch_id) -> DataFrame:
        """B-3 (hourly): /1h → hourly rows → liquidity → flips view."""
        self.load_window("1h", docs, batch_id)
        self.rebuild_liquidity()
        return self.flip_opportunities()

    def refresh_daily(self, mapping: DataFrame, latest: DataFrame, five_min: DataFrame,
                      one_hour: DataFrame, batch_id) -> DataFrame:
        """B-4 (daily): the mapping, then all three feeds and every mart."""
        self.load_mapping(mapping, batch_id)
        self.load_latest(latest, batch_id)
        self.load_window("5m", five_min, batch_id)
        self.load_window("1h", one_hour, batch_id)
        self.rebuild_volatility()
        self.rebuild_liquidity()
        return self.flip_opportunities()

"""S-1 … S-3: flatten landed API payloads (one JSON document per file).

Documents are parsed with a declared schema and exploded to one row per item.  The same
functions serve batch and streaming DataFrames.  A document that does not parse yields no
rows in ``parse_*`` and is reported by ``quarantined``.

``latest_records``, ``window_records`` and ``mapping_records`` are what the jobs load: one parse
that gives the accepted rows and, with a ``reason``, everything that is not loadable: documents
that do not parse, an explicit null timestamp, item ids and numbers that are no integers of the
column's range, mapping records without a required field.  Nothing becomes NULL that was sent
as a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow import schemas


def _loaded_at(loaded_at: str | Column | None) -> Column:
    if loaded_at is None:
        return F.current_timestamp()   # one value per query / micro-batch, like now()
    return F.col(loaded_at) if isinstance(loaded_at, str) else loaded_at


def _epoch_or_null(epoch: Column) -> Column:
    """Trade-time epoch seconds; 0 and NULL both mean 'never traded'."""
    return F.timestamp_seconds(F.nullif(epoch, F.lit(0).cast("long")))


def envelope_schema(payload_schema) -> T.StructType:
    """Landed line ``{"poll_time": <epoch s>, "payload": <API document>}``."""
    return T.StructType([T.StructField("poll_time", T.LongType()),
                         T.StructField("payload", payload_schema)])


def _parse(payloads: DataFrame, schema, value: str, loaded_at, envelope: bool):
    """``(payload_id, loaded_at, doc)``; with ``envelope`` the load time is the
    envelope's ``poll_time`` unless ``loaded_at`` is given."""
    pid = (F.col("payload_id") if "payload_id" in payloads.columns
           else F.lit(None).cast("string").alias("payload_id"))
    if not envelope:
        return payloads.select(pid, _loaded_at(loaded_at).alias("loaded_at"),
                               F.from_json(F.col(value), schema).alias("doc"))
    e = payloads.select(pid, F.from_json(F.col(value), envelope_schema(schema)).alias("e"))
    at = (F.timestamp_seconds(F.col("e.poll_time")) if loaded_at is None
          else _loaded_at(loaded_at))
    return e.select("payload_id", at.alias("loaded_at"), F.col("e.payload").alias("doc"))


def _entries(payloads: DataFrame, schema, value: str, loaded_at, envelope: bool = False) -> DataFrame:
    return _parse(payloads, schema, value, loaded_at, envelope).select(
        "payload_id", "loaded_at", F.col("doc.*"))


def _last_per_key(data: Column) -> Column:
    """Entries of a parsed JSON object that repeats a key, sorted so that of each key the one that
    counts comes first: as in a dict the last one wins (``from_json`` keeps both).  NULL for an
    object whose keys are all different, which is most of them.

    Row-local, no shuffle: the entries are tagged with their negated position and sorted by
    (key, -position).  Works the same on batch and streaming DataFrames.
    """
    keys = F.map_keys(data)
    tagged = F.transform(F.map_entries(data),
                         lambda e, i: F.struct(e["key"].alias("key"), (-i).alias("neg_pos"),
                                               e["value"].alias("value")))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.array_sort(tagged))


def _explode_last_wins(df: DataFrame, data: str, keep: list[str], outer: bool = False) -> DataFrame:
    """One row per distinct key.  No lambda refers to the whole array (the
    optimizer may inline it into the lambda, making the step quadratic): the
    previous key comes from a shifted copy combined element-wise."""
    sorted_df = df.select(*keep, F.col(data).alias("_d"), _last_per_key(F.col(data)).alias("_s"))   # sorted once
    s = F.col("_s")
    keys = F.transform(s, lambda x: x["key"])
    prev = F.slice(F.concat(F.array(F.lit(None).cast("string")), keys), 1, F.size(s))
    first = F.zip_with(s, prev, lambda x, p: F.when(p.isNull() | (p != x["key"]), F.struct(
        x["key"].alias("key"), x["value"].alias("value"))))
    kept = F.when(s.isNotNull(), F.filter(first, lambda x: x.isNotNull())).otherwise(F.map_entries("_d"))
    return sorted_df.select(*keep, (F.inline_outer if outer else F.inline)(kept)).withColumnRenamed("value", "v")


def parse_latest_payload(payloads: DataFrame, value: str = "value",
                         loaded_at: str | Column | None = None,
                         envelope: bool = False) -> DataFrame:
    """S-1: ``{"data": {id: {high, highTime, low, lowTime}}}`` → raw.prices_latest rows.

    Items with neither price are dropped; epoch 0 / NULL times become NULL.
    """
    e = _entries(payloads, schemas.LATEST_PAYLOAD, value, loaded_at, envelope)
    x = _explode_last_wins(e, "data", ["payload_id", "loaded_at"])
    return (x.select(F.col("key").cast("int").alias("item_id"),
                     F.col("v.high").alias("high_price"),
                     _epoch_or_null(F.col("v.highTime")).alias("high_time"),
                     F.col("v.low").alias("low_price"),
                     _epoch_or_null(F.col("v.lowTime")).alias("low_time"),
                     "loaded_at")
            .filter(F.col("high_price").isNotNull() | F.col("low_price").isNotNull()))


def parse_window_payload(payloads: DataFrame, value: str = "value",
                         loaded_at: str | Column | None = None,
                         with_source: bool = False, last_key_wins: bool = True,
                         envelope: bool = False) -> DataFrame:
    # ``last_key_wins=False`` skips resolving duplicate keys (cheaper when a
    # later dedupe on (item_id, timestamp) handles repeats anyway)
    """S-2: ``{"timestamp": epoch, "data": {id: {avgHighPrice, ...}}}`` → raw
    prices_5m / prices_1h rows.  The payload timestamp applies to every row
    (missing → epoch 0); no row filter."""
    e = _entries(payloads, schemas.WINDOW_PAYLOAD, value, loaded_at, envelope)
    e = e.withColumn("ts", F.timestamp_seconds(F.coalesce("timestamp", F.lit(0).cast("long"))))
    if last_key_wins:
        x = _explode_last_wins(e, "data", ["payload_id", "loaded_at", "ts"])
    else:
        x = e.select("payload_id", "loaded_at", "ts", F.explode("data").alias("key", "v"))
    return x.select(F.col("key").cast("int").alias("item_id"),
                    F.col("v.avgHighPrice").alias("avg_high_price"),
                    F.col("v.highPriceVolume").alias("high_price_volume"),
                    F.col("v.avgLowPrice").alias("avg_low_price"),
                    F.col("v.lowPriceVolume").alias("low_price_volume"),
                    F.col("ts").alias("timestamp"), "loaded_at",
                    *(["payload_id"] if with_source else []))


# Mapping fields by the JSON type that their column takes.
_MAPPING_INTS = {"item_id": "id", "lowalch": "lowalch", "highalch": "highalch", "buy_limit": "limit", "value": "value"}
_MAPPING_TEXTS = {"name": "name", "examine": "examine", "icon": "icon"}


def mapping_records(payloads: DataFrame, value: str = "value", loaded_at: str | Column | None = None,
                    envelope: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """S-3 with its rejects: ``[{id, name, examine, members, lowalch, highalch, limit, value,
    icon}]`` → raw.item_mapping rows (``id``→``item_id``, ``limit``→``buy_limit``) plus payload_id,
    pos, reason and rejected.

    A document is parsed once, into VARIANT, and every field is typed from it: a number that is no
    integer of the column's range, a text where a number is due, or an object or array where a
    text is due rejects the record (``value``), as does a missing ``id`` or ``name``
    (``required``) and a record that is no object (``record``).  A document that does not parse or
    holds no array is rejected as a whole (``document``), one without a load time too
    (``load_time``).  ``keep`` names columns of ``payloads`` to carry along.
    """
    pid = F.col("payload_id") if "payload_id" in payloads.columns else F.lit(None).cast("string")
    docs = payloads.select(pid.alias("payload_id"), *keep, F.col(value).alias("_text"), F.try_parse_json(value).alias("_v"),
                           *([] if loaded_at is None and envelope else [_loaded_at(loaded_at).alias("loaded_at")]))
    if envelope and loaded_at is None:
        docs = docs.withColumn("loaded_at", F.timestamp_seconds(F.try_variant_get("_v", "$.poll_time", "bigint")))
    docs = docs.withColumn("_records", F.try_variant_get("_v", "$.payload" if envelope else "$", "array<variant>"))
    docs = docs.withColumn("_reason", F.when(F.col("_records").isNull(), "document").when(F.col("loaded_at").isNull(), "load_time"))
    rows = docs.select("payload_id", *keep, "loaded_at", "_reason", F.when(F.col("_reason").isNotNull(), F.col("_text")).alias("_text"),
                       F.posexplode_outer(F.when(F.col("_reason").isNull(), F.col("_records"))).alias("pos", "_r"))
    # an empty array has no records
    rows = rows.filter(F.col("pos").isNotNull() | F.col("_reason").isNotNull())

    def kind(field: str) -> Column:
        return F.schema_of_variant(F.try_variant_get("_r", f"$.{field}", "variant"))

    def sent(field: str) -> Column:
        return F.coalesce(kind(field) != "VOID", F.lit(False))

    def integer(field: str) -> Column:
        """The field as an integer, NULL where it is another type or value."""
        exact = F.try_variant_get("_r", f"$.{field}", "decimal(38,10)")
        number = kind(field).isin("BIGINT", "DOUBLE") | kind(field).startswith("DECIMAL")
        whole = exact.try_cast("int")
        return F.when(number & (exact == whole), whole)

    bad = sent("members") & (kind("members") != "BOOLEAN")
    for field in _MAPPING_INTS.values():
        bad = bad | (sent(field) & integer(field).isNull())
    for field in _MAPPING_TEXTS.values():
        bad = bad | (sent(field) & (kind(field).startswith("OBJECT") | kind(field).startswith("ARRAY")))
    reason = (F.when(~F.schema_of_variant("_r").startswith("OBJECT"), "record")
              .when(~sent("id") | ~sent("name"), "required").when(bad, "value"))
    typed = {c: integer(f) for c, f in _MAPPING_INTS.items()}
    typed |= {c: F.try_variant_get("_r", f"$.{f}", "string") for c, f in _MAPPING_TEXTS.items()}
    typed["members"] = F.when(kind("members") == "BOOLEAN", F.try_variant_get("_r", "$.members", "boolean"))
    rows = rows.withColumn("reason", F.coalesce("_reason", reason))
    return rows.select(*[typed[c].alias(c) for c in schemas.ITEM_MAPPING.fieldNames() if c != "loaded_at"], "loaded_at",
                       "payload_id", "pos", *keep, "reason",
                       F.when(F.col("reason").isNotNull(), F.coalesce("_text", F.to_json("_r"))).alias("rejected"))


def parse_mapping_payload(payloads: DataFrame, value: str = "value",
                          loaded_at: str | Column | None = None,
                          keep_position: bool = False, envelope: bool = False) -> DataFrame:
    """S-3: the accepted rows of ``mapping_records``.  ``keep_position`` adds ``(payload_id, pos)``
    so an upsert can apply "last record wins"."""
    rows = mapping_records(payloads, value, loaded_at, envelope).filter(F.col("reason").isNull())
    return rows.select(*schemas.ITEM_MAPPING.fieldNames(), *(["payload_id", "pos"] if keep_position else []))


def invalid_mapping_records(payloads: DataFrame, value: str = "value",
                            envelope: bool = False, loaded_at=None) -> DataFrame:
    """(loaded_at, reason, rejected): the rejects of ``mapping_records``, as JSON."""
    rows = mapping_records(payloads, value, loaded_at, envelope)
    return rows.filter(F.col("reason").isNotNull()).select("loaded_at", "reason", "rejected")


def quarantined(payloads: DataFrame, schema=schemas.LATEST_PAYLOAD, value: str = "value",
                envelope: bool = False) -> DataFrame:
    """Payload documents that did not parse (no ``data`` map / no record array)."""
    cols = [c for c in payloads.columns if c != value]
    target = envelope_schema(schema) if envelope else schema
    p = payloads.select(*cols, F.col(value), F.from_json(F.col(value), target).alias("p"))
    doc = F.col("p.payload") if envelope else F.col("p")
    bad = doc["data"].isNull() if isinstance(schema, T.StructType) else doc.isNull()
    return p.filter(F.col("p").isNull() | bad).select(*cols, F.col(value))


def _lenient(entry: T.StructType) -> T.StructType:
    """The entry with every scalar as its JSON text, so that no value is lost in the parse."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in entry.fields])


def _records(payloads: DataFrame, payload: T.StructType, value: str, loaded_at, envelope: bool,
             with_timestamp: bool) -> DataFrame:
    """(payload_id, loaded_at, ts, key, v, doc_reason, doc_text): entries as texts; a document
    that cannot be loaded gives one row with its reason and text."""
    entry = payload["data"].dataType.valueType
    fields = [T.StructField("data", T.MapType(T.StringType(), _lenient(entry)))]
    fields += [T.StructField("timestamp", T.StringType())] if with_timestamp else []
    schema = T.StructType(fields)
    pid = (F.col("payload_id") if "payload_id" in payloads.columns else F.lit(None).cast("string")).alias("payload_id")
    if envelope:
        e = payloads.select(pid, F.col(value).alias("text"), F.from_json(F.col(value), envelope_schema(schema)).alias("e"))
        at = F.timestamp_seconds(F.col("e.poll_time")) if loaded_at is None else _loaded_at(loaded_at)
        e = e.select("payload_id", "text", at.alias("loaded_at"), F.col("e.payload").alias("doc"))
        inner = F.get_json_object("text", "$.payload")
    else:
        e = payloads.select(pid, F.col(value).alias("text"), _loaded_at(loaded_at).alias("loaded_at"),
                            F.from_json(F.col(value), schema).alias("doc"))
        inner = F.col("text")
    reason = F.when(F.col("doc.data").isNull(), F.lit("document"))
    if with_timestamp:
        raw = F.col("doc.timestamp")
        # a missing timestamp means the epoch; one sent as null, or as no integer, is an error
        sent_null = raw.isNull() & F.coalesce(F.array_contains(F.json_object_keys(inner), "timestamp"), F.lit(False))
        reason = reason.when(sent_null | (raw.isNotNull() & raw.try_cast("bigint").isNull()), F.lit("timestamp"))
        e = e.withColumn("ts", F.timestamp_seconds(F.coalesce(raw.try_cast("bigint"), F.lit(0).cast("bigint"))))
    else:
        e = e.withColumn("ts", F.lit(None).cast("timestamp"))
    e = e.withColumn("doc_reason", reason).withColumn("doc_text", F.when(F.col("doc_reason").isNotNull(), F.col("text")))
    e = e.withColumn("data", F.when(F.col("doc_reason").isNull(), F.col("doc.data")))
    x = _explode_last_wins(e, "data", ["payload_id", "loaded_at", "ts", "doc_reason", "doc_text"], outer=True)
    return x.filter(F.col("key").isNotNull() | F.col("doc_reason").isNotNull())


def _with_reasons(x: DataFrame, ints: dict[str, str], longs: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns, ``reason`` and ``rejected`` (the record's text) from ``_records`` rows."""
    item = F.col("key").try_cast("int")
    bad = [F.col(f"v.{raw}").isNotNull() & F.col(f"v.{raw}").try_cast("bigint" if raw in longs else "int").isNull()
           for raw in [*ints.values(), *longs]]
    any_bad = bad[0]
    for b in bad[1:]:
        any_bad = any_bad | b
    reason = F.coalesce("doc_reason", F.when(item.isNull(), F.lit("item")).when(any_bad, F.lit("value")))
    return x.select("*", item.alias("item_id"), reason.alias("reason"),
                    F.coalesce("doc_text", F.to_json(F.struct("key", "v"))).alias("record"),
                    *[F.col(f"v.{raw}").try_cast("int").alias(name) for name, raw in ints.items()])


def latest_records(payloads: DataFrame, value: str = "value", loaded_at: str | Column | None = None,
                   envelope: bool = False) -> DataFrame:
    """S-1 with its rejects: raw.prices_latest rows plus payload_id, reason and rejected."""
    x = _with_reasons(_records(payloads, schemas.LATEST_PAYLOAD, value, loaded_at, envelope, False),
                      {"high_price": "high", "low_price": "low"}, ("highTime", "lowTime"))
    x = x.select("item_id", "high_price", _epoch_or_null(F.col("v.highTime").try_cast("bigint")).alias("high_time"),
                 "low_price", _epoch_or_null(F.col("v.lowTime").try_cast("bigint")).alias("low_time"), "loaded_at",
                 "payload_id", "reason", F.when(F.col("reason").isNotNull(), F.col("record")).alias("rejected"))
    return x.filter(F.col("reason").isNotNull() | F.col("high_price").isNotNull() | F.col("low_price").isNotNull())


def window_records(payloads: DataFrame, value: str = "value", loaded_at: str | Column | None = None,
                   envelope: bool = False) -> DataFrame:
    """S-2 with its rejects: raw prices_5m / prices_1h rows plus payload_id, reason and rejected."""
    x = _with_reasons(_records(payloads, schemas.WINDOW_PAYLOAD, value, loaded_at, envelope, True),
                      {"avg_high_price": "avgHighPrice", "high_price_volume": "highPriceVolume",
                       "avg_low_price": "avgLowPrice", "low_price_volume": "lowPriceVolume"})
    return x.select("item_id", "avg_high_price", "high_price_volume", "avg_low_price", "low_price_volume",
                    F.col("ts").alias("timestamp"), "loaded_at", "payload_id", "reason",
                    F.when(F.col("reason").isNotNull(), F.col("record")).alias("rejected"))

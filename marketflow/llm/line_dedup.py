"""Substring dedup: line hashing.

Texts are cut into units (lines, or paragraphs between blank lines).  A unit is normalised
(lower case, code point by code point, white space runs as one blank, trimmed) and hashed.  Digests are grouped over all
documents; the earliest occurrence, by document id and then place in the text, stays and every
later one is removed, with its offsets in the original text.

A digest that a third of all units share is no large group anywhere: the grouping keeps a
minimum and a count, summed up before the shuffle, and the units of the at most ``HOT_DIGESTS``
most frequent digests meet the table of repeated digests under a salt, their rows there once
per salt.

Every unit that is not empty counts, however short; a caller may ask for more words with
``min_words``.  A passage is found where it is a unit: one that runs across the middle of other
lines stays.

Defined results: null and empty texts have no units; the whole of a repeated document is
removed from the later copy; documents of equal id are ordered by their texts' md5 hashes, and
repeated rows (same id, same text) are one document; null ids come last; an empty table gives
an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from .common import documents, map_batches, packed, stored

MIN_WORDS = 1
HOT_DIGESTS = 1_000
SALTS = 64
LINE = "\n"
PARAGRAPH = r"\n[ \t\r]*\n"
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def spans(text: str, boundary: str = LINE) -> list[tuple[int, int]]:
    """(start, end) of the units of a text, without the boundaries."""
    out, at = [], 0
    for m in re.finditer(boundary, text):
        out.append((at, m.start()))
        at = m.end()
    return out + [(at, len(text))]


def normalised(unit: str) -> str:
    # str.lower looks at the neighbours of a capital sigma and makes two code points of a dotted I
    return _SPACE.sub(" ", unit.replace("\u0130", "i").replace("\u03a3", "\u03c3").lower()).strip(" ")


def text_hash(text: Column) -> Column:
    """The first 64 bits of a text's md5 hash, as a number in the order of the hexadecimal hash."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 16), 16, -10).cast("bigint").bitwiseXOR(F.lit(-1 << 63))


def units(docs: DataFrame, boundary: str = LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_id, unit, start, end, digest): the units of at least ``min_words`` words,
    with their offsets in code points, end exclusive; ``text_id`` is the text's hash."""

    def run(cols: dict) -> dict:
        out: dict[str, list] = {c: [] for c in ("doc_id", "text_id", "unit", "start", "end", "digest")}
        for doc_id, text_id, text in zip(cols["doc_id"], cols["text_id"], cols["text"]):
            for i, (a, b) in enumerate(spans(text or "", boundary)):
                unit = normalised(text[a:b]) if b > a else ""
                if unit and unit.count(" ") + 1 >= min_words:
                    for c, v in zip(out, (doc_id, text_id, i, a, b, xxhash.xxh3_128_digest(unit.encode("utf-8", "surrogatepass")))):
                        out[c].append(v)
        return out

    rows = documents(docs).withColumn("text_id", text_hash(F.col("text")))
    return map_batches(rows, run, "doc_id bigint, text_id bigint, unit bigint, start bigint, end bigint, digest binary", rows=200)


def repeated_units(docs: DataFrame, boundary: str = LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_id, unit, start, end, first_doc_id, first_unit): every unit that stands
    earlier already, with its earliest occurrence."""
    found = stored(units(docs, boundary, min_words), "line-units")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_id", "unit")
    groups = stored(found.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1"), "line-groups")
    often = max(1_000, found.count() // HOT_DIGESTS)
    hot = groups.filter(F.col("n") > often).select("digest", F.lit(True).alias("hot"))
    salted = found.join(F.broadcast(hot), "digest", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "text_id", "unit"), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint")))
    firsts = groups.withColumn("salt", F.explode(F.when(
        F.col("n") > often, F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_id") == F.col("first.text_id")) & (F.col("unit") == F.col("first.unit"))
    return salted.join(firsts, ["digest", "salt"]).filter(~is_first).select(
        "doc_id", "text_id", "unit", "start", "end", F.col("first.doc_id").alias("first_doc_id"), F.col("first.unit").alias("first_unit")).distinct()


def remove_repeats(docs: DataFrame, boundary: str = LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (columns doc_id and text, others kept) without the repeated units, each with
    the boundary after it; the result's last column, ``removed``, holds their (start, end) in
    the original text and replaces a column of that name."""
    gone = repeated_units(docs, boundary, min_words).groupBy("doc_id", "text_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
    gone = stored(gone.select(F.col("doc_id").alias("gone_id"), F.col("text_id").alias("gone_text"), "removed"), "line-removed")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "removed"])
    rows = packed(docs).join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (text_hash(F.col("text")) == F.col("gone_text")), "left")
    rows = rows.select("row", F.coalesce("removed", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("removed"), "text")
    schema = StructType([rows.schema["row"], rows.schema["removed"], StructField("text", StringType())])
    arrow, cut = to_arrow_schema(schema), cutter(boundary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the whole row passes as Arrow has it, only the text is made anew
        for batch in batches:
            spans_of = [[(s["start"], s["end"]) for s in r] for r in batch.column("removed").to_pylist()]
            left = [cut(t, r) for t, r in zip(batch.column("text").to_pylist(), spans_of)]
            columns = [batch.column(c).cast(arrow.field(c).type) for c in ("row", "removed")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(left, pa.string())], schema=arrow)

    left = rows.mapInArrow(run, schema)
    rest = [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return left.select(*rest, "removed")


def cutter(boundary: str) -> Callable[[str | None, list | None], str | None]:
    def cut(text: str | None, removed: list | None) -> str | None:
        if not text or not removed:
            return text
        out, at = [], 0
        for a, b in removed:
            m = re.compile(boundary).match(text, b)
            out.append(text[at:a])
            at = m.end() if m else b
        return "".join(out) + text[at:]

    return cut

"""Benchmark decontamination: size-partitioned MinHash containment search.

Finds the test items that a document contains: at least ``threshold`` of the item's distinct
word shingles occur in the document.  Only DataFrame functions are used.

Items are partitioned by size, in powers of two of their distinct shingle count.  In the
partition up to size u an item's signature is its bottom-k MinHash sketch: the k shingles of
the smallest hashes, k = floor((1 - threshold) u) + 1.  A document that contains the item
lacks at most (1 - threshold) |item| <= k - 1 shingles, so it holds one of the k, and an
equality join of document shingles with the sketches finds every (document, item) candidate,
however long the document is.  Candidates are verified by counting the item's shingles, as
texts, in the document.

Words are runs of anything but ASCII white space, lower-cased; shingles have five words; an
item of fewer words has one shingle, all its words, which is looked for among the document's
shingles of that length.

The sketches are joined in blocks of ``BLOCK_ENTRIES`` entries, whose size is thereby bounded
and may be broadcast; more or longer items mean more blocks.

Defined results: null and empty texts, or items without a word, match nothing; a null
document or item id stays null in the result; repeated rows of a document, and items of equal
id and text, give one row; an empty table on either side gives an empty result; columns other
than those named are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, packed, stored, unpacked, with_text_key

WORDS = 5
THRESHOLD = 0.8
# Sketch entries (a hash and an item number, 16 bytes) of one broadcast block.
BLOCK_ENTRIES = 1_000_000
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")


def _places(n_words: Column, size: int) -> Column:
    """1 .. number of shingles, an empty array if there are none."""
    none = F.array().cast("array<int>")
    return F.when(n_words >= size, F.sequence(F.lit(1), F.greatest(n_words - size + 1, F.lit(1)))).otherwise(none)


def _hashes(w: str, size: int) -> Column:
    return F.transform(_places(F.size(w), size), lambda i: F.xxhash64(*[F.get(F.col(w), i - 1 + k) for k in range(size)]))


def _texts(w: str, size: int) -> Column:
    return F.transform(_places(F.size(w), size), lambda i: F.concat_ws(" ", *[F.get(F.col(w), i - 1 + k) for k in range(size)]))


def items_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, w, size): ``item`` numbers the distinct (id, text) pairs that hold a
    word; ``size`` is the item's shingle length."""
    rows = items.select(F.col(f"`{id_col}`").cast("bigint").alias("item_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text")).distinct()
    rows = rows.withColumn("w", words(F.col("text"))).filter(F.size("w") > 0)
    return stored(rows.select(F.monotonically_increasing_id().alias("item"), "item_id", "w",
                              F.least(F.size("w"), F.lit(WORDS)).alias("size")), "benchmark-items")


def sketches(items: DataFrame, sizes: list[int], threshold: float = THRESHOLD) -> DataFrame:
    """(item, size, hash): the bottom-k sketch of each item, k by its size partition."""
    out = []
    for size in sizes:
        hashes = items.filter(F.col("size") == size).select("item", "size", F.array_sort(F.array_distinct(_hashes("w", size))).alias("h"))
        upper = F.pow(2, F.ceil(F.log2(F.size("h").cast("double"))))  # of the partition's sizes
        k = (F.floor(upper * (1 - threshold) + 1e-9) + 1).cast("int")
        out.append(hashes.select("item", "size", F.explode(F.slice("h", F.lit(1), F.least(k, F.size("h")))).alias("hash")))
    return reduce(DataFrame.unionByName, out)


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, item_id, n_shingles, n_shared, containment): the (document, item)
    pairs whose containment is at least ``threshold``."""
    rows = with_text_key(documents(docs))
    known = items_of(items)
    # one row: the shingle lengths in use, at most WORDS of them
    sizes = known.agg(F.sort_array(F.collect_set("size")).alias("sizes")).first()["sizes"] or [WORDS]
    of_item = reduce(DataFrame.unionByName, [
        known.filter(F.col("size") == s).select("item", "item_id", "size", F.array_distinct(_texts("w", s)).alias("s"))
        for s in sizes])
    texts = _candidates(rows, known, sizes, threshold).withColumn("w", words(F.col("text")))
    texts = texts.select("doc_id", "text_key", "items", *[F.array_distinct(_texts("w", s)).alias(f"s{s}") for s in sizes])
    pairs = texts.withColumn("item", F.explode("items")).join(of_item, "item")
    own = reduce(lambda rest, s: F.when(F.col("size") == s, F.col(f"s{s}")).otherwise(rest), sizes, F.array().cast("array<string>"))
    return pairs.select("doc_id", "text_key", "item_id", F.size("s").alias("n_shingles"),
                        F.size(F.array_intersect(F.col("s"), own)).alias("n_shared")) \
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles")) \
        .filter(F.col("containment") >= threshold).distinct()


def _candidates(rows: DataFrame, known: DataFrame, sizes: list[int], threshold: float) -> DataFrame:
    """(doc_id, text_key, text, items): documents that hold a shingle of the items' sketches.

    The sketch entries are split by hash into blocks of about ``BLOCK_ENTRIES``, so what is
    broadcast has that bound however many or long the items are.  Only rows that pass the join
    are written with their text, once per task, so no other text is shuffled.
    """
    sketch = stored(sketches(known, sizes, threshold), "benchmark-sketch")
    blocks = max(1, -(-sketch.count() // BLOCK_ENTRIES))
    docs = rows.select("doc_id", "text_key", "text", words(F.col("text")).alias("w"))
    found = []
    for size in sizes:
        # hashed before the explode, which then runs in one generated loop with the join; the
        # outer one, as for the inner one the hashes would be made once more to test their number
        hashed = docs.select("doc_id", "text_key", "text", _hashes("w", size).alias("h"))
        shingles = hashed.select("doc_id", "text_key", "text", F.explode_outer("h").alias("hash"))
        entries = sketch.filter(F.col("size") == size).select("hash", "item")
        for b in range(blocks):
            here = F.pmod("hash", F.lit(blocks)) == b
            found.append(shingles.join(F.broadcast(entries.filter(here)), "hash").select("doc_id", "text_key", "text", "item"))
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "text_key").agg(
        F.first("text").alias("text"), F.collect_set("item").alias("items"))


def remove_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (columns doc_id and text, others kept) without the rows that contain an item."""
    bad = stored(contained(docs, items, threshold).select(
        F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct(), "benchmark-bad")
    clean = packed(docs).join(bad, F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("text_key") == F.col("bad_key")), "left_anti")
    return unpacked(clean, docs)

"""SimHash near-dedup: deletion-variant signatures.

A fingerprint has 64 bits.  Two fingerprints within ``max_bits`` = 2 bits, cut into two
segments, agree in one segment up to at most one bit.  Each segment is indexed exactly and
with each of its bits deleted in turn (a one-wildcard variant: the bit's place and the
segment without it), so an equality join on the variants finds every such pair; the rest of
the fingerprint is then verified.

Work is done on distinct fingerprints, so copies cost nothing.  An index bin with more than
``PAIR_BIN`` different fingerprints is not paired: inside such a bin the variants of the other
segment are added to the key, until members of a bin can differ in the two wildcard places
only.  A bin then holds at most four fingerprints, all within two bits of each other, and
gives a star of links.  Both ways are exact; the second grows linearly however large a group
of near copies is.

Components come from repeated joins on the link table (hooking to the smallest neighbour and
pointer jumping), cut by written tables; no link or component reaches the driver.

Defined results: a text that is null, empty or without words has fingerprint zero and links
like any other; fewer words than a shingle give one shingle, the whole sequence; a null id
never names a component unless all ids of the component are null; repeated rows each give a
row; an empty table gives an empty table; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, map_batches, packed, stored, unpacked, with_text_key

SEED = 42
PAIR_BIN = 32
SEGMENT = 32
_BITS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """64-bit SimHash: bit b is 1 if set in over half of the shingles' XXH64 values."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space only
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << _BITS[2 * ones > len(h)]).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp bigint): one row per input row; the bits as a signed 64-bit integer."""

    def run(cols: dict) -> dict:
        return {"doc_id": cols["doc_id"], "fp": _signed(fingerprint(t, shingle_words) for t in cols["text"])}

    return map_batches(documents(docs, id_col, text_col), run, "doc_id bigint, fp bigint")


def _segment(seg: int, fp: Column) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT * seg).bitwiseAND(F.lit((1 << SEGMENT) - 1))


def _one(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.cast("int"))


def _without(fp: Column, bit: Column) -> Column:
    return fp.bitwiseAND(F.bitwise_not(_one(bit)))


def _variants(fps: DataFrame) -> DataFrame:
    """(key, seg, bit, fp): 2 x (1 + 32) index rows of a fingerprint; ``bit`` is the deleted
    place in the fingerprint, -1 for the segment as it is.  ``key`` packs segment, place and
    what is left of the segment into one integer."""
    rows = fps.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("seg"))
    rows = rows.withColumn("part", F.when(F.col("seg") == 0, _segment(0, F.col("fp"))).otherwise(_segment(1, F.col("fp"))))
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(-1), F.lit(SEGMENT - 1))))
    left = F.when(F.col("at") < 0, F.col("part")).otherwise(_without(F.col("part"), F.col("at")))
    code = F.when(F.col("at") < 0, 64 + F.col("seg")).otherwise(F.col("at") + SEGMENT * F.col("seg"))
    return rows.select((left * 128 + code).alias("key"), "fp")


def _unpacked(index: DataFrame) -> DataFrame:
    code = F.col("key").bitwiseAND(F.lit(127))
    return index.withColumn("seg", F.when(code < 64, F.floor(code / SEGMENT)).otherwise(code - 64).cast("int")) \
        .withColumn("bit", F.when(code < 64, code).otherwise(-1).cast("int"))


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) with a < b: links whose closure is that of all pairs of distinct fingerprints in
    ``fps`` (column fp) within ``max_bits`` (0, 1 or 2) differing bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("two segments with one wildcard cover at most 2 differing bits")
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("a < b")
    # the few bytes of the fingerprints would be read by a task or two, which then make 66 rows
    # of each: spread them first, by a key that the grouping before has not dealt them by
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    # bins of one fingerprint link nothing: they go before anything is joined.  Merged by hint, as
    # Spark sizes the 66 rows of a fingerprint as the one they are made of, and the index by its
    # encoded file, and would broadcast either
    bins = _variants(fps).groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").hint("merge")
    index = stored(_variants(fps).join(bins, "key"), "simhash-index")
    small, large = (_unpacked(index.filter(c)) for c in (F.col("n") <= PAIR_BIN, F.col("n") > PAIR_BIN))
    a = small.select("key", "seg", "bit", F.col("fp").alias("a"))
    b = small.select("key", F.col("fp").alias("b")).hint("merge")
    place = F.when(F.col("bit") < 0, F.lit(0).cast("bigint")).otherwise(_one(F.greatest(F.col("bit"), F.lit(0))))
    low = F.lit((1 << SEGMENT) - 1)
    within = F.when(F.col("seg") == 0, low).otherwise(F.bitwise_not(low))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    # a pair counts in the one bin of a segment whose wildcard is just where it differs
    pairs = a.join(b, "key").filter((F.col("a") < F.col("b")) & (differ.bitwiseAND(within) == place)
                                    & (F.bit_count(differ) <= max_bits)).select("a", "b")
    return pairs.unionByName(_stars(large, max_bits)).distinct()


def _stars(large: DataFrame, max_bits: int) -> DataFrame:
    """Links inside large bins: wildcards are added outside the bin's segment until a bin
    holds only fingerprints that differ in ``max_bits`` places at most."""
    def other(seg, first: int):
        # places of the other segment, from `first` on
        return F.sequence(SEGMENT * (1 - seg) + first, SEGMENT * (1 - seg) + SEGMENT - 1)

    one = large.filter("bit >= 0").withColumn("fixed", _without(F.col("fp"), F.col("bit")))
    exact = large.filter("bit < 0").withColumn("fixed", F.col("fp"))
    # the members of an exact bin may differ in two places of the other segment ...
    two = exact.withColumn("i", F.explode(other(F.col("seg"), 0)))
    if max_bits == 1:
        keyed = two.select("fp", F.col("i"), F.lit(-1).alias("j"), _without(F.col("fixed"), F.col("i")).alias("k"))
        keyed = keyed.unionByName(one.select("fp", F.col("bit").alias("i"), F.lit(-1).alias("j"), F.col("fixed").alias("k")))
    else:
        two = two.withColumn("j", F.explode(other(F.col("seg"), 0))).filter("i < j")
        keyed = two.select("fp", "i", "j", _without(_without(F.col("fixed"), F.col("i")), F.col("j")).alias("k"))
        # ... those of a one-wildcard bin in that place and one of the other segment
        mixed = one.withColumn("j", F.explode(other(F.col("seg"), 0)))
        keyed = keyed.unionByName(mixed.select(
            "fp", F.least("bit", "j").alias("i"), F.greatest("bit", "j").alias("j"),
            _without(F.col("fixed"), F.col("j")).alias("k")))
    stars = keyed.groupBy("i", "j", "k").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b")


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable from each one that has a link.

    Each round takes the smallest root among a node and its neighbours and then jumps to
    that root's own root; the label table is written each round.  A path of n nodes needs
    about log n rounds on random labels; the loop ends when a round changes nothing.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")), "simhash-links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
                    .withColumnRenamed("a", "fp"), "simhash-labels")
    while True:
        near = both.join(labels.select(F.col("fp").alias("b"), "root"), "b").groupBy(F.col("a").alias("fp")).agg(F.min("root").alias("near"))
        # both a node and its present root may hook to a smaller root
        hooks = labels.join(near, "fp").select("fp", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        roots = hooks.groupBy(F.col("was").alias("fp")).agg(F.min("root").alias("up"))
        hooked = hooks.join(roots.withColumnRenamed("fp", "was"), "was").select("fp", "was", F.least("root", "up").alias("root"))
        jump = hooked.select(F.col("fp").alias("root"), F.col("root").alias("far"))
        nxt = stored(hooked.join(jump, "root", "left").select(
            "fp", F.coalesce("far", "root").alias("root"), (F.coalesce("far", "root") != F.col("was")).alias("changed")), "simhash-labels")
        if nxt.filter("changed").isEmpty():
            return nxt.select("fp", "root")
        labels = nxt.select("fp", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row; ``component_id`` is the smallest id
    reachable over links, the row's own included.

    The last join carries 16 bytes a document; a fingerprint that many rows share makes a
    skewed key, which adaptive execution splits on the documents' side.
    """
    return label_rows(stored(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fp"), max_bits)


def keep_one(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` (columns doc_id and text, others kept) with one row of each group: the one of
    the smallest id (null ids last), then of the smallest text digest; of repeats of that row
    one, whichever.

    Only narrow rows meet in the grouping; the documents are then joined once by
    (doc_id, digest of the text) with the rows to keep.
    """
    rows = stored(map_batches(
        with_text_key(documents(docs)),
        lambda cols: {"doc_id": cols["doc_id"], "text_key": cols["text_key"],
                      "fp": _signed(fingerprint(t, shingle_words) for t in cols["text"])},
        "doc_id bigint, text_key string, fp bigint"), "simhash-fp")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    # the best row of a fingerprint before the best of a component: copies meet as partial sums
    best = rows.groupBy("fp").agg(F.min(order).alias("best"))
    roots = components(links(best.select("fp"), max_bits))
    best = best.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
    copies = rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("copies"))
    best = stored(best.select("best.doc_id", "best.text_key").alias("b").join(copies.alias("c"), (
        F.col("b.doc_id").eqNullSafe(F.col("c.doc_id"))) & (F.col("b.text_key") == F.col("c.text_key"))).select(
        F.col("b.doc_id").alias("kept_id"), F.col("b.text_key").alias("kept_key"), "copies"), "simhash-kept")
    found = packed(docs).join(best, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key")))
    once = found.filter("copies = 1").select("row")
    return unpacked(once.unionByName(found.filter("copies > 1").dropDuplicates(["kept_id", "kept_key"]).select("row")), docs)


def _signed(fps: Iterable[int]) -> list[int]:
    return [f - (1 << 64) if f >> 63 else f for f in fps]


def label_rows(rows: DataFrame, max_bits: int = 2) -> DataFrame:
    """Add ``component_id`` to rows with doc_id and fp."""
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(fps.select("fp"), max_bits))
    named = stored(fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"), "simhash-roots")
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    names = stored(named.join(ids, "root").select("fp", "component_id"), "simhash-names")
    return rows.join(names, "fp").select(*[c for c in rows.columns], "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

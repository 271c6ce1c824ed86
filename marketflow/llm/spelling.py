"""Spelling variant grouping: asymmetric q-chunks.

Two words within one edit (a code point inserted, deleted or replaced) differ in one place, so
of two disjoint chunks of the shorter word one is left whole in the other word, moved by no more
than the difference in length.  Each word of t code points contributes its two chunks, the first
t // 2 code points and the rest.  As the other word of a pair it contributes its positional
grams: for a partner of its own length those of shift 0, for one that is a code point shorter
those of shift 0 (first chunk) and 1 (last chunk).  Grams at other places meet no chunk within
shift one, so they are not written.  An equality join of chunks and grams finds every pair, and
an edit distance of exactly one is verified.

A chunk that many words share ("...tions") makes a large bin.  Bins of more than ``PAIR_BIN``
pairs are not paired: the part of the word that is not fixed yet is cut into two chunks again,
which are added to the key, until a bin is small or one code point is open; such a bin is as
large as the alphabet at most.  Both ways are exact, and nothing is dropped.

Defined results: null texts have no words; a null id reads as empty text where the id is hashed;
repeated rows count again; ties of the largest count go to the smallest word in code-point
order; a word without near words has ``n_near`` 0, no form and itself as root; an empty table
gives an empty table; columns other than the id and the text are ignored.  A very long text is
read whole in one task; a word of any length is joined by the hash of its chunks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, map_batches, stored

LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS = 7
MIN_COUNT = 2
FORM_FACTOR = 10
EDIT_EVERY = 31
PAIR_BIN = 1024


def misspelt(doc_id: int | None, run: str, every: int = EDIT_EVERY) -> str:
    """The lower-cased run, one code point left out where the hash says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run[:(at := h % len(run))] + run[at + 1:] if every and h % every == 0 else run


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, every: int = EDIT_EVERY) -> DataFrame:
    """(word, n): runs of letters, only A-Z lower-cased, of so many code points and occurrences;
    counted by batch, then by task, then over all documents."""
    runs = re.compile(f"[{LETTERS}]{{{min_chars},}}")

    def run(cols: dict) -> dict:
        n: Counter = Counter()
        for doc_id, text in zip(cols["doc_id"], cols["text"]):
            lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            for found, k in Counter(runs.findall(lowered)).items():
                n[misspelt(doc_id, found, every)] += k
        n = {w: k for w, k in n.items() if len(w) >= min_chars}
        return {"word": list(n), "n": list(n.values())}

    return map_batches(documents(docs), run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= min_count)


def _part(word: Column, start: Column, end: Column) -> Column:
    return F.substring(word, start + 1, end - start)


def _index(rows: DataFrame) -> DataFrame:
    """(key, word, n, d, a, b): two rows for each row, the open part [a, b) of the chunk side's
    word being cut into two; ``d`` is 1 where the word is a code point longer than its partner.
    The key hashes the fixed code points on both sides, their places and the partner's length."""
    half = F.col("a") + F.floor((F.col("b") - F.col("a")) / 2).cast("int")
    rows = rows.withColumn("open", F.explode(F.array(
        F.struct(half.alias("a"), F.col("b").alias("b")), F.struct(F.col("a").alias("a"), half.alias("b"))))).select(
        "word", "n", "d", "size", F.col("open.a").alias("a"), F.col("open.b").alias("b"))
    left = _part(F.col("word"), F.lit(0), F.col("a"))
    right = _part(F.col("word"), F.col("b") + F.col("d"), F.col("size") + F.col("d"))
    return rows.withColumn("key", F.xxhash64("size", "a", "b", left, right))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): each ordered pair of words (columns word, n; distinct) that differ
    by exactly one inserted, deleted or replaced code point."""
    size = F.char_length("word")
    both = words.withColumn("d", F.explode(F.array(F.lit(0), F.lit(1))))
    # of partners of length 0 there is nothing to hash: a word of one code point has none here
    rows = both.select("word", "n", "d", (size - F.col("d")).alias("size")).filter("size > 0") \
        .select("*", F.lit(0).alias("a"), F.col("size").alias("b"))
    pairs = None
    while True:
        index = _index(rows)
        bins = index.groupBy("key").agg(F.count_if(F.col("d") == 0).alias("own"), F.count_if(F.col("d") == 1).alias("longer"))
        # bins without a partner go before anything is paired
        bins = bins.filter("own > 1 or (own > 0 and longer > 0)")
        live = stored(index.join(bins, "key"), "spelling-index")
        paired = (F.col("own") * (F.col("own") + F.col("longer")) <= PAIR_BIN) | (F.col("b") - F.col("a") <= 1)
        small = live.filter(paired)
        x = small.filter("d = 0").select("key", F.col("word").alias("x"), F.col("n").alias("x_n"))
        y = small.select("key", "d", F.col("word").alias("y"), F.col("n").alias("y_n"))
        found = x.join(y, "key").filter((F.col("d") == 1) | (F.col("x") < F.col("y"))) \
            .filter(F.levenshtein("x", "y", 1) == 1).select("x", "x_n", "y", "y_n")
        pairs = found if pairs is None else pairs.unionByName(found)
        large = live.filter(~paired)
        if large.isEmpty():
            break
        rows = large.select("word", "n", "d", "size", "a", "b")
    pairs = stored(pairs.distinct(), "spelling-pairs")
    return pairs.select(F.col("x").alias("word"), F.col("y").alias("near"), F.col("y_n").alias("near_n")).unionByName(
        pairs.select(F.col("y").alias("word"), F.col("x").alias("near"), F.col("x_n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to.  Counts grow tenfold with
    each form, so a path is short; each round doubles the part of it that is done."""
    labels = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        jump = labels.select(F.col("word").alias("root"), F.col("root").alias("far"))
        nxt = stored(labels.join(jump, "root", "left").select(
            "word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
        if nxt.filter("moved").isEmpty():
            return nxt.select("word", "root")
        labels = nxt.select("word", "root")


def group_variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n), one row per word: the form is the near
    word of largest count, if that is at least ``factor`` times the word's own."""
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    rows = words.join(near, "word", "left")
    is_form = -F.col("best.less") >= factor * F.col("n")
    rows = stored(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(rows.filter(F.col("form").isNotNull()))
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """``group_variants`` over the words of all documents."""
    return group_variants(stored(word_counts(docs), "spelling-words"))

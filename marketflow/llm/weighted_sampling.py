"""Document fingerprints: consistent weighted sampling.

A text is a bag of two-word shingles (lower-cased words; a single word is its own shingle),
weighted by how often they occur.  Sample k of a bag takes for every term i of weight w the
values r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) that belong to (i, k), and

    t = floor(ln w / r + b),   ln a = ln c - r (t - b + 1),

and keeps the (term, t) of the smallest a.  Two bags agree in a sample with a probability that
is their generalised Jaccard similarity, sum of min over sum of max of the weights.

All draws are hashes of (term, k), so every worker agrees and nothing is kept per term.  They are
made in an order that leaves most of them undrawn: a bag's a for weight 1, a1 = c / exp(r (1 - b)),
is exponential, and given a1 the others follow from two more exponential values E and F,

    c = a1 + E,   r (1 - b) = ln(c / a1),   r = r (1 - b) + F,

which gives r, c and b the same joint law as above.  A term of weight 1 needs a1 alone.  One of
weight w has a >= a1 exp(-F) / w, and E is drawn only where that is below the smallest a found.

A fingerprint is the ``SAMPLES`` samples at 16 bits each in hexadecimal; the likeness of two is
the share of equal samples.

Defined results: a text without a word (null and empty ones too) has the empty fingerprint,
like another empty one (1) and unlike all others (0); a null id sorts below all ids; rows of
equal id are ordered by their text; repeated rows give a row each; an empty table gives an
empty table, and the only row of a table is its own next one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ARROW_ROWS, arrow_schema, documents, map_batches, with_text_key

SAMPLES = 128
SEED = 7
# Rows of one place, about: documents of neighbouring ids that one task walks along.
NEIGHBOURS = 2_000
# Cut points and first rows that the driver holds; beyond, a place takes an even share of the rows
# and streams through its task.
MOST_PLACES = 200_000
# Terms of a text that are sampled at a time: bounds memory for very long texts.
_TERMS = 4_096
# Words whose hash a worker remembers.
CACHED_WORDS = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=16)
def _salts(samples: int, draw: int) -> np.ndarray:
    return np.random.default_rng([SEED, draw]).integers(0, 1 << 63, samples, dtype=np.uint64) << np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def scrambled(hashes: np.ndarray) -> np.ndarray:
    """Terms whose hashes are alike get draws that are not."""
    x = hashes ^ (hashes >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def lanes(hashes: np.ndarray, samples: int, draw: int) -> np.ndarray:
    """The leading 16 bits of each (term, sample)'s uniform value; ``draw`` numbers the values that
    belong to one."""
    return mixed(hashes[:, None] ^ _salts((samples + 3) // 4, draw)).view("<u2")[:, :samples]


def uniform(lane: np.ndarray, hashes: np.ndarray, sample: np.ndarray, samples: int, draw: int) -> np.ndarray:
    """The whole value, 48 bits, of terms and samples in pairs."""
    rest = mixed(hashes ^ _salts(samples, draw + 10)[sample]) >> np.uint64(32)
    return (lane.astype(np.float64) * 2.0**32 + rest + 0.5) * 2.0**-48


class _Hashes(dict):
    """Word hashes, remembered until there are ``CACHED_WORDS``."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), SEED)
        return h


_HASHES = _Hashes()


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, weights) of the distinct terms, by hash."""
    words = text.lower().split()
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(h) > 1:
        h = (h[:-1] * np.uint64(3) + np.uint64(1)) ^ (h[1:] * _MIX)
        h ^= h >> np.uint64(31)
        h *= _MIX
    return np.unique(h, return_counts=True)


def signature(text: str | None, samples: int = SAMPLES) -> np.ndarray:
    """``samples`` values of 16 bits; none if the text has no word."""
    hashes, weights = terms(text or "")
    if not len(hashes):
        return np.zeros(0, dtype=np.uint16)
    best = np.full(samples, np.inf)
    value = np.zeros(samples, dtype=np.uint64)
    column = np.arange(samples)

    def offer(k: np.ndarray, a: np.ndarray, term: np.ndarray, t: np.ndarray | float) -> None:
        """Take the values that are smaller than the best of their sample; each sample once."""
        better = np.flatnonzero(a < best[k])
        if len(better):
            k, term = k[better], term[better]
            steps = t[better].astype(np.uint64) if isinstance(t, np.ndarray) else np.uint64(t)
            best[k] = a[better]
            value[k] = (term ^ (steps * np.uint64(0xC2B2AE3D27D4EB4F))) * _MIX >> np.uint64(48)

    for first in range(0, len(hashes), _TERMS):
        h, w = scrambled(hashes[first:first + _TERMS]), weights[first:first + _TERMS]
        once, often = h[w == 1], np.flatnonzero(w > 1)
        if len(once):
            # a1 rises with its uniform value: only the terms of the least leading bits can be least
            lane = lanes(once, samples, 0)
            i, k = np.divmod(np.flatnonzero(lane == lane.min(axis=0)), samples)
            u = uniform(lane[i, k], once[i], k, samples, 0)
            i, k, u = least(i, k, u, once)
            offer(k, -np.log1p(-u), once[i], 0)
        if len(often):
            term, ln_w = h[often], np.log(w[often].astype(np.float64))
            first_lane, last_lane = lanes(term, samples, 0), lanes(term, samples, 1)
            # an exponential value is at least the uniform one, and that at least its leading bits
            bound = first_lane.astype(np.float32) * last_lane * (np.float32(2.0**-32) / w[often][:, None].astype(np.float32))

            def exact(i: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """a and t of terms i in samples k."""
                a1 = -np.log1p(-uniform(first_lane[i, k], term[i], k, samples, 0))
                e = -np.log(uniform(lanes(term[i], 4, 2)[:, 0], term[i], k, samples, 2))
                rise = np.log1p(e / a1)
                r = rise - np.log(uniform(last_lane[i, k], term[i], k, samples, 1))
                t = np.floor(ln_w[i] / r + 1 - rise / r)
                return a1 * np.exp(-r * t), t

            if not len(once):
                # the term of the lowest bound gives a value that few other bounds are below
                lowest = bound.argmin(axis=0)
                a, t = exact(lowest, column)
                offer(column, a, term[lowest], t)
            i, k = np.divmod(np.flatnonzero(bound <= (best * 1.0001).astype(np.float32)), samples)
            a, t = exact(i, k)
            i, k, a, t = least(i, k, a, term, t)
            offer(k, a, term[i], t)
    return value.astype(np.uint16)


def least(i: np.ndarray, k: np.ndarray, a: np.ndarray, term: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of (i, k, a, *more) the row of the least a for each k, the term of the least hash if equal."""
    order = np.lexsort((term[i], a, k))
    if len(order):
        order = order[np.r_[True, k[order][1:] != k[order][:-1]]]
    return tuple(x[order] for x in (i, k, a, *more))


def hexadecimal(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated generalised Jaccard similarity of two texts by their signatures."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint): one row per input row."""
    return map_batches(documents(docs), lambda cols: {
        "doc_id": cols["doc_id"], "fingerprint": [hexadecimal(signature(t, samples)) for t in cols["text"]],
    }, "doc_id bigint, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as many first code points of ``following``."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def in_places(docs: DataFrame) -> DataFrame:
    """(place, ends, rank, text_key, doc_id, text): rows dealt so that the next one of every
    row, by descending id and then by text digest, is in the same ``place``; ``ends`` marks
    copies that only end a place.

    Quantiles of the ids cut the rows into places of about ``NEIGHBOURS`` rows, at most
    ``MOST_PLACES``; an id that spans several quantiles is cut by its texts' digests.  A copy of
    each place's first row goes to the place before it, that of the very first to the very
    last.  So the texts are shuffled once, by place, and the driver sees one row a place.
    """
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    lowest = F.lit(-(1 << 63)).cast("bigint")
    # ascending rank is descending id
    rows = with_text_key(documents(docs)).withColumn("rank", F.bitwise_not(F.coalesce("doc_id", lowest)))
    rows = rows.withColumn("near", F.col("rank").cast("double"))
    places = max(1, min(MOST_PLACES, -(-rows.count() // NEIGHBOURS)))
    cuts = Counter(rows.approxQuantile("near", [(i + 1) / places for i in range(places - 1)], 0.2 / places) if places > 1 else [])
    wide = {v: n for v, n in cuts.items() if n > 1}  # ids that fill places of their own
    bounds = sorted({*cuts, *(math.nextafter(v, math.inf) for v in wide)})
    splits = [-math.inf, *(bounds or [0.0]), math.inf]
    rows = Bucketizer(splits=splits, inputCol="near", outputCol="bucket").transform(rows)
    digits = {bounds.index(v) + 1: min(3, 1 + int(math.log(n, 16))) for v, n in wide.items()}
    part = F.lit(0)
    for k in (1, 2, 3):
        part = F.when(F.col("bucket").isin([b for b, d in digits.items() if d == k]),
                      F.conv(F.substr("text_key", F.lit(1), F.lit(k)), 16, 10).cast("int")).otherwise(part)
    rows = rows.withColumn("place", F.col("bucket").cast("bigint") * 4096 + part)
    firsts = sorted(rows.groupBy("place").agg(F.min(F.struct("rank", "text_key")).alias("first")).collect())
    marks = [(f["first"]["rank"], f["first"]["text_key"], firsts[i - 1]["place"]) for i, f in enumerate(firsts)]
    ends = F.broadcast(spark.createDataFrame(marks, "rank bigint, text_key string, earlier bigint"))
    target = F.struct("place", F.lit(False).alias("ends"))
    also = F.struct(F.col("earlier").alias("place"), F.lit(True).alias("ends"))
    both = rows.join(ends, ["rank", "text_key"], "left").withColumn(
        "to", F.explode(F.when(F.col("earlier").isNull(), F.array(target)).otherwise(F.array(target, also))))
    return both.select("to.place", "to.ends", "rank", "text_key", "doc_id", "text")


def near_next(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next): each row beside its text edited by the next one, see ``edited``."""
    spark = docs.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ddl = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")
    out = arrow_schema(spark, ddl)

    def beside(row: tuple, following: tuple) -> tuple:
        _, doc_id, text, own = row
        changed = edited(text, following[2])
        other = own if changed == text else signature(changed, samples)
        return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), hexadecimal(own),
                hexadecimal(other), likeness(own, other), likeness(own, following[3]))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, ended = None, None
        for batch in batches:
            found = []
            for place, ends, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("place", "ends", "doc_id", "text"))):
                if place == ended:  # repeats of the place's end
                    continue
                row = (place, doc_id, text or "", signature(text, samples))
                if before is not None:
                    found.append(beside(before, row))
                before, ended = (None, place) if ends else (row, None)
            columns = zip(*found) if found else ([] for _ in out)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, out)], schema=out)

    dealt = in_places(docs).repartition("place").sortWithinPartitions("place", "ends", "rank", "text_key")
    return dealt.select("place", "ends", "doc_id", "text").mapInArrow(walk, ddl)

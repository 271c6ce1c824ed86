"""Best-fit packing: exact-complement hashing.

Documents become token sequences; those longer than a sequence are cut.  Packing depends on
lengths only, and there are at most ``capacity`` different ones, so the plan is made from
the histogram of lengths, whose size does not grow with the data:

* the longest length left opens sequences; their gap is looked up among the single lengths,
  the sums of two and the sums of three lengths that are still available, and a combination
  that fills the gap exactly is used as often as its counts allow;
* a gap that no combination fills takes the longest length that fits (best fit) and is
  looked up again.

The plan is a list of runs: "ranks r0 .. r1 of length L go to sequences s0 .. at offset o".
Spark ranks the pieces of each length (in salted buckets, so a length that a third of the
pieces share is no single group) and looks each rank up in the runs.

Defined results: a null or empty text is the single end id; a null id stays null; repeated
rows are packed each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .common import documents, map_batches, stored, text_key

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
# Pieces of one length and salt bucket that are ranked in one group, about.
RANK_BUCKET = 256
# Salts whose offsets one window adds up; the blocks of a length are a row for each million pieces.
SALT_BLOCK = 4_096


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = plain_encoder(path, self.tokenizer)

    def encode_whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.encode_whole(text)
        return array("I", self.plain(text)).tobytes()


def plain_encoder(path: str, tokenizer):
    """Ids of a text without special tokens: by the rank file of the same vocabulary where one
    lies beside the tokenizer's file (five times faster), else by the tokenizer itself."""
    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                             special_tokens={})._core_bpe.encode_ordinary


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, text_key, piece, start, length, ids_crc32): the ids themselves stay in the task."""
    import public_tokenizers

    path = tokenizer or public_tokenizers.path(VOCABULARY)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(cols: dict) -> dict:
        encode = encoder(path)
        out: dict[str, list] = {c: [] for c in ("doc_id", "text_key", "piece", "start", "length", "ids_crc32")}
        for doc_id, key, text in zip(cols["doc_id"], cols["text_key"], cols["text"]):
            ids = encode(text or "") + end
            for i, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                for c, v in zip(out, (doc_id, key, i, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]))):
                    out[c].append(v)
        return out

    return map_batches(documents(docs).withColumn("text_key", text_key(F.col("text"))), run,
                       "doc_id bigint, text_key string, piece int, start bigint, length bigint, ids_crc32 bigint", rows=200)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, number, first sequence, offset) that pack ``counts`` pieces
    of each length; sequences are numbered from 0 without gaps."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for n, c in counts.items():
        left[n] = c
    used = np.zeros(capacity + 1, dtype=np.int64)
    runs, sequence = [], 0

    def place(lengths: tuple[int, ...], times: int) -> None:
        nonlocal sequence
        at = 0
        for n in lengths:
            runs.append((n, int(used[n]), times, sequence, at))
            used[n] += times
            at += n
        sequence += times

    for longest in range(capacity, 0, -1):
        # at most `most` of this length share a sequence, so this many sequences need one each
        most = capacity // longest
        while left[longest]:
            times = -(-int(left[longest]) // most)
            left[longest] -= times
            _fill((longest,), times, left, capacity, place)
    return runs


def _fill(opened: tuple[int, ...], times: int, left: np.ndarray, capacity: int, place) -> None:
    """Place ``times`` sequences that begin with the lengths ``opened``."""
    todo = [(opened, times)]
    while todo:
        lengths, times = todo.pop()
        gap = capacity - sum(lengths)
        while times:
            fill = exact(left, gap) if gap else ()
            if fill is None:
                fits = np.flatnonzero(left[1:gap + 1])
                fill = (int(fits[-1]) + 1,) if len(fits) else ()
                partial = bool(fill)
            else:
                partial = False
            need = {n: fill.count(n) for n in fill}
            now = min([times, *(int(left[n]) // k for n, k in need.items())])
            for n, k in need.items():
                left[n] -= now * k
            times -= now
            if partial:
                todo.append((lengths + fill, now))
            else:
                place(lengths + fill, now)


def exact(left: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that sum to ``gap``, with the longest first length
    possible; None if there is none.

    ``left`` is the hash of the lengths: a sum of two is found by looking each length's
    complement up, a sum of three by doing so for each longest length.
    """
    if left[gap]:
        return (gap,)
    if (two := _pair(left, gap)) is not None:
        return two
    for a in np.flatnonzero(left[:gap])[::-1]:
        a = int(a)
        if 3 * a < gap:
            break
        left[a] -= 1
        two = _pair(left, gap - a, a)
        left[a] += 1
        if two is not None:
            return (a, *two)
    return None


def _pair(left: np.ndarray, total: int, most: int | None = None) -> tuple[int, int] | None:
    """Two available lengths a >= b with a + b = total and a <= most, a as long as possible."""
    low, high = (total + 1) // 2, min(total - 1, most or total)
    if high < low or low < 1:
        return None
    a = np.arange(low, high + 1)
    ok = (left[low:high + 1] > 0) & (left[total - a] > 0)
    if total % 2 == 0 and left[total // 2] < 2:
        ok[0] = False
    found = np.flatnonzero(ok)
    return None if not len(found) else (int(a[found[-1]]), int(total - a[found[-1]]))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece."""
    cutted = stored(pieces(docs, tokenizer, capacity), "packing-pieces")
    # at most `capacity` rows, whatever the number of documents
    counts = {r["length"]: r["n"] for r in cutted.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan(counts, capacity)
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)

    # as many salts for a length as it has buckets of pieces; equal rows share one
    salts = [(n, max(1, -(-c // RANK_BUCKET))) for n, c in counts.items()]
    salts = F.broadcast(cutted.sparkSession.createDataFrame(salts, "length bigint, salts bigint"))
    salted = cutted.join(salts, "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_key", "piece"), "salts"))
    # where the ranks of a salt begin, in two levels: the salts of a block, and the blocks of a length
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("salt") / SALT_BLOCK))
    blocks = sizes.groupBy("length", "block").agg(F.sum("n").alias("all"))
    blocks = blocks.select("length", "block", (F.sum("all").over(Window.partitionBy("length").orderBy("block")) - F.col("all")).alias("before"))
    within = F.sum("n").over(Window.partitionBy("length", "block").orderBy("salt")) - F.col("n")
    base = sizes.withColumn("within", within).join(blocks, ["length", "block"]).select(
        "length", "salt", (F.col("before") + F.col("within")).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "text_key", "piece")
    ranked = salted.withColumn("rank", F.row_number().over(order) - 1).join(base, ["length", "salt"]) \
        .withColumn("rank", F.col("rank") + F.col("base"))

    shift = np.int64(1 << 44)
    firsts = table[:, 0] * shift + table[:, 1]

    names = ("doc_id", "piece", "start", "length", "ids_crc32")

    def look_up(cols: dict) -> dict:
        length, rank = (np.array(cols[c], dtype=np.int64) for c in ("length", "rank"))
        run = table[np.searchsorted(firsts, length * shift + rank, side="right") - 1] if len(table) else table
        return {c: cols[c] for c in names} | {"sequence_id": run[:, 3] + rank - run[:, 1], "offset": run[:, 4]}

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    assert [f.name for f in StructType.fromDDL(schema)][:5] == list(names)
    return map_batches(ranked.select(*names, "rank"), look_up, schema)

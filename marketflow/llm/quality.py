"""Quality classifier: random Fourier features, ridge normal equations, isotonic calibration.

Each text gives a row of statistics.  Random cosines of the standardised statistics
approximate a Gaussian kernel between documents; a ridge regression on them needs only the
sums Z'Z and Z'y, which every partition adds up over its labelled rows and a tree of tasks
adds together, so the driver solves one system of fixed size.  The regression's values are
calibrated by isotonic regression (pool adjacent violators) over all labelled rows, counted in
``CALIBRATION_BINS`` bins; scores between two blocks are interpolated.

Defined results: a null text is the empty text, which has statistics and a score like any
other; without a labelled row every score is 0.5; a null id counts as the empty text in the
split and has no label; several labels of an id count as their mean; repeated rows are
learned and scored each; empty documents give an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, map_batches, stored

FEATURES = 512
RIDGE = 1e-3
WIDTH = 1.5
# Standardised statistics beyond this many deviations count as this many.
REACH = 5.0
SEED = 11
CALIBRATION_BINS = 2_000
THRESHOLD = 0.3

STATISTICS = ("chars", "words", "word_chars", "letters", "digits", "symbols", "upper", "distinct_words",
              "top_word", "symbol_words", "distinct_lines", "line_words", "stops", "letter_entropy",
              "compressed", "distinct_pairs", "long_words", "bars", "doubled")


def statistics(text: str | None) -> list[float]:
    """The statistics of a text, in the order of ``STATISTICS``."""
    text = text or ""
    n = len(text)
    chars = Counter(text)
    letters = sum(c for ch, c in chars.items() if ch.isalpha())
    digits = sum(c for ch, c in chars.items() if ch.isdigit())
    blank = sum(c for ch, c in chars.items() if ch.isspace())
    common = sum(chars[ch] for ch in ".,;:!?'\"-")
    upper = sum(c for ch, c in chars.items() if ch.isupper())
    words = text.split()
    counts = Counter(words)
    k = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    entropy = -sum(c / n * math.log2(c / n) for c in chars.values()) if n else 0.0
    pairs = len(set(zip(words, words[1:])))
    share = lambda a, b: a / b if b else 0.0
    return [
        math.log1p(n), math.log1p(k), min(share(n - blank, k), 40.0), share(letters, n), share(digits, n),
        share(n - letters - digits - blank - common, n), share(upper, n), share(len(counts), k) * math.log1p(k),
        share(max(counts.values(), default=0), k), share(sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,"), k),
        share(len(set(lines)), len(lines)), math.log1p(share(k, len(lines))), share(sum(w[-1] in ".!?" for w in words), k),
        entropy, share(len(zlib.compress(text.encode("utf-8", "surrogatepass"), 1)), n),
        share(pairs, k - 1) if k > 1 else 1.0, share(sum(c for w, c in counts.items() if len(w) > 12), k), share(chars["|"], k),
        share(sum(a == b for a, b in zip(words, words[1:])), k)]


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>): one row per input row, written once."""
    return stored(map_batches(documents(docs), lambda cols: {
        "doc_id": cols["doc_id"], "x": [statistics(t) for t in cols["text"]]}, "doc_id bigint, x array<double>"), "quality-statistics")


class Model:
    """Random features, ridge weights and the calibration's steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        # a kernel wider than the usual distance of two standardised documents
        self.omega = rng.normal(size=(len(mean), features)) / (WIDTH * math.sqrt(len(mean)))
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.at, self.value = np.array([0.0]), np.array([0.5])

    def transform(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -REACH, REACH)
        z = np.cos(z @ self.omega + self.phase) * math.sqrt(2 / len(self.phase))
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.transform(x) @ self.weights, -0.5, 1.5)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.value), 0, 1)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def normal_sums(train: DataFrame, model: Model) -> np.ndarray:
    """Z'Z, Z'y and y'y in one matrix: each partition's sum, then a tree of sums."""
    size = len(model.weights) + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                zy = np.hstack([model.transform(_matrix(batch.column("x"))), batch.column("y").to_numpy()[:, None]])
                total += zy.T @ zy
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], names=["total"])

    sums = train.select("x", "y").mapInArrow(add, "total binary").rdd.map(lambda r: np.frombuffer(r["total"]))
    # so many levels that the driver adds up 16 matrices or fewer of many partitions
    depth = max(2, math.ceil(math.log(max(2, sums.getNumPartitions()), 16)))
    return sums.treeReduce(np.add, depth).reshape(size, size)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the blocks' centres and non-decreasing means."""
    blocks: list[list[float]] = []
    for x, y, w in zip(at, mean, weight):
        blocks.append([x * w, y * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    table = np.array(blocks)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


def fit(stats: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality",
        features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """Fit on the rows of ``stats`` where ``train`` holds and the id has a label."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.avg(F.col(label_col).cast("double")).alias("y"))
    rows = stored(stats.filter(train).select("doc_id", "x").join(known, "doc_id").select("x", "y"), "quality-train")
    d = len(STATISTICS)
    moments = rows.agg(F.count("*").alias("n"), *[f(F.col("x")[i]).alias(f"{f.__name__}{i}") for f in (F.avg, F.stddev_pop) for i in range(d)]).first()
    if not moments["n"]:
        return Model(np.zeros(d), np.ones(d), features)
    model = Model(np.array(moments[1:1 + d]), np.maximum(np.array(moments[1 + d:]), 1e-9), features)
    sums = normal_sums(rows, model)
    n = len(model.weights)
    penalty = ridge * moments["n"] / features * np.eye(n)
    penalty[-1, -1] = 0  # the constant is free
    model.weights = np.linalg.solve(sums[:n, :n] + penalty, sums[:n, n])
    raws = raw_values(rows, model)
    bins = raws.groupBy(F.floor(F.col("raw") * (CALIBRATION_BINS / 2)).alias("bin")).agg(
        F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()  # at most CALIBRATION_BINS + 1 rows
    model.at, model.value = isotonic(*(np.array([r[c] for r in bins], dtype=float) for c in ("raw", "y", "n")))
    return model


def raw_values(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(model.raw(_matrix(batch.column("x")))), batch.column("y")], names=["raw", "y"])

    return rows.select("x", "y").mapInArrow(run, "raw double, y double")


def score(stats: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """(*keep, score, predicted): one row per row of ``stats``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields if f.name in keep)
    rows = stats.select(*[f.name for f in stats.schema.fields if f.name in keep], "x")

    def run(cols: dict) -> dict:
        x = np.array(cols.pop("x"), dtype=float).reshape(-1, len(STATISTICS))
        s = model.score(x)
        return cols | {"score": s, "predicted": (s >= threshold).astype(np.int32)}

    return map_batches(rows, run, f"{ddl}, score double, predicted int")

"""Language ID: hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from a seed and its code point, so all
workers agree).  An n-gram vector binds the letters' vectors, each rotated by its distance
from the end; a document vector bundles (sums) the vectors of all its n-grams.  A language
prototype bundles the unit vectors of its training documents, and a document goes to the
prototype of the largest cosine.

A document's bundle is its n-gram counts times the n-gram vectors, so a batch of documents is
one matrix product over the batch's distinct n-grams; nothing depends on a text's length but
its counts.

Defined results: a null text, and one without a letter, gives ``und`` with score 0; so does
every text if nothing was learned; ties go to the first label in order; a null id counts as
the empty text in the split; repeated rows are learned and predicted each; an empty table
gives an empty table; columns other than those named are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches

DIM = 512
NGRAM = 3
SEED = 2024
UNKNOWN = "und"
_ROWS = 48
_GRAMS = 4096


@lru_cache(maxsize=20_000)
def letter_vector(code: int, dim: int = DIM, turned: int = 0) -> np.ndarray:
    signs = np.random.default_rng([SEED, code]).integers(0, 2, dim, dtype=np.int8) * np.int8(2) - np.int8(1)
    return np.roll(signs, turned)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True at the code points that are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram, count) triples over ``texts`` and the n-grams' code points, one row
    each.  Letters are lower-cased; a run of anything else is one blank, also at the ends."""
    codes, owner = [], []
    for i, text in enumerate(texts):
        points = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        points = np.where(_letters()[points], points, 32).astype(np.int64)
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
        points = points[keep]
        if len(points) > 2:  # a letter between two blanks at least
            codes.append(points)
            owner.append(i)
    if not codes:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, np.zeros((0, NGRAM), dtype=np.int64)
    present = np.zeros(0x110000, dtype=bool)
    for points in codes:
        present[points] = True
    alphabet = np.flatnonzero(present)
    place = np.zeros(alphabet[-1] + 1, dtype=np.int64)
    place[alphabet] = np.arange(len(alphabet))
    size, keys = len(alphabet), []
    for points, i in zip(codes, owner):
        own = place[points]
        key = np.full(len(own) - NGRAM + 1, i, dtype=np.int64)
        for k in range(NGRAM):
            key = key * size + own[k:len(own) - NGRAM + 1 + k]
        keys.append(key)
    # sorted by document anyway, so each document is counted on its own
    key, count = map(np.concatenate, zip(*(np.unique(k, return_counts=True) for k in keys)))
    gram, index = np.unique(key % size**NGRAM, return_inverse=True)
    parts = np.stack([alphabet[gram // size**(NGRAM - 1 - k) % size] for k in range(NGRAM)], axis=1)
    return key // size**NGRAM, index, count, parts


def bundles(texts: list[str | None], dim: int = DIM) -> np.ndarray:
    """One row per text: the sum of its n-grams' vectors (zero without letters)."""
    doc, gram, count, parts = grams(texts)
    out = np.zeros((len(texts), dim), dtype=np.float32)
    points, index = np.unique(parts, return_inverse=True)
    index = index.reshape(parts.shape)
    rotated = [np.stack([letter_vector(int(p), dim, NGRAM - 1 - k) for p in points]) for k in range(NGRAM)] if len(points) else []
    for first in range(0, len(parts), _GRAMS):  # the n-gram vectors of a block at a time
        block = index[first:first + _GRAMS]
        vectors = rotated[0][block[:, 0]]
        for k in range(1, NGRAM):
            vectors = vectors * rotated[k][block[:, k]]
        here = (gram >= first) & (gram < first + _GRAMS)
        counts = np.zeros((len(texts), len(block)), dtype=np.float32)
        counts[doc[here], gram[here] - first] = count[here]
        out += counts @ vectors.astype(np.float32)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def prototypes(docs: DataFrame, train: Column, text_col: str = "text", label_col: str = "lang",
               dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """(labels, one unit row each): bundles of the rows where ``train`` holds and the label
    and the text are there, in order of the labels.  Each batch sends one partial sum per label;
    one row of ``dim`` numbers per language reaches the driver and every task."""
    rows = docs.filter(train & F.col(label_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"))

    def partial(cols: dict) -> dict:
        unit, labels = _unit(bundles(cols["text"], dim)), np.array(cols["label"])
        names = sorted(set(cols["label"]))
        return {"label": names, "total": [unit[labels == n].sum(axis=0).astype(np.float64).tolist() for n in names]}

    sums = map_batches(rows, partial, "label string, total array<double>", rows=_ROWS)
    exploded = sums.select("label", F.posexplode("total").alias("place", "value"))
    summed = exploded.groupBy("label", "place").agg(F.sum("value").alias("value")) \
        .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("total"))
    got = summed.select("label", F.transform("total", lambda x: x["value"]).alias("total")).collect()
    got = sorted((r["label"], r["total"]) for r in got)
    return [g[0] for g in got], _unit(np.array([g[1] for g in got], dtype=np.float32).reshape(len(got), dim))


def predict(docs: DataFrame, labels: list[str], profile: np.ndarray, text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """(*keep, lang_pred, score): the nearest prototype of each row and its cosine, 0 if that
    is negative."""
    schema = [f for f in docs.schema.fields if f.name in keep]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    apart = text_col not in keep
    rows = docs.select(*[F.col(f"`{f.name}`") for f in schema],
                       *([F.col(text_col).cast("string").alias("_text")] if apart else []))
    dim = profile.shape[1]

    def run(cols: dict) -> dict:
        texts = cols.pop("_text") if apart else cols[text_col]
        if not labels:
            return cols | {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)}
        unit = _unit(bundles(texts, dim))
        cosine = unit @ profile.T
        best = cosine.argmax(axis=1)
        known = unit.any(axis=1)
        return cols | {"lang_pred": [labels[b] if k else UNKNOWN for b, k in zip(best, known)],
                       "score": np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0).astype(np.float64)}

    return map_batches(rows, run, f"{ddl}{', ' * bool(ddl)}lang_pred string, score double", rows=_ROWS)


def keep_known(docs: DataFrame, labels: list[str], profile: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is unknown: those without a letter."""
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])  # no name clashes with the prediction's
    found = predict(numbered, labels, profile, f"c{names.index(text_col)}", keep=tuple(numbered.columns))
    return found.filter(F.col("lang_pred") != UNKNOWN).select(*numbered.columns).toDF(*names)

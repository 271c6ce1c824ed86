"""Quality rules: line-first cleaning.

Every line (between ``\\n``) that has a word is held against the line rules, in this order; the
first that it breaks names the reason, and the line goes:

* ``punctuation``: more than one character of ``[#*$%&|<>]`` for every five words, more than one
  run of two or more ``!`` or ``?`` for every ten words, or no word that ends a sentence;
* ``navigation``: two separators or more (``| » › • ·``) with five words or fewer to an entry,
  tried before the symbols, as ``|`` is one;
* ``boilerplate``: one of the phrases of ``PHRASES``, in either ASCII case.

A document is rejected if the lines that go hold more than ``LOST_TENTHS`` tenths of the code
points in its words, or if it fails one of the base rules (too few words, too many words in
repeated five-word windows).

Defined results: null, empty and wordless texts have no words, lose nothing and are rejected as
too short; lines without a word stay as they are; the cleaned text is what is left of the
lines, joined by ``\\n``, and a document that loses no line keeps its text to the byte; equal
rows get equal results, one each; null ids are ids; an empty table gives an empty table; other
columns, whatever their names, are carried by ``clean`` and ignored by ``evaluate``.  A text is
read whole in one task, in time that grows with its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from .common import documents, map_batches

SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
MARKS = re.compile(r"[!?]{2,}")
SENTENCE_END = re.compile(r"""[.!?…][)\]"'”’»]*(?:[\x20\x09-\x0D]|$)""")
PHRASES = ("all rights reserved", "licensed under", "released under the", "privacy policy", "terms of use",
           "terms of service", "cookie policy", "uses cookies", "use cookies", "enable javascript", "click here",
           "read more", "subscribe to our", "sign up for", "log in to", "lorem ipsum", "powered by", "copyright ©",
           "copyright (c)", "follow us on", "share this")
MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20
LOST_TENTHS = 5
RULES = ("punctuation", "navigation", "boilerplate")

RESULT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, lost_chars bigint, n_punctuation bigint, n_navigation bigint, "
          "n_boilerplate bigint, removed array<struct<start:bigint,end:bigint,rule:string>>")


def repeated_words(words: list, window: int = REPEAT_WINDOW) -> int:
    """Words that stand in a window of so many words found twice or more, the first included."""
    windows = list(zip(*(words[i:] for i in range(window))))
    if len(set(windows)) == len(windows):
        return 0
    often, n, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            n += i + window - max(end, i)
            end = i + window
    return n


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def broken_rule(line: str, n_words: int, symbols: bool, marks: bool, phrases: bool) -> str | None:
    """The rule that a line of so many words breaks; the flags say what its text holds at all."""
    if symbols or "»" in line or "›" in line or "•" in line or "·" in line:
        separators = sum(line.count(c) for c in SEPARATORS)
        if separators >= 2 and n_words <= 5 * (separators + 1):
            return "navigation"
    if symbols and 5 * sum(line.count(c) for c in SYMBOLS) > n_words:
        return "punctuation"
    if marks and 10 * len(MARKS.findall(line)) > n_words or not SENTENCE_END.search(line):
        return "punctuation"
    if phrases and any(p in ascii_lower(line) for p in PHRASES):
        return "boilerplate"
    return None


def rate(text: str | None) -> dict:
    """The columns of ``RESULT`` for one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # by ASCII white space only
    word_chars = len(text) - sum(text.count(c) for c in SPACE)
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    marks, lowered = bool(MARKS.search(text)), ascii_lower(text)
    phrases = any(p in lowered for p in PHRASES)
    seen, n_dup, removed, lost, at = set(), 0, [], 0, 0
    for line in text.split("\n"):
        n_words = len(line.encode("utf-8", "surrogatepass").split())
        if n_words:
            n_dup += line in seen
            seen.add(line)
            if rule := broken_rule(line, n_words, bool(n_symbols), marks, phrases):
                removed.append({"start": at, "end": at + len(line), "rule": rule})
                lost += len(line) - sum(line.count(c) for c in SPACE)
        at += len(line) + 1
    n_repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * n_repeat > REPEAT_PERCENT * len(words)
    why = Counter(r["rule"] for r in removed)
    return {"n_words": len(words), "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
            "n_repeat_words": n_repeat, "base_failed": failed, "kept": not failed and 10 * lost <= LOST_TENTHS * word_chars,
            "lost_chars": lost, **{f"n_{r}": why[r] for r in RULES}, "removed": removed}


def evaluate(docs: DataFrame) -> DataFrame:
    """(doc_id, columns of ``RESULT``): one row per input row; ``removed`` has the lines that
    go, in code points of the original text, end exclusive."""

    def run(cols: dict) -> dict:
        rated = [rate(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], **{c: [r[c] for r in rated] for c in (f.split()[0] for f in RESULT.split(", "))}}

    return map_batches(documents(docs), run, f"doc_id bigint, {RESULT}", rows=200)


def without(text: str, removed: list[dict]) -> str:
    """``text`` without the removed lines, each with its ``\\n``."""
    if not removed:
        return text
    gone = {r["start"] for r in removed}
    out, at = [], 0
    for line in text.split("\n"):
        if at not in gone:
            out.append(line)
        at += len(line) + 1
    return "\n".join(out)


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` (columns doc_id and text, others kept) without the rejected documents and
    without the failed lines of the others.  Rows pass through Arrow as one struct."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("`text`").cast("string").alias("text"))
    schema = StructType([rows.schema["row"], StructField("text", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, texts = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = rate(text)
                if found["kept"]:
                    at.append(i)
                    texts.append(without(text, found["removed"]))
            kept = batch.column("row").take(pa.array(at, pa.int64())).cast(arrow.field("row").type)
            yield pa.RecordBatch.from_arrays([kept, pa.array(texts, pa.string())], schema=arrow)

    found = rows.mapInArrow(run, schema)
    return found.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])

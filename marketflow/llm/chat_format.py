"""Chat formatting: schema fingerprinting.

Chat data comes as JSON records of many layouts.  A record's *schema fingerprint* is the hash
of its sorted nested field paths (``messages[].role`` and so on), of which those that some layout
uses select a declarative mapping that says where roles and texts lie; other fields of a record
do not matter.  A content may be a text or a list of parts with texts.  The record becomes
canonical turns.  A template marks the turns in one string; control strings inside texts are
escaped, so the turns can be read back exactly, and a loss mask gives the spans of the
assistant's texts.

Rows by turn become records of at most ``PART_TURNS`` turns each: a conversation is a sequence of
parts, one for most, and goes the same way whatever its length.  A task holds one part.

Defined results: a null text is the empty text and a null role the empty role; a record that
is null, not JSON or of an unknown layout gives a row without layout, turns or output, never an
error; a conversation without turns formats to the start mark alone; repeated records are
formatted each; an empty table gives an empty table.  In ``as_records`` turns of equal number
are ordered by role and text, rows of null conv_id are one conversation, and columns other than
those named are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, map_batches

# Turns that one record holds.
PART_TURNS = 64


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns: ``fixed`` pairs of a role and the fields whose texts make its
    turn (joined by a blank line, empty ones left out), or a list of entries with a role and a
    text field; ``roles`` renames roles."""

    name: str
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)
    optional: tuple[str, ...] = ()

    def paths(self) -> list[frozenset[str]]:
        """Field paths of every variant of the layout: with and without optional fields, with
        texts, lists of parts, or both."""
        if self.each:
            role, text, part = (f"{self.each}[].{x}" for x in (self.role, self.text, f"{self.text}[].text"))
            return [frozenset(v) for v in ([role, text], [role, part], [role, text, part], [f"{self.each}[]"])]
        variants = [[]]
        for name in (f for _, fields in self.fixed for f in fields):
            variants = [v + [name] for v in variants] + ([v for v in variants] if name in self.optional else [])
        return [frozenset(v) for v in variants]

    def turns(self, record: dict) -> list[tuple[str, str]]:
        if self.each:
            pairs = [(m.get(self.role), joined(m.get(self.text))) for m in record[self.each]]
        else:
            pairs = [(role, "\n\n".join(t for f in fields if (t := record.get(f) or "")) if len(fields) > 1 else record[fields[0]])
                     for role, fields in self.fixed if any(f in record for f in fields)]
        return [(self.roles.get(role or "", role or ""), text or "") for role, text in pairs]


def joined(content):
    """The text of a content that may be a list of parts."""
    if isinstance(content, list):
        return "".join(p["text"] for p in content if isinstance(p, dict) and isinstance(p.get("text"), str))
    return content


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant"}
MAPPINGS = (
    Mapping("messages", each="messages", role="role", text="content"),
    Mapping("share", each="conversations", role="from", text="value", roles=SPEAKERS),
    Mapping("dialog", each="dialog", role="speaker", text="text", roles=SPEAKERS),
    Mapping("prompt", fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Mapping("completion", fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("question", fixed=(("user", ("question",)), ("assistant", ("answer",)))),
    # a task and what it is to be done on are one turn of the user
    Mapping("instruction", fixed=(("user", ("instruction", "input")), ("assistant", ("output",))), optional=("input",)),
)


def field_paths(value, prefix: str = "") -> set[str]:
    """Nested paths of the leaves: ``a.b`` for objects, ``a[]`` for lists."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{prefix}[]") for v in value)) if value else {f"{prefix}[]"}
    return {prefix}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


REGISTRY = {fingerprint(p): m for m in MAPPINGS for p in m.paths()}
USED = frozenset().union(*(p for m in MAPPINGS for p in m.paths()))


def mapping_of(paths: set[str]) -> Mapping | None:
    """The layout of a record with these field paths, by the fingerprint of those that layouts use;
    a record with the fields of two layouts has the first one that it holds whole."""
    found = REGISTRY.get(fingerprint(paths & USED))
    return found or next((m for m in MAPPINGS if any(p <= paths for p in m.paths())), None)


def canonical(record: str | None) -> tuple[str | None, str | None, list[tuple[str, str]] | None]:
    """(fingerprint, layout, turns) of a JSON record; no layout and turns if it has none known."""
    try:
        value = json.loads(record or "")
    except ValueError:
        return None, None, None
    paths = field_paths(value)
    key, mapping = fingerprint(paths), mapping_of(paths)
    if mapping is None or not isinstance(value, dict):
        return key, None, None
    try:
        turns = mapping.turns(value)
    except (AttributeError, TypeError):  # entries that are no objects beside some that are
        return key, None, None
    if not all(isinstance(x, str) for turn in turns for x in turn):
        return key, None, None
    return key, mapping.name, turns


START, END = "<s>", "</s>"
USER, USER_END = "[INST] ", " [/INST]"
SYSTEM, SYSTEM_END = "<<SYS>>\n", "\n<</SYS>>\n"
ROLE, NAME_END, ROLE_END = "<<ROLE>>", "<</NAME>>", "<</ROLE>>"
CONTROLS = ("<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</NAME>>", "<</ROLE>>", "[INST]", "[/INST]", "<s>", "</s>")
_CONTROL = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_ESCAPED = re.compile(r"\\(\\?)")
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]| (?P<assistant>.*?)</s>|<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n"
    r"|<<ROLE>>(?P<name>.*?)<</NAME>>(?P<text>.*?)<</ROLE>>", re.DOTALL)


def escape(text: str) -> str:
    """A backslash is doubled; a control string gets one after its first character."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string and the loss mask: (start, end) of each assistant text in it."""
    out, at, mask = [START], len(START), []
    for role, text in turns:
        text = escape(text)
        if role == "user":
            piece = USER + text + USER_END
        elif role == "system":
            piece = SYSTEM + text + SYSTEM_END
        elif role == "assistant":
            piece = " " + text + END
            mask.append((at + 1, at + 1 + len(text)))
        else:
            piece = ROLE + escape(role) + NAME_END + text + ROLE_END
        out.append(piece)
        at += len(piece)
    return "".join(out), mask


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    turns, at = [], len(START)
    if not formatted.startswith(START):
        raise ValueError("no start mark")
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        if m["name"] is not None:
            turns.append((unescape(m["name"]), unescape(m["text"])))
        else:
            turns.append((m.lastgroup, unescape(m[m.lastgroup])))
        at = m.end()
    return turns


def format_records(records: DataFrame, id_col: str = "conv_id", record_col: str = "record") -> DataFrame:
    """(conv_id, fingerprint, layout, turns, formatted, loss_mask): one row per record, in the
    records' order."""
    rows = records.select(F.col(id_col).cast("bigint").alias("conv_id"), F.col(record_col).cast("string").alias("record"))

    def run(cols: dict) -> dict:
        found = [canonical(r) for r in cols["record"]]
        made = [render(t) if t is not None else (None, None) for _, _, t in found]
        return {"conv_id": cols["conv_id"], "fingerprint": [f[0] for f in found], "layout": [f[1] for f in found],
                "turns": [None if t is None else [{"role": r, "text": x} for r, x in t] for _, _, t in found],
                "formatted": [m[0] for m in made],
                "loss_mask": [None if m[1] is None else [{"start": a, "end": b} for a, b in m[1]] for m in made]}

    return map_batches(rows, run, "conv_id bigint, fingerprint string, layout string, turns array<struct<role:string,text:string>>, "
                                  "formatted string, loss_mask array<struct<start:bigint,end:bigint>>")


def as_record(turns: list[tuple[str, str]]) -> str:
    """A part as a JSON record of the layout that its roles suggest."""
    roles, texts = [r for r, _ in turns], [t for _, t in turns]
    if roles == ["user", "assistant"]:
        record = dict(zip(("prompt", "response"), texts))
    elif roles == ["system", "user", "assistant"]:
        record = dict(zip(("system", "prompt", "response"), texts))
    elif roles[0] == "user" and {*roles} <= {"user", "assistant", "system"}:
        names = {"user": "human", "assistant": "gpt"}
        record = {"conversations": [{"from": names.get(r, r), "value": t} for r, t in turns]}
    else:
        record = {"messages": [{"role": r, "content": t} for r, t in turns]}
    return json.dumps(record, ensure_ascii=False)


def as_records(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, record): each conversation's rows (conv_id, turn, role, text) as JSON records
    of up to ``PART_TURNS`` turns.  A conversation's parts follow each other in one partition."""
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id bigint, part bigint, record string"
    out = arrow_schema(conversations.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, turns = None, 0, []
        for batch in batches:
            found = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if turns and (conv_id != now or len(turns) == PART_TURNS):
                    found.append((now, part, as_record(turns)))
                    part, turns = (part + 1 if conv_id == now else 0), []
                now = conv_id
                turns.append((role, text))
            yield made(found, out)
        if turns:
            yield made([(now, part, as_record(turns))], out)

    return dealt.select("conv_id", "role", "text").mapInArrow(run, schema)


def made(found: list[tuple], out: pa.Schema) -> pa.RecordBatch:
    columns = zip(*found) if found else ([] for _ in out)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, out)], schema=out)


DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint, layout string")


class _Running:
    """The digests of one conversation whose formatted parts come one by one."""

    def __init__(self, conv_id: int | None, layout: str | None):
        self.conv_id, self.layout, self.n = conv_id, layout, 0
        self.said, self.loss, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, len(START)

    def add(self, formatted: str, mask: list[dict]) -> None:
        for role, text in read_back(formatted):
            self.said.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.n += 1
        for m in mask:
            kept = unescape(formatted[m["start"]:m["end"]])
            self.loss.update(kept.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(kept)
        # the parts' strings are one string, whose start mark is that of the first
        self.chars += len(formatted) - len(START)

    def row(self) -> tuple:
        return (self.conv_id, self.n, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.layout)


def digests(formatted: DataFrame) -> DataFrame:
    """The contract columns of the registered query, read back from the formatted strings of
    neighbouring rows of a conversation; a record without output has a row without digests."""
    out = arrow_schema(formatted.sparkSession, DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            found = []
            for conv_id, layout, text, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "layout", "formatted", "loss_mask"))):
                if text is None:
                    found.append((conv_id, *[None] * (len(out) - 1)))
                    continue
                if now is None or conv_id != now.conv_id:
                    found += [now.row()] if now else []
                    now = _Running(conv_id, layout)
                now.add(text, mask)
            yield made(found, out)
        if now is not None:
            yield made([now.row()], out)

    return formatted.select("conv_id", "layout", "formatted", "loss_mask").mapInArrow(run, DIGESTS)


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """The contract columns for each conversation of (conv_id, turn, role, text)."""
    return digests(format_records(as_records(conversations)))

"""Secret scans: multipart credential linking.

A text holds *parts* of credentials.  Base parts (``assign``, ``access``, ``hex``) are
findings on their own.  Weak parts are ordinary words by themselves and are findings only
beside a complementary part:

* ``login``    an assigned user, account or client id   (identifier)
* ``short``    an assigned password-like value of under 8 characters, or a value of a
               weaker key such as ``pwd`` or ``auth``   (secret)
* ``endpoint`` a URL, or an assigned host or endpoint   (endpoint)

Parts carry a role (identifier, secret, endpoint) and a scope: the run of text between two
blank lines.  An interval join links every secret with the identifiers and endpoints of its
scope at most ``window`` code points away: each part is widened by the window, indexed by
the fixed-width cells that it covers, equality-joined on (row, scope, cell) and the true gap
is verified.  A weak part is reported if it has a link, that is, if it is a secret beside an
identifier or endpoint, or one of those beside a secret.

Defined results: a null or empty text has no parts and still gives its row; a null id gives
a row with a null id; repeated rows each give a row; an empty table gives an empty table;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, map_batches, packed, stored, unpacked, with_text_key

BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("login", "short", "endpoint")
KINDS = BASE_KINDS + WEAK_KINDS
ROLE = {"assign": "secret", "hex": "secret", "short": "secret",
        "access": "identifier", "login": "identifier", "endpoint": "endpoint"}

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
_KEY = re.compile(r"password|passwd|secret|token|api_?key", re.ASCII | re.IGNORECASE)
# A run of 12 or 32 characters is what the unbounded pattern finds and the length test
# keeps: the runs of one class are maximal, so no shorter match hides a longer one.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_LOGIN = re.compile(
    r"""\b(?:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]+""",
    re.ASCII | re.IGNORECASE)
_SHORT = re.compile(
    r"""\b(?:pwd|pass|auth|private_?key|credential)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    re.ASCII | re.IGNORECASE)
_HOST = re.compile(
    r"""\b(?:host|endpoint|server|base_?url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:/-]+""",
    re.ASCII | re.IGNORECASE)
# A scheme is looked for from the start of a run of its characters only: each run is read once.
_URL = re.compile(r"""(?<![A-Za-z0-9+])[A-Za-z0-9+]+://[^\s"'<>]""", re.ASCII)
_SCHEME = re.compile(r"\b[A-Za-z]", re.ASCII)
_URL_REST = re.compile(r"""[^\s"'<>]+""", re.ASCII)
_BLANK_LINE = re.compile(r"\n[ \t\r]*\n")

MIN_ASSIGN = 8


def find_parts(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every base and weak part, in code points."""
    parts = []
    # every assignment holds ':' or '='; the cheap test spares most texts the slow pattern
    assigned = ":" in text or "=" in text
    if assigned and _KEY.search(text):
        for m in _ASSIGN.finditer(text):
            parts.append(("assign" if len(m[2]) >= MIN_ASSIGN else "short", m.start(), m.end()))
    parts += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    parts += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if assigned:
        parts += [("login", *m.span()) for m in _LOGIN.finditer(text)]
        parts += [("short", *m.span()) for m in _SHORT.finditer(text)]
        parts += [("endpoint", *span) for span in find_endpoints(text)]
    return parts


def find_endpoints(text: str) -> list[tuple[int, int]]:
    """Addresses (scheme, ``://`` and what follows) and named hosts, leftmost first, none
    overlapping."""
    out, at = [], 0
    host, url = _HOST.search(text), _URL.search(text)
    while host or url:
        start = len(text)
        if url:
            # the scheme begins with the first letter that starts a word in its run
            colon = url.end() - 4
            m = _SCHEME.search(text, max(at, url.start()), colon)
            if m is None:
                url = _URL.search(text, url.end() - 1)
                continue
            start = m.start()
        if host and host.start() < start:
            at = host.end()
            out.append(host.span())
        else:
            at = _URL_REST.match(text, url.end() - 1).end()
            out.append((start, at))
        if host and host.start() < at:
            host = _HOST.search(text, at)
        if url and url.end() - 4 < at:
            url = _URL.search(text, max(at, url.end() - 3))
    return out


def _scopes(text: str, starts: list[int]) -> list[int]:
    from bisect import bisect_right

    cuts = [m.start() for m in _BLANK_LINE.finditer(text)] if starts else []
    return [bisect_right(cuts, s) for s in starts]


def _scan(cols: dict) -> dict:
    found = []
    for text in cols["text"]:
        parts = find_parts(text or "")
        scopes = _scopes(text or "", [p[1] for p in parts])
        found.append([{"kind": k, "role": ROLE[k], "scope": c, "start": s, "end": e}
                      for (k, s, e), c in zip(parts, scopes)])
    return {"doc_id": cols["doc_id"], "text_key": cols["text_key"], "parts": found}


def scan_parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_id, doc_id, text_key, parts): one row per input row, written once to the shared
    folder; ``text_key`` is the text's digest."""
    found = map_batches(
        with_text_key(documents(docs, id_col, text_col)), _scan,
        "doc_id bigint, text_key string, "
        "parts array<struct<kind:string,role:string,scope:bigint,start:bigint,end:bigint>>")
    return stored(found.withColumn("row_id", F.monotonically_increasing_id()), "secret-parts")


def linked_parts(scanned: DataFrame, window: int = 200) -> DataFrame:
    """(row_id, kind, start, end): parts that have a complementary part within ``window``
    code points of the same scope, each once.

    Two semi-joins on (row, scope, cell), secrets against the others and back: no pair is
    ever built.  A cell is ``window`` wide, so a hot key cannot hold more parts than fit in
    a cell, however long the text is.
    """
    parts = scanned.select("row_id", F.explode("parts").alias("p")).select("row_id", "p.*")
    # only rows that hold both a secret and another part can have links
    rows = parts.withColumn("secret", F.col("role") == "secret").groupBy("row_id").agg(
        F.bool_or("secret").alias("a"), F.bool_or(~F.col("secret")).alias("b")).filter("a and b")
    parts = parts.join(rows.select("row_id"), "row_id", "left_semi")

    def cells(df: DataFrame, margin: int) -> DataFrame:
        return df.withColumn("cell", F.explode(F.sequence(
            F.floor((F.col("start") - margin) / window), F.floor((F.col("end") - 1 + margin) / window))))

    def beside(some: DataFrame, others: DataFrame) -> DataFrame:
        a, b = cells(some, 0).alias("a"), cells(others, window).alias("b")
        near = ((F.col("a.row_id") == F.col("b.row_id")) & (F.col("a.scope") == F.col("b.scope"))
                & (F.col("a.cell") == F.col("b.cell"))
                & (F.col("a.start") - F.col("b.end") <= window)
                & (F.col("b.start") - F.col("a.end") <= window))
        return a.join(b, near, "left_semi").select("row_id", "kind", "start", "end").distinct()

    secrets, others = parts.filter("role = 'secret'"), parts.filter("role != 'secret'")
    return beside(secrets, others).unionByName(beside(others, secrets))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 window: int = 200) -> DataFrame:
    """(doc_id, text_key, findings array<struct<kind,start,end,linked>>): one row per input
    row; findings by start, then kind as listed in ``KINDS``."""
    scanned = scan_parts(docs, id_col, text_col)
    linked = linked_parts(scanned, window).groupBy("row_id").agg(
        F.collect_set(F.struct("kind", "start", "end")).alias("linked"))
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])

    def has_link(p):
        return F.coalesce(F.array_contains("linked", F.struct(p["kind"], p["start"], p["end"])), F.lit(False))

    keep = F.filter("parts", lambda p: p["kind"].isin(*BASE_KINDS) | has_link(p))
    findings = F.array_sort(F.array_distinct(F.transform(keep, lambda p: F.struct(
        p["start"].alias("start"), rank[p["kind"]].alias("rank"), p["end"].alias("end"),
        p["kind"].alias("kind"), has_link(p).alias("linked")))))
    return scanned.join(linked, "row_id", "left").select("doc_id", "text_key", F.transform(
        findings, lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"),
                                     f["end"].alias("end"), f["linked"].alias("linked"))).alias("findings"))


def redact(docs: DataFrame, mask: str = "[SECRET]", window: int = 200) -> DataFrame:
    """``docs`` (columns doc_id and text, others kept) with every finding in ``text`` replaced
    by ``mask`` and ``n_chars``, if there, counted anew; overlapping findings become one mask.

    Rows meet their findings by (doc_id, digest of the text), so repeated rows are alike.
    The findings are written first: a small table is broadcast, a large one is not.
    """
    found = find_secrets(docs, window=window).filter(F.size("findings") > 0).dropDuplicates(["doc_id", "text_key"])
    found = stored(found.select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"), "findings"), "secret-findings")
    rows = packed(docs).join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")), "left")

    def cut(begin: Column, length: Column) -> Column:
        return F.substr(F.col("text"), (begin + 1).cast("int"), length.cast("int"))

    masked = F.aggregate(
        "findings", F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, f: F.when(f["start"] >= acc["at"], F.struct(
            F.concat(acc["out"], cut(acc["at"], f["start"] - acc["at"]), F.lit(mask)).alias("out"), f["end"].alias("at")))
        .otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], f["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], cut(acc["at"], F.length("text") - acc["at"])))
    rows = rows.withColumn("masked", F.when(F.col("findings").isNotNull(), masked))
    changed = {"text": F.coalesce("masked", F.col("row.text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.coalesce(F.length("masked").cast(docs.schema["n_chars"].dataType), F.col("row.n_chars"))
    return unpacked(rows, docs, **changed)


def mask_spans(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """``redact`` for one text: overlapping spans become one mask."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


def span_text(findings: list[dict], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{f['kind']}:{f['start']}:{f['end']}" for f in findings if f["kind"] in kinds)


def digests(found: DataFrame) -> DataFrame:
    """The contract columns of the registered query, from ``find_secrets``' rows."""

    def run(cols: dict) -> dict:
        out = {"doc_id": cols["doc_id"]}
        for kind in BASE_KINDS:
            out[f"n_{kind}"] = [sum(f["kind"] == kind for f in fs) for fs in cols["findings"]]
        out["base_sha256"] = [hashlib.sha256(span_text(fs, BASE_KINDS).encode()).hexdigest()
                              for fs in cols["findings"]]
        out["spans"] = [span_text(fs, KINDS) for fs in cols["findings"]]
        out["n_linked"] = [sum(f["linked"] for f in fs) for fs in cols["findings"]]
        return out

    return map_batches(found, run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
                                   "base_sha256 string, spans string, n_linked bigint")

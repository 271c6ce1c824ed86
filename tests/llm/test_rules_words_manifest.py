"""Line rules, spelling variants and the Merkle manifest against SQL on the whole table and
brute force on edge rows."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketflow.llm import line_rules, merkle, queries, spelling
from marketflow.llm.common import crc_mod

from .test_scanning import SF, table

KEYS = ["op11_line_rules", "op12_spelling_variants", "op13_merkle_manifest"]
LONG = "many different words stand here. " + " ".join(f"word{i}." for i in range(60_000))


@pytest.mark.parametrize("key", KEYS)
def test_whole_table_equals_sql(spark, key):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    df = queries.QUERIES[key](spark, SF)
    res = con.execute(queries.ORACLE_SQL[key])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, res.fetchall()))


# line rules

PROSE = "This line says something whole. "
RULE_DOCS = [
    (1, None), (2, ""), (3, " \n\t\n"), (4, "one two"), (5, LONG), (5, LONG), (None, PROSE * 3),
    (6, "\n".join(f"Line{i} says thing{i}. And so does one{i}, apart from the rest." for i in range(5)) + "\nHome | News | About us | Contact\n"
        "All rights RESERVED by the owner.\nMenu\n\nWhat now?!! Buy!! Go!! Now!!\nA ### b ### c."),
    (7, "Home | News | Sport\nWeather | Travel | Food\nA last line that says something at all."),
    (8, " ".join("abcdefghij"[i % 5] for i in range(40)) + "."),
    (9, f"{PROSE}And more of that.\n{PROSE}And more of that.\nIt ends with a ’quoted word.’"),
]


def test_line_rules_on_edges(spark):
    rows = line_rules.evaluate(table(spark, RULE_DOCS)).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(RULE_DOCS) and [r["n_words"] for r in rows].count(60_005) == 2
    for i in (1, 2, 3):
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["base_failed"], got[i]["kept"], got[i]["lost_chars"]) == (0, 0, True, False, 0)
    assert got[4]["base_failed"] and not got[5]["base_failed"] and got[5]["kept"]
    text = dict(RULE_DOCS)[6]
    assert [(text[r["start"]:r["end"]], r["rule"]) for r in got[6]["removed"]] == [
        ("Home | News | About us | Contact", "navigation"), ("All rights RESERVED by the owner.", "boilerplate"), ("Menu", "punctuation"),
        ("What now?!! Buy!! Go!! Now!!", "punctuation"), ("A ### b ### c.", "punctuation")]
    assert got[6]["kept"] and got[6]["n_punctuation"] == 3
    assert not got[7]["base_failed"] and not got[7]["kept"] and got[7]["n_navigation"] == 2
    assert got[8]["n_repeat_words"] == 39 and got[8]["base_failed"]
    assert got[9]["n_dup_lines"] == 1
    assert line_rules.evaluate(table(spark, RULE_DOCS).limit(0)).count() == 0


def test_clean_keeps_rows_and_columns(spark):
    docs = table(spark, RULE_DOCS).withColumn("text_", F.col("text"))
    clean = line_rules.clean(docs)
    assert clean.columns == docs.columns
    got = {r["doc_id"]: r for r in clean.collect()}
    assert sorted(got, key=str) == [5, 6] and clean.count() == 3 and got[5]["text"] == LONG
    assert got[6]["text"].count("\n") == 5 and got[6]["text"].endswith("the rest.\n") and got[6]["row"] == "x"
    assert line_rules.clean(docs.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_words(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    marked = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    assert line_rules.repeated_words(words) == len(marked)


# spelling variants

def brute_counts(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return out


def variant_rows(df):
    return sorted(map(repr, map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect())))


def test_spelling_edges(spark):
    docs = [(1, None), (None, "the Letters Éténdard Éténdard letters letterss"), (2, ""), (3, "×÷abcdef_gABCDEF×÷" * 3),
            (4, "letters " * 300 + "lettters " * 20 + "lettter " * 2 + "leters1 leters2 xletters xletters"), (4, "aletters " * 20 + "bletters " * 20 + "letterq letterq")]
    docs += docs[-1:]
    n = brute_counts(docs)
    assert variant_rows(spelling.variants(table(spark, docs))) == sorted(map(repr, brute_variants(n)))
    assert spelling.variants(table(spark, docs).limit(0)).count() == 0


@pytest.mark.parametrize("pair_bin", [0, 6, 1024])
def test_crowded_chunks(spark, monkeypatch, pair_bin):
    """Words that share their chunks: large bins are cut further, and every pair is found."""
    monkeypatch.setattr(spelling, "PAIR_BIN", pair_bin)
    words = {"walking", "walkingg", "wwalking"}
    for base in ("walking", "nations", "stationary"):
        for i in range(len(base) + 1):
            for c in "aeioé":
                words |= {base[:i] + c + base[i:], base[:i] + c + base[i + 1:] if i < len(base) else base, base + c + "s"}
    n = {w: (i * 37) % 2000 + 2 for i, w in enumerate(sorted(w for w in words if len(w) >= 7))}
    got = spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n bigint"))
    assert variant_rows(got) == sorted(map(repr, brute_variants(n)))


def test_long_words(spark):
    long = "abcdefghij" * 3000
    n = {long: 100, long + "x": 3, "x" + long: 2, long[:999] + "é" + long[1000:]: 5, long[:-1]: 11}
    got = spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n bigint"))
    assert variant_rows(got) == sorted(map(repr, brute_variants(n)))


# Merkle manifest

def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_tree(nodes):
    """(root, path of each node): path as [(left siblings, right siblings)] by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p - p % 16:p - p % 16 + 16]
            paths[i].append((run[:p % 16], run[p % 16 + 1:]))
            at[i] = p // 16
        nodes = [H(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute_manifest(docs):
    """docs: (doc_id, source, lang, n_chars, text) -> rows of the contract."""
    def leaf(r):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    by = {}
    for r in docs:
        lowered = None if r[4] is None else "".join(c.lower() if c.isascii() else c for c in r[4])
        draw = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0], leaf((*r[:4], lowered)) if draw else leaf(r)))
    subs, out = [], []
    for source in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        rows = sorted(by[source])
        sub, paths = brute_tree([r[2] for r in rows])
        subs.append((sub, rows, paths))
    root, tops = brute_tree([s[0] for s in subs])
    for (sub, rows, paths), top in zip(subs, tops):
        for r, path in zip(rows, paths):
            fold = r[4]
            for left, right in path + top:
                fold = H(*left, fold, *right)
            out.append((r[3], r[2], sub, root, H(*(h for p in path + top for side in p for h in side)), fold, fold == root))
    return sorted(map(repr, out))


def manifest_rows(df):
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(repr, map(tuple, df.select(*cols).collect())))


def test_manifest_of_uneven_sources(spark):
    """Sources of 1 to 66,000 leaves (three rounds of blocks), nulls, ties and repeated rows."""
    docs = [(i, "big", "en", 5, f"Text {i}") for i in range(66_000)] + [(i, "mid", None, None, None if i % 7 else "É") for i in range(257)]
    docs += [(i, f"s{i % 40:02d}", "fr", i, "Ünï Code") for i in range(300)] + [(9, "lone", "en", 1, "X")] + [(None, None, None, None, None)] * 3
    docs += [(5, "tie", "en", 1, "B"), (5, "tie", "en", 1, "A"), (5, "tie", "en", 1, "A"), (None, "tie", "en", 1, "null id"), (6, "", "en", 1, ""), (7, "", None, 2, LONG)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    for c in ("tree", "pos", "size", "leaf", "changed", "path", "members", "tampered"):
        df = df.withColumn(c, F.lit("x"))
    found = merkle.manifest(df.repartition(5), crc_mod("doc_id", 5) == 0)
    assert manifest_rows(found) == brute_manifest(docs)
    # a version copies its leaf's ancestors up to the new root, and nothing of an untouched leaf
    for r in found.filter("source = 'big'").limit(50).collect():
        tampered = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert (r["copied"] is not None) == tampered
        assert not tampered or (r["copied"][-1] == r["folded_root"] and len(r["copied"]) == 5 + 2)


def test_manifest_small_and_empty(spark):
    one = spark.createDataFrame([(1, "s", "en", 1, "A")], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert manifest_rows(merkle.manifest(one, F.lit(False))) == manifest_rows(one.select(
        "doc_id", *[F.lit(H("1:1", "1:s", "2:en", "1:1", "1:A")).alias(c) for c in ("leaf", "subroot", "root")],
        F.lit(H("")).alias("proof_sha256"), F.lit(H("1:1", "1:s", "2:en", "1:1", "1:A")).alias("folded_root"), F.lit(True).alias("verified")))
    assert merkle.manifest(one.limit(0), F.lit(True)).count() == 0

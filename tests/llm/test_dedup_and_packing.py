"""SimHash, line dedup, chat formatting, quality, packing, weighted sampling and the pipeline
against brute force, exact round trips and held-out accuracy."""

import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from marketflow.llm import chat_format, line_dedup, packing, quality, queries, simhash, weighted_sampling

from .test_scanning import SF, containment, table

LONG = "many different words " + " ".join(f"w{i}" for i in range(30_000))
EDGES = [(5, None), (None, None), (6, ""), (7, "one"), (8, "ONE"), (8, "ONE"), (9, "a b c d e f g h i j\nk l m n o p q r s t"),
         (None, "a b c d e f g h i j\nk l m n o p q r s t"), (10, LONG), (11, LONG + " end"), (4, "   \t ")]


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """Smallest member index reachable, by union-find over all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash_of_the_whole_table(spark):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in queries.op6_simhash(spark, SF).collect()}
    fps = [brute_fingerprint(d["text"]) for d in docs]
    want = brute_components(fps)
    for d, fp, c in zip(docs, fps, want):
        assert got[d["doc_id"]]["fingerprint"] == f"{fp:016x}"
        assert got[d["doc_id"]]["component_id"] == docs[c]["doc_id"]


@pytest.mark.parametrize("pair_bin", [0, 3, 32])
def test_links_of_clustered_fingerprints(spark, monkeypatch, pair_bin):
    """Large bins go through the stars; both ways give the components of all pairs."""
    monkeypatch.setattr(simhash, "PAIR_BIN", pair_bin)
    rng = np.random.default_rng(pair_bin)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 6).tolist() + [0, (1 << 64) - 1]:
        here = {centre}
        for _ in range(25):
            x = int(rng.choice(np.array(sorted(here), dtype=object)))
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
                x ^= 1 << int(b)
            here.add(x)
        fps |= here
    fps = sorted(fps)
    want = brute_components(fps)
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id bigint, fp bigint")
    got = {r["doc_id"]: r["component_id"] for r in simhash.label_rows(df).collect()}
    assert [got[i] for i in range(len(fps))] == want and len(set(want)) < len(fps)


@pytest.mark.parametrize("max_bits", [0, 1])
def test_fewer_bits(spark, max_bits):
    fps = [0, 1, 3, 7, 1 << 40, (1 << 40) | 1, (1 << 40) | (1 << 33)]
    got = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), max_bits).collect()}
    assert got == {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= max_bits}


def test_long_chain_of_links(spark):
    chain = [0]
    for i in range(40):
        chain.append(chain[-1] ^ (1 << (i % 63)) ^ (1 << ((i * 7 + 3) % 63)))
    edges = spark.createDataFrame(list(zip(chain, chain[1:])), "a bigint, b bigint").filter("a != b")
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    assert {r["root"] for r in simhash.components(edges).collect()} == {min(chain)}


def test_simhash_index_is_merged_not_broadcast(spark, monkeypatch):
    # 66 index rows of a fingerprint are sized as the one they come from: no plan may rely on it
    plans = []

    def store(df, name, put=simhash.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return put(df, name)

    monkeypatch.setattr(simhash, "stored", store)
    fps = spark.createDataFrame([(f,) for f in (0, 1, 3, 7, 1 << 40, 5 << 50)], "fp bigint")
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) >= 10 << 20
    found = simhash.links(fps)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2 and all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for p in plans)
    assert {(r["a"], r["b"]) for r in found.collect()} == {
        (0, 1), (0, 3), (1, 3), (1, 7), (3, 7), (0, 1 << 40), (1, 1 << 40), (0, 5 << 50)}


def test_pipeline_stage_broadcasts_no_index_rows(spark, monkeypatch):
    # every table that the near-dedup stage writes on the way to its groups, by name
    plans = {}

    def store(df, name, put=simhash.stored):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return put(df, name)

    monkeypatch.setattr(simhash, "stored", store)
    docs = table(spark, [(1, "a b c d e"), (2, "a b c d e"), (3, "f g h i j k"), (4, None)])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert "BroadcastHashJoin" not in plans["simhash-index"] and "BroadcastHashJoin" not in plans["simhash-links"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_simhash_edges_and_keep_one(spark):
    docs = table(spark, EDGES)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(EDGES)
    got = defaultdict(set)
    for r in rows:
        got[r["component_id"]].add(r["doc_id"])
    assert got[4] == {4, 5, 6, None} and got[7] == {7, 8} and got[9] == {9, None} and got[10] == {10, 11}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 7, 9, 10]
    assert simhash.keep_one(table(spark, [(1, "x y z"), (1, "x y z"), (1, "X y z")])).count() == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0
    assert [r["component_id"] for r in simhash.near_duplicates(table(spark, [(None, "x"), (None, "x")])).collect()] == [None, None]


def brute_lines(docs):
    seen, out = {}, set()
    for i, t in sorted({(i, t) for i, t in docs if t}, key=lambda d: (d[0] is None, d[0] or 0)):
        at = 0
        for u, line in enumerate(t.split("\n")):
            norm = re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")
            if norm:
                if norm in seen:
                    out.add((i, u, at, at + len(line), *seen[norm]))
                else:
                    seen[norm] = (i, u)
            at += len(line) + 1
    return out


def test_lines_of_the_whole_table(spark):
    """Every line that is not empty counts, a license line of three words too."""
    docs = [tuple(d) for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    gone = brute_lines(docs)
    rows = queries.op5_line_dedup_all(spark, SF).collect()
    assert {tuple(r) for r in rows} == gone and len(rows) == len(gone) and min(len(dict(docs)[g[0]][g[2]:g[3]].split()) for g in gone) < 8
    by = defaultdict(list)
    for i, _, a, b, *_ in gone:
        by[i].append((a, b))
    left = queries.op5_line_dedup(spark, SF).collect()
    assert len(left) == len(docs)
    for r in left:
        text, at, out = dict(docs)[r["doc_id"]], 0, ""
        for a, b in sorted(by[r["doc_id"]]):
            out, at = out + text[at:a], b + (text[b:b + 1] == "\n")
        assert r["text"] == out + text[at:]
        assert r["removed"] == ",".join(f"{a}:{b}" for a, b in sorted(by[r["doc_id"]])) and r["n_removed"] == len(by[r["doc_id"]])


def test_short_line_edges(spark):
    docs = [(1, "}\n\n  \nAll rights reserved.\nx"), (2, "\t}\nall  RIGHTS reserved.\n\n"), (None, "x"), (3, "x")]
    rows = line_dedup.repeated_units(table(spark, docs), min_words=1).collect()
    assert {tuple(r)[:1] + tuple(r)[2:] for r in rows} == {(2, 0, 0, 2, 1, 0), (2, 1, 3, 24, 1, 3), (3, 0, 0, 1, 1, 4), (None, 0, 0, 1, 1, 4)}


def test_lines_of_equal_ids_and_capitals_follow_the_sql(spark, scratch):
    """Texts of one id are ordered by md5; a capital is lowered by itself, at the end of a word too."""
    docs = [(1, "z\nshared"), (1, "y\nshared"), (1, "shared\nw"), (1, "y\nshared"), (2, "ΟΔΟΣ"), (3, "οδοσ"), (4, "οδος"),
            (5, "İx"), (6, "i\u0307x"), (7, "ix"), (None, "w\nnone"), (None, "none\nv"), (None, "u\nnone")]
    table(spark, docs, clash=False).write.parquet(f"{scratch}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{scratch}/documents.parquet/*.parquet')")
    for name in ("op5_line_dedup", "op5_line_dedup_all"):
        want = con.execute(queries.ORACLE_SQL[name]).fetchall()
        assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in queries.QUERIES[name](spark, scratch).collect())
    left = {r["doc_id"]: r["text"] for r in queries.op5_line_dedup(spark, scratch).collect()}
    assert (left[3], left[4], left[6], left[7]) == ("", "οδος", "i\u0307x", "")


def test_line_edges_and_hot_lines(spark, monkeypatch):
    hot = "this very common line has eight words here"
    docs = EDGES + [(100 + i, f"own line number {i} with enough words to count\n  {hot.upper()}  \nshort {i}") for i in range(30)]
    docs += [(100, docs[-30][1])]  # a repeated row
    monkeypatch.setattr(line_dedup, "HOT_DIGESTS", 10**9)
    want = {r[:4] for r in brute_lines(docs)}
    rows = line_dedup.repeated_units(table(spark, docs)).collect()
    assert {(r["doc_id"], r["unit"], r["start"], r["end"]) for r in rows} == want and len(rows) == len(want)
    clean = line_dedup.remove_repeats(table(spark, docs))
    texts = {r["doc_id"]: r for r in clean.collect()}
    assert clean.count() == len(docs)
    assert texts[101]["text"].endswith("to count\nshort 1") and texts[101]["removed"][0]["end"] - texts[101]["removed"][0]["start"] == len(hot) + 4
    assert texts[None]["text"] in ("", None) and texts[9]["text"] == EDGES[6][1]
    assert line_dedup.repeated_units(table(spark, docs).limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool", "</s>\\"]),
                          st.lists(st.sampled_from([*"</s>[INST] \\\nSYROLEAM,", *chat_format.CONTROLS]), max_size=12).map("".join)), max_size=6))
def test_format_round_trip(turns):
    formatted, mask = chat_format.render(turns)
    assert chat_format.read_back(formatted) == turns
    assert [chat_format.unescape(formatted[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def test_conversations_of_the_whole_table(spark):
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        convs[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    said = "</s>[INST] ok [/INST]"
    convs[-1] = [(0, "user", said), (1, "assistant", said)]
    got = {r["conv_id"]: r for r in queries.op7_chat_format(spark, SF).collect()}
    assert got.keys() == convs.keys()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for i, rows in convs.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        g = got[i]
        assert g["n_turns"] == len(rows) and g["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for _, r, t in rows))
        assert g["loss_chars"] == len(loss) and g["loss_sha256"] == sha(loss)
        assert g["formatted_chars"] > sum(len(t) for _, _, t in rows)
    assert len({r["layout"] for r in got.values()}) > 2


def test_layouts_become_the_same_turns(spark):
    ask, tell = {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}
    same = [{"messages": [ask, tell]}, {"conversations": [{"from": "human", "value": "q"}, {"value": "a", "from": "gpt"}]},
            {"prompt": "q", "response": "a"}, {"completion": "a", "prompt": "q"}, {"question": "q", "answer": "a"},
            {"instruction": "q", "output": "a"}, {"instruction": "q", "input": "", "output": "a", "id": 3, "source": {"x": [1]}},
            {"id": 1, "messages": [{"role": "user", "content": [{"type": "text", "text": "q"}]}, {**tell, "weight": 1}]},
            {"prompt": "q", "response": "a", "completion": "b"}, {"dialog": [{"speaker": "human", "text": "q"}, {"speaker": "bot", "text": "a"}]}]
    bad = [None, "", "no json", "[]", "3", json.dumps({"prompt": "q", "answer": "a"}), json.dumps({"prompt": 3, "response": "a"}),
           json.dumps({"messages": [ask, {"role": "x"}]}), json.dumps({"messages": []}),
           json.dumps({"instruction": "i", "input": "on this", "output": "o"}), json.dumps({"messages": [ask, "x"]})]
    rows = [(i, json.dumps(r)) for i, r in enumerate(same)] + [(100 + i, r) for i, r in enumerate(bad)] + [(None, json.dumps(same[0]))]
    df = spark.createDataFrame(rows, "conv_id bigint, record string").withColumn("formatted", F.lit("x"))
    out = chat_format.format_records(df)
    got = {r["conv_id"]: r for r in out.collect()}
    assert len({got[i]["formatted"] for i in range(len(same))} | {got[None]["formatted"]}) == 1
    assert [got[100 + i]["layout"] for i in range(7)] == [None] * 7
    assert [tuple(t) for t in got[107]["turns"]] == [("user", "q"), ("x", "")]  # an entry without a text
    assert got[108]["turns"] == [] and got[108]["formatted"] == "<s>"
    assert [tuple(t) for t in got[109]["turns"]] == [("user", "i\n\non this"), ("assistant", "o")] and got[110]["layout"] is None
    assert got[0]["fingerprint"] != got[1]["fingerprint"]
    assert chat_format.digests(out).count() == len(rows)
    assert chat_format.format_records(df.limit(0)).count() == 0


def test_record_edges(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "x"), (None, None, "user", "y"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"),
            (3, 0, "human", "z" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("said", F.lit(1))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat_format.format_records(chat_format.as_records(df)).collect()}
    assert got == {1: [("", "x"), ("assistant", "")], None: [("user", "y")], 2: [("user", "a"), ("user", "a"), ("user", "b")],
                   3: [("human", "z" * 100_000)]}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversations_of_any_length_go_one_way(spark):
    """Turns, loss text and length of a conversation of many parts are those of its turns as one."""
    rows = [(1, 1, "assistant", None), (1, 0, None, "x"), (None, None, "user", "y"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"),
            (3, 0, "human", "z" * 100), (4, 0, "user", "</s>\\"), (4, 1, "assistant", "[INST]"), (5, 0, "system", "s"), (5, 1, "user", "u"),
            (5, 2, "assistant", "a")] + [(6, i, ("user", "assistant", "tool")[i % 3], f"t{i} <s>") for i in range(2_500)]
    rows += [(7, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(chat_format.PART_TURNS)] + [(8, i, "user", "u") for i in range(65)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    records = chat_format.as_records(df)
    parts = Counter(r["conv_id"] for r in records.collect())
    assert parts[6] == 40 and parts[7] == 1 and parts[8] == 2 and max(len(json.loads(r["record"]).get("messages", [])) for r in records.collect()) == 64
    got = {r["conv_id"]: r for r in chat_format.conversation_digests(df).collect()}
    convs = defaultdict(list)
    for i, turn, role, text in rows:
        convs[i].append((turn, role or "", text or ""))
    assert got.keys() == convs.keys()
    for i, said in convs.items():
        turns = [(r, t) for _, r, t in sorted(said)]
        formatted, mask = chat_format.render(turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[i]["n_turns"], got[i]["formatted_chars"], got[i]["loss_chars"]) == (len(turns), len(formatted), len(loss))
        assert got[i]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns)) and got[i]["loss_sha256"] == sha(loss)
    assert {i: got[i]["layout"] for i in (4, 5, 7, 6, 3)} == {4: "prompt", 5: "prompt", 7: "share", 6: "messages", 3: "messages"}
    assert chat_format.conversation_digests(df.limit(0)).count() == 0


def test_likeness_of_texts_of_a_million_terms():
    """Unequal weights and more distinct terms than any table of draws would hold."""
    rng = np.random.default_rng(5)
    errors = []
    for _ in range(6):
        words = rng.permutation(1_200_000)
        # single words, each set apart by one common word: terms are pairs of the word and it
        shared, one, other = (words[k * 300_000:(k + 1) * 300_000] for k in range(3))
        bag = lambda own: (np.r_[shared, own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.r_[np.ones(300_000, int), np.full(300_000, 3)])
        a, b = (sampled(*bag(own)) for own in (one, other))
        errors.append(weighted_sampling.likeness(a, b) - 1 / 7)
    assert abs(np.mean(errors)) < 0.03


def sampled(hashes, weights):
    order = np.argsort(hashes)
    old, weighted_sampling.terms = weighted_sampling.terms, lambda text: (hashes[order], weights[order])
    try:
        return weighted_sampling.signature("x")
    finally:
        weighted_sampling.terms = old


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stats = quality.document_statistics(docs.join(labels.select("doc_id"), "doc_id")).withColumn(
        "held_out", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0)
    got = quality.score(stats, quality.fit(stats, labels, train=~stats["held_out"]), keep=("doc_id", "held_out")) \
        .join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert len(held) > 700 and (held.predicted == held.quality).mean() > 0.98
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_quality_of_the_whole_table_by_plain_numpy(spark):
    """The contract's split, explicit random features, a ridge system and pooling by repeated scans."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 for d in docs}
    x = {d["doc_id"]: np.array(quality.statistics(d["text"])) for d in docs}
    train = [i for i in x if not held[i] and i in labels]
    X, y = np.array([x[i] for i in train]), np.array([labels[i] for i in train], dtype=float)
    model = quality.Model(X.mean(axis=0), np.maximum(X.std(axis=0), 1e-9))

    def features(rows):
        z = np.clip((rows - X.mean(axis=0)) / np.maximum(X.std(axis=0), 1e-9), -5, 5)
        return np.c_[np.cos(z @ model.omega + model.phase) * np.sqrt(2 / 512), np.ones(len(rows))]

    Z = features(X)
    penalty = np.eye(513) * 1e-3 * len(X) / 512
    penalty[-1, -1] = 0
    weights = np.linalg.solve(Z.T @ Z + penalty, Z.T @ y)
    raw = np.clip(Z @ weights, -0.5, 1.5)
    bins = np.floor(raw * 1000)
    blocks = [[raw[bins == b].mean(), y[bins == b].mean(), (bins == b).sum()] for b in np.unique(bins)]
    while bad := [k for k in range(len(blocks) - 1) if blocks[k][1] >= blocks[k + 1][1]]:
        (a, p, n), (b, q, m) = blocks[bad[0]], blocks[bad[0] + 1]
        blocks[bad[0]:bad[0] + 2] = [[(a * n + b * m) / (n + m), (p * n + q * m) / (n + m), n + m]]
    at, value, _ = map(np.array, zip(*blocks))
    want = dict(zip(x, np.clip(np.interp(np.clip(features(np.array(list(x.values()))) @ weights, -0.5, 1.5), at, value), 0, 1)))
    got = queries.op8_quality(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["held_out"] == held[r["doc_id"]] and r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-5)
        assert r["predicted"] == (r["score"] >= 0.3)


def test_quality_edges(spark):
    docs = table(spark, EDGES)
    stats = quality.document_statistics(docs)
    labels = spark.createDataFrame([(7, 1), (8, 0), (8, 1), (None, 1), (9, None), (10, 0), (999, 1)], "doc_id bigint, quality int").withColumn("y", F.lit(1))
    model = quality.fit(stats, labels, train=F.lit(True))
    rows = quality.score(stats, model).collect()
    assert len(rows) == len(EDGES) and all(0 <= r["score"] <= 1 for r in rows)
    nothing = quality.fit(stats, labels.limit(0), train=F.lit(True))
    assert {r["score"] for r in quality.score(stats, nothing).collect()} == {0.5}
    assert quality.score(quality.document_statistics(docs.limit(0)), model).count() == 0
    assert all(np.isfinite(quality.statistics(t)).all() for _, t in EDGES)


def test_isotonic_is_monotone_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    x, y, w = np.arange(50.0), rng.random(50), rng.integers(1, 9, 50).astype(float)
    at, value = quality.isotonic(x, y, w)
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
    blocks = np.searchsorted(np.r_[0, (at[1:] + at[:-1]) / 2], x, side="right")
    assert len(np.unique(blocks)) == len(value)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_places_every_piece_once(counts):
    runs = packing.plan(counts, 64)
    placed, fill = Counter(), defaultdict(list)
    for length, first, n, sequence, offset in runs:
        assert first == placed[length]
        placed[length] += n
        for k in range(n):
            fill[sequence + k].append((offset, length))
    assert placed == Counter(counts)
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(fill) == list(range(len(fill)))
    bound = -(-sum(a * b for a, b in counts.items()) // 64)
    assert len(fill) <= max(bound * 1.5 + 1, sum(n for a, n in counts.items() if a > 32) + bound)


def test_exact_complements():
    left = np.zeros(100, dtype=np.int64)
    left[[10, 20, 30, 45]] = [1, 1, 2, 1]
    assert packing.exact(left, 45) == (45,) and packing.exact(left, 60) == (30, 30) and packing.exact(left, 50) == (30, 20)
    assert packing.exact(left, 85) == (45, 30, 10) and packing.exact(left, 41) is None and packing.exact(left, 20 + 20) == (30, 10)


def test_packing_of_the_whole_table(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op9_packing(spark, SF).collect()
    by, fill = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by.keys() == docs.keys()
    total = 0
    for i, text in docs.items():
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        total += len(ids)
        pieces = sorted(by[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // 2048)
        at = 0
        for p in pieces:
            assert p["start"] == at and (p["length"] == 2048 or p["piece"] == 0)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(fill) <= -(-total // 2048) + 3


def test_packing_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BUCKET", 2)
    rows = [*EDGES, *[(50, "same text")] * 9, (51, "<|endoftext|> a  b\n\nc")]
    got = packing.pack(table(spark, rows)).collect()
    places = {(r["sequence_id"], r["offset"]) for r in got}
    assert len(places) == len(got) and sum(r["piece"] == 0 for r in got) == len(rows)
    assert packing.pack(table(spark, rows).limit(0)).count() == 0


def exact_likeness(a, b):
    x, y = (dict(zip(*(v.tolist() for v in weighted_sampling.terms(t)))) for t in (a, b))
    keys = x.keys() | y.keys()
    return sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)


def test_collisions_estimate_the_generalised_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(150):
        a = list(rng.choice([f"w{i}" for i in range(30)], 200))
        b = a[:int(rng.integers(10, 200))] + list(rng.choice([f"w{i}" for i in range(60)], 80))
        a, b = " ".join(a), " ".join(b)
        errors.append(weighted_sampling.likeness(weighted_sampling.signature(a, 256), weighted_sampling.signature(b, 256)) - exact_likeness(a, b))
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.05


def test_sampling_of_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(weighted_sampling, "NEIGHBOURS", 17)
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), reverse=True)
    got = {r["doc_id"]: r for r in queries.op10_weighted_sampling(spark, SF).collect()}
    assert len(got) == len(docs)
    far = []
    for d, e in zip(docs, docs[1:] + docs[:1]):
        text, following = d["text"] or "", e["text"] or ""
        n = len(text) // 3
        changed = text[:len(text) - n] + following[:n]
        r = got[d["doc_id"]]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == weighted_sampling.hexadecimal(weighted_sampling.signature(text))
        assert r["edited_fingerprint"] == weighted_sampling.hexadecimal(weighted_sampling.signature(changed))
        assert abs(r["near_next"] - exact_likeness(text, following)) < 0.25
        far.append(r["near_edited"] - exact_likeness(text, changed))
    assert abs(np.mean(far)) < 0.02
    texts = defaultdict(set)
    for d in docs:
        texts[d["text"]].add(got[d["doc_id"]]["fingerprint"])
    assert all(len(f) == 1 for f in texts.values())


def test_sampling_edges(spark, monkeypatch):
    monkeypatch.setattr(weighted_sampling, "NEIGHBOURS", 2)
    order = sorted(EDGES, key=lambda d: (d[0] is None, -(d[0] or 0), hashlib.md5((d[1] or "").encode()).hexdigest()))
    rows = weighted_sampling.near_next(table(spark, EDGES)).collect()
    want = Counter((a[0], hashlib.sha256(weighted_sampling.edited(a[1] or "", b[1] or "").encode()).hexdigest())
                   for a, b in zip(order, order[1:] + order[:1]))
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in rows) == want
    assert all(r["near_edited"] == 1 and r["fingerprint"] == "" for r in rows if not r["n_chars"])
    many = [(None, f"text number {i}") for i in range(60)] + [(3, "a"), (3, "b")]
    rows = weighted_sampling.near_next(table(spark, many)).collect()
    assert len(rows) == len(many)
    one = weighted_sampling.near_next(table(spark, [(1, "a b c")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    assert weighted_sampling.near_next(table(spark, EDGES).limit(0)).count() == 0


def test_pipeline_agrees_with_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = sorted(i for i, t in docs.items() if any(c.isalpha() for c in t or ""))
    fps = [brute_fingerprint(docs[i]) for i in kept]
    kept = [i for k, (i, c) in enumerate(zip(kept, brute_components(fps))) if k == c]
    kept = [i for i in kept if all(containment(docs[i], q) < 0.8 for q in items)]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted({r["doc_id"] for r in rows}) == kept and 0 < len(kept) < len(docs)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination", "secret scan", "best-fit packing"]
    lengths = Counter()
    for r in rows:
        lengths[r["doc_id"]] += r["length"]
    import public_tokenizers
    from tokenizers import Tokenizer

    from marketflow.llm import secrets

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = {i: [p[1:] for p in secrets.find_parts(docs[i]) if p[0] in secrets.BASE_KINDS] for i in kept}
    weak = {i for i in kept if any(p[0] in secrets.WEAK_KINDS for p in secrets.find_parts(docs[i]))}
    for i in set(kept) - weak:
        assert lengths[i] == len(tok.encode(secrets.mask_spans(docs[i], parts[i], "[SECRET]"), add_special_tokens=False).ids) + 1


def test_stages_take_empty_and_odd_documents(spark):
    docs = table(spark, EDGES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0

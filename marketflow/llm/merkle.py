"""Merkle dataset manifest: a persistent, path-copying tree.

A leaf is the hash of a row's fields.  The leaves of a source, in order of id, are the bottom of
the source's tree, in which every ``FANOUT`` consecutive nodes have a parent; the sources'
roots, in order of source, are the bottom of the upper tree.

Aligned blocks of ``FANOUT ** BLOCK_LEVELS`` leaves are whole subtrees, so a block is one row and
one task's work, however large its source.  Their roots are the leaves of the next round, in
blocks again, until each tree has one node: the work of a round is a ``BLOCK``-th of the one
before, and no tree meets in one task.  The way back down hands every block the siblings above
it, a few kilobytes.

A tampered leaf makes a new version of the tree: only its ancestors are copied (``copied``, from
its run upward to the new root), all other nodes are those of the original.  The version starts
inside the leaf's block and is continued there through the upper levels by the siblings handed
down; sent up, the versions of all leaves would meet in the few blocks at the top.

Places are dealt without a global sort in one task: rows are range-partitioned and sorted, and
each partition's rows are counted by tree; the running sum of these counts (a row for each tree
and partition) is added to the place in the partition.

Defined results: null fields hash as ``-``; the null source is a source of its own and comes
first; null ids come first in their source and are hashed as empty text where ids are drawn;
rows of equal source and id are in order of their leaves, and equal rows stand side by side;
a text of any length is hashed in its row's task; an empty table gives an empty manifest; other
columns are ignored.
"""

from __future__ import annotations

import string
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored

FANOUT = 16
BLOCK_LEVELS = 2
BLOCK = FANOUT ** BLOCK_LEVELS
FIELDS = (("doc_id", "bigint"), ("source", "string"), ("lang", "string"), ("n_chars", "bigint"), ("text", "string"))


def digest(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def field_code(value: Column) -> Column:
    """``-`` or the value's length in bytes, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(tree, doc_id, leaf, changed): a row's leaf, and where ``tampered`` holds the leaf of the row
    with its text's A-Z lower-cased.  ``tree`` names the source so that null is first in order."""
    rows = docs.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in FIELDS], F.coalesce(tampered, F.lit(False)).alias("tampered"))
    code = {c: field_code(F.col(c)) for c, _ in FIELDS}
    leaf = F.sha2(F.concat(*code.values()), 256)
    changed = F.sha2(F.concat(*(code | {"text": field_code(lower_ascii(F.col("text")))}).values()), 256)
    return rows.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"), "doc_id",
                       leaf.alias("leaf"), F.when(F.col("tampered"), changed).alias("changed"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place in their tree (``pos``, from 0) in the given order, nulls first,
    and the tree's number of rows (``size``)."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order, "row_tie")]
    dealt = rows.withColumn("row_tie", F.monotonically_increasing_id()).repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    dealt = stored(dealt.drop("row_tie").select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "merkle-order")
    counts = stored(dealt.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n")), "merkle-counts")
    # a tree has at most one row a partition here
    before = counts.select("tree", "part", (F.expr("coalesce(sum(n) over (partition by tree order by part rows between unbounded preceding and 1 preceding), 0)")
                                            - F.col("first")).alias("shift"), F.expr("sum(n) over (partition by tree)").alias("size"))
    return dealt.join(before, ["tree", "part"]).select(*rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "size")


def in_blocks(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """(tree, block, size, members): the nodes of an aligned block, at most ``BLOCK``, as one row."""
    nodes = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("bigint"))
    return stored(nodes.groupBy("tree", "block").agg(
        F.min("size").alias("size"), F.array_sort(F.collect_list(F.struct("pos", *payload))).alias("members")), "merkle-blocks")


def levels_of(size: int) -> int:
    """Levels that a round climbs in a tree of ``size`` nodes."""
    n = 0
    while size > 1 and n < BLOCK_LEVELS:
        size, n = -(-size // FANOUT), n + 1
    return n


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and those of each level above them."""
    out = [nodes]
    for _ in range(levels):
        nodes = [digest("".join(nodes[i:i + FANOUT])) for i in range(0, len(nodes), FANOUT)]
        out.append(nodes)
    return out


def sibling_pairs(levels: list[list[str]]) -> list[list[str]]:
    """For each bottom node the concatenated siblings to its left and right, level by level."""
    at = []
    for nodes in levels[:-1]:
        at.append([("".join(nodes[i - i % FANOUT:i]), "".join(nodes[i + 1:i - i % FANOUT + FANOUT])) for i in range(len(nodes))])
    return [[s for k, pairs in enumerate(at) for s in pairs[i // FANOUT ** k]] for i in range(len(levels[0]))]


def fold(leaf: str, path: list[str]) -> list[str]:
    """The ancestors of a leaf, from its run's parent to the root, by the siblings of its path."""
    out = []
    for left, right in zip(path[::2], path[1::2]):
        leaf = digest(left + leaf + right)
        out.append(leaf)
    return out


def block_roots(blocks: DataFrame) -> DataFrame:
    """(tree, pos, digest, size): the block's top node as a node of the next round."""

    def run(cols: dict) -> dict:
        tops = [climb([m["digest"] for m in ms], levels_of(size))[-1][0] for ms, size in zip(cols["members"], cols["size"])]
        return {"tree": cols["tree"], "pos": cols["block"], "digest": tops, "size": [-(-s // BLOCK) for s in cols["size"]]}

    rows = blocks.select("tree", "block", "size", F.transform("members", lambda m: F.struct(m["digest"].alias("digest"))).alias("members"))
    return map_batches(rows, run, "tree string, pos bigint, digest string, size bigint", rows=50)


def grow(bottom: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of the rounds above a bottom of blocks, and (tree, digest): the trees' roots."""
    rounds, done, blocks = [], None, bottom
    while True:
        tops = stored(block_roots(blocks), "merkle-nodes")
        roots = tops.filter("size = 1").select("tree", "digest")
        done = roots if done is None else done.unionByName(roots)
        more = tops.filter("size > 1")
        if more.isEmpty():
            return rounds, done
        rounds.append(blocks := in_blocks(more, ["digest"]))


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame | None:
    """(tree, block, path, subroot, root) of the bottom's blocks, from the top round down; ``tops``
    has (tree, path, subroot, root) of the trees.  None where no tree has a round above."""

    def run(cols: dict) -> dict:
        out: dict[str, list] = {c: [] for c in ("tree", "block", "path", "subroot", "root")}
        for tree, ms, size, path, subroot, root in zip(*(cols[c] for c in ("tree", "members", "size", "path", "subroot", "root"))):
            for m, inner in zip(ms, sibling_pairs(climb([m["digest"] for m in ms], levels_of(size)))):
                for c, v in zip(out, (tree, m["pos"], inner + path, subroot, root)):
                    out[c].append(v)
        return out

    above = None
    for blocks in reversed(rounds):
        above = stored(map_batches(with_path(blocks, tops, above), run, "tree string, block bigint, path array<string>, "
                                   "subroot string, root string", rows=10), "merkle-paths")
    return above


def with_path(blocks: DataFrame, tops: DataFrame, above: DataFrame | None) -> DataFrame:
    """Blocks with the path above them: a tree's last block has the tree's own, others have that
    of their node in the round above."""
    last = blocks.filter(F.col("size") <= BLOCK).join(tops, "tree")
    if above is None:
        return last
    return last.unionByName(blocks.filter(F.col("size") > BLOCK).join(above, ["tree", "block"]))


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """(doc_id, source, pos, leaf, subroot, root, proof_sha256, folded_root, verified, copied): one
    row per row of ``docs``, with its place in its source.  ``folded_root`` is computed from the
    tampered leaf, else from the original one, and the original siblings; ``copied`` holds the
    nodes of a tampered row's version, null for the others."""
    found = placed(stored(leaves(docs, tampered), "merkle-leaves"), ["doc_id", "leaf"])
    bottom = in_blocks(found.withColumnRenamed("leaf", "digest"), ["digest", "doc_id", "changed"])
    rounds, subroots = grow(bottom)
    # the upper tree, whose leaves are the sources' roots
    subroots = stored(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), "merkle-subroots")
    upper = in_blocks(placed(subroots, ["source"]), ["digest", "source"])
    upper_rounds, root = grow(upper)
    tops = root.select("tree", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))

    def sources(cols: dict) -> dict:
        out: dict[str, list] = {c: [] for c in ("tree", "path", "subroot", "root")}
        for ms, size, path, root in zip(cols["members"], cols["size"], cols["path"], cols["root"]):
            for m, inner in zip(ms, sibling_pairs(climb([m["digest"] for m in ms], levels_of(size)))):
                for c, v in zip(out, (m["source"], inner + path, m["digest"], root)):
                    out[c].append(v)
        return out

    trees = stored(map_batches(with_path(upper, tops, descend(upper_rounds, tops)), sources,
                               "tree string, path array<string>, subroot string, root string", rows=10), "merkle-trees")
    joined = with_path(bottom, trees, descend(rounds, trees))

    def rows(cols: dict) -> dict:
        names = ("doc_id", "source", "pos", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "copied")
        out: dict[str, list] = {c: [] for c in names}
        for tree, ms, size, path, subroot, root in zip(*(cols[c] for c in ("tree", "members", "size", "path", "subroot", "root"))):
            upper_bytes = "".join(path).encode()
            for m, inner in zip(ms, sibling_pairs(climb([m["digest"] for m in ms], levels_of(size)))):
                proof = sha256("".join(inner).encode())
                proof.update(upper_bytes)
                start = m["digest"] if m["changed"] is None else m["changed"]
                nodes = fold(start, inner + path)
                folded = nodes[-1] if nodes else start
                values = (m["doc_id"], tree[1:] if tree else None, m["pos"], m["digest"], subroot, root, proof.hexdigest(),
                          folded, folded == root, None if m["changed"] is None else nodes)
                for c, v in zip(names, values):
                    out[c].append(v)
        return out

    return map_batches(joined, rows, "doc_id bigint, source string, pos bigint, leaf string, subroot string, root string, "
                       "proof_sha256 string, folded_root string, verified boolean, copied array<string>", rows=10)


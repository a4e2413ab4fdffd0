"""Merkle manifest of a dataset, folded with retained hash states.

A row's leaf is the SHA-256 of its columns; the leaves of one tree, in order,
are hashed in runs of ``fan`` (the last run may be shorter, even one) level by
level until one node is left.  The roots of the trees, in the order of their
names, are hashed alike to the dataset's root.

While a parent is hashed it keeps a copy of the hash state before each child
slot.  When a child changes, folding resumes the state before that child's
slot, takes in the replacement and the right siblings alone, and goes on with
the parent's digest one level up: what lies to the left is never hashed again.

On Spark a tree is cut into aligned blocks of ``fan ** block_levels`` leaves; a
block is one task's group, whatever the size of its tree.  A pass takes the
blocks' roots as the nodes of the next pass, until every tree is one block;
the trees' roots then are one more set of nodes.  On the way down a block is
given the siblings of its own path, absorbs the left ones once per block, and
every row of the block resumes from that copied state.

Cases: null columns count as ``-``; rows of null tree name come first, as a
tree of their own; a null id comes before the others, equal ids are ordered by
their leaves; a lone leaf is its tree's root, a lone tree the dataset's; rows
whose edited leaf is null fold their own leaf; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

FAN = 3
BLOCK_LEVELS = 7

_TOP = "top"  # the tree of the roots
_CHAIN = "array<string>"  # by level: the left siblings, the right siblings


def _field(column: Column) -> Column:
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 (hex) of the columns, each ``-`` if null, else its UTF-8 size, a colon and its value."""
    return F.sha2(F.concat(*[_field(c) for c in columns]).cast("binary"), 256)


class Block:
    """Levels of one block: every parent with the hash states before its children.

    ``levels`` None: up to a single node; else exactly so many levels.
    """

    def __init__(self, leaves: list[str], fan: int = FAN, levels: int | None = None):
        self.fan = fan
        self.nodes = [leaves]
        self.states: list[list[list]] = []  # by level, parent, slot
        while len(self.nodes[-1]) > 1 if levels is None else len(self.states) < levels:
            below, above, states = self.nodes[-1], [], []
            for k in range(0, len(below), fan):
                state, slots = hashlib.sha256(), []
                for child in below[k:k + fan]:
                    slots.append(state.copy())
                    state.update(child.encode())
                above.append(state.hexdigest())
                states.append(slots)
            self.nodes.append(above)
            self.states.append(states)

    @property
    def root(self) -> str:
        return self.nodes[-1][0]

    def chain(self, k: int) -> list[str]:
        """Left, right siblings of leaf ``k`` on every level."""
        out = []
        for nodes in self.nodes[:-1]:
            run = k - k % self.fan
            out += ["".join(nodes[run:k]), "".join(nodes[k + 1:run + self.fan])]
            k //= self.fan
        return out

    def siblings(self, k: int) -> str:
        """All siblings of leaf ``k``, level by level, left to right."""
        return "".join(self.chain(k))

    def fold(self, k: int, leaf: str) -> str:
        """The block's root with ``leaf`` in place of leaf ``k``."""
        for nodes, states in zip(self.nodes, self.states, strict=False):
            parent, slot = divmod(k, self.fan)
            leaf = _resumed(states[parent][slot], leaf, "".join(nodes[k + 1:(parent + 1) * self.fan]))
            k = parent
        return leaf


def _resumed(state, node: str, right: str) -> str:
    state = state.copy()
    state.update(node.encode())
    state.update(right.encode())
    return state.hexdigest()


class Path:
    """The path above a block: per level the state after the left siblings, and the right siblings."""

    def __init__(self, chain: list[str]):
        self.levels = [(hashlib.sha256(left.encode()), right) for left, right in zip(chain[::2], chain[1::2], strict=True)]
        self.siblings = "".join(chain)

    def fold(self, node: str) -> str:
        for state, right in self.levels:
            node = _resumed(state, node, right)
        return node


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, their place from 0 within ``tree`` by ``order``, which has no ties, and the tree's ``size``.

    Sorted once by ranges over (tree, order), so a large tree spreads over many
    tasks; the offsets come from one count per task and tree.
    """
    placed = written(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                     .withColumn("seq", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("seq", 33)
    counts = placed.groupBy("tree", part.alias("part")).agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("size"))
    return placed.withColumn("part", part).join(offsets, ["tree", "part"]) \
        .withColumn("rank", F.col("seq") + F.col("shift")).drop("seq", "part", "shift")


def _roots(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """tree, rank, digest, size of each block's root (size: the blocks of its tree)."""
    per_block = fan ** levels

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        size = int(rows["size"].iloc[0])
        block = Block(rows["digest"].tolist(), fan, None if size <= per_block else levels)
        return pd.DataFrame({"tree": rows["tree"].iloc[:1], "rank": rows["block"].iloc[:1], "digest": [block.root],
                             "size": [-(-size // per_block)]})

    return nodes.select("tree", "block", "rank", "digest", "size").groupBy("tree", "block") \
        .applyInPandas(fold, "tree string, rank long, digest string, size long")


def _up(nodes: DataFrame, fan: int, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(nodes of every pass with their block, tree and digest of each root)."""
    passes, roots = [], None
    while True:
        now = written(nodes.withColumn("block", F.floor(F.col("rank") / F.lit(fan ** levels)).cast("long")), f"{name}-nodes")
        passes.append(now)
        found = written(_roots(now, fan, levels), f"{name}-roots")
        done = found.where("size = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        nodes = found.where("size > 1")
        if nodes.isEmpty():
            return passes, roots


def _chains(nodes: DataFrame, above: DataFrame, fan: int, levels: int) -> DataFrame:
    """tree, block, chain: the path of every node of ``nodes``, given ``above``, the paths of their blocks."""
    per_block = fan ** levels

    def walk(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"tree": [], "block": [], "chain": []}, dtype=object)
        rows = rows.sort_values("rank")
        block = Block(rows["digest"].tolist(), fan, None if rows["size"].iloc[0] <= per_block else levels)
        up = list(upper["chain"].iloc[0])
        return pd.DataFrame({"tree": rows["tree"], "block": rows["rank"], "chain": [block.chain(k) + up for k in range(len(rows))]})

    return nodes.select("tree", "block", "rank", "digest", "size").groupBy("tree", "block") \
        .cogroup(above.groupBy("tree", "block")).applyInPandas(walk, f"tree string, block long, chain {_CHAIN}")


def _down(passes: list[DataFrame], above: DataFrame, fan: int, levels: int, name: str) -> DataFrame:
    """Paths of the blocks of the first pass; ``above``: tree and chain of each tree's root."""
    paths = above.select("tree", F.lit(0).cast("long").alias("block"), "chain")
    for nodes in reversed(passes[1:]):  # a node of a later pass is a block of the one before
        lower = paths.join(nodes.select("tree").distinct(), "tree", "left_anti")
        paths = written(lower.unionByName(_chains(nodes, paths, fan, levels)), f"{name}-paths")
    return paths


def manifest(leaves: DataFrame, fan: int = FAN, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every leaf.

    ``leaves``: tree (string, not null, the trees' order), doc_id, leaf,
    edited (a leaf to fold in place of the own one, or null).  A block of
    ``fan ** block_levels`` leaves is what one task holds.
    """
    per_block = fan ** block_levels
    stored = written(leaves.withColumn("uid", F.monotonically_increasing_id()), "merkle-leaves")
    rows = _ranked(stored, ["doc_id", "leaf", "uid"]).drop("uid").withColumnRenamed("leaf", "digest")
    # ids travel as text: pandas has no whole numbers beside nulls
    passes, roots = _up(rows.withColumn("doc_id", F.col("doc_id").cast("string")), fan, block_levels, "merkle")
    roots = written(roots, "merkle-subroots")

    named = _ranked(roots.select(F.lit(_TOP).alias("tree"), "digest", F.col("tree").alias("name")), ["name"])
    top_passes, root = _up(named, fan, block_levels, "merkle-top")
    start = root.select("tree", F.expr(f"CAST(array() AS {_CHAIN})").alias("chain"))
    top_paths = _down(top_passes, start, fan, block_levels, "merkle-top")
    paths = _down(passes, _named_paths(top_passes[0], top_paths, fan, block_levels), fan, block_levels, "merkle")
    one_root = root.select(F.col("digest").alias("root"))
    paths = paths.join(roots.withColumnRenamed("digest", "subroot"), "tree").crossJoin(one_root)

    def fold(own: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("rank")
        leaf = own["digest"].tolist()
        block = Block(leaf, fan, None if own["size"].iloc[0] <= per_block else block_levels)
        up, root_ = Path(upper["chain"].iloc[0]), upper["root"].iloc[0]
        edited = [a if isinstance(a, str) else b for a, b in zip(own["edited"].tolist(), leaf, strict=True)]
        folded = [up.fold(block.fold(k, e)) for k, e in enumerate(edited)]
        proofs = [hashlib.sha256((block.siblings(k) + up.siblings).encode()).hexdigest() for k in range(len(leaf))]
        return pd.DataFrame({"doc_id": own["doc_id"], "leaf": leaf, "subroot": upper["subroot"].iloc[0], "root": root_,
                             "proof_sha256": proofs, "folded_root": folded, "verified": [f == root_ for f in folded]})

    return passes[0].groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")) \
        .applyInPandas(fold, _SCHEMA).withColumn("doc_id", F.col("doc_id").cast("long"))


_SCHEMA = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _named_paths(nodes: DataFrame, above: DataFrame, fan: int, levels: int) -> DataFrame:
    """tree, chain: the path of every tree's root within the tree of roots."""
    paths = _chains(nodes, above, fan, levels)
    return nodes.join(paths.select(F.col("block").alias("rank"), "chain"), "rank").select(F.col("name").alias("tree"), "chain")


def document_leaves(docs: DataFrame) -> DataFrame:
    """tree (by source), doc_id, leaf and edited leaf of documents.

    Every second document, by crc32 of its id, is edited: its text loses its
    line breaks.  The others have no edited leaf.
    """
    own = pick(docs, "doc_id", "source", "lang", "n_chars", "text")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    edited = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return own.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("tree"), "doc_id",
        leaf_digest(*columns, F.col("text")).alias("leaf"),
        F.when(edited, leaf_digest(*columns, F.translate("text", "\n", ""))).alias("edited"))

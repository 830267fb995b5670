"""Merkle manifest of a dataset, with proofs for many rows at once.

Every row is a leaf, the SHA-256 of its columns. The leaves of a tree (a source) lie in
order of the id; while several nodes remain, every ``FAN`` consecutive ones become the
hash of their texts. The roots of the trees, in order of the source, are the leaves of
one last tree. All hashes are lowercase hex text.

Proofs are made by partition (``BLOCK`` consecutive leaves of a tree, aligned, so that
what lies below is in one place). A partition works out the smallest set of nodes its
leaves need and it can't derive, level by level: the run mates of its nodes, less the
nodes it has. It fetches that union once, derives the interior nodes its leaves share,
and expands one proof for each leaf. As partitions are aligned, only nodes above them
are fetched, from a table with one row for ``BLOCK`` leaves.

Ranks come from a range sort and counts per (tree, range); so a source with most rows
is spread over many ranges and partitions. Ties of the id are ordered by leaf, so rows
that tie are equal rows and it doesn't matter which is which. Null ids come first, a null
source is a tree of its own before all others, and not the one named ''. An empty table
gives no trees and no rows. Each row is a leaf, repeated rows too. Other columns than
those hashed are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import LOWER, TYPES, UPPER, batch, map_batches, stored

FAN = 16
# Levels below a partition's own top: 16^3 leaves.
LEVELS = 3
BLOCK = FAN**LEVELS
RANGE_ROWS = 1 << 16
HASHED = ["doc_id", "source", "lang", "n_chars", "text"]
# The key of the tree over the trees' roots; those of sources begin with '-' or '='.
TOP = ""


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(columns: list[Column]) -> Column:
    """Hash of the columns as text, each with its length in bytes, '-' for null."""
    parts = [
        F.when(c.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)
        )
        for c in (c.cast("string") for c in columns)
    ]
    return F.sha2(F.concat(*parts), 256)


def tree_key(source: Column) -> Column:
    """A key that is never null and sorts as the source does with null first."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source.cast("string")))


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with ``at``, their place in their ``tree`` from 0, and ``n``, its size."""
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    keys = [F.col("tree"), *order]
    laid = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    laid = laid.withColumn("_number", number).select(
        "*",
        F.shiftright("_number", 33).alias("_range"),
        F.col("_number").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    laid = stored(laid.drop("_number"), name)
    # One row per tree and range it reaches.
    counts = laid.groupBy("tree", "_range").agg(F.count("*").alias("_c"), F.min("_place").alias("_low"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree",
        "_range",
        (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_low")).alias("_shift"),
        F.sum("_c").over(whole).alias("n"),
    )
    placed = laid.join(counts, ["tree", "_range"])
    return placed.withColumn("at", F.col("_place") + F.col("_shift")).drop("_range", "_place", "_shift")


def size_at(n: Column, level: int) -> Column:
    """Nodes of a level in a tree of n leaves."""
    return F.ceil(n / F.lit(FAN**level)).cast("long")


def _parents(nodes: DataFrame, level: int, keys: list[str]) -> DataFrame:
    """Nodes of the next level. A tree that has come to its root keeps it."""
    runs = nodes.groupBy(*keys, "n", F.expr(f"at div {FAN}").alias("at")).agg(
        F.array_sort(F.collect_list(F.struct(nodes["at"].alias("i"), "hash"))).alias("run")
    )
    joined = F.concat_ws("", F.transform("run", lambda x: x["hash"]))
    done = size_at(F.col("n"), level) == 1
    return runs.select(
        *keys, "n", "at", F.when(done, F.col("run")[0]["hash"]).otherwise(F.sha2(joined, 256)).alias("hash")
    )


@dataclass
class Manifest:
    """``leaves``: (tree, block, at, n, doc_id, leaf, shown). ``nodes``: (tree, level, at,
    hash), those from level ``LEVELS`` up, with the top tree's from level 0. ``trees``:
    (tree, n, subroot, place). ``root``: None where there are no rows."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    n_trees: int
    root: str | None


def _grown(nodes: DataFrame, level: int, name: str) -> list[DataFrame]:
    """The levels from ``level`` on, up to where each tree has one node."""
    levels = [stored(nodes, f"{name}-{level}")]
    widest = levels[0].agg(F.max("n")).first()[0] or 0
    while -(-widest // FAN**level) > 1:
        made = _parents(levels[-1].select("tree", "n", "at", "hash"), level, ["tree"])
        level += 1
        levels.append(stored(made.withColumn("level", F.lit(level)), f"{name}-{level}"))
    return levels


def manifest(rows: DataFrame) -> Manifest:
    """The manifest of (tree, doc_id, leaf, shown); ``shown`` is the leaf that a proof
    is tried with."""
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "merkle-leaves")
    order = [F.asc_nulls_first("doc_id"), F.col("leaf"), F.col("row")]
    block = F.expr(f"at div {BLOCK}")
    leaves = ranked(rows, order, "merkle-ranged").drop("row").withColumn("block", block)
    # All levels of a block follow from one exchange: later keys hold the first.
    nodes = leaves.select("tree", "block", "n", "at", F.col("leaf").alias("hash"))
    nodes = nodes.repartition("tree", "block")
    for level in range(LEVELS):
        nodes = _parents(nodes, level, ["tree", "block"])
    levels = _grown(nodes.drop("block").withColumn("level", F.lit(LEVELS)), LEVELS, "merkle-nodes")
    # A tree keeps its root on all later levels.
    roots = levels[-1].select("tree", F.col("n").alias("size"), F.col("hash").alias("subroot"))
    keyed = roots.withColumnsRenamed({"tree": "key"}).withColumn("tree", F.lit(TOP))
    trees = stored(ranked(keyed, [F.col("key")], "merkle-trees"), "merkle-roots")
    top = trees.select("tree", "n", "at", F.col("subroot").alias("hash"), F.lit(0).alias("level"))
    tops = _grown(top, 0, "merkle-top")
    root = tops[-1].first()
    every = [x.select("tree", F.col("level").cast("int").alias("level"), "at", "hash") for x in levels + tops]
    found = every[0]
    for more in every[1:]:
        found = found.unionAll(more)
    return Manifest(
        leaves,
        found,
        trees.select(F.col("key").alias("tree"), F.col("size").alias("n"), "subroot", F.col("at").alias("place")),
        root["n"] if root else 0,
        root["hash"] if root else None,
    )


def missing(known: np.ndarray, n: int) -> list[np.ndarray]:
    """For each level of a tree of n leaves, the nodes that the proofs of the leaves
    ``known`` need and that can't be derived from the levels below."""
    out, size = [], n
    while size > 1:
        runs = np.unique(known // FAN)
        members = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        out.append(np.setdiff1d(members[members < size], known))
        known, size = runs, -(-size // FAN)
    return out


REQUESTS = "tree string, block long, of string, level int, at long"


def requests(blocks: DataFrame, n_trees: int) -> DataFrame:
    """The coordinates each block asks for, of (tree, block, n, place, lowest, highest):
    every leaf of a block is at hand, so from its own top on it knows one node."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out: list[list] = [[] for _ in range(5)]
            for row in part.to_pylist():
                leaves = np.arange(row["low"], row["high"] + 1)
                wanted = [(row["tree"], missing(leaves, row["n"]))]
                wanted.append((TOP, missing(np.array([row["place"]]), n_trees)))
                for of, levels in wanted:
                    for level, places in enumerate(levels):
                        same = row["tree"], row["block"], of, level
                        for column, x in zip(out[:4], same, strict=True):
                            column += [x] * len(places)
                        out[4] += places.tolist()
            yield batch(REQUESTS, *out)

    return map_batches(blocks, step, REQUESTS)


class Tree:
    """Nodes a partition knows, by level: runs as one text, parents derived from runs."""

    def __init__(self, n: int, known: list[dict[int, str]], over: Tree | None, place: int):
        self.over, self.place = over, place
        self.runs: list[dict[int, str]] = []
        level, size = 0, n
        while size > 1:
            nodes = known[level]
            members: dict[int, list[int]] = {}
            for at in sorted(nodes):
                members.setdefault(at // FAN, []).append(at)
            joined = {run: "".join(nodes[at] for at in m) for run, m in members.items()}
            # A run with a gap is no parent: its hash can't be known here.
            whole = {run for run, m in members.items() if len(m) == min(FAN, size - run * FAN)}
            self.runs.append({run: joined[run] for run in whole})
            level, size = level + 1, -(-size // FAN)
            if len(known) == level:
                known.append({})
            known[level].update({run: digest(joined[run]) for run in whole})
        self.upper: dict[tuple[int, int], str] = {}
        self.folded: dict[tuple[int, int, str], str] = {}

    def siblings(self, level: int, at: int) -> str:
        """The other nodes of the runs from here to the root, one after another."""
        if level == len(self.runs):
            return self.over.siblings(0, self.place) if self.over else ""
        if level == 0:
            return self._siblings(level, at)
        key = level, at
        if key not in self.upper:
            self.upper[key] = self._siblings(level, at)
        return self.upper[key]

    def _siblings(self, level: int, at: int) -> str:
        run, cut = self.runs[level][at // FAN], at % FAN * 64
        return run[:cut] + run[cut + 64 :] + self.siblings(level + 1, at // FAN)

    def fold(self, level: int, at: int, node: str) -> str:
        """The root that follows if the node at this place is ``node``."""
        if level == len(self.runs):
            return self.over.fold(0, self.place, node) if self.over else node
        key = level, at, node
        if level and key in self.folded:
            return self.folded[key]
        run, cut = self.runs[level][at // FAN], at % FAN * 64
        found = self.fold(level + 1, at // FAN, digest(run[:cut] + node + run[cut + 64 :]))
        if level:
            self.folded[key] = found
        return found


PROOFS = (
    "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)
SIBLINGS = ", proof array<string>"


def proofs(made: Manifest, siblings: bool = False) -> DataFrame:
    """For each leaf the digest of its proof, the root folded from ``shown`` and that
    proof, and whether that is the root; with ``siblings`` the proof too, as hashes."""
    spark = made.leaves.sparkSession
    schema = PROOFS + (SIBLINGS if siblings else "")
    if made.root is None:
        return spark.createDataFrame([], schema)
    leaves = stored(made.leaves, "merkle-placed")
    blocks = leaves.groupBy("tree", "block", "n").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    blocks = stored(blocks.join(made.trees.drop("n"), "tree"), "merkle-blocks")
    asked = requests(blocks, made.n_trees)
    nodes = made.nodes.withColumnsRenamed({"tree": "of"})
    fetched = (
        asked.join(nodes, ["of", "level", "at"])
        .groupBy("tree", "block")
        .agg(F.collect_list(F.struct((F.col("of") == TOP).alias("top"), "level", "at", "hash")).alias("nodes"))
    )
    known = blocks.select("tree", "block", "n", "subroot", "place").join(fetched, ["tree", "block"], "left")
    n_trees, root = made.n_trees, made.root
    kinds = [part.strip().split(" ", 1) for part in schema.split(", ")]
    shape = pa.schema([(name, TYPES[kind]) for name, kind in kinds])

    def expand(block: pa.Table, about: pa.Table) -> pa.Table:
        [row] = about.to_pylist()
        levels: dict[bool, list[dict[int, str]]] = {True: [{}], False: [{}]}
        for node in row["nodes"] or []:
            levels[node["top"]] += [{} for _ in range(node["level"] + 1 - len(levels[node["top"]]))]
            levels[node["top"]][node["level"]][node["at"]] = node["hash"]
        at, leaf, shown = (block[c].to_pylist() for c in ("at", "leaf", "shown"))
        levels[True][0][row["place"]] = row["subroot"]
        levels[False][0].update(zip(at, leaf, strict=True))
        top = Tree(n_trees, levels[True], None, 0)
        tree = Tree(row["n"], levels[False], top, row["place"])
        paths = [tree.siblings(0, i) for i in at]
        folded = [tree.fold(0, i, h) for i, h in zip(at, shown, strict=True)]
        n = len(at)
        source = None if row["tree"] == "-" else row["tree"][1:]
        columns = [
            block["doc_id"], [source] * n, leaf, [row["subroot"]] * n, [root] * n,
            [digest(p) for p in paths], folded, [x == root for x in folded],
        ]
        if siblings:
            columns.append([[p[i : i + 64] for i in range(0, len(p), 64)] for p in paths])
        return pa.Table.from_arrays(
            [x if isinstance(x, pa.ChunkedArray) else pa.array(x, f.type) for x, f in zip(columns, shape, strict=True)],
            schema=shape,
        )

    needed = leaves.select("tree", "block", "at", "doc_id", "leaf", "shown")
    return needed.groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInArrow(expand, schema)


def holds(leaf: str, steps: list[tuple[str, str]], root: str) -> bool:
    """Whether a leaf and what stands before and after it at each level give the root."""
    for before, after in steps:
        leaf = digest(before + leaf + after)
    return leaf == root


def leaves_of(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(tree, doc_id, leaf, shown) of documents; where ``tampered`` is true the text
    shown has its A-Z in lower case."""
    columns = [F.col(c) for c in HASHED]
    leaf = leaf_hash(columns)
    shown = leaf
    if tampered is not None:
        changed = F.translate(F.col("text").cast("string"), UPPER, LOWER)
        shown = F.when(tampered, leaf_hash([*columns[:-1], changed])).otherwise(F.lit(None))
    made = docs.select(
        tree_key(F.col("source")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf.alias("leaf"), shown.alias("shown"),
    )
    return made.withColumn("shown", F.coalesce("shown", "leaf"))


def report(docs: DataFrame, modulus: int = 5) -> DataFrame:
    """Proofs of all documents, tried with a changed text where ``modulus`` divides the
    crc32 of the id; a null id is not changed."""
    changed = F.crc32(F.col("doc_id").cast("string")) % modulus == 0
    found = proofs(manifest(leaves_of(docs, changed)))
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )

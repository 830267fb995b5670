"""SimHash near-duplicates by a hierarchical index in Gray order.

A fingerprint has bit i if over half of the XXH64 hashes (seed 42) of the text's
3-word shingles have it. Two fingerprints link at ``radius`` or fewer differing bits.

Equal fingerprints are one. The others are sorted by Gray rank, where neighbours
differ in few bits, and cut into blocks with a common prefix, over-full blocks into
parts. Only pairs of blocks whose prefixes differ in at most ``radius`` bits meet: a
block is one row with an array of fingerprints, sent once to each such partner. A
task builds an index over both: groups of eight in Gray order hold the bits that all
their members share (pattern and mask), groups of groups likewise. A pair of groups
whose shared patterns differ in more than ``radius`` bits is pruned with all below it.
What a pair of parts finds leaves its task as a spanning forest, never as all pairs.

Defined results: a text without words, null included, has fingerprint zero and links
like any other; a null id never names a component if another id is there (a component
of null ids has a null id); repeated rows are each reported; an empty table gives no
rows. Fingerprints are 64-bit, so two documents with unequal texts may share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import FOLD, batch, map_batches, stored, utf8
from postlake.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
# Fingerprints in a part, so rows of 64 KB; prefixes have at least so many bits.
PART = 8192
LEAST_BITS = 6
GROUP = 8
# Pairs of groups that a task looks at together.
SLICE = 1 << 12
PRINTS = "doc_id long, text_hash long, fingerprint long"
LINKS = "a long, b long"


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text, counted in slices of bounded size."""
    words = text.translate(FOLD).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*(islice(words, i, None) for i in range(shingle)), strict=False)
    total = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    while hashes := [digest(join(g), SEED) for g in islice(grams, 255 * 64)]:
        counts += _bit_counts(np.array(hashes, np.uint64))
    bits = np.flatnonzero(counts * 2 > total)
    return sum(1 << int(i) for i in bits)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit; up to 255 byte counters add up unspilled."""
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    bits = np.unpackbits(padded.view(np.uint8), bitorder="little")
    sums = bits.view(np.uint64).reshape(-1, 255, 8).sum(axis=1)
    return sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fingerprint as a signed long) of every document."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            prints = np.array([fingerprint(t, shingle) for t in utf8(part["text"])], np.uint64)
            yield batch(PRINTS, part["doc_id"], part["text_hash"], pa.array(prints.view(np.int64)))

    text = F.col("text").cast("string")
    return map_batches(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(text).alias("text_hash"),
            text.alias("text"),
        ),
        step,
        PRINTS,
    )


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in Gray order."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Index:
    """Fingerprints in Gray order; levels of groups with the bits their members share.

    ``levels[0]`` has the groups of fingerprints, the last level a single group.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints[np.argsort(gray_rank(prints))]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        every = some = self.prints
        while True:
            starts = np.arange(0, len(every), GROUP)
            every = np.bitwise_and.reduceat(every, starts)
            some = np.bitwise_or.reduceat(some, starts)
            self.levels.append((every, ~(every ^ some)))
            if len(every) == 1:
                break

    def raised(self, height: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The levels, the top one repeated up to a height."""
        return self.levels + [self.levels[-1]] * (height - len(self.levels))


def near_pairs(a: Index, b: Index, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in a and b of all pairs within the radius, slice by slice."""
    height = max(len(a.levels), len(b.levels))
    left, right = a.raised(height), b.raised(height)
    zero = np.zeros(1, np.int64)
    todo = [(height - 1, zero, zero)]
    offsets = np.arange(GROUP)
    while todo:
        level, i, j = todo.pop()
        if len(i) > SLICE:
            todo += [
                (level, i[at : at + SLICE], j[at : at + SLICE]) for at in range(0, len(i), SLICE)
            ]
            continue
        if level >= 0:
            (pa_, ma), (pb, mb) = left[level], right[level]
            apart = np.bitwise_count((pa_[i] ^ pb[j]) & ma[i] & mb[j])
            i, j = i[apart <= radius], j[apart <= radius]
            n, m = (
                (len(x.prints) if level == 0 else len(x_levels[level - 1][0]))
                for x, x_levels in ((a, left), (b, right))
            )
            same_a = level > 0 and n == len(pa_) == 1
            same_b = level > 0 and m == len(pb) == 1
            ci = i[:, None] if same_a else i[:, None] * GROUP + offsets
            cj = j[:, None] if same_b else j[:, None] * GROUP + offsets
            ci, cj = np.broadcast_arrays(ci[:, :, None], cj[:, None, :])
            ci, cj = ci.ravel(), cj.ravel()
            keep = (ci < n) & (cj < m)
            if a is b:
                keep &= ci <= cj
            if keep.any():
                todo.append((level - 1, ci[keep], cj[keep]))
        else:
            near = (np.bitwise_count(a.prints[i] ^ b.prints[j]) <= radius) & (
                a.prints[i] != b.prints[j]
            )
            if near.any():
                yield i[near], j[near]


class Forest:
    """Smallest label per linked position, from slices of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        label = self.label
        while True:
            lu, lv = label[u], label[v]
            apart = lu != lv
            if not apart.any():
                return
            u, v, lu, lv = u[apart], v[apart], lu[apart], lv[apart]
            np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
            while (up := label[label]).tobytes() != label.tobytes():
                label[:] = up


def _links_of(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> np.ndarray:
    """A spanning forest of the links between two parts, as pairs of fingerprints."""
    left = Index(a)
    right = left if same else Index(b)
    prints = left.prints if same else np.concatenate([left.prints, right.prints])
    shift = 0 if same else len(left.prints)
    forest = Forest(len(prints))
    for i, j in near_pairs(left, right, radius):
        forest.add(i, j + shift)
    linked = np.flatnonzero(forest.label != np.arange(len(prints)))
    return np.stack([prints[linked], prints[forest.label[linked]]])


def links(distinct: DataFrame, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that is linked."""
    spark = distinct.sparkSession
    n = distinct.count()
    bits = max(LEAST_BITS, (n // part).bit_length())
    prefix = F.shiftrightunsigned("fingerprint", 64 - bits)
    distinct = distinct.select("fingerprint", prefix.alias("prefix"))
    counts = stored(
        distinct.groupBy("prefix").agg(F.ceil(F.count("*") / part).cast("int").alias("parts")),
        "simhash-counts",
    )
    parts = stored(
        distinct.join(counts, "prefix")
        .groupBy("prefix", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int").alias("part"))
        .agg(F.collect_list("fingerprint").alias("prints")),
        "simhash-parts",
    )
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    mask = F.explode(F.array(*(F.lit(m).cast("long") for m in masks)))
    other = counts.select(F.col("prefix").alias("to_prefix"), F.col("parts").alias("to_parts"))
    asked = (
        parts.select("*", mask.alias("mask"))
        .withColumn("to_prefix", F.col("prefix").bitwiseXOR(F.col("mask")))
        .filter("to_prefix >= prefix")
        .join(other, "to_prefix")
        .withColumn("to_part", F.explode(F.expr("sequence(0, to_parts - 1)")))
        .filter("to_prefix > prefix or to_part >= part")
    )
    target = parts.select(
        F.col("prefix").alias("to_prefix"), F.col("part").alias("to_part"), F.col("prints").alias("to_prints")
    )
    same = (F.col("to_prefix") == F.col("prefix")) & (F.col("to_part") == F.col("part"))
    pairs = asked.join(target, ["to_prefix", "to_part"]).select(
        "prefix", "part", "to_prefix", "to_part", "prints", "to_prints", same.alias("same")
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(tasks, "prefix", "part", "to_prefix", "to_part")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                a, b = (
                    rows[name][i].values.to_numpy().view(np.uint64)
                    for name in ("prints", "to_prints")
                )
                found = _links_of(a, b, rows["same"][i].as_py(), radius).view(np.int64)
                if found.size:
                    yield batch(LINKS, pa.array(found[0]), pa.array(found[1]))

    return map_batches(pairs, step, LINKS)


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, root): root is one fingerprint of the component."""
    distinct = stored(prints.select("fingerprint").distinct(), "simhash-distinct")
    found = components(links(distinct, radius))
    return distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fingerprint as a long, root, component_id) of every document."""
    prints = stored(fingerprints(docs, shingle), "simhash-prints")
    of_print = stored(classes(prints, radius), "simhash-classes")
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    named = (
        of_print.join(first, "fingerprint")
        .groupBy("root")
        .agg(F.min("first").alias("component_id"))
    )
    of_print = stored(of_print.join(named, "root"), "simhash-classes")
    return prints.join(of_print, "fingerprint")


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents, one of each group of near-duplicates: the smallest id, among
    equal ids the smallest text hash. Rows of equal id and text are one document, of
    which the row stays whose other columns, as JSON, come first."""
    return keep_first(docs, near_duplicates(docs, shingle, radius))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The document of each ``root`` with the smallest id; found: (doc_id, text_hash, root)."""
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    # Three columns that are never null choose the row and meet the kept ones: one shuffle of texts.
    key = ["row_id", "unnamed", "row_hash"]
    kept = stored(
        found.groupBy("root")
        .agg(F.min(place).alias("kept"))
        .select(F.coalesce("kept.doc_id", F.lit(0)).alias("row_id"), "kept.unnamed", F.col("kept.text_hash").alias("row_hash")),
        "simhash-kept",
    )
    names = [f"c{i}" for i in range(len(docs.columns))]
    others = [n for c, n in zip(docs.columns, names, strict=True) if c != "text"]
    row = Window.partitionBy(*key).orderBy(F.to_json(F.struct(*others)))
    doc_id = F.col("doc_id").cast("long")
    carried = (
        docs.select(
            *(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)),
            F.coalesce(doc_id, F.lit(0)).alias("row_id"),
            doc_id.isNull().alias("unnamed"),
            F.xxhash64(F.col("text").cast("string")).alias("row_hash"),
        )
        .withColumn("row_place", F.row_number().over(row))
        .filter("row_place = 1")
    )
    return carried.join(kept, key, "left_semi").select(
        *(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True))
    )

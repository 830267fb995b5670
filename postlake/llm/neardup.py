"""Near-duplicates by Jaccard similarity of word shingles, over SimHash sketches.

The pipeline's near-dedup: fingerprints that differ in three bits are nearly equal
texts, so for a similarity of 0.8 (about a sixth of the bits differ) a document has a
sketch of ``WORDS`` times 64 bits over the set of its shingles. A table picks 64 of
those bits. Documents whose picks begin alike form a block, and within it the
hierarchical Gray-order index of ``simhash`` finds all picks within ``RADIUS`` bits:
groups hold the bits that their members share, and whole groups are pruned by them.
What is within ``APART`` bits over the whole sketch is a candidate. The length of the
common beginning follows from the number of documents, so that blocks keep their
size, and the number of tables from that length, so that a pair right at the
threshold shares a block with probability ``RECALL``.

A task keeps the minimum spanning forest of its candidates by sketch distance, never
all pairs: a group of thousands of copies leaves as one link per member, to what is
closest to it. Each link left is checked exactly, on the shingles of both texts;
what is below the threshold is no link.

Defined results: documents with equal sets of shingles are one, texts without words
(null and empty ones too) among themselves; fewer words than a shingle are one
shingle; repeats of a shingle count once; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import FOLD, batch, map_batches, stored, utf8
from postlake.llm.components import components
from postlake.llm.simhash import Index, keep_first, near_pairs

SHINGLE = 5
SIMILARITY = 0.8
WORDS = 16
# At similarity 0.8 a bit differs with probability 0.1514, so 155 of 1024 do, with a
# standard deviation of 11.5; both bounds lie over two deviations above.
DIFFERS = float(np.arccos(2 * SIMILARITY / (1 + SIMILARITY)) / np.pi)
APART = 180
RADIUS = 17
RECALL = 0.97
PART = 1024
# Candidates that a task holds before it cuts them down to a forest.
HELD = 1 << 18
# Texts fetched by a broadcast of their keys, 16 bytes each; more are joined.
FETCHED = 500_000
PRINTS = "doc_id long, text_hash long, key long, sketch binary"
LINKS = "a long, b long"
SETS = "key long, shingles binary"
# Odd multipliers that make WORDS hashes of one.
MULTIPLIERS = np.random.default_rng(5).integers(1 << 62, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of one text's shingles."""
    words = text.translate(FOLD).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*(islice(words, i, None) for i in range(shingle)), strict=False)
    return np.unique(np.fromiter((digest(join(g)) for g in grams), np.uint64, len(words) - shingle + 1))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """``WORDS`` fingerprints of a set of hashes, counted in slices of bounded size."""
    counts = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), 255):  # as many as a byte counts
        mixed = hashes[at : at + 255, None] * MULTIPLIERS
        mixed ^= mixed >> np.uint64(32)
        mixed *= MULTIPLIERS
        mixed ^= mixed >> np.uint64(29)
        bits = np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)


def sketches(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, key of the set of shingles, sketch) of every document."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keys, found = [], []
            for text in utf8(part["text"]):
                hashes = shingles(text, shingle)
                keys.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                found.append(sketch(hashes).tobytes())
            keys = pa.array(np.array(keys, np.uint64).view(np.int64))
            yield batch(PRINTS, part["doc_id"], part["text_hash"], keys, found)

    return map_batches(_rows(docs), step, PRINTS)


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )


def plan(n: int, part: int = PART, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): the beginning that a block shares, and how many tables that takes."""
    bits = min(60, (n // part).bit_length())
    alike = (1 - DIFFERS) ** bits
    return bits, 1 if bits == 0 else ceil(log(1 - recall) / log(1 - alike))


def picks(words: np.ndarray, table: int, bits: np.ndarray | None = None) -> np.ndarray:
    """The 64 bits of each sketch that a table looks at, the first ones first.

    ``bits`` are those of the sketches, for those who ask for several tables.
    """
    places = np.random.default_rng(table).permutation(64 * WORDS)[:64]
    if bits is None:
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
    picked = np.ascontiguousarray(np.packbits(bits[:, places], axis=1, bitorder="big"))
    return picked.view(">u8").ravel().astype(np.uint64)


class Nearest:
    """The minimum spanning forest, by distance, of links that come slice by slice."""

    def __init__(self, n: int):
        self.n, self.held, self.slices = n, 0, []

    def add(self, u: np.ndarray, v: np.ndarray, apart: np.ndarray) -> None:
        self.slices.append((u, v, apart.astype(np.int64)))
        self.held += len(u)
        if self.held > max(HELD, 4 * self.n):
            self.links()

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """What is kept: every round, each component takes its shortest link."""
        if not self.slices:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        u, v, apart = (np.concatenate(x) for x in zip(*self.slices, strict=True))
        order = np.argsort(apart, kind="stable")
        u, v, apart = u[order], v[order], apart[order]
        label, taken = np.arange(self.n), np.zeros(len(u), bool)
        open_ = np.arange(len(u))
        while len(open_ := open_[label[u[open_]] != label[v[open_]]]):
            first = np.full(self.n, len(u))
            np.minimum.at(first, label[u[open_]], open_)
            np.minimum.at(first, label[v[open_]], open_)
            new = np.unique(first[first < len(u)])
            taken[new] = True
            while True:
                a, b = label[u[new]], label[v[new]]
                if (a == b).all():
                    break
                np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
                while (up := label[label]).tobytes() != label.tobytes():
                    label = up
        self.slices, self.held = [(u[taken], v[taken], apart[taken])], int(taken.sum())
        return u[taken], v[taken]


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts a list into slices of about ``HELD`` in size, of one entry at least."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HELD, "right")))
        yield at, to
        at = to


def _spread(
    rows: np.ndarray, starts: np.ndarray, entries: np.ndarray, others: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The rows of each entry, each beside what goes with the entry."""
    n = starts[entries + 1] - starts[entries]
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return rows[np.repeat(starts[entries], n) + k], np.repeat(others, n)


def _candidates(a: np.ndarray, b: np.ndarray | None, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a followed by b of the forest's links; b None: within a."""
    words = a if b is None else np.concatenate([a, b])
    prints = picks(words, table)
    sides = [np.arange(len(a))] if b is None else [np.arange(len(a)), np.arange(len(a), len(words))]
    # The index is over distinct picks; rows of equal picks are chained to its entries.
    indexes, members, forest = [], [], Nearest(len(words))
    for side in sides:
        distinct, entry = np.unique(prints[side], return_inverse=True)
        index = Index(distinct)
        place = np.empty(len(distinct), np.int64)
        place[np.searchsorted(distinct, index.prints)] = np.arange(len(distinct))
        order = np.argsort(place[entry], kind="stable")
        starts = np.searchsorted(place[entry][order], np.arange(len(distinct) + 1))
        indexes.append(index)
        members.append((side[order], starts))

    (left, ls), (right, rs) = members[0], members[-1]

    def offer(i: np.ndarray, j: np.ndarray) -> None:
        for at, to in _slices(ls[i + 1] - ls[i]):
            rows, to_entry = _spread(left, ls, i[at:to], j[at:to])
            for start, end in _slices(rs[to_entry + 1] - rs[to_entry]):
                v, u = _spread(right, rs, to_entry[start:end], rows[start:end])
                if b is None:
                    u, v = u[u < v], v[u < v]
                apart = np.zeros(len(u), np.int64)
                for word in range(WORDS):
                    apart += np.bitwise_count(words[u, word] ^ words[v, word])
                near = apart <= APART
                if near.any():
                    forest.add(u[near], v[near], apart[near])

    if b is None:
        every = np.arange(len(indexes[0].prints))
        offer(every, every)
    else:
        _, i, j = np.intersect1d(indexes[0].prints, indexes[1].prints, return_indices=True)
        offer(i, j)
    for i, j in near_pairs(indexes[0], indexes[-1], RADIUS):
        if b is None:  # both orders, since rows are offered from the smaller position
            i, j = np.concatenate([i, j]), np.concatenate([j, i])
        offer(i, j)
    return forest.links()


def candidates(distinct: DataFrame, part: int = PART, recall: float = RECALL) -> DataFrame:
    """(a, b): links between keys that may reach the similarity."""
    spark = distinct.sparkSession
    bits, tables = plan(distinct.count(), part, recall)

    def placed(sketched: bool) -> DataFrame:
        """The block of every sketch in every table."""
        schema = "key long, sketch binary, table int, block long" if sketched else "table int, block long"

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                if not rows.num_rows:
                    continue
                words = _words(rows["sketch"].to_pylist())
                every = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
                for table in range(tables):
                    blocks = (
                        picks(words, table, every) >> np.uint64(64 - bits) if bits else np.zeros(len(words), np.uint64)
                    )
                    known = [rows["key"], rows["sketch"]] if sketched else []
                    yield batch(
                        schema, *known,
                        pa.array(np.full(len(words), table, np.int32)), pa.array(blocks.view(np.int64)),
                    )

        return map_batches(distinct.select("key", "sketch"), place, schema)

    # Blocks that are over-full fall into parts, which meet pair by pair. All others are
    # searched where their sketches meet: these are shuffled once, and not stored.
    full = stored(
        placed(False).groupBy("table", "block")
        .agg(F.ceil(F.count("*") / (2 * part)).cast("int").alias("parts"))
        .filter("parts > 1"),
        "neardup-full",
    )
    rows = F.collect_list(F.struct("key", "sketch")).alias("rows")
    found = placed(True)
    alone = found.join(full, ["table", "block"], "left_anti").groupBy("table", "block").agg(rows)
    none = F.lit(None).cast(alone.schema["rows"].dataType)
    alone = alone.select("table", "rows", none.alias("to_rows"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for table, a, b in zip(*(rows[c] for c in ("table", "rows", "to_rows")), strict=True):
                keys, words = _unpacked(a)
                more = None
                if b.is_valid:
                    more_keys, more = _unpacked(b)
                    keys = np.concatenate([keys, more_keys])
                u, v = _candidates(words, more, table.as_py())
                if len(u):
                    yield batch(LINKS, pa.array(keys[u]), pa.array(keys[v]))

    links = map_batches(alone, step, LINKS)
    if full.isEmpty():
        return links.distinct()
    parts = stored(
        found.join(full, ["table", "block"])
        .withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
        .groupBy("table", "block", "parts", "part")
        .agg(rows),
        "neardup-parts",
    )
    asked = parts.withColumn("to_part", F.explode(F.expr("sequence(part, parts - 1)")))
    other = parts.select("table", "block", F.col("part").alias("to_part"), F.col("rows").alias("to_rows"))
    names = ["table", "block", "part", "to_part", "rows", "to_rows"]
    pairs = asked.filter("to_part = part").withColumn("to_rows", none).select(names).unionByName(
        asked.filter("to_part > part").join(other, ["table", "block", "to_part"]).select(names)
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(tasks, *names[:4]).select("table", "rows", "to_rows")
    return links.union(map_batches(pairs, step, LINKS)).distinct()


def _words(found: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(found), np.uint64).reshape(-1, WORDS)


def _unpacked(rows: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    keys, words = rows.values.flatten()
    return keys.to_numpy(), _words(words.to_pylist())


def verified(docs: DataFrame, prints: DataFrame, links: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """The links whose sets of shingles have at least the similarity."""
    needed = stored(
        links.select(F.col("a").alias("key")).union(links.select("b")).distinct()
        .join(prints.groupBy("key").agg(F.min(F.struct("text_hash", "doc_id")).alias("row")), "key")
        .select("key", F.col("row.doc_id").alias("id"), F.col("row.text_hash").alias("hash")),
        "neardup-needed",
    )
    wanted = F.broadcast(needed) if needed.count() <= FETCHED else needed
    rows = _rows(docs)
    texts = rows.join(
        wanted, (rows["text_hash"] == wanted["hash"]) & rows["doc_id"].eqNullSafe(wanted["id"])
    ).select("key", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield batch(SETS, part["key"], [shingles(t, shingle).tobytes() for t in utf8(part["text"])])

    sets = stored(map_batches(texts, encode, SETS).dropDuplicates(["key"]), "neardup-sets")
    pairs = links.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("of_a")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("shingles").alias("of_b")), "b"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keep = []
            for x, y in zip(part["of_a"], part["of_b"], strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield batch(LINKS, part["a"].filter(keep), part["b"].filter(keep))

    return map_batches(pairs.select("a", "b", "of_a", "of_b"), check, LINKS)


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, part: int = PART
) -> DataFrame:
    """(doc_id, text_hash, key, root) of every document; equal roots are one group."""
    prints = stored(sketches(docs, shingle), "neardup-prints")
    distinct = stored(prints.groupBy("key").agg(F.first("sketch").alias("sketch")), "neardup-distinct")
    links = stored(candidates(distinct, part), "neardup-candidates")
    found = components(stored(verified(docs, prints, links, similarity, shingle), "neardup-links"))
    return prints.select("doc_id", "text_hash", "key").join(found, F.col("key") == found["node"], "left").select(
        "doc_id", "text_hash", "key", F.coalesce("root", "key").alias("root")
    )


def one_per_group(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """The documents, one of each group of near-duplicates, chosen as in ``simhash``."""
    return keep_first(docs, stored(near_duplicates(docs, similarity, shingle), "neardup-classes"))

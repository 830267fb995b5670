"""Benchmark decontamination by Wu-Manber search over words.

Texts are seen as sequences of words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after
lower-casing A-Z). A pattern is a window of ``size`` consecutive words of a
benchmark item; an item with fewer words, but at least one, is one pattern.
Patterns of equal length form a table of their own:

* the shift table maps a block of two adjacent words to how far the search may
  move without missing a pattern; a block of no pattern moves it by the most;
* at shift 0 the block, as the suffix of a pattern, selects a bucket, the first
  word narrows it, and the words are compared one by one.

Defined results: a null text has no words and no hit; repeated rows are each
reported; an item without words has no window; an item with a null id marks hits
but is not counted or named; an empty benchmark leaves every document clean.
Only the columns named here are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import FOLD_WORDS, batch, map_batches, texts, utf8

WINDOW = 10
# Windows in one block: each is at most `size` words, and a block is what one
# broadcast holds. A larger benchmark is searched in several blocks.
BLOCK_WINDOWS = 100_000
BLOCK_BYTES = 32 << 20
WINDOWS = "pattern binary, item_id long"
SPANS = "starts array<int>, ends array<int>, items array<long>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD_WORDS).split()


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (pattern, item_id); the pattern holds its words, space-joined."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for item, text in zip(part["item_id"].to_pylist(), utf8(part["text"]), strict=True):
                words = words_of(text)
                if words:
                    found = {
                        b" ".join(words[i : i + size])
                        for i in range(max(1, len(words) - size + 1))
                    }
                    yield batch(WINDOWS, list(found), [item] * len(found))

    items = texts(benchmark, "item_id", "text").withColumn("item_id", F.col("item_id").cast("long"))
    return map_batches(items, step, WINDOWS).distinct()


class Table:
    """Shift table and suffix buckets of patterns with the same number of words."""

    def __init__(self, length: int):
        self.length = length
        self.width = min(2, length)
        self.furthest = length - self.width + 1
        self.shift: dict = {}
        self.buckets: dict = {}

    def add(self, pattern: tuple[bytes, ...], items: list[int]) -> None:
        for end in range(self.width, self.length + 1):
            block = pattern[end - self.width : end]
            left = self.length - end
            self.shift[block] = min(left, self.shift.get(block, self.furthest))
        suffix = self.buckets.setdefault(pattern[-self.width :], {})
        suffix.setdefault(pattern[0], []).append((pattern, items))

    def search(self, words: tuple[bytes, ...]) -> Iterator[tuple[int, list[int]]]:
        """The start of each occurrence, with the items of its pattern."""
        length, width, shift, furthest = self.length, self.width, self.shift, self.furthest
        end, last = length, len(words)
        while end <= last:
            move = shift.get(words[end - width : end], furthest)
            if move:
                end += move
                continue
            start = end - length
            for pattern, items in self.buckets[words[end - width : end]].get(words[start], ()):
                if words[start:end] == pattern:
                    yield start, items
            end += 1


def tables_of(patterns: dict[bytes, list[int]]) -> list[Table]:
    tables: dict[int, Table] = {}
    for pattern, items in patterns.items():
        words = tuple(pattern.split(b" "))
        tables.setdefault(len(words), Table(len(words))).add(words, items)
    return list(tables.values())


def blocks(found: DataFrame, most: int, most_bytes: int) -> Iterator[dict[bytes, list[int]]]:
    """The windows, so many at a time; the driver holds one block."""
    block: dict[bytes, list[int]] = {}
    n = size = 0
    for pattern, item in found.toLocalIterator():
        items = block.setdefault(bytes(pattern), [])
        if item is not None:
            items.append(item)
        n, size = n + 1, size + len(pattern)
        if n >= most or size >= most_bytes:
            yield block
            block, n, size = {}, 0, 0
    if block:
        yield block


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(docs: DataFrame, block: dict[bytes, list[int]]) -> DataFrame:
    """Add what one block of patterns finds to the spans and items so far."""
    held = docs.sparkSession.sparkContext.broadcast(block)
    out = docs.schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of(held.value)
        for part in batches:
            starts, ends, items, counts = [], [], [], []
            for text, s, e, known in zip(
                utf8(part["text"]),
                part["starts"].to_pylist(),
                part["ends"].to_pylist(),
                part["items"].to_pylist(),
                strict=True,
            ):
                words = tuple(words_of(text))
                spans, names = list(zip(s, e, strict=True)), set(known)
                for table in tables:
                    for start, found in table.search(words):
                        spans.append((start, start + table.length))
                        names.update(found)
                spans = merged(spans)
                starts.append([x for x, _ in spans])
                ends.append([x for _, x in spans])
                items.append(sorted(names))
                counts.append(len(words))
            new = {
                "n_words": pa.array(counts, pa.int64()),
                "starts": pa.array(starts, pa.list_(pa.int32())),
                "ends": pa.array(ends, pa.list_(pa.int32())),
                "items": pa.array(items, pa.list_(pa.int64())),
            }
            yield pa.RecordBatch.from_arrays(
                [new.get(name, part[name]) for name in out.names], out.names
            )

    return map_batches(docs, step, out)


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    keys: list[str],
    size: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The key columns and text of every document, ``n_words``, the disjoint word
    spans ``starts``/``ends`` that windows occupy, and the ``items`` found.

    ``keys`` must not be named like the columns added. Documents aren't shuffled:
    each block of patterns is one more pass within the same tasks.
    """
    out = texts(docs, *dict.fromkeys([*keys, "text"])).select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("starts"),
        F.array().cast("array<int>").alias("ends"),
        F.array().cast("array<long>").alias("items"),
    )
    found = windows(benchmark, size)
    empty = True
    for block in blocks(found, block_windows, block_bytes):
        out, empty = _scan(out, block), False
    return _scan(out, {}) if empty else out


def report(found: DataFrame) -> DataFrame:
    """Per document: words, hit words, items found and their digest."""
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    n_hit = F.aggregate(
        F.zip_with("starts", "ends", lambda s, e: (e - s).cast("long")),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark window.

    Columns are carried under names of their own, so none can clash.
    """
    carried = docs.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)),
        F.col("text").cast("string").alias("text"),
    )
    keys = [f"c{i}" for i in range(len(docs.columns))]
    return (
        hits(carried, benchmark, keys, size)
        .filter(F.size("starts") == 0)
        .select(*(F.col(k).alias(c) for k, c in zip(keys, docs.columns, strict=True)))
    )

"""Line dedup by a log-template tree.

A line's place in the tree is its number of tokens and its ``DEPTH`` leading tokens;
tokens with a digit are variable fields and read ``<*>`` everywhere. Below that fixed
depth a leaf has a list of templates: lines that agree in at least ``SAME`` of their
positions belong to one, their other positions being variable fields too. A template
that occurs in more than one document is dropped from all of them but the first, by id.

Two lines that agree are always one template, and so are lines linked by others. The
distinct lines of a leaf meet in one task, which compares a line with those that nothing
has linked to it so far, if they are at most ``PART`` lines of ``PART_BYTES``.

Larger leaves, however large, are done without comparing all their lines. The tokens
below the fixed depth are cut into one segment more than the positions in which two
agreeing lines may differ, so two such lines share a segment. Each distinct line is
compared with the leading line of every segment it has: the most frequent one, then the
one seen first, by id and line number. Where that leaves lines of unequal templates with
a segment in common, all of these are compared with each other, in cells of two parts
that hold as much as a small leaf. This last step is quadratic in such a group of distinct
lines, but not in groups that their leading line holds together. A task sends one link per
line or template, never all pairs.

Lines are those between line feeds; tokens are runs without ASCII white space, but each
character of a script written without spaces is a token. Lines under ``LEAST`` tokens
say too little to be told from chance and stay.

Tasks send, per line, two 64-bit hashes and four bytes per token, never its text; only
leaves seen in two documents go on, only those with unequal lines are compared. Texts
meet their dropped line numbers once.

Defined results: a null text stays null and has no lines, an empty one has one empty
line; rows with equal id are one document (a null id is known by its text); repeats
within a document stay; an empty table stays empty.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch, map_batches, stored, utf8
from postlake.llm.components import components

DEPTH = 3
SAME = 0.8
LEAST = 5
# Lines that are compared with each other at a time, and bytes of their tokens' hashes.
PART = 4096
PART_BYTES = 1 << 20
LINES = "key long, text_hash long, line_no int, leaf long, line long, tokens binary"
SEGMENTS = "bucket long, n long, key long, line_no int, line long"
LINKS = "a long, b long"
# Blocks of Thai and Lao, Myanmar, Khmer, Kana, Han and its compatibility forms.
UNSPACED = (
    r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
)
_DIGIT = re.compile(rb"[0-9]")
_WIDE = re.compile(rb"[\xe0-\xef]")
_TOKEN = re.compile(rf"[{UNSPACED}]|[^\x20\x09-\x0d{UNSPACED}]+")


def masked(line: bytes) -> list[bytes]:
    if _WIDE.search(line):
        tokens = [t.encode() for t in _TOKEN.findall(line.decode())]
    else:
        tokens = line.split()
    if _DIGIT.search(line):
        return [b"<*>" if _DIGIT.search(t) else t for t in tokens]
    return tokens


def document_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def lines(docs: DataFrame, depth: int = DEPTH, least: int = LEAST) -> DataFrame:
    """One row per line of at least ``least`` tokens: its leaf, its hash, its tokens' hashes."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, crc = xxhash.xxh64_intdigest, zlib.crc32
        for part in batches:
            rows: list[list] = [[] for _ in range(6)]
            for key, text_hash, text in zip(
                part["key"].to_pylist(), part["text_hash"].to_pylist(), utf8(part["text"]), strict=True
            ):
                for number, line in enumerate(text.split(b"\n")):
                    tokens = masked(line)
                    if len(tokens) < least:
                        continue
                    lead = b"%d %s" % (len(tokens), b" ".join(tokens[:depth]))
                    hashes = np.array([crc(t) for t in tokens], "<u4")
                    for column, value in zip(
                        rows,
                        (key, text_hash, number, _signed(digest(lead)),
                         _signed(digest(b" ".join(tokens))), hashes.tobytes()),
                        strict=True,
                    ):
                        column.append(value)
            yield batch(LINES, *rows)

    text = F.col("text").cast("string")
    rows = docs.select(document_key().alias("key"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return map_batches(rows, step, LINES)


def segments(tokens: int, depth: int = DEPTH, same: float = SAME) -> list[int]:
    """Where the segments of a line of that many tokens begin, and where the last ends."""
    apart = tokens - math.ceil(same * tokens)
    free = max(0, tokens - depth)
    # Where all that is free may differ, any two lines of the leaf agree.
    parts = apart + 1 if apart < free else 1
    if parts == 1 and apart:
        return [tokens, tokens]
    return [tokens - free + i * free // parts for i in range(parts + 1)]


def _segmented(distinct: DataFrame, depth: int, same: float) -> DataFrame:
    """One row per segment of each distinct line, keyed by leaf, place and tokens."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for part in batches:
            rows: list[list] = [[] for _ in range(5)]
            for leaf, n, key, line_no, line, tokens in zip(
                *(part[c].to_pylist() for c in ("leaf", "n", "key", "line_no", "line", "tokens")),
                strict=True,
            ):
                ends = segments(len(tokens) // 4, depth, same)
                for number, (start, end) in enumerate(zip(ends, ends[1:])):
                    bucket = digest(b"%d %d " % (leaf, number) + tokens[4 * start : 4 * end])
                    for column, value in zip(
                        rows, (_signed(bucket), n, key, line_no, line), strict=True
                    ):
                        column.append(value)
                if len(rows[0]) > 1 << 16:
                    yield batch(SEGMENTS, *rows)
                    rows = [[] for _ in range(5)]
            yield batch(SEGMENTS, *rows)

    return map_batches(
        distinct.select("leaf", "n", "first.key", "first.line_no", "line", "tokens"), step, SEGMENTS
    )


def _templates(
    seen: DataFrame, mixed: DataFrame, depth: int, same: float, part: int = PART
) -> DataFrame:
    """(line, template) of the lines that share a template with other lines."""
    distinct = stored(
        seen.join(mixed, "leaf", "left_semi")
        .groupBy("leaf", "line")
        .agg(
            F.count("*").alias("n"),
            F.min(F.struct("key", "line_no")).alias("first"),
            F.first("tokens").alias("tokens"),
        ),
        "line-distinct",
    )
    large = stored(
        distinct.groupBy("leaf")
        .agg(F.count("*").alias("lines"), F.max(F.length("tokens")).alias("width"))
        .filter(_share("lines", "width", part) > 1)
        .select("leaf"),
        "line-large",
    )
    small = (
        distinct.join(large, "leaf", "left_anti")
        .groupBy("leaf")
        .agg(F.collect_list(F.struct(F.col("line").alias("label"), "tokens")).alias("rows"))
    )
    found = stored(_linked(small, same).toDF("line", "template"), "line-templates")
    if large.isEmpty():
        return found
    return found.union(_large(distinct.join(large, "leaf", "left_semi"), depth, same, part))


def _share(lines: str, width: str, part: int) -> Column:
    """How much a group is of what may be compared at a time."""
    return F.greatest(F.col(lines) / part, F.col(lines) * F.col(width) / PART_BYTES)


def _linked(groups: DataFrame, same: float) -> DataFrame:
    """(a, b): each label that lines of a group link to another one, and the group's name for it."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            a, b = [], []
            for rows in part["rows"]:
                label, tokens = rows.values.flatten()
                label = label.to_numpy()
                words = np.frombuffer(b"".join(tokens.to_pylist()), "<u4").reshape(len(label), -1)
                found = label[linked(words, label, same)]
                moved = found != label
                a.append(label[moved])
                b.append(found[moved])
            if a:
                yield batch(LINKS, pa.array(np.concatenate(a)), pa.array(np.concatenate(b)))

    return map_batches(groups.select("rows"), step, LINKS)


def linked(words: np.ndarray, label: np.ndarray, same: float = SAME) -> np.ndarray:
    """Per line, the place of the first line that equal labels and agreeing lines link it to.

    A line is compared only with lines that nothing has linked to it so far.
    """
    least = same * words.shape[1]
    root, left = np.arange(len(words)), np.arange(len(words))
    while len(left):
        first, left = left[0], left[1:]
        todo = [first]
        while todo and len(left):
            i = todo.pop()
            near = np.count_nonzero(words[left] == words[i], axis=1) >= least
            near |= label[left] == label[i]
            root[left[near]] = first
            todo += left[near].tolist()
            left = left[~near]
    return root


def _large(distinct: DataFrame, depth: int, same: float, part: int) -> DataFrame:
    """(line, template) in leaves of more lines than one task compares."""
    distinct = stored(distinct, "line-distinct")
    parts = stored(_segmented(distinct, depth, same), "line-segments")
    # ~x falls as x rises, without overflow.
    rank = F.struct("n", F.bitwise_not("key"), F.bitwise_not("line_no"), "line")
    leads = stored(
        parts.groupBy("bucket")
        .agg(F.max(rank).alias("lead"), F.count("*").alias("lines"))
        .filter("lines > 1")
        .select("bucket", F.col("lead.line").alias("b"), "lines"),
        "line-leads",
    )
    pairs = stored(
        parts.join(leads, "bucket").select(F.col("line").alias("a"), "b").filter("a <> b").distinct(),
        "line-pairs",
    )
    compared = pairs.join(
        distinct.select(F.col("line").alias("a"), F.col("tokens").alias("x")), "a"
    ).join(distinct.select(F.col("line").alias("b"), F.col("tokens").alias("y")), "b")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            agree = []
            for a, b in zip(part["x"].to_pylist(), part["y"].to_pylist(), strict=True):
                x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
                agree.append(len(x) == len(y) and np.count_nonzero(x == y) >= same * len(x))
            keep = pa.array(agree, pa.bool_())
            yield batch(LINKS, part["a"].filter(keep), part["b"].filter(keep))

    links = map_batches(compared.select("a", "b", "x", "y"), step, LINKS)
    found = stored(
        components(links).select(F.col("node").alias("line"), F.col("root").alias("template")),
        "line-led",
    )
    more = stored(_unled(parts, leads, distinct, found, same, part), "line-more")
    if more.isEmpty():
        return found
    every = more.union(found.select("line", "template"))
    return components(every).select(F.col("node").alias("line"), F.col("root").alias("template"))


def _unled(
    parts: DataFrame, leads: DataFrame, distinct: DataFrame, found: DataFrame, same: float, part: int
) -> DataFrame:
    """(a, b): links between templates that the leading lines left apart."""
    labelled = stored(
        parts.select("bucket", "line")
        .join(leads.select("bucket", "lines"), "bucket")
        .join(found, "line", "left")
        .select("bucket", "lines", "line", F.coalesce("template", "line").alias("label")),
        "line-labels",
    )
    open_ = (
        labelled.groupBy("bucket")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .filter("lo < hi")
        .select("bucket")
    )
    # Any two parts of a bucket meet in a cell, so any two of its lines do.
    cells = (
        labelled.join(open_, "bucket", "left_semi")
        .join(distinct.select("line", "tokens", F.length("tokens").alias("width")), "line")
        .withColumn("parts", F.ceil(2 * _share("lines", "width", part)).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("line"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .filter("other <> part or parts = 1")
        .groupBy("bucket", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
        .agg(F.collect_list(F.struct("label", "tokens")).alias("rows"))
    )
    return _linked(cells, same).distinct()


def dropped(
    docs: DataFrame, depth: int = DEPTH, same: float = SAME, least: int = LEAST
) -> DataFrame:
    """(key, text_hash, drop): the numbers, from 0, of the lines a document loses."""
    seen = stored(lines(docs, depth, least), "lines")
    shared = stored(
        seen.groupBy("leaf")
        .agg(F.min("key").alias("lo"), F.max("key").alias("hi"),
             F.min("line").alias("a"), F.max("line").alias("b"))
        .filter("lo < hi")
        .select("leaf", (F.col("a") < F.col("b")).alias("mixed")),
        "line-leaves",
    )
    templates = _templates(seen, shared.filter("mixed").select("leaf"), depth, same)
    placed = (
        seen.select("key", "text_hash", "line_no", "leaf", "line")
        .join(shared.select("leaf"), "leaf", "left_semi")
        .join(templates, "line", "left")
    )
    placed = stored(
        placed.select(
            "key", "text_hash", "line_no", F.coalesce("template", "line").alias("template")
        ),
        "line-places",
    )
    recurring = stored(
        placed.groupBy("template")
        .agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
        .filter("lo < hi")
        .select("template", "lo"),
        "line-recurring",
    )
    return stored(
        placed.join(recurring, "template")
        .filter("key <> lo")
        .groupBy("key", "text_hash")
        .agg(F.collect_set("line_no").alias("drop")),
        "line-drops",
    )


def without_recurring_lines(
    docs: DataFrame,
    depth: int = DEPTH,
    same: float = SAME,
    least: int = LEAST,
    keep_emptied: bool = True,
) -> DataFrame:
    """The documents, with all their columns, their text without dropped lines.

    ``keep_emptied`` False leaves out documents of which only white space is left
    because all they said stands in earlier documents; that drops copies.
    """
    found, names = _cleaned(docs, depth, same, least)
    if not keep_emptied:
        found = found.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    return found.select(
        *(
            (F.col("text") if c == "text" else F.col(n)).alias(c)
            for c, n in zip(docs.columns, names, strict=True)
        )
    )


def _cleaned(
    docs: DataFrame, depth: int, same: float, least: int
) -> tuple[DataFrame, list[str]]:
    """The columns under names that can't clash, the text left, and counts of lines."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = F.col("text").cast("string")
    carried = docs.select(
        *(
            (F.lit(None).cast("string") if c == "text" else F.col(f"`{c}`")).alias(n)
            for c, n in zip(docs.columns, names, strict=True)
        ),
        document_key().alias("key"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )
    drops = dropped(docs, depth, same, least)
    rows = carried.join(drops, ["key", "text_hash"], "left").select(*names, "text", "drop")
    schema = (
        rows.drop("drop")
        .withColumns({"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")})
        .schema
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts, before, gone = [], [], []
            for text, drop in zip(
                part["text"].cast(pa.string()).to_pylist(), part["drop"].to_pylist(), strict=True
            ):
                found = [] if text is None else text.split("\n")
                away = set(drop or ())
                kept = [line for i, line in enumerate(found) if i not in away]
                texts.append(None if text is None else "\n".join(kept))
                before.append(len(found))
                gone.append(len(found) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [*(part[n] for n in names), pa.array(texts, pa.string()),
                 pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                schema.names,
            )

    return map_batches(rows, step, schema), names


def report(
    docs: DataFrame, depth: int = DEPTH, same: float = SAME, least: int = LEAST
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text left) of every document."""
    found, _ = _cleaned(docs.select("doc_id", "text"), depth, same, least)
    return found.select(F.col("c0").alias("doc_id"), "n_lines", "n_dropped", "text")

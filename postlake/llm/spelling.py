"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case,
of at least ``LEAST`` code points and ``SEEN`` occurrences. Two are near if one inserted,
deleted or replaced code point makes one of the other.

The vocabulary is put into blocked Bloom filters, sharded by length: a word's hash picks
a block of 512 bits in its length's filter, and ``PROBES`` bits in it. Tasks generate
the edits of their words, a column at a time for all words of one length, and probe the
filter of the edit's length; only positives are written out, and the exact join with the
vocabulary removes the false ones. Nearness goes both ways, so a word generates its
deletions, and of its replacements those with a larger letter: every pair is met once.

A broadcast holds at most ``FILTER_BYTES``. A larger vocabulary is dealt, by hash, into
as many slices as that needs, and one pass over the words probes each slice; the letters
that edits use are those of the vocabulary.

A word's form is its near word of largest count (ties: smallest in code-point order) if
that count is ``FACTOR`` times its own or more. Counts rise along forms, so chains end,
after few steps: each step multiplies the count. Roots follow by doubling the pointers.

Defined results: null and empty texts have no words; a null id counts as '' in the hash
that disturbs words; repeated rows count each; an empty table gives no rows. No word has
more near words than it has edits, so no group in a join or count is unbounded.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import LOWER, UPPER, batch, map_batches, stored

LETTERS = r"A-Za-zÀ-ÿ"
LEAST, SEEN, FACTOR = 6, 5, 5
MODULUS = 199
# Bits for each word of a filter, bits set for each, and bits of a block.
BITS, PROBES, BLOCK = 16, 6, 512
FILTER_BYTES = 32 << 20
DISTINCT = 1 << 18
# Words whose edits are generated side by side, and lengths from which one filter serves.
TOGETHER = 1 << 13
LONGEST = 40
_LOWER = str.maketrans(UPPER, LOWER)
COUNTS = "word string, n long"


def disturbed(prefix: int, run: str) -> str:
    """The run as a word: one code point is missing where the hash says so. ``prefix``
    is the crc32 of what stands before the run."""
    h = zlib.crc32(run.encode(), prefix)
    if h % MODULUS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(word, n) over the whole texts of (doc_id, text)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Shorter runs are no words, and deleting a letter makes none of them longer.
        find = re.compile(f"[{LETTERS}]{{{least},}}").finditer
        seen: dict[str, int] = {}

        def flushed() -> pa.RecordBatch:
            out = batch(COUNTS, list(seen), list(seen.values()))
            seen.clear()
            return out

        for part in batches:
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # A document's runs are counted first: equal ones are disturbed alike.
                own: dict[str, int] = {}
                for found in find((text or "").translate(_LOWER)):
                    run = found[0]
                    own[run] = own.get(run, 0) + 1
                    if len(own) >= DISTINCT:
                        add(seen, own, prefix, least)
                        own.clear()
                        yield flushed()
                add(seen, own, prefix, least)
                if len(seen) >= DISTINCT:
                    yield flushed()
        yield flushed()

    def add(seen: dict[str, int], own: dict[str, int], prefix: int, least: int) -> None:
        for run, n in own.items():
            word = disturbed(prefix, run)
            if len(word) >= least:
                seen[word] = seen.get(word, 0) + n

    counted = map_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")), step, COUNTS)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# --- Hashes that follow an edit -------------------------------------------------

# A word's hash is the sum of code(letter) * BASE^place modulo 2^64; BASE is odd, so
# places can move both ways.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def codes(letters: np.ndarray) -> np.ndarray:
    return mixed(letters.astype(np.uint64) + np.uint64(1))


def powers(length: int) -> np.ndarray:
    return np.array([pow(BASE, i, 1 << 64) for i in range(length + 1)], np.uint64)


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as a table of code points."""
    if not words:
        return np.zeros((0, 0), np.uint32)
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def word_hashes(letters: np.ndarray) -> np.ndarray:
    """Unmixed hashes of words of one length."""
    return (codes(letters) * powers(letters.shape[1])[: letters.shape[1]]).sum(axis=1, dtype=np.uint64)


# --- Filters --------------------------------------------------------------------


def shard_of(length: int) -> int:
    return min(length, LONGEST)


def blocks_for(words: int) -> int:
    return max(1, -(-words * BITS // BLOCK))


def bits_of(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The block of each mixed hash, and its bits in the block."""
    block = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    again = mixed(hashes + np.uint64(BASE))
    return block.astype(np.int64), [
        ((again >> np.uint64(9 * i)) & np.uint64(BLOCK - 1)).astype(np.int64) for i in range(PROBES)
    ]


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return mixed(hashes ^ np.uint64(INVERSE)) % np.uint64(slices)


def holds(bits: np.ndarray, blocks: int, hashes: np.ndarray) -> np.ndarray:
    """Which of the mixed hashes a filter may hold."""
    block, places = bits_of(hashes, blocks)
    alive = np.arange(len(hashes))
    for place in places:
        at = block[alive] * BLOCK + place[alive]
        alive = alive[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
    return alive


LANES = "shard int, lane long, bits long"


def filters(words: DataFrame, sizes: dict[int, int], slices: int, number: int) -> dict[int, np.ndarray]:
    """The filters of one slice by shard. Tasks set the bits of their words, 64 to a
    lane, and lanes are combined before they are read: FILTER_BYTES bounds them."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            by_length: dict[int, list[str]] = {}
            for word in part["word"].to_pylist():
                by_length.setdefault(len(word), []).append(word)
            for length, some in by_length.items():
                hashes = mixed(word_hashes(letters_of(some)))
                hashes = hashes[slice_of(hashes, slices) == number]
                block, places = bits_of(hashes, sizes[shard_of(length)])
                at = np.unique(np.concatenate([block * BLOCK + p for p in places]))
                lane, first = np.unique(at >> 6, return_index=True)
                values = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else at
                shard = np.full(len(lane), shard_of(length), np.int32)
                bits = values.astype(np.uint64).view(np.int64)
                yield batch(LANES, pa.array(shard), pa.array(lane), pa.array(bits))

    lanes = map_batches(words.select("word"), step, LANES)
    found = lanes.groupBy("shard", "lane").agg(F.expr("bit_or(bits)").alias("bits")).toPandas()
    out = {}
    for shard, blocks in sizes.items():
        own = found[found["shard"] == shard]
        bits = np.zeros(blocks * BLOCK // 64, np.int64)
        bits[own["lane"].to_numpy()] = own["bits"].to_numpy()
        out[shard] = bits.view(np.uint8)
    return out


POSITIVES = "word string, n long, near string"


def positives(
    words: DataFrame,
    bits: dict[int, np.ndarray],
    sizes: dict[int, int],
    alphabet: np.ndarray,
    slices: int,
    number: int,
) -> DataFrame:
    """(word, n, near): edits of words that the filters may hold."""
    held = words.sparkSession.sparkContext.broadcast((bits, alphabet))

    def kept(hashes: np.ndarray, length: int) -> np.ndarray:
        """Places of the unmixed hashes that are in the slice's filter."""
        shard = shard_of(length)
        if shard not in sizes:
            return np.zeros(0, np.int64)
        hashes = mixed(hashes)
        own = np.flatnonzero(slice_of(hashes, slices) == number) if slices > 1 else np.arange(len(hashes))
        return own[holds(held.value[0][shard], sizes[shard], hashes[own])]

    def edits(some: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
        letters = letters_of(some)
        length = letters.shape[1]
        power, code = powers(length), codes(letters)
        terms = code * power[:length]
        total = terms.sum(axis=1, dtype=np.uint64)
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        every = held.value[1]
        new = codes(every)
        for i in range(length):
            # What follows the deleted letter moves down one place. Of equal letters in
            # a row only the last is deleted: the words would be the same.
            last = np.flatnonzero(letters[:, i] != letters[:, i + 1]) if i + 1 < length else np.arange(len(some))
            rest = (total - before[:, i] - terms[:, i]) * np.uint64(INVERSE)
            at = last[kept((before[:, i] + rest)[last], length - 1)]
            yield at, [some[k][:i] + some[k][i + 1 :] for k in at.tolist()]
            larger, letter = np.nonzero(every[None, :] > letters[:, i][:, None])
            hashes = total[larger] + (new[letter] - code[larger, i]) * power[i]
            hit = kept(hashes, length)
            at = larger[hit]
            chosen = [chr(x) for x in every[letter[hit]].tolist()]
            yield at, [some[k][:i] + c + some[k][i + 1 :] for k, c in zip(at.tolist(), chosen, strict=True)]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            by_length: dict[int, list[tuple[str, int]]] = {}
            for pair in zip(part["word"].to_pylist(), part["n"].to_pylist(), strict=True):
                by_length.setdefault(len(pair[0]), []).append(pair)
            for length, pairs in by_length.items():
                # Long words have many edits, so fewer of them go together.
                count = max(1, TOGETHER * 8 // length)
                for start in range(0, len(pairs), count):
                    some = [w for w, _ in pairs[start : start + count]]
                    times = np.array([n for _, n in pairs[start : start + count]], np.int64)
                    for at, near in edits(some):
                        if len(at):
                            yield batch(POSITIVES, [some[k] for k in at.tolist()], pa.array(times[at]), near)

    return map_batches(words, step, POSITIVES)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), each pair both ways, of a stored vocabulary (word, n)."""
    by_length = words.groupBy(F.char_length("word").alias("length")).count().collect()
    shards: dict[int, int] = {}
    for length, count in by_length:
        shards[shard_of(length)] = shards.get(shard_of(length), 0) + count
    whole = sum(shards.values())
    slices = max(1, -(-whole * BITS // (8 * FILTER_BYTES)))
    # Slices differ a little in size; the blocks are those of an equal share.
    sizes = {shard: blocks_for(-(-count // slices)) for shard, count in shards.items()}
    # The letters of the vocabulary, 90 at most.
    letter = F.explode(F.split("word", "")).alias("letter")
    found = words.select(letter).filter("letter <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(row[0]) for row in found), np.uint32)
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = None
    for number in range(slices):
        bits = filters(words, sizes, slices, number)
        made = stored(
            positives(words, bits, sizes, alphabet, slices, number).join(exact, "near"), "spelling-pairs"
        )
        pairs = made if pairs is None else pairs.unionAll(made)
    one = pairs.select("word", "n", "near", "near_n")
    return one.unionAll(pairs.select("near", "near_n", "word", "n"))


def forms(words: DataFrame, pairs: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word of the vocabulary."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    form_n = -F.col("best.less")
    has = form_n >= F.col("n") * factor
    return joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"),
        F.when(has, form_n).alias("form_n"),
    )


def roots(found: DataFrame) -> DataFrame:
    """Add ``root``, the last of the chain of forms; a word without form is its own.

    Every round lets each word that has a form point twice as far."""
    pointers = stored(found.filter("form is not null").select("word", F.col("form").alias("to")), "spelling-roots")
    while True:
        further = pointers.select(F.col("word").alias("to"), F.col("to").alias("next"))
        moved = pointers.join(further, "to", "left")
        moved = stored(
            moved.select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        pointers = moved.select("word", "to")
        if moved.filter("moved").isEmpty():
            break
    joined = found.join(pointers, "word", "left")
    return joined.withColumn("root", F.coalesce("to", "word")).drop("to")


def report(docs: DataFrame, seen: int = SEEN) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of the documents."""
    words = stored(word_counts(docs).filter(F.col("n") >= seen), "spelling-words")
    found = stored(forms(words, near_words(words)), "spelling-forms")
    return roots(found).select("word", "form", "root", "n", "n_near", "form_n")

"""Hashed character n-grams of words, for many texts at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

# ASCII letters stay; every other ASCII character parts words.
LETTERS = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256))
_MULTIPLIER = np.uint32(0x9E3779B1)


def words_of(text: str) -> list[bytes]:
    """Lower-case words: runs of ASCII letters and of characters outside ASCII."""
    return text.lower().encode("utf-8", "replace").translate(LETTERS).split()


def hashed(buffer: bytes, least: int, most: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, positions and hashes of the n-grams within space-parted words.

    An n-gram counts bytes. It may begin or end with the space beside a word, so
    beginnings and ends of words have n-grams of their own.
    """
    data = np.frombuffer(buffer, np.uint8)
    values = data.astype(np.uint32) + np.uint32(1)
    space = data == 32
    n = len(data)
    total = np.zeros(n, np.uint32)
    inside = np.ones(n, bool)
    power = np.uint32(1)
    for length in range(1, min(most, n) + 1):
        keep = n - length + 1
        total = total[:keep] + values[length - 1 :] * power
        power = np.uint32(int(power) * 0x01000193 & 0xFFFFFFFF)
        if length >= 3:  # the last but one character is now inside
            inside = inside[:keep] & ~space[length - 2 : length - 2 + keep]
        else:
            inside = inside[:keep]
        if length >= least:
            at = np.flatnonzero(inside)
            mixed = (total[at] ^ (total[at] >> np.uint32(15))) * _MULTIPLIER
            yield at, (mixed >> np.uint32(32 - bits)).astype(np.int64)


def grouped(
    texts: Iterable[list[bytes]], most_bytes: int = 1 << 17, most_texts: int = 1 << 16
) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Joined words of consecutive texts, some at a time: the first text's number, the
    buffer, and where each text ends in it. One long text is a group of its own."""
    first, parts, ends, size = 0, [], [], 0
    for i, words in enumerate(texts):
        part = b" " + b" ".join(words) + b" "
        if parts and (size + len(part) > most_bytes or len(parts) == most_texts):
            yield first, b"".join(parts), np.array(ends)
            first, parts, ends, size = i, [], [], 0
        parts.append(part)
        size += len(part)
        ends.append(size)
    if parts:
        yield first, b"".join(parts), np.array(ends)

"""Secret scans: patterns, and password guess costs of values in credential context.

The base spans come from three patterns (assignments, access keys, hex runs). The
method looks at further values that follow a credential word and a separator, whole
up to white space or a quote, and adds those that are costly to guess. The cost, the
log10 of guesses, is the least over all segmentations of the value into

* words of a list, by rank, with capitals and look-alike characters charged extra;
* dates and years;
* repeats of up to ``PERIOD`` characters;
* walks over neighbouring keys, and runs up or down the alphabet or the digits;
* brute-force spans, charged per character by its class;

with a charge for every change of segment, found by dynamic programming from left to
right. A value whose cheapest states all reach the limit is not read further.

Defined results: a null or empty text has no spans; positions are code points, ends
exclusive; repeated rows are each reported. A value that a base span covers is not
added again. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import inf, log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch, map_batches

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "value")

CONTEXT = re.compile(
    r"""(?<![a-z0-9_.-])(?:[a-z0-9]*[_.-])*
    (?:password|passwd|passphrase|passcode|pass|pwd|pin|secret|token|credentials?|bearer
      |authorization|auth|(?:api|access|private|secret|signing|encryption|account|client)[_-]?key)
    ["']?[ \t]*(?:=>|:=|[:=]|[ ]is[ ])[ \t]*(?:(?:bearer|basic|token)[ \t]+)?(["'`]?)""",
    re.IGNORECASE | re.ASCII | re.VERBOSE,
)
_BARE = re.compile(r"""[^\s"'`,;<>()\[\]{}]+""")
_QUOTED = {q: re.compile(rf"[^\s{q}]+") for q in "\"'`"}

# Frequent words in passwords, most frequent first.
COMMON_WORDS = """
password admin welcome login letmein monkey dragon master qwerty abc love hello root
test user guest secret change changeme default pass sunshine princess football baseball
shadow michael superman batman trustno iloveyou freedom whatever starwars computer
internet summer winter spring autumn monday tuesday wednesday thursday friday saturday
sunday january february march april may june july august september october november
december server system manager office company demo example sample placeholder your token
key here none null true false insert value string replace account database oracle mysql
postgres cisco ninja azerty solo access flower cheese cookie orange banana apple silver
gold diamond killer hunter ranger buster soccer hockey tigger charlie jordan thomas robert
daniel andrew jessica jennifer ashley nicole matthew
""".split()
WORD_COST = {word: log10(rank + 2) for rank, word in enumerate(COMMON_WORDS)}
LONGEST = max(map(len, WORD_COST))
# Look-alike characters, and the rows of a keyboard.
LOOKS = str.maketrans("@4301!$57+", "aaeoiisstt")
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
PERIOD = 4
LIMIT = 10.0
BREAK = 0.3
BACK = 64
_DATE = re.compile(
    r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d))",
    re.ASCII,
)
_YEAR = re.compile(r"(?:19|20)\d\d", re.ASCII)
DATE_COST, YEAR_COST = log10(365 * 120), log10(120)


def _neighbours() -> dict[str, str]:
    """Keys beside each other, in a row and on the slant between rows."""
    near: dict[str, set[str]] = {}
    at = {key: (r, c) for r, row in enumerate(ROWS) for c, key in enumerate(row)}
    by_place = {place: key for key, place in at.items()}
    for key, (r, c) in at.items():
        for place in ((r, c - 1), (r, c + 1), (r - 1, c), (r - 1, c + 1), (r + 1, c), (r + 1, c - 1)):
            if place in by_place:
                near.setdefault(key, set()).add(by_place[place])
    return {key: "".join(sorted(keys)) for key, keys in near.items()}


NEAR = _neighbours()


def _brute(char: str) -> float:
    if char.isdigit():
        return 1.0
    return log10(26) + 0.2 * char.isupper() if char.isalpha() and char.isascii() else log10(95)


def _word(text: str) -> float:
    """Cost of a piece as one word of the list, infinite if it is none."""
    low = text.lower()
    plain = low.translate(LOOKS)
    cost = WORD_COST.get(low, WORD_COST.get(plain, inf))
    if cost == inf:
        return inf
    capitals = sum(c.isupper() for c in text)
    if capitals:
        cost += log10(2) if capitals in (1, len(text)) else capitals * log10(2)
    return cost + (0 if low in WORD_COST else log10(2) * sum(a != b for a, b in zip(low, plain, strict=True)))


def guess_cost(value: str, limit: float = inf) -> float:
    """log10 of the guesses the cheapest segmentation needs; beyond ``limit`` any
    number that isn't less than it may be given."""
    n = len(value)
    low = value.lower()
    # best[j]: cheapest way to the first j characters; loose[j]: ending in brute force.
    best, loose = [0.0] + [inf] * n, [inf] * (n + 1)
    dates: dict[int, list[int]] = {}
    for match in (m for p in (_DATE, _YEAR) for i in range(n) if (m := p.match(value, i))):
        if match.start() + 4 <= match.end():
            dates.setdefault(match.end(), []).append(match.start())
    walk = step = 0  # where the current key walk and alphabet run begin
    repeats = [0] * (PERIOD + 1)
    for j in range(1, n + 1):
        char = value[j - 1]
        cost = _brute(char)
        loose[j] = min(loose[j - 1], best[j - 1] + (BREAK if j > 1 else 0.0)) + cost
        found = loose[j]
        for i in range(max(0, j - LONGEST), j - 1):
            if (word := _word(value[i:j])) < inf:
                found = min(found, best[i] + word + (BREAK if i else 0.0))
        for i in dates.get(j, ()):
            found = min(found, best[i] + (YEAR_COST if j - i == 4 else DATE_COST) + (BREAK if i else 0.0))
        if j > 1 and low[j - 1] not in NEAR.get(low[j - 2], ""):
            walk = j - 1
        delta = ord(char) - ord(value[j - 2]) if j > 1 else 0
        same = j > 2 and delta == ord(value[j - 2]) - ord(value[j - 3])
        if abs(delta) != 1 or not char.isalnum():
            step = j - 1
        elif not same and j - step > 2:
            step = j - 2
        for start, unit in ((walk, log10(47)), (step, log10(36) + log10(2))):
            for i in {start, *range(max(start, j - BACK), j - 2)}:
                if j - i >= 3:
                    turns = log10(4) * 0.5 * (j - i - 1) if start is walk else 0.0
                    found = min(found, best[i] + unit + log10(j - i) + turns + (BREAK if i else 0.0))
        for period in range(1, PERIOD + 1):
            if j <= period or char != value[j - 1 - period]:
                repeats[period] = j - period if j > period else 0
            start = max(0, repeats[period])
            unit = sum(map(_brute, value[start : start + period]))
            if j - start >= 2 * period and j - start >= 3:
                found = min(found, best[start] + unit + log10((j - start) / period) + (BREAK if start else 0.0))
        best[j] = found
        if j >= BACK and j % 16 == 0 and min(min(best[j - BACK : j + 1]), best[walk], best[step], *(best[max(0, r)] for r in repeats)) >= limit:
            return limit
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns."""
    found = []
    if ":" in text or "=" in text:
        found += [
            (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE
        ]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def value_spans(text: str, base: list[tuple[int, int, int]], limit: float = LIMIT) -> list[tuple[int, int, int]]:
    """(start, kind, end) of costly values in credential context that no base span covers."""
    found, covered = [], 0
    at = 0
    low = None
    if not (":" in text or "=" in text or " is " in text.lower()):
        return found
    for match in CONTEXT.finditer(text):
        value = (_QUOTED[match[1]] if match[1] else _BARE).match(text, match.end())
        if not value or value.start() < covered:
            continue
        start, end = value.span()
        if not match[1]:
            end -= len(value[0]) - len(value[0].rstrip(".!?:"))
        if end - start < LEAST_VALUE:
            continue
        while at < len(base) and base[at][2] <= start:
            at += 1
        if any(s <= start and end <= e for s, _, e in base[at : at + 8]):
            continue
        if guess_cost(text[start:end], limit) >= limit:
            found.append((start, 3, end))
            covered = end
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


OUT = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "spans string, n_value long"
)


def scan(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Per document the number of spans by kind, the digest of the base spans, and all
    spans as ``kind:start:end``, by start and kind; no shuffle."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows: list[list] = [[] for _ in range(6)]
            for text in part["text"].to_pylist():
                base = base_spans(text or "")
                more = value_spans(text or "", base, limit)
                kinds = [k for _, k, _ in base]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                for column, value in zip(
                    rows,
                    (kinds.count(0), kinds.count(1), kinds.count(2), digest,
                     joined(sorted(base + more)), len(more)),
                    strict=True,
                ):
                    column.append(value)
            yield batch(OUT, part["doc_id"], *rows)

    text = F.col("text").cast("string").alias("text")
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), step, OUT)

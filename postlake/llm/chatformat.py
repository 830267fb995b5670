"""Conversations as training text, from typed content parts.

A turn's content is plain text or parts: text, image, audio, document. A visitor walks
them in order and makes one flat block per turn: text stands escaped, every attachment
is a numbered placeholder, and its reference and the tokens it will expand to are kept
in a list beside the block. Parts of a document are visited between its placeholder and
its end.

    <turn ROLE>            "\\\\" stands for "\\", "\\l" for "<", "\\g" for ">" in texts and
    text <image 1> text    roles, so "<" and ">" occur in control strings only, and
    </turn>                reading back gives every text as it was

The loss mask is a list of spans, code points of the formatted conversation, over the
texts of assistant turns; placeholders are outside it.

Blocks are made where the turns lie. Then turns are brought into the order of their
conversation and put together as a stream: a conversation leaves in pieces of whole
turns, about ``PIECE`` characters each, and no conversation is ever held as a whole. Its
stream is one task, as a digest over all its text in order has to be; only narrow work
is left for it, and the sort before it spills.

Defined results: a null text is empty, a null role is ''; turns are in order of ``turn``,
null first, then role and text, so rows that tie are equal rows; rows with a null
conversation id are one conversation; repeated rows are turns each. An empty table gives
no rows. Content given as parts that isn't a JSON array of objects is one text; a part
of unknown type, or without one, is an attachment of kind "other"; a size that isn't a
positive number counts as missing.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, isfinite

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch, map_batches

LEARNED = "assistant"
KINDS = ["image", "audio", "document"]
PIECE = 1 << 20
ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
_ESCAPE = str.maketrans(ESCAPES)
_PLAIN = {code[1]: sign for sign, code in ESCAPES.items()}
_CODE = re.compile(r"\\(.)", re.DOTALL)
_OPEN, _CLOSE = "<turn ", "</turn>\n"


def escape(text: str) -> str:
    return text.translate(_ESCAPE)


def unescape(text: str) -> str:
    return _CODE.sub(lambda m: _PLAIN[m[1]], text) if "\\" in text else text


@dataclass(frozen=True)
class Expansion:
    """Tokens of an attachment: per patch of an image, second of audio, page of a
    document; ``missing`` where its size isn't known."""

    patch: int = 28
    per_second: float = 25.0
    per_page: int = 1024
    missing: int = 256


def _size(part: dict, name: str) -> float | None:
    value = part.get(name)
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    return value if number and isfinite(value) and value > 0 else None


@dataclass
class Visitor:
    """Flattens the parts of one turn; ``learned`` says that its texts are masked in."""

    expansion: Expansion
    learned: bool
    out: list[str] = field(default_factory=list)
    length: int = 0
    starts: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    kinds: list[str] = field(default_factory=list)
    refs: list[str | None] = field(default_factory=list)
    tokens: list[int] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def visit_text(self, text: str) -> None:
        start = self.length
        self.write(escape(text))
        if not self.learned or self.length == start:
            return
        if self.ends and self.ends[-1] == start:
            self.ends[-1] = self.length
        else:
            self.starts.append(start)
            self.ends.append(self.length)

    def placeholder(self, kind: str, part: dict, tokens: int) -> None:
        ref = part.get("ref")
        self.kinds.append(kind)
        self.refs.append(ref if isinstance(ref, str) or ref is None else json.dumps(ref))
        self.tokens.append(tokens)
        self.write(f"<{kind} {len(self.kinds)}>")

    def visit_image(self, part: dict) -> None:
        wide, high = _size(part, "width"), _size(part, "height")
        known = wide is not None and high is not None
        patch = self.expansion.patch
        self.placeholder("image", part, ceil(wide / patch) * ceil(high / patch) if known else self.expansion.missing)

    def visit_audio(self, part: dict) -> None:
        seconds = _size(part, "seconds")
        tokens = self.expansion.missing if seconds is None else ceil(seconds * self.expansion.per_second)
        self.placeholder("audio", part, tokens)

    def visit_document(self, part: dict) -> None:
        """The document itself; what it holds is visited next and counted by itself."""
        if isinstance(part.get("parts"), list):
            self.placeholder("document", part, 0)
            return
        pages = _size(part, "pages")
        tokens = self.expansion.missing if pages is None else ceil(pages) * self.expansion.per_page
        self.placeholder("document", part, tokens)

    def visit(self, parts: list[dict]) -> None:
        """All parts in order, documents' parts where they stand."""
        open_: list = list(reversed(parts))
        while open_:
            part = open_.pop()
            if part is None:
                self.write("</document>")
            elif not isinstance(part, dict):
                self.visit_text(part if isinstance(part, str) else json.dumps(part))
            elif part.get("type") == "text":
                text = part.get("text")
                self.visit_text(text if isinstance(text, str) else "" if text is None else json.dumps(text))
            elif part.get("type") in KINDS:
                getattr(self, f"visit_{part['type']}")(part)
                if part["type"] == "document" and isinstance(part.get("parts"), list):
                    open_.append(None)
                    open_ += reversed(part["parts"])
            else:
                self.placeholder("other", part, self.expansion.missing)


def parts_of(content: str) -> list[dict]:
    """The parts of a JSON array of objects; any other content is one text."""
    try:
        parts = json.loads(content)
    except (ValueError, RecursionError):
        parts = None
    if isinstance(parts, list) and all(isinstance(part, dict) for part in parts):
        return parts
    return [{"type": "text", "text": content}]


def visited(role: str, parts: list[dict], expansion: Expansion) -> Visitor:
    """A turn's block: markers, texts, placeholders."""
    visitor = Visitor(expansion, role == LEARNED)
    visitor.write(f"{_OPEN}{escape(role)}>\n")
    visitor.visit(parts)
    visitor.write(_CLOSE)
    return visitor


LISTS = "starts array<long>, ends array<long>, kinds array<string>, refs array<string>, tokens array<long>"
BLOCKS = f"conv_id long, turn long, role string, text string, block string, {LISTS}"


def blocks(turns: DataFrame, typed: bool = False, expansion: Expansion | None = None) -> DataFrame:
    """Each turn of (conv_id, turn, role, text) with its ``block`` and the lists beside
    it; with ``typed`` the text holds parts as JSON."""
    rule = expansion or Expansion()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            made: list[list] = [[] for _ in range(6)]
            for role, text in zip(part["role"].to_pylist(), part["text"].to_pylist(), strict=True):
                found = parts_of(text or "") if typed else [{"type": "text", "text": text or ""}]
                turn = visited(role or "", found, rule)
                for column, x in zip(
                    made,
                    ("".join(turn.out), turn.starts, turn.ends, turn.kinds, turn.refs, turn.tokens),
                    strict=True,
                ):
                    column.append(x)
            yield batch(BLOCKS, part["conv_id"], part["turn"], part["role"], part["text"], *made)

    columns = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return map_batches(columns, step, BLOCKS)


PIECES = f"conv_id long, piece long, n_turns long, formatted string, {LISTS}, turns array<long>"


def formatted(made: DataFrame, piece: int = PIECE) -> DataFrame:
    """Conversations in order, as pieces of whole turns, from ``blocks``.

    Spans count from the start of the conversation. ``turns`` are the places, from 0,
    of the turns that the attachments belong to.
    """
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    laid = made.repartition("conv_id").sortWithinPartitions(*order)
    lists = ["starts", "ends", "kinds", "refs", "tokens"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, place, offset, first = None, 0, 0, 0, True
        texts: list[str] = []
        held: dict[str, list] = {name: [] for name in [*lists, "turns"]}
        size = count = 0

        def flushed() -> pa.RecordBatch:
            row = [key], [number], [count], ["".join(texts)], *([held[n]] for n in [*lists, "turns"])
            out = batch(PIECES, *row)
            texts.clear()
            for name in held:
                held[name] = []
            return out

        for part in batches:
            columns = [part[c].to_pylist() for c in ("conv_id", "block", *lists)]
            for conv, block, starts, ends, *rest in zip(*columns, strict=True):
                if first or conv != key:
                    if not first:
                        yield flushed()
                    key, number, place, offset, first = conv, 0, 0, 0, False
                    size = count = 0
                elif size + len(block) > piece and count:
                    yield flushed()
                    number, size, count = number + 1, 0, 0
                texts.append(block)
                held["starts"] += [x + offset for x in starts]
                held["ends"] += [x + offset for x in ends]
                for name, values in zip(lists[2:], rest, strict=True):
                    held[name] += values
                held["turns"] += [place] * len(rest[0])
                offset, size, count, place = offset + len(block), size + len(block), count + 1, place + 1
        if not first:
            yield flushed()

    return map_batches(laid.drop("turn", "role", "text"), step, PIECES)


_SIGN = re.compile(r"<([^>]*)>")


def read_turns(text: str) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """(role, parts) of each turn of formatted text; a part is ("text", its text) or
    ("sign", a placeholder)."""
    at = 0
    while at < len(text):
        if not text.startswith(_OPEN, at):
            raise ValueError(f"no turn at {at}")
        body = text.index(">\n", at) + 2
        end = text.index(_CLOSE, body)
        role = unescape(text[at + len(_OPEN) : body - 2])
        parts, done = [], body
        for sign in _SIGN.finditer(text, body, end):
            if sign.start() > done:
                parts.append(("text", unescape(text[done : sign.start()])))
            parts.append(("sign", sign[1]))
            done = sign.end()
        if end > done:
            parts.append(("text", unescape(text[done:end])))
        yield role, parts
        at = end + len(_CLOSE)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, what is read back from its pieces: digests of all turns, and of
    the text under the loss mask. Takes ``formatted`` as it is, pieces in order."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first = None, True
        n = chars = learned = 0
        turns = loss = hashlib.sha256()

        def row() -> pa.RecordBatch:
            return batch(DIGESTS, [key], [n], [turns.hexdigest()], [learned], [loss.hexdigest()], [chars])

        for part in batches:
            columns = [part[c].to_pylist() for c in ("conv_id", "formatted", "starts", "ends")]
            for conv, text, starts, ends in zip(*columns, strict=True):
                if first or conv != key:
                    if not first:
                        yield row()
                    key, first, n, chars, learned = conv, False, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, parts in read_turns(text):
                    said = "".join(x for kind, x in parts if kind == "text")
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for start, end in zip(starts, ends, strict=True):
                    said = unescape(text[start - chars : end - chars])
                    loss.update(said.encode())
                    learned += len(said)
                chars += len(text)
        if not first:
            yield row()

    return map_batches(pieces, step, DIGESTS)


def report(turns: DataFrame) -> DataFrame:
    """Digests of all conversations of plain texts."""
    return digests(formatted(blocks(turns)))

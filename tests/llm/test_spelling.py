"""Near words against brute force over all pairs."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from postlake.llm import spelling

from tests.llm.cases import LONG, documents, empty, plain


def words_of(rows) -> Counter:
    found: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                found[run] += 1
    return found


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(rows, seen: int = 5) -> list[tuple]:
    n = {w: c for w, c in words_of(rows).items() if c >= seen}
    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {}
    for w, some in near.items():
        if some:
            best = min(some, key=lambda x: (-n[x], x))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


CHAIN = (
    ["colour"] * 400 + ["colours"] * 70 + ["colourss"] * 12 + ["color"] * 30 + ["colors"] * 30
    + ["banana"] * 60 + ["bananna"] * 9 + ["bannana"] * 9 + ["banan\u00e1"] * 5 + ["panama"] * 60
    + ["aaaaaa"] * 50 + ["aaaaaaa"] * 8 + ["aaaaab"] * 8 + ["\u00ffoghurt"] * 40 + ["yoghurt"] * 7
    + ["Signal"] * 20 + ["SIGNAL"] * 20 + ["signul"] * 4
)


def rows(texts) -> list[tuple]:
    return [(i, text) for i, text in enumerate(texts)]


def check(spark, some) -> list[tuple]:
    got = [tuple(r) for r in spelling.report(plain(spark, some)).collect()]
    assert Counter(got) == Counter(expected(some))
    return got


def test_chains_ties_and_letters(spark):
    got = {r[0]: r for r in check(spark, rows(CHAIN))}
    assert got["colourss"][1:3] == ("colours", "colour")
    assert got["\u00ffoghurt"][4] == 1 and got["yoghurt"][1] == "\u00ffoghurt"
    assert "signul" not in got and "color" not in got
    # Two near words of equal count: none outweighs the other.
    assert got["banana"][1] is None


def test_disturbed_words(spark):
    """Enough ids that the hash deletes letters, a run of six among them."""
    some = [(i, "wonderful thingy \u00c9toiles") for i in range(4000)]
    got = {r[0] for r in check(spark, some)}
    assert "hingy" not in got and len(got) > 3


@pytest.mark.parametrize("size", [64, 4096])
def test_slices_give_the_same(spark, monkeypatch, size):
    monkeypatch.setattr(spelling, "FILTER_BYTES", size)
    rng = np.random.default_rng(5)
    made = ["".join(rng.choice(list("abcd\u00e9"), int(rng.integers(6, 9)))) for _ in range(300)]
    check(spark, rows(w for w in made for _ in range(int(rng.integers(5, 40)))))


def test_full_filter_is_only_slower(spark, monkeypatch):
    """With hardly any bits nearly every edit is positive; the exact join decides."""
    monkeypatch.setattr(spelling, "BITS", 1)
    check(spark, rows(CHAIN))


def test_hard_rows_and_long_words(spark):
    docs = documents(spark)
    got = [tuple(r) for r in spelling.report(docs, seen=2).collect()]
    assert Counter(got) == Counter(expected([(r["doc_id"], r["text"]) for r in docs.collect()], seen=2))
    long = "x" * 3000
    some = rows([long] * 30 + [long + "y"] * 5 + [LONG, None, "", " \n"])
    assert {r[1] for r in check(spark, some)} == {None, long}


def test_empty(spark):
    assert spelling.report(empty(spark)).count() == 0


def test_edit_hashes_follow_the_edits():
    words = ["banana", "orange"]
    letters = spelling.letters_of(words)
    power, code = spelling.powers(6), spelling.codes(letters)
    total = spelling.word_hashes(letters)
    terms = code * power[:6]
    for i in range(6):
        before = terms[:, :i].sum(axis=1, dtype=np.uint64)
        shorter = before + (total - before - terms[:, i]) * np.uint64(spelling.INVERSE)
        assert (shorter == spelling.word_hashes(spelling.letters_of([w[:i] + w[i + 1 :] for w in words]))).all()

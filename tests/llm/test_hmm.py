from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from postlake.llm import hmm as h
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.cases import TEXTS, documents, empty


def small_model(states=2, symbols=4, seed=0):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.random(states), rng.random((states, states)), rng.random((symbols, states))
    return h.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, text):
    """Probability of each state path with the text."""
    for path in itertools.product(range(len(model.start)), repeat=len(text)):
        p = model.start[path[0]] * model.emit[text[0], path[0]]
        for a, b, x in zip(path, path[1:], text[1:], strict=False):
            p *= model.move[a, b] * model.emit[x, b]
        yield path, p


TEXT_SET = [np.array(t) for t in ([3, 1, 0, 2, 2, 1], [0], [1, 1, 3], [2, 0, 3])]


def test_forward_is_exact():
    model = small_model()
    for chosen, lengths, symbols in h.side_by_side(TEXT_SET, 100):
        got = h.forward(model, lengths, symbols)
        for i, value in zip(chosen, got, strict=True):
            assert value == pytest.approx(math.log(sum(p for _, p in paths(model, TEXT_SET[i]))))


def test_expected_counts_are_exact():
    model = small_model(3, 4, 1)
    got, want = h.zeros(model), h.zeros(model)
    for _, lengths, symbols in h.side_by_side(TEXT_SET, 7):
        h.expected(model, lengths, symbols, got)
    for text in TEXT_SET:
        total = sum(p for _, p in paths(model, text))
        for path, p in paths(model, text):
            want[0][path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                want[1][a, b] += p / total
            for x, s in zip(text, path, strict=True):
                want[2][x, s] += p / total
    for a, b in zip(got, want, strict=True):
        assert np.allclose(a, b)


def test_model_is_a_distribution_over_texts():
    """Short texts over all symbols, ended, have at most the whole probability."""
    model = small_model(2, 3, 2)
    total = sum(
        math.exp(h.forward(model, np.array([n]), np.array(t))[0])
        for n in range(1, 12)
        for t in itertools.product((0, 1), repeat=n - 1)
        for t in [[*t, 2]]
    )
    assert 0.8 < total <= 1 + 1e-9


def test_rounds_raise_the_likelihood(spark):
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(0, 5, 30) + 5 * (i % 2), [10, 11]) for i in range(40)]
    frame = spark.createDataFrame([(bytearray(t.astype("<u2").tobytes()),) for t in texts], "symbols binary")
    base = np.full(12, 1 / 12)
    model, values = h.Model.first(base, 3), []
    for _ in range(4):
        values.append(sum(h.forward(model, l, s).sum() for _, l, s in h.side_by_side(texts, 500)))
        model = h.baum_welch(frame.repartition(3), model, base)
    assert all(b > a for a, b in zip(values, values[1:], strict=False))


def test_tokens_without_a_symbol_are_learned(spark, monkeypatch):
    """Two kinds of texts whose words are all too rare for a symbol of their own, but for
    one marker each: a held-out text of one kind's words scores above one that mixes them."""
    monkeypatch.setattr(h, "SYMBOL", 0.05)
    rng = np.random.default_rng(4)

    def text(kind, n=20):
        return " ".join(f"{kind} {kind}w{i}" for i in rng.integers(0, 60, n))

    rows = [(i, text("ab"[i % 2]), None, None) for i in range(300)]
    words = rng.integers(0, 60, 20)
    rows += [(1000, " ".join(f"{'ab'[k]} {'ab'[k]}w{i}" for i in words), None, None) for k in (0, 1)]
    rows += [(1001, " ".join(f"{'ab'[k]} {'ba'[k]}w{i}" for i in words), None, None) for k in (0, 1)]
    got = h.scores(documents(spark, rows), F.col("doc_id") >= 1000, states=2).filter("held_out").collect()
    own, mixed = (sum(r.score - r.base_score for r in got if r.doc_id == i) for i in (1000, 1001))
    assert own > mixed + 20


def test_rounds_go_on_until_settled(spark, monkeypatch):
    """As long as a round gains, another follows, however few are asked for."""
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(0, 5, 30) + 5 * (i % 2), [10, 11]) for i in range(40)]
    rows = [(i, bytearray(t.astype("<u2").tobytes()), len(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, symbols binary, n_tokens long")
    monkeypatch.setattr(h, "START_ROUNDS", 0)
    known = h.Vocabulary(np.arange(10), np.full(10, 120), 1280, 12, 40)

    def value(model):
        return sum(h.forward(model, l, s).sum() for _, l, s in h.side_by_side(texts, 500))

    model = h.train(frame, known, 3, rounds=1)
    after = h.baum_welch(frame, model, known.base())
    assert value(after) - value(model) < 2 * h.SETTLED * known.total


def brute(rows, modulus=7, held_out=2):
    low = {i: i + 32 for i in range(65, 91)}
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % modulus == held_out for i, _ in rows]
    counts, ends = Counter(), 0
    for out, own in zip(held, tokens, strict=True):
        if not out:
            counts.update(own)
            ends += 1
    n = sum(counts.values()) + ends
    scale = n + len(counts) + (ends > 0) + 1
    return [
        (i, out, len(own) + 1, sum(counts[w] > 0 for w in own) + (ends > 0), n,
         sum(math.log10((counts[w] + 1) / scale) for w in own) + math.log10((ends + 1) / scale))
        for (i, _), out, own in zip(rows, held, tokens, strict=True)
    ]


@pytest.mark.parametrize("heavy", [2e-6, 0.02])
def test_base_against_brute_force(spark, heavy, monkeypatch):
    monkeypatch.setattr(h, "HEAVY", heavy)
    monkeypatch.setattr(h, "SYMBOL", max(heavy, h.SYMBOL))
    rows = [(r[0], r[1]) for r in TEXTS] + [(i, f"alpha word{i % 977} unseen{i} END") for i in range(30, 60)]
    got = h.report(documents(spark, [(*r, None, None) for r in rows])).collect()
    order = lambda r: repr((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)))
    for a, b in zip(sorted(map(tuple, got), key=order), sorted(brute(rows), key=order), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] < 0


def test_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = h.report(docs).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) and len(rows) > 100
    known = {i: b for i, _, _, _, _, b in brute([(r.doc_id, r.text) for r in docs.collect()])}
    assert all(r.base_score == pytest.approx(known[r.doc_id]) for r in rows)


def test_empty_table_and_no_training(spark):
    from pyspark.sql import functions as F

    assert h.report(empty(spark)).count() == 0
    rows = h.scores(documents(spark), F.lit(True)).collect()
    assert len(rows) == len(TEXTS)
    assert all(r.base_score == 0 and r.n_known == 0 and r.score <= 0 for r in rows)

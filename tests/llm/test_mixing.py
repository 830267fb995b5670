from __future__ import annotations

import random

import pytest
from postlake.llm import mixing as m
from pyspark.sql import functions as F

from tests.llm.cases import documents, empty


def test_targets_are_shared_anew(spark):
    sizes = spark.createDataFrame(
        [("b", 10), ("a", 100), ("a", 20), (None, 5), ("c", 1000), ("d", 0)], "source string, size long"
    )
    got = {r.source: r for r in m.proportional_targets(sizes).collect()}
    # Weights a 3, b 1, c 2, d 3, null 1; 1.5 * 1135 words; all but c are full.
    assert got["a"].target == 240 and got["b"].target == 20 and got[None].target == 10
    assert got["d"].target == 0
    assert got["c"].target == pytest.approx(1.5 * 1135 - 270)


def test_words_taken_meet_targets(spark):
    rng = random.Random(5)
    rows = [
        (i, "w " * int(rng.lognormvariate(3, 1.2)), rng.choices("abcde", [40, 30, 20, 9, 1])[0])
        for i in range(600)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = m.mix(docs).collect()
    again = m.mix(docs.orderBy(F.rand(1))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    source = {i: s for i, _, s in rows}
    for name in "abcde":
        own = [r for r in got if source[r.doc_id] == name]
        assert len({r.target for r in own}) == 1
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies for r in own)


def test_rates_solve_the_dual(spark):
    rows = [(i, "w " * (1 + i % 37), "s") for i in range(300)]
    documents_ = m.sized(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    total = sum(1 + i % 37 for i in range(300))
    for share in (0.3, 1.0, 1.7):
        targets = spark.createDataFrame(
            [("s", 300, total, share * total)], "source string, docs long, source_size long, target double"
        )
        found = m.multipliers(documents_, targets).first()
        mean = total / 300
        import math

        rates = [min(2.0, math.exp(min(1, found.multiplier * (1 + i % 37) / mean))) for i in range(300)]
        assert sum(r * (1 + i % 37) for i, r in enumerate(rates)) == pytest.approx(share * total, rel=1e-8)


def test_hard_rows(spark):
    got = m.mix(documents(spark)).collect()
    assert len(got) == 11
    assert all(r.taken <= 2 * r.size for r in got)
    same = [r for r in got if r.doc_id == 1]
    assert same[0] == same[1]
    assert {r.taken for r in got if r.size == 0} == {0}


def test_empty_table_and_plan(spark):
    out = m.mix(empty(spark))
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan

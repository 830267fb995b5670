from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from postlake.llm import toxicity as t
from pyspark.sql import functions as F

from tests.llm.cases import TEXTS, documents, empty, rows_of

LABELS = "doc_id long, quality int, toxic int"


def test_presence_against_brute_force():
    texts = ["Ab abc!", None, "", "abc abc", "é" * 5, "ab"]
    got = {(int(o), int(b)) for owner, bucket in t.presence(texts, None) for o, b in zip(owner, bucket, strict=True)}
    shared = {b for o, b in got if o == 0} & {b for o, b in got if o == 3}
    # " ab", "abc", "bc ", " abc", "abc ", " abc "
    assert len({b for o, b in got if o == 3}) == 6 and len(shared) == 6
    assert {o for o, _ in got} == {0, 3, 4, 5}
    some = np.zeros(1 << t.BITS, bool)
    some[list(shared)] = True
    kept = {(int(o), int(b)) for owner, bucket in t.presence(texts, some) for o, b in zip(owner, bucket, strict=True)}
    assert kept == {(o, b) for o, b in got if b in shared}


def test_held_out_accuracy(spark):
    # The smaller tables hold a handful of toxic rows only.
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = t.report(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert toxic and np.mean([r.predicted == 1 for r in toxic]) >= 0.8
    assert np.mean([r.predicted == 0 for r in rows if r.toxic == 0]) >= 0.99
    assert found.filter("score < 0 or score > 1 or score is null").count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 0, 0), (2, None, None)], [(1, 1, 1), (4, 0, 0), (4, 0, 1), (9, 0, 0), (None, 1, 1)]])
def test_hard_rows(spark, labels):
    docs = documents(spark)
    found = t.report(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(TEXTS)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert all(r.held_out is not None for r in found)
    same = [r for r in found if r.doc_id == 1]
    assert same[0] == same[1]


def test_stage_keeps_columns_and_empty_tables(spark):
    docs, none = documents(spark), spark.createDataFrame([], LABELS)
    kept = t.clean(docs, none)
    assert kept.columns == docs.columns and rows_of(kept) == rows_of(docs)
    assert t.clean(empty(spark), none).count() == 0
    assert t.report(empty(spark), spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    n = t.training_rows(docs, labels, F.lit(True), most=500).count()
    assert 400 < n < 600


def test_fit_unfolds_some_rows_at_a_time(monkeypatch):
    """The same weights whatever the cuts; memory that doesn't grow with all features."""
    rng = np.random.default_rng(2)
    width = rng.integers(0, 40, 300)
    indptr = np.concatenate([[0], np.cumsum(width)])
    indices = rng.integers(0, 90, indptr[-1]).astype("<u4")
    ratio, label = rng.normal(size=90), (rng.random(300) < 0.3).astype(float)
    weight, bias = t.fit_linear(indptr, indices, ratio, label)
    for entries in (1, 57, 5000):
        monkeypatch.setattr(t, "ENTRIES", entries)
        again = t.fit_linear(indptr, indices, ratio, label)
        assert again[1] == bias and (again[0] == weight).all()
    monkeypatch.undo()
    monkeypatch.setattr(t, "STEPS", 2)
    indptr = np.arange(20_001) * 100
    indices = rng.integers(0, 90, indptr[-1]).astype("<u4")
    label = np.arange(20_000) % 2.0
    tracemalloc.start()
    try:
        t.fit_linear(indptr, indices, ratio, label)
        assert tracemalloc.get_traced_memory()[1] < 30e6
    finally:
        tracemalloc.stop()

"""Merkle manifest against a whole-tree calculation, and its pieces by hand."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from postlake.llm import merkle
from pyspark.sql import functions as F

from tests.llm.cases import documents, empty

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def expected(rows: list[tuple]) -> list[tuple]:
    """All rows' proofs from trees held whole."""
    trees: dict = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    for some in trees.values():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    keys = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    below = {k: levels([leaf(r) for r in trees[k]]) for k in keys}
    top = levels([below[k][-1][0] for k in keys])
    out = []
    for place, key in enumerate(keys):
        for i, row in enumerate(trees[key]):
            shown = leaf(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                shown = leaf((*row[:4], text))
            proof, folded = "", shown
            for tree, at in ((below[key], i), (top, place)):
                for nodes in tree[:-1]:
                    run = nodes[at - at % 16 : at - at % 16 + 16]
                    before, after = "".join(run[: at % 16]), "".join(run[at % 16 + 1 :])
                    proof, folded, at = proof + before + after, sha(before + folded + after), at // 16
            root = top[-1][0]
            out.append((row[0], leaf(row), below[key][-1][0], root, sha(proof), folded, folded == root))
    return out


def check(docs) -> None:
    rows = [tuple(r) for r in docs.select(COLUMNS).collect()]
    got = [tuple(r) for r in merkle.report(docs).collect()]
    assert Counter(got) == Counter(expected(rows))


def test_hard_rows(spark):
    check(documents(spark))


def test_empty(spark):
    found = merkle.report(empty(spark))
    assert found.count() == 0
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("rows", [1, 2, 16, 17])
def test_small_trees(spark, rows):
    docs = spark.range(rows).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).alias("n_chars"), F.concat(F.lit("Text "), "id").alias("text"),
    )
    check(docs)


def test_hot_source_over_many_blocks_and_many_sources(spark, monkeypatch):
    """A third of all rows in one source, sources of one row, a null source and ''."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", 1500)
    source = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 7 == 0, None)
        .when(F.col("id") % 11 == 0, "")
        .when(F.col("id") % 2 == 0, F.concat(F.lit("é"), "id"))
        .otherwise("s")
    )
    docs = spark.range(14_000).select(
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 9000).alias("doc_id"),
        source.alias("source"), F.lit(None).cast("string").alias("lang"),
        (F.col("id") % 5).alias("n_chars"), F.concat(F.lit("Über "), F.col("id") % 77).alias("text"),
    )
    check(docs)


def test_missing_nodes_are_the_least_union():
    assert [x.tolist() for x in merkle.missing(np.arange(16), 16)] == [[]]
    assert [x.tolist() for x in merkle.missing(np.array([0]), 1)] == []
    # Leaves 3 and 20 of 40: their run mates, then the third of the three parents.
    found = merkle.missing(np.array([3, 20]), 40)
    assert found[0].tolist() == [i for i in range(32) if i not in (3, 20)]
    assert found[1].tolist() == [2]
    assert [x.tolist() for x in merkle.missing(np.arange(40), 40)] == [[], []]


def test_proofs_as_lists(spark):
    docs = documents(spark)
    found = merkle.proofs(merkle.manifest(merkle.leaves_of(docs)), siblings=True)
    for row in found.collect():
        assert row["verified"]
        assert sha("".join(row["proof"])) == row["proof_sha256"]
    assert merkle.holds("a", [("x", "y"), ("", "z")], sha(sha("xay") + "z"))
    assert not merkle.holds("b", [("x", "y")], sha("xay"))

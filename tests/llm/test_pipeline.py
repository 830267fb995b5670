from __future__ import annotations

import random

import corpus_pipeline as p
import pytest

from tests.conftest import SMALL, TINY
from tests.llm.cases import TEXTS, documents
from tests.llm.test_decontaminate import brute as benchmark_hits
from tests.llm.test_neardup import brute_groups


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Tables with one case per stage, beside clean documents."""
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]

    def text(n):
        return " ".join(rng.choices(words, k=n))

    passage, item = text(60), text(12)
    rows = [(i, text(150) + "\n" + text(40), "en", f"s{i % 3}") for i in range(120)]
    changed = rows[5][1].split(" ")
    changed[70] = "changed"
    rows += [(500, rows[4][1], "en", "s0"), (501, " ".join(changed), "en", "s1")]
    long = text(4000).split(" ")
    rows += [(502, " ".join(long), "en", "s1"), (503, " ".join([long[0], "changed", *long[2:]]), "en", "s1")]
    rows += [(510 + i, f"{text(50)}\n{passage}\n{text(50)}", "en", "s1") for i in range(4)]
    rows += [(520, f"{text(60)} {item} {text(60)}", "en", "s2")]
    rows += [(530 + i, f"{text(40)} stupid idiot {text(40)}", "en", "s2") for i in range(12)]
    rows += [(600 + i, f"{text(50)} idiot {text(30)} stupid {text(9)}", "en", "s2") for i in range(60)]
    labels = [(i, 1, 0) for i in range(120)] + [(600 + i, 0, 1) for i in range(60)]
    where = str(tmp_path_factory.mktemp("planted"))
    documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where, rows, passage, item


def test_planted_cases(spark, planted):
    where, rows, passage, item = planted
    docs, after = spark.read.parquet(f"{where}/documents.parquet"), []
    columns = docs.columns
    for number, (_, stage) in enumerate(p.STAGES):
        docs = p.stored(stage(spark, docs, where), f"test-{number}")
        if number < 4:
            assert docs.columns == columns
        after.append({r.doc_id: r for r in docs.collect()})
    assert not any(i >= 530 for i in after[0]) and len(after[0]) == 129
    texts = {i: r.text for i, r in after[1].items()}
    assert passage in texts[510] and not any(passage in texts[510 + i] for i in (1, 2, 3))
    # A whole copy, and one with a changed word, say nothing of their own.
    assert set(after[1]) == set(after[0]) - {500, 501}
    assert all(texts[i] == rows[i][1] for i in range(120))
    assert set(after[2]) == set(after[1]) - {503}
    assert set(after[3]) == set(after[2]) - {520}
    assert set(after[4]) == set(after[3])
    got = p.run(spark, where)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, after[4].values()))


def test_stages_against_brute_force(spark):
    """The stages that SQL can't express, or that keep whole documents, at work on one another."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lines = p.stored(p.drop_repeated_lines(spark, docs, SMALL), "test")
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    single = p.stored(p.drop_near_duplicates(spark, lines, SMALL), "test")
    kept = {r.doc_id for r in single.select("doc_id").collect()}
    first = brute_groups(rows)
    assert kept >= set(first.values())
    assert len(kept - set(first.values())) <= 0.05 * (len(rows) - len(set(first.values())))
    items = [tuple(r) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    some = [r for r in rows if r[0] in kept and r[0] % 9 == 0]
    clean = p.drop_contaminated(spark, single.filter("doc_id % 9 = 0"), TINY)
    assert {r.doc_id for r in clean.collect()} == {i for i, *_, hit in benchmark_hits(some, items) if not hit}


def test_hard_rows(spark, tmp_path):
    where = str(tmp_path)
    documents(spark).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    got = p.run(spark, where)
    texts = {r.doc_id for r in got.collect()}
    assert texts <= {r[0] for r in TEXTS} and 1 in texts and 4 in texts

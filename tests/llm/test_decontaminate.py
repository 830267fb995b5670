from __future__ import annotations

import hashlib
import random
import re

from postlake.llm import decontaminate as d

from tests.llm.cases import LONG, TEXTS, documents, empty, plain, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for item_id, item in items:
            w = words(item)
            for i in range(max(1, len(w) - size + 1) if w else 0):
                win = w[i : i + size]
                for j in range(len(own) - len(win) + 1):
                    if own[j : j + len(win)] == win:
                        hit.update(range(j, j + len(win)))
                        names.add(item_id)
        names.discard(None)
        ids = ",".join(sorted(map(str, names)))
        digest = hashlib.sha256(ids.encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_against_brute_force_in_one_block_and_in_many(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "é", "x1", "Ω"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 9, 10, 11, 14])))) for i in range(25)]
    items += [(30, None), (None, "b b a c"), (31, items[3][1]), (3, items[4][1])]
    docs = [(i, "; ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 40])))) for i in range(30)]
    docs += [(40 + i, f"q {items[i][1] or ''}! {items[i + 1][1] or ''} q") for i in range(20)]
    want = brute(docs, items)
    for block in (100_000, 7):
        found = d.hits(plain(spark, docs), bench(spark, items), ["doc_id"], block_windows=block)
        assert rows_of(d.report(found)) == want


def test_hard_rows_and_stage(spark):
    items = [(1, "beta gamma"), (2, LONG[:500])]
    rows = [(r[0], r[1]) for r in TEXTS]
    found = d.report(d.hits(documents(spark), bench(spark, items), ["doc_id"]))
    assert rows_of(found) == brute(rows, items)
    docs = documents(spark)
    kept = d.decontaminated(docs, bench(spark, items))
    assert kept.columns == docs.columns
    assert rows_of(kept) == rows_of(docs.filter("doc_id is null or doc_id not in (1, 4)"))


def test_empty_tables(spark):
    none = bench(spark, [])
    assert d.report(d.hits(empty(spark), bench(spark, [(1, "a b")]), ["doc_id"])).count() == 0
    found = d.report(d.hits(documents(spark), none, ["doc_id"]))
    assert not any(r.contaminated for r in found.collect())
    assert d.decontaminated(documents(spark), none).count() == len(TEXTS)


def test_shift_table_skips():
    table = d.Table(10)
    table.add(tuple(b"abcdefghij"[i : i + 1] for i in range(10)), [1])
    assert table.furthest == 9
    assert min(table.shift.values()) == 0 and max(table.shift.values()) == 8

from __future__ import annotations

import numpy as np
import pytest
from postlake.llm import neardup as n

from tests.llm.cases import TEXTS, documents, empty, plain

WORDS = np.array([f"w{i}" for i in range(5000)])


def grams(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = low.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(x, y):
    a, b = grams(x), grams(y)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_groups(rows):
    """The smallest id of each row's group, by all pairs that share a shingle."""
    found = [(i, grams(text)) for i, text in rows]
    size = {i: max(1, len(own)) for i, own in found}
    root, seen = {i: i for i, _ in found}, {}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in found:
        shared = {}
        for gram in own or {()}:
            for j in seen.get(gram, ()):
                shared[j] = shared.get(j, 0) + 1
            seen.setdefault(gram, []).append(i)
        for j, both in shared.items():
            if both >= 0.8 * (max(1, len(own)) + size[j] - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def groups(spark, rows, **more):
    found = n.near_duplicates(plain(spark, rows), **more)
    return {r.doc_id: r.root for r in found.select("doc_id", "root").collect()}


@pytest.fixture(scope="module")
def pairs():
    """Texts of 100, 300 and 1000 words, each with a copy of 1 to 4 % changed words."""
    rng = np.random.default_rng(3)
    rows = []
    for size in (100, 300, 1000):
        for share in (0.01, 0.02, 0.03, 0.04):
            for _ in range(40):
                words = rng.choice(WORDS, size)
                copy = words.copy()
                copy[rng.choice(size, max(1, int(size * share)), False)] = "changed"
                rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(copy))]
    return rows


@pytest.mark.parametrize("part", [n.PART, 60])
def test_recall_of_planted_pairs(spark, pairs, part):
    """Blocks of sixty make many tables; what is below the threshold is never joined."""
    root = groups(spark, pairs, part=part)
    near = lost = 0
    for (i, a), (j, b) in zip(pairs[::2], pairs[1::2], strict=True):
        if jaccard(a, b) >= 0.8:
            near, lost = near + 1, lost + (root[i] != root[j])
        else:
            assert root[i] != root[j]
    assert near > 200 and lost <= 0.05 * near
    assert len(set(root.values())) == len(pairs) - near + lost


def test_groups_of_copies_against_all_pairs(spark):
    """Chains and stars of copies, in blocks that fall into parts."""
    rng = np.random.default_rng(4)
    rows = []
    for size in (3, 30, 90):
        words = rng.choice(WORDS, 400)
        for k in range(size):
            copy = words.copy()
            copy[rng.choice(400, k % 5, False)] = f"new{k}"
            rows += [(len(rows), " ".join(copy))] * 2
    root = groups(spark, list(dict.fromkeys(rows)), part=8)
    texts = dict(rows)
    for i, a in texts.items():
        for j, b in texts.items():
            if i < j and jaccard(a, b) >= 0.8:
                assert root[i] == root[j]
    assert len(set(root.values())) == 3


def test_forest_keeps_the_closest_links():
    rng = np.random.default_rng(5)
    u, v = rng.integers(0, 200, (2, 3000))
    u, v = u[u != v], v[u != v]
    apart = rng.integers(0, 50, len(u))
    forest = n.Nearest(200)
    forest.held = -(10**9)
    for at in range(0, len(u), 100):
        forest.add(u[at : at + 100], v[at : at + 100], apart[at : at + 100])
        if at % 500 == 0:
            forest.links()
    forest.links()
    root, total = list(range(200)), 0

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in np.argsort(apart, kind="stable"):
        a, b = find(u[i]), find(v[i])
        if a != b:
            root[a], total = b, total + apart[i]
    assert forest.slices[0][2].sum() == total
    assert len(forest.slices[0][0]) == 200 - len({find(i) for i in range(200)})


def test_sketch_tells_the_similarity():
    rng = np.random.default_rng(6)
    both, a, b = rng.integers(0, 2**63, 1600, np.uint64), *rng.integers(0, 2**63, (2, 200), np.uint64)
    x, y = n.sketch(np.concatenate([both, a])), n.sketch(np.concatenate([both, b]))
    assert abs(np.bitwise_count(x ^ y).sum() / (64 * n.WORDS) - n.DIFFERS) < 0.05
    assert n.plan(100)[1] == 1 and n.plan(10**9)[1] < 100


def test_hard_rows(spark):
    docs = documents(spark)
    kept = n.one_per_group(docs)
    assert kept.columns == docs.columns
    want = {}
    for i, text in ((r[0], r[1]) for r in TEXTS):
        want.setdefault(frozenset(grams(text)), []).append(i)
    got = [r.doc_id for r in kept.select("doc_id").collect()]
    named = [min((x for x in ids if x is not None), default=None) for ids in want.values()]
    assert sorted(map(repr, got)) == sorted(map(repr, named))
    assert n.one_per_group(empty(spark)).count() == 0


def test_row_that_stays_of_equal_ids_and_texts(spark):
    rows = [(1, "a b c", "en", s) for s in ("s3", "s1", "s2")]
    assert [r.source for r in n.one_per_group(documents(spark, rows)).collect()] == ["s1"]


def test_blocks_are_shuffled_once(spark):
    """Where no block is over-full, sketches are searched where they meet, without another exchange."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(30)]
    distinct = n.sketches(plain(spark, rows)).select("key", "sketch")
    plan = n.candidates(distinct)._jdf.queryExecution().toString().split("== Optimized Logical Plan ==")[1]
    logical = plan.split("== Physical Plan ==")[0]
    assert "Repartition" not in logical and "Union" not in logical


def test_texts_are_shuffled_once(spark):
    """The choice of a row and its meeting with the kept ones use the same keys."""
    from postlake.llm.simhash import keep_first

    rows = plain(spark, [(1, "a b c"), (None, "a b c"), (None, None), (0, None), (2, "d e f"), (1, "a b c")])
    found = n.near_duplicates(rows).select("doc_id", "text_hash", "root")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_first(rows, found)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(str, (r.doc_id for r in kept.collect())))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == ["0", "1", "2"]
    assert plan.count("Exchange hashpartitioning(row_id") == 2  # the texts and the kept keys

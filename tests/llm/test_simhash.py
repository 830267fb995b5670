from __future__ import annotations

import numpy as np
import pytest
import xxhash
from postlake.llm import simhash as s
from postlake.llm.components import components

from tests.llm.cases import LONG, TEXTS, documents, empty, plain, rows_of


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate({i: 32 for i in range(9, 14)}).split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """Smallest id per row, by union of all pairs within three bits."""
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    named = {r: min((x for x in g if x is not None), default=None) for r, g in ids.items()}
    return sorted(((rows[i][0], f"{prints[i]:016x}", named[find(i)]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 300, 20_000])
def test_fingerprint(n):
    rng = np.random.default_rng(n)
    text = "\t".join(f"W{k}é" for k in rng.integers(0, 300, n))
    assert s.fingerprint(text.encode()) == brute_print(text)


def test_index_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, size=200, dtype=np.uint64)
    bits = np.uint64(1) << rng.integers(0, 64, (200, 4)).astype(np.uint64)
    a = np.unique(np.concatenate([base, np.bitwise_xor.reduce(bits, axis=1) ^ base]))
    b = np.unique(rng.permutation(a)[:77] ^ np.uint64(5))
    for left, right in ((a, b), (b, a), (a[:1], b), (a[:9], a[:20])):
        x, y = s.Index(left), s.Index(right)
        got = {(int(x.prints[i]), int(y.prints[j])) for u, v in s.near_pairs(x, y) for i, j in zip(u, v, strict=True)}
        assert got == {(int(p), int(q)) for p in left for q in right if p != q and (int(p) ^ int(q)).bit_count() <= 3}


def test_upper_nodes_prune():
    """Random fingerprints are compared far less often than all pairs would be."""
    rng = np.random.default_rng(2)
    prints = np.unique(rng.integers(0, 2**63, size=40_000, dtype=np.uint64))
    index, seen = s.Index(prints), []
    original = np.bitwise_count
    try:
        s.np.bitwise_count = lambda x: seen.append(x.size) or original(x)
        list(s.near_pairs(index, index))
    finally:
        s.np.bitwise_count = original
    assert sum(seen) < len(prints) ** 2 / 10


def test_documents_against_brute_force(spark):
    rng = np.random.default_rng(4)
    words = np.array([f"w{i}" for i in range(400)])
    rows = []
    for i in range(60):
        own = rng.choice(words, 120)
        rows.append((100 - i, " ".join(own)))
        for _ in range(i % 4):
            own = own.copy()
            own[rng.integers(120)] = "changed"
            rows.append((200 + len(rows), " ".join(own)))
    rows += [(r[0], r[1]) for r in TEXTS]
    want = brute_components(rows)
    docs = plain(spark, rows)
    assert rows_of(s.report(s.near_duplicates(docs))) == want
    # Parts of three fingerprints make many pairs of parts; nothing changes.
    prints = s.stored(s.fingerprints(docs).select("fingerprint").distinct(), "test")
    roots = {r.node: r.root for r in components(s.links(prints, part=3)).collect()}
    small = {}
    for doc_id, p, _ in want:
        value = int(p, 16)
        value -= (1 << 64) if value >> 63 else 0
        small.setdefault(roots.get(value, value), []).append(doc_id)
    assert sorted(sorted(map(repr, g)) for g in small.values()) == sorted(
        sorted(map(repr, g)) for g in _groups(want).values()
    )


def _groups(found):
    groups = {}
    for doc_id, _, component in found:
        groups.setdefault(component, []).append(doc_id)
    return groups


def test_one_per_group(spark):
    rows = [*TEXTS, (9, TEXTS[0][1], "en", "s9"), (0, TEXTS[0][1] + "", "en", "s0")]
    docs = documents(spark, rows)
    kept = s.one_per_group(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(got))
    want = {c for _, _, c in brute_components([(r[0], r[1]) for r in rows])}
    assert {i for i, _ in got} == want and len(got) == len(want)
    assert (4, LONG) in got


def test_empty_table(spark):
    assert s.report(s.near_duplicates(empty(spark))).count() == 0
    assert s.one_per_group(empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 150)} | {201: 200}

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from postlake.llm import linededup as d

from tests.llm.cases import TEXTS, documents, empty, plain, rows_of

PASSAGE = " ".join(f"token{chr(97 + i % 26)}" for i in range(60))


def texts(spark, rows):
    return {r[0]: r[3] for r in d.report(plain(spark, rows)).collect()}


def test_templates_across_documents(spark):
    first = "2024-01-02 user 17 logged in from 10.0.0.1 after 3 tries"
    other = "2023-11-30 user 4 logged in from 10.9.8.7 after 12 tries"
    rows = [
        (1, f"one line only here now\n{first}\nshort"),
        (2, f"{other}\nsomething else with no equal line\nshort"),
        (3, f"{first}\n{first}"),
        (4, "a text whose only line is like no other"),
    ]
    got = texts(spark, rows)
    assert got[1] == rows[0][1] and got[4] == rows[3][1]
    assert got[2] == "something else with no equal line\nshort"
    assert got[3] == ""


def test_general_positions_and_limits(spark):
    near = PASSAGE.split()
    near[30] = near[40] = "changed"
    far = PASSAGE.split()[:3] + ["other"] * 57
    got = texts(spark, [(1, PASSAGE), (2, " ".join(near)), (3, " ".join(far)), (4, PASSAGE), (5, PASSAGE + " more")])
    assert got[1] == PASSAGE and got[2] == "" and got[4] == ""
    assert got[3] == " ".join(far) and got[5] == PASSAGE + " more"


def test_several_templates_of_a_leaf(spark):
    """Unrelated lines of the same leaf, however frequent, don't part a template."""
    cat = "the quick brown cat sat down on the mat by noon"
    other = "the quick brown set of words here says what else goes"
    rows = [(1, cat), (2, cat.replace("cat", "dog")), (3, cat.replace("noon", "night").replace("mat", "rug"))]
    rows += [(10 + i, other) for i in range(5)] + [(20, other.replace("else", "more"))]
    got = texts(spark, rows)
    assert got.pop(1) == cat and got.pop(10) == other
    assert set(got.values()) == {""}


def test_lines_led_by_others_still_meet(spark):
    """All segments that two agreeing lines share are led by a line neither agrees with."""
    first = "aa bb cc d e f g h i j"
    second = "aa bb cc D e F g h i j"
    leader = "aa bb cc k l m n h i j"
    rows = [(1, first), (2, second)] + [(10 + i, leader) for i in range(4)]
    got = texts(spark, rows)
    assert got == {1: first, 2: "", 10: leader, 11: "", 12: "", 13: ""}


def test_all_agreeing_lines_are_linked_across_parts(spark):
    """Small parts give the same templates as all pairs of lines do."""
    rng = random.Random(19)
    words = [["m" * k, "n" * k, "o" * k] for k in range(1, 8)]
    lines = {" ".join(["a", "b", "c", *map(rng.choice, words)]) for _ in range(40)}
    rows = list(enumerate(sorted(lines)))
    seen = d.lines(plain(spark, rows))
    leaves = seen.select("leaf").distinct()
    name = {r.line: r.key for r in seen.select("line", "key").collect()}
    label = {i: i for i, _ in rows}
    for i, a in rows:
        for j, b in rows:
            if i < j and sum(x == y for x, y in zip(a.split(), b.split())) >= 8:
                old, new = label[j], label[i]
                label = {k: new if v == old else v for k, v in label.items()}
    assert 1 < len(set(label.values())) < len(rows)
    for part in (3, d.PART):
        of = {key: line for line, key in name.items()}
        of |= {name[r.line]: r.template for r in d._templates(seen, leaves, d.DEPTH, d.SAME, part).collect()}
        assert all((of[i] == of[j]) == (label[i] == label[j]) for i, _ in rows for j, _ in rows)


def chained(rng, words, n):
    """Lines of one leaf in chains, each step two words from the one before, in any order."""
    out = set()
    while len(out) < n:
        line = ["a", "b", "c", *rng.choices(words, k=12)]
        for _ in range(rng.randrange(1, 8)):
            line[rng.randrange(3, 15)] = rng.choice(words)
            line[rng.randrange(3, 15)] = rng.choice(words)
            out.add(" ".join(line))
    return rng.sample(sorted(out), n)


def test_linked_is_all_that_labels_and_agreeing_lines_link():
    rng = np.random.default_rng(7)
    for same in (0.5, 0.8, 1.0):
        words = rng.integers(0, 3, (60, 6)).astype("<u4")
        label = rng.integers(0, 45, 60)
        near = (words[:, None] == words).sum(2) >= same * 6
        near |= label[:, None] == label
        for _ in range(6):
            near = near.astype(int) @ near > 0
        assert d.linked(words, label, same).tolist() == near.argmax(1).tolist()
    assert d.linked(words[:0], label[:0]).tolist() == []


def test_leaves_that_a_task_holds_take_few_jobs(spark):
    """Chains of lines inside a leaf don't start rounds of jobs."""
    rng = random.Random(3)
    rows = list(enumerate(chained(rng, [chr(97 + i) * 4 for i in range(9)], 150)))
    context = spark.sparkContext
    before = len(context.statusTracker().getJobIdsForGroup("few"))
    context.setJobGroup("few", "")
    try:
        drops = d.dropped(plain(spark, rows)).count()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < drops < 150
    assert len(context.statusTracker().getJobIdsForGroup("few")) - before <= 30


def test_groups_are_bounded_by_bytes(spark, monkeypatch):
    """Wide lines of a large leaf meet in groups of bounded size, with the same templates."""
    rng = random.Random(5)
    rows = list(enumerate(chained(rng, [chr(97 + i) * 4 for i in range(9)], 200)))
    whole = texts(spark, rows)
    sizes, linked = [], d._linked

    def measured(groups, same):
        size = "aggregate(rows, 0, (n, x) -> n + length(x.tokens))"
        sizes.extend(r[0] for r in groups.select(F.expr(size)).collect())
        return linked(groups, same)

    monkeypatch.setattr(d, "_linked", measured)
    monkeypatch.setattr(d, "PART_BYTES", 30 * 60)
    assert texts(spark, rows) == whole
    # Parts are dealt by hash, so they are a little uneven.
    assert sizes and max(sizes) <= 2 * 30 * 60


def test_scripts_without_spaces(spark):
    line = "".join(chr(0x4E00 + 7 * i) for i in range(185))
    changed = line[:90] + "\u3042" + line[91:]
    thai = "\u0e01\u0e02\u0e03\u0e04 abc"
    got = texts(spark, [(1, line), (2, line), (3, changed), (4, thai), (5, thai), (6, line[:4]), (7, line[:4])])
    assert got == {1: line, 2: "", 3: "", 4: thai, 5: "", 6: line[:4], 7: line[:4]}


def test_agreeing_lines_share_a_segment():
    rng = random.Random(4)
    for n in range(5, 80):
        ends = d.segments(n)
        assert ends[0] == d.DEPTH and ends[-1] == n and ends == sorted(ends)
        a = list(range(n))
        for _ in range(50):
            b = list(a)
            for i in rng.sample(range(d.DEPTH, n), min(n - d.DEPTH, n - math.ceil(0.8 * n))):
                b[i] = -1
            assert sum(x == y for x, y in zip(a, b)) >= 0.8 * n
            assert any(a[i:j] == b[i:j] for i, j in zip(ends, ends[1:]))


def test_repeats_within_a_document_stay(spark):
    row = (1, f"{PASSAGE}\n{PASSAGE}")
    assert texts(spark, [row, row, (2, "of four tokens only")])[1] == row[1]


def test_hard_rows_keep_columns(spark):
    docs = documents(spark)
    out = d.without_recurring_lines(docs)
    assert out.schema.names == docs.schema.names
    # Rows of equal id, or equal text without an id, are one document.
    assert rows_of(out) == rows_of(docs)
    report = {(r[0], r[1], r[2]) for r in d.report(docs).collect()}
    assert (2, 0, 0) in report and (3, 1, 0) in report and (6, 2, 0) in report
    assert d.report(docs).count() == len(TEXTS)


def test_empty_table(spark):
    assert d.without_recurring_lines(empty(spark)).count() == 0

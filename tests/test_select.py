from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from postlake.operators import select, summary
from postlake.sources import tables
from tests.conftest import utc

DAY = dt.date(2024, 3, 10)


def test_day_bounds_and_order(make_raw):
    raw = make_raw(
        {"post_id": "late", "subreddit": "S", "post_date": utc(2024, 3, 10, 23, 59, 59)},
        {"post_id": "b", "subreddit": "s", "post_date": utc(2024, 3, 10)},
        {"post_id": "a", "subreddit": "s", "post_date": utc(2024, 3, 10)},
        {"post_id": "next", "subreddit": "s", "post_date": utc(2024, 3, 11)},
        {"post_id": "before", "subreddit": "s", "post_date": utc(2024, 3, 9, 23, 59, 59)},
        {"post_id": "other", "subreddit": "t", "post_date": utc(2024, 3, 10)},
    )
    assert [r.post_id for r in select.posts_for_day(raw, "S", DAY).collect()] == ["a", "b", "late"]
    assert [r.post_id for r in select.posts_for_day(raw, "s", DAY, 2).collect()] == ["a", "b"]
    assert select.is_day_loaded(raw, "S", DAY)
    assert not select.is_day_loaded(raw, "s", dt.date(2024, 3, 12))


def test_flair_is_a_substring_in_any_case(make_raw):
    flairs = ["Question", "QUESTION?", "my question", "Quest", "", None]
    raw = make_raw(*[{"post_id": str(i), "post_flair": f} for i, f in enumerate(flairs)])
    assert sorted(r.post_id for r in select.with_flair(raw, "question").collect()) == ["0", "1", "2"]
    assert select.with_flair(raw, "").count() == len(flairs)


def test_communities(make_raw):
    raw = make_raw({"post_id": "a", "subreddit": "babybumps"}, {"post_id": "b", "subreddit": "x"})
    assert [r.post_id for r in select.of_communities(raw).collect()] == ["a"]
    assert [r.post_id for r in select.of_communities(raw, ["X"]).collect()] == ["b"]


@pytest.mark.parametrize(
    ("period", "expected"),
    [("hour", 1), ("day", 2), ("week", 3), ("month", 4), ("year", 5), ("all", 6)],
)
def test_periods(make_raw, period, expected):
    as_of = utc(2024, 6, 1, 12)
    ages = [dt.timedelta(minutes=30), dt.timedelta(hours=5), dt.timedelta(days=3),
            dt.timedelta(days=20), dt.timedelta(days=200), dt.timedelta(days=800)]
    raw = make_raw(*[{"post_id": str(i), "post_date": as_of - a} for i, a in enumerate(ages)])
    assert select.in_period(raw, period, as_of).count() == expected
    naive = select.in_period(raw, period, as_of.replace(tzinfo=None))
    assert naive.count() == expected


def test_top_posts_of_a_huge_community(spark):
    """A third of all posts in one community, many equal scores; against brute force."""
    posts = spark.range(0, 9000, 1, 6).select(
        F.concat(F.lit("p"), "id").alias("post_id"),
        F.when(F.col("id") % 3 == 0, "huge").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("subreddit"),
        ((F.col("id") * 7919) % 50).alias("score"),
    )
    groups = defaultdict(list)
    for r in posts.collect():
        groups[r.subreddit].append((-r.score, r.post_id))
    expected = {
        (name, rank, post_id)
        for name, rows in groups.items()
        for rank, (_, post_id) in enumerate(sorted(rows)[:100], 1)
    }
    got = {(r.subreddit, r.top_rank, r.post_id) for r in select.top_posts(posts, 100).collect()}
    assert got == expected


def test_loaded(spark, make_raw):
    raw = make_raw(
        {"post_id": "a", "subreddit": "BabyBumps", "post_date": utc(2024, 3, 10, 5)},
        {"post_id": "b", "subreddit": "babybumps", "post_date": utc(2024, 3, 10, 6)},
    )
    names = spark.createDataFrame([("BabyBumps",), ("BABYBUMPS",)], "subreddit string")
    rows = {r.subreddit: r.is_loaded for r in select.loaded_communities(names, raw).collect()}
    assert rows == {"BabyBumps": True, "BABYBUMPS": False}
    wanted = spark.createDataFrame(
        [("BABYBUMPS", DAY), ("x", DAY), ("babybumps", dt.date(2024, 3, 11))],
        "subreddit string, day date",
    )
    rows = {(r.subreddit, r.day.day): (r.n_posts, r.is_loaded) for r in select.loaded_days(wanted, raw).collect()}
    assert rows == {("BABYBUMPS", 10): (2, True), ("x", 10): (0, False), ("babybumps", 11): (0, False)}
    assert select.is_community_loaded(raw, "BabyBumps")
    assert not select.is_community_loaded(raw, "BABYBUMPS")


def test_loaded_of_a_table(spark, make_raw, tmp_path):
    assert not tables.day_loaded(spark, "no_such_table", "s", DAY)
    assert not tables.community_loaded(spark, "no_such_table", "s")
    tables.create_raw_table(spark, "loaded_posts", str(tmp_path / "t"))
    assert tables.table_exists(spark, "LOADED_POSTS")
    assert not tables.community_loaded(spark, "loaded_posts", "s")
    tables.append_posts(make_raw({"post_id": "a", "subreddit": "s", "post_date": utc(2024, 3, 10)}), "loaded_posts")
    assert tables.community_loaded(spark, "loaded_posts", "s")
    assert tables.day_loaded(spark, "LOADED_POSTS", "S", DAY)


def test_reports(spark, make_annotations):
    words = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "keyword string")
    assert [tuple(r) for r in summary.top_keywords(words, 2).collect()] == [("a", 2), ("b", 2)]
    notes = make_annotations(
        {"post_id": "a", "model_name": "m", "input_tokens": 10, "output_tokens": 1},
        {"post_id": "a", "model_name": "m", "input_tokens": 20, "output_tokens": None},
    )
    usage = summary.token_usage(notes).first()
    assert (usage.n_annotations, usage.input_tokens, usage.avg_input_tokens, usage.output_tokens) == (2, 30, 15.0, 1)
    assert [tuple(r) for r in summary.repeated_annotations(notes).collect()] == [("a", 2)]


def test_newest_annotations(spark):
    gold = spark.createDataFrame(
        [("a", utc(2024, 1, 1)), ("b", None), ("c", utc(2024, 1, 2))], "post_id string, annotated_at timestamp"
    ).selectExpr("*", "'t' as post_title", "'s' as post_summary", "'r' as care_response")
    assert [r.post_id for r in summary.latest_annotated(gold).collect()] == ["b", "c", "a"]
    only = summary.latest_annotated(gold, 1, annotated_only=True)
    assert [r.post_id for r in only.collect()] == ["c"]


def test_top_posts_counts(spark):
    posts = spark.range(500).selectExpr("cast(id as string) as post_id", "'one' as subreddit", "id as score")
    ranks = Counter(r.top_rank for r in select.top_posts(posts, 300).collect())
    assert ranks == Counter(range(1, 301))

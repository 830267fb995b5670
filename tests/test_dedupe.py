from __future__ import annotations

import random

from pyspark.sql import functions as F

from postlake.operators import dedupe
from postlake.plans import models
from tests.conftest import utc


def test_newest_scrape_wins_and_missing_time_is_newest(make_raw):
    raw = make_raw(
        {"post_id": "a", "score": 1, "scraped_at": utc(2024, 1, 1)},
        {"post_id": "a", "score": 2, "scraped_at": utc(2024, 1, 2)},
        {"post_id": "b", "score": 3, "scraped_at": utc(2024, 1, 2)},
        {"post_id": "b", "score": 4, "scraped_at": None},
        {"post_id": None, "score": 5},
    )
    rows = {r.post_id: r.score for r in dedupe.latest_posts(raw).collect()}
    assert rows == {"a": 2, "b": 4, None: 5}


def test_choice_does_not_depend_on_row_order(make_raw):
    """Ties on every leading column, in many orders and partitionings."""
    rows = [
        {"post_id": "a", "score": s, "title": t, "content": c, "scraped_at": utc(2024, 1, 1)}
        for s in (1, 2)
        for t in ("x", None)
        for c in ("p", "q", None)
    ]
    rng, seen = random.Random(1), set()
    for n in (1, 3, 8):
        rng.shuffle(rows)
        seen.add(tuple(dedupe.latest_posts(make_raw(*rows).repartition(n)).first()))
    assert len(seen) == 1


def test_choice_without_text_is_the_same_row(make_raw):
    rng = random.Random(2)
    rows = [
        {
            "post_id": f"p{rng.randint(0, 30)}",
            "score": rng.randint(0, 2),
            "title": rng.choice(["x", "y", None]),
            "content": rng.choice(["p", "q", None]),
            "scraped_at": rng.choice([None, utc(2024, 1, 1), utc(2024, 1, 2)]),
        }
        for _ in range(600)
    ]
    raw = make_raw(*rows)
    full = models.bronze(raw).drop("post_content_raw", "content_hash")
    narrow = models.bronze_without_text(raw)
    assert full.exceptAll(narrow).isEmpty() and narrow.exceptAll(full).isEmpty()


def test_bronze_cleans(make_raw):
    raw = make_raw(
        {"post_id": "a", "title": "  T\t ", "content": "\n one  \n\n two ", "subreddit": "BabyBumps"},
        {"post_id": "b", "title": None, "content": None},
        {"post_id": "c", "title": "", "content": ""},
    )
    rows = {r.post_id: r for r in models.bronze(raw).collect()}
    assert (rows["a"].post_title, rows["a"].post_content_raw) == ("T\t", " one two")
    assert rows["a"].subreddit == "babybumps"
    assert (rows["b"].post_title, rows["b"].post_content_raw) == (None, "")
    assert rows["b"].content_hash == rows["c"].content_hash


def test_one_id_with_a_third_of_all_rows(spark):
    """The hot id leaves each map task as a single row."""
    n = 30_000
    base = spark.range(0, n, 1, 6)
    raw = base.select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), "id")).alias("post_id"),
        F.lit(None).cast("timestamp").alias("post_date"),
        F.col("id").alias("post_timestamp"),
        F.lit(None).cast("string").alias("post_flair"),
        F.lit("t").alias("title"),
        F.lit("u").alias("url"),
        F.lit("c").alias("content"),
        F.col("id").alias("score"),
        F.col("id").alias("num_comments"),
        F.lit("s").alias("subreddit"),
        F.timestamp_seconds("id").alias("scraped_at"),
    )
    latest = dedupe.latest_posts(raw)
    assert latest.count() == n - n // 3 + 1
    assert latest.filter("post_id = 'hot'").first().score == n - 3
    plan = latest._jdf.queryExecution().executedPlan().toString()
    shuffle, partial = plan.index("Exchange hashpartitioning(post_id"), plan.index("Partial")
    assert shuffle < partial  # printed from the root, so the limit is below


def test_content_duplicates(make_raw):
    posts = models.bronze(
        make_raw(*[{"post_id": f"p{i}", "title": "t", "content": "same"} for i in range(4)],
                 {"post_id": "z", "title": "t", "content": "other"})
    )
    row = dedupe.content_duplicates(posts).first()
    assert (row.n_posts, row.first_post_id, row.last_post_id) == (4, "p0", "p3")
    kept = dedupe.one_per_content(posts).select("post_id").collect()
    assert sorted(r.post_id for r in kept) == ["p0", "z"]


def test_first_seen(make_raw):
    raw = make_raw(
        {"post_id": "a", "score": 2, "scraped_at": utc(2024, 1, 2)},
        {"post_id": "a", "score": 1, "scraped_at": utc(2024, 1, 1)},
        {"post_id": "b", "score": 3, "scraped_at": None},
    )
    rows = dedupe.first_seen(raw, "post_id", [F.asc_nulls_last("scraped_at")]).collect()
    assert {r.post_id: r.score for r in rows} == {"a": 1, "b": 3}

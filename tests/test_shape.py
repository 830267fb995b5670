from __future__ import annotations

import json

from postlake.operators import shape
from postlake.schemas import RAW_COLUMNS
from tests.conftest import utc

RUN = utc(2024, 5, 1, 8)
BASE = {"id": "a", "created_utc": 1704067200}


def archive(spark, *records):
    values = [(r if isinstance(r, str) or r is None else json.dumps(r),) for r in records]
    return spark.createDataFrame(values, "value string")


def shaped(spark, *records):
    return shape.shape_archive(archive(spark, *records), RUN).collect()


def test_defaults_for_absent_keys_only(spark):
    """An explicit null is kept, as a lookup with a default keeps it."""
    absent, null = shaped(
        spark,
        BASE,
        BASE | {"id": "b", "title": None, "score": None, "num_comments": None, "subreddit": None},
    )
    assert (absent.title, absent.score, absent.num_comments, absent.subreddit) == ("", 0, 0, "")
    assert (null.title, null.score, null.num_comments, null.subreddit) == (None,) * 4
    assert absent.post_flair is None


def test_content_falls_back_to_link(spark):
    rows = shaped(
        spark,
        BASE | {"selftext": "body", "url": "https://x"},
        BASE | {"selftext": "", "url": "https://x"},
        BASE | {"selftext": None, "url": "https://x"},
        BASE | {"url": "https://x"},
        BASE | {"selftext": ""},
        BASE | {"selftext": "", "url": None},
    )
    assert [r.content for r in rows] == ["body", "https://x", "https://x", "https://x", "", None]


def test_link_and_time(spark):
    one, two = shaped(spark, BASE | {"permalink": "/r/x/1"}, BASE | {"created_utc": 1704067201.9})
    assert (one.url, two.url) == ("https://reddit.com/r/x/1", "https://reddit.com")
    assert (one.post_timestamp, two.post_timestamp) == (1704067200, 1704067201)
    seconds = shape.shape_archive(archive(spark, BASE), RUN).selectExpr(
        "unix_seconds(post_date) as d", "unix_seconds(scraped_at) as s"
    )
    assert tuple(seconds.first()) == (1704067200, int(RUN.timestamp()))


def test_rejects(spark):
    records = archive(
        spark, BASE, {"created_utc": 1}, {"id": "x"}, {"id": "y", "created_utc": None}, "{oops", "[1]", None
    )
    assert shape.shape_archive(records, RUN).count() == 1
    reasons = [r.reason for r in shape.archive_rejects(records).collect()]
    assert reasons == ["no id", "no created_utc", "no created_utc"] + ["not a JSON object"] * 3


def test_shape_top(spark):
    schema = (
        "id string, created_utc double, link_flair_text string, title string, url string,"
        "permalink string, is_self boolean, selftext string, score bigint, num_comments bigint,"
        "subreddit string"
    )
    rows = [
        ("a", 1704067200.5, None, "t", "https://ext", "/r/x/a", True, "body", 1, 2, "X"),
        ("b", 1704067200.0, "F", "t", "https://ext", "/r/x/b", False, "", 1, 2, "X"),
        (None, 1704067200.0, "F", "t", "https://ext", "/r/x/b", False, "", 1, 2, "X"),
    ]
    df = shape.shape_top(spark.createDataFrame(rows, schema), RUN)
    assert df.columns == RAW_COLUMNS
    a, b = df.collect()
    assert (a.url, a.content, a.post_timestamp) == ("https://www.reddit.com/r/x/a", "body", 1704067200)
    assert (b.url, b.content) == ("https://ext", "")


def test_bulk_rename(spark):
    df = spark.createDataFrame([(1, 2)], "post_id int, Score int")
    assert shape.rename_upper(df).columns == ["POST_ID", "SCORE"]
    assert shape.rename_lower(shape.rename_upper(df)).columns == ["post_id", "score"]

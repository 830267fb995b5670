"""The index of what is loaded equals a scan, whatever happened before."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from postlake.operators import select
from postlake.sources import presence, tables
from tests.conftest import TINY, utc


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def check(spark, path, index):
    raw = tables.raw_posts(spark, path)
    days = F.to_date("post_date").alias("day")
    wanted = raw.select("subreddit", days).union(raw.select(F.lit("nowhere"), days)).distinct()
    assert same(presence.loaded_days(wanted, raw, index), select.loaded_days(wanted, raw))
    names = wanted.select("subreddit").distinct()
    assert same(presence.loaded_communities(names, raw, index), select.loaded_communities(names, raw))


def test_equals_a_scan_after_every_append(spark, tmp_path):
    path, index = str(tmp_path / "raw"), str(tmp_path / "index")
    posts = fx.raw_posts(spark, TINY)
    for number in range(3):
        posts.filter(F.col("score") % 2 == number % 2).repartition(2).write.mode("append").parquet(path)
        assert presence.refresh(tables.raw_posts(spark, path), index) == 2
        check(spark, path, index)
    assert presence.refresh(tables.raw_posts(spark, path), index) == 0


def test_lost_and_repeated_refreshes(spark, tmp_path, make_raw):
    """Files taken in late, twice, without rows, and files that are gone."""
    path, index = str(tmp_path / "raw"), str(tmp_path / "index")
    make_raw({"post_id": "a", "subreddit": "X y", "post_date": utc(2024, 1, 1)}).write.parquet(path)
    make_raw({"post_id": "b", "subreddit": None, "post_date": None}).write.mode("append").parquet(path)
    make_raw().write.mode("append").parquet(path)
    presence.refresh(tables.raw_posts(spark, path), index)
    rows = spark.read.schema(presence.INDEX).parquet(index).collect()
    spark.createDataFrame(rows, presence.INDEX).write.mode("append").parquet(index)
    check(spark, path, index)
    make_raw({"post_id": "c", "subreddit": "z", "post_date": utc(2024, 1, 2)}).write.mode("overwrite").parquet(path)
    presence.refresh(tables.raw_posts(spark, path), index)
    check(spark, path, index)
    assert [tuple(r)[::2] for r in presence.counts(tables.raw_posts(spark, path), index).collect()] == [("z", 1)]

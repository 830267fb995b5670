"""Texts fetched by place: equal rows, and no text in an exchange."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from postlake.operators import late
from postlake.operators.dedupe import latest_posts
from postlake.plans import models
from postlake.sources import tables
from tests.conftest import TINY, utc


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def scan(spark, tmp_path):
    """Raw posts in several files, each with old scrapes."""
    fx.raw_posts(spark, TINY).repartition(5, "url").write.parquet(str(tmp_path / "raw"))
    return tables.raw_posts(spark, str(tmp_path / "raw"))


def test_latest_rows_are_the_same(spark, scan):
    assert same(late.latest_posts_late(scan), latest_posts(scan))


def test_ties_are_decided_by_text(spark, make_raw, tmp_path):
    rng = random.Random(3)
    rows = [
        {
            "post_id": rng.choice([None, "a", "b", "c", "d"]),
            "score": rng.randint(0, 1),
            "content": rng.choice(["x", "y", "z", None]),
            "scraped_at": rng.choice([None, utc(2024, 1, 1)]),
        }
        for _ in range(200)
    ]
    make_raw(*rows).repartition(3).write.parquet(str(tmp_path / "raw"))
    scan = tables.raw_posts(spark, str(tmp_path / "raw"))
    assert same(late.latest_posts_late(scan), latest_posts(scan))


def test_rows_beyond_one_bitmap(spark, make_raw, tmp_path):
    """A file of 100,000 rows has four bitmaps; the chosen lie at their edges too."""
    n = 100_000
    ids = F.when(F.col("id").isin(0, 32_767, 32_768, 65_535, 65_536, n - 1), F.col("id")).otherwise(F.lit(7))
    empty = make_raw()
    rows = spark.range(n).coalesce(1).select(
        *[
            {
                "post_id": ids.cast("string"), "content": F.concat(F.lit("t"), "id"), "score": F.col("id"),
            }.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in empty.schema
        ]
    )
    rows.write.parquet(str(tmp_path / "raw"))
    scan = tables.raw_posts(spark, str(tmp_path / "raw"))
    assert scan.select(late.FILE).distinct().count() == 1
    got = {r.post_id: r.content for r in late.latest_posts_late(scan).collect()}
    assert got == {str(i): f"t{i}" for i in (0, 32_767, 32_768, 65_535, 65_536, n - 1)} | {"7": f"t{n - 2}"}


@pytest.mark.parametrize("limit", [None, 0, 1, 7, 10_000])
def test_pending(spark, scan, limit):
    notes = fx.annotations(spark, TINY)
    assert same(models.pending_of_scan(scan, notes, limit), models.pending(scan, notes, limit))


def test_files_in_blocks(spark, scan, monkeypatch):
    monkeypatch.setattr(late, "BITMAP_BYTES", 2 * 4096)
    notes = fx.annotations(spark, TINY)
    found = models.pending_of_scan(scan, notes)
    assert plan(found).count("BroadcastHashJoin") > 2
    assert same(found, models.pending(scan, notes))


def test_no_text_is_shuffled(spark, scan):
    found = models.pending_of_scan(scan, fx.annotations(spark, TINY))
    assert not re.search(r"Exchange hashpartitioning", plan(found))
    places = plan(late.latest_places(scan))
    assert "content" not in places and "WindowGroupLimit" in places


def test_tables_have_places(spark, scan, tmp_path):
    tables.create_raw_table(spark, "late_raw", str(tmp_path / "table"))
    try:
        tables.append_posts(scan, "late_raw")
        table = tables.raw_table(spark, "late_raw")
        assert late.has_places(table) and late.has_places(scan)
        assert not late.has_places(spark.range(3))
        assert not late.has_places(scan.groupBy("post_id").count())
        assert same(late.latest_posts_late(table), latest_posts(table))
    finally:
        spark.sql("DROP TABLE late_raw")


def test_empty(spark, make_raw, tmp_path):
    make_raw().write.parquet(str(tmp_path / "raw"))
    scan = tables.raw_posts(spark, str(tmp_path / "raw"))
    assert late.latest_posts_late(scan).count() == 0
    assert models.pending_of_scan(scan, fx.annotations(spark, TINY), 5).count() == 0

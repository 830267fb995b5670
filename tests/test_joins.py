from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postlake.operators import joins
from postlake.plans import models
from postlake.sources import tables
from tests.conftest import utc


def sample(spark):
    """Posts p0..p99 and a null id; a third of the annotations are of p7."""
    posts = spark.range(100).select(F.concat(F.lit("p"), "id").alias("post_id"), F.col("id").alias("n"))
    posts = posts.unionAll(spark.sql("select cast(null as string), 1000L"))
    ids = F.when(F.col("id") % 3 == 0, "p7").otherwise(F.concat(F.lit("p"), F.col("id") % 150))
    notes = spark.range(3000).select(ids.alias("post_id"), F.col("id").alias("note"))
    return posts, notes.unionAll(spark.sql("select cast(null as string), 1000L"))


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_parts_follow_counts(spark):
    _, notes = sample(spark)
    parts = {r.post_id: r._parts for r in joins.hot_parts(notes, 100).collect()}
    assert parts == {"p7": 11}
    assert {r._parts for r in joins.hot_parts(notes, 7).filter("post_id <> 'p7'").collect()} == {3}
    assert joins.hot_parts(notes, 10_000).isEmpty()


def test_split_join_gives_the_plain_join(spark):
    """Posts without annotations stay, whatever is hot."""
    posts, notes = sample(spark)
    for how in ("left", "inner"):
        plain = joins.with_annotations(posts, notes, how=how)
        for part_rows in (1, 7, 100, 10_000):
            split = joins.with_annotations(posts, notes, part_rows, how)
            assert split.columns == plain.columns
            assert same(plain, split)


def test_equal_rows_are_parted(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__coalescePartitions__enabled="false", shuffle__partitions="16")
    posts = spark.sql("select 'a' as post_id")
    notes = spark.range(0, 20_000, 1, 4).selectExpr("'a' as post_id", "1 as note")
    joined = joins.with_annotations(posts, notes, 1000)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) > 4 and max(sizes) < 10_000


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    names = []

    def set_all(**options):
        for name, value in options.items():
            names.append("spark.sql." + name.replace("__", "."))
            spark.conf.set(names[-1], value)

    yield set_all
    for name in names:
        spark.conf.unset(name)


def test_without_annotation(spark):
    posts, notes = sample(spark)
    left = joins.without_annotation(posts, notes)
    assert same(left, posts.join(notes, "post_id", "left_anti"))
    assert left.columns == posts.columns


def test_null_id_in_annotations_hides_nothing(spark):
    """NOT IN would return no row at all here; the stored key is never null."""
    posts, _ = sample(spark)
    nothing = spark.sql("select cast(null as string) as post_id")
    assert joins.without_annotation(posts, nothing).count() == posts.count()


def test_repeated_annotation_fans_out(make_raw, make_annotations):
    raw = make_raw({"post_id": "a", "content": "x"}, {"post_id": "b", "content": "y"})
    notes = make_annotations({"post_id": "a", "sentiment": "neutral"}, {"post_id": "a"})
    gold = models.gold(models.silver(models.bronze(raw)), notes)
    assert gold.count() == 3
    assert len(gold.columns) == 41
    safe = models.gold(models.silver(models.bronze(raw)), notes, redacted_only=True)
    assert not {"post_title", "post_url", "post_flair", "text_raw"} & set(safe.columns)


def test_marts_of_ids_equal_marts_of_gold(make_raw, make_annotations):
    raw = make_raw(
        *[{"post_id": p, "content": c, "scraped_at": utc(2024, 1, 1)} for p in "abcd" for c in "xy"]
    )
    notes = make_annotations(
        {"post_id": "a", "keywords": ["Iron", "iron", None], "safety_flags": ["urgent_pain"]},
        {"post_id": "b", "keywords": [], "safety_flags": ["Urgent_Pain", None]},
        {"post_id": "c", "keywords": None, "safety_flags": None},
        {"post_id": "zz", "keywords": ["lost"], "safety_flags": ["urgent_bleeding"]},
    )
    gold = models.post_review(models.gold(models.silver(models.bronze(raw)), notes))
    for part_rows in (None, 1):
        review = models.review_of_ids(raw, notes, ["keywords", "safety_flags"], part_rows)
        for mart in (models.keywords_exploded, models.safety_flags_exploded, models.safety_booleans):
            assert same(mart(review), mart(gold))
    words = [r.keyword for r in models.keywords_exploded(gold).collect()]
    assert sorted(words, key=str) == [None, "iron", "iron"]
    flags = {r.post_id: (r.is_urgent_pain, r.is_mh_crisis) for r in models.safety_booleans(gold).collect()}
    # Exact case; NULL for no annotation, and for a list with a NULL and no hit.
    assert flags == {"a": (True, False), "b": (None, None), "c": (None, None), "d": (None, None)}
    assert models.keywords_exploded(gold, distinct=True).count() == 3


def test_bucketed_tables_join_without_shuffle(spark, make_raw, make_annotations, tmp_path):
    tables.create_raw_table(spark, "bucketed_raw", str(tmp_path / "raw"), buckets=4)
    tables.create_annotation_table(spark, "bucketed_notes", str(tmp_path / "notes"), buckets=4)
    tables.append_posts(make_raw(*[{"post_id": f"p{i % 20}", "score": i} for i in range(60)]), "bucketed_raw", 4)
    tables.append_annotations(make_annotations({"post_id": "p3"}), "bucketed_notes", 4)
    assert len(list((tmp_path / "raw").glob("*.parquet"))) == 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver = models.silver(models.bronze(tables.raw_table(spark, "bucketed_raw")))
        gold = models.gold(silver, tables.annotation_table(spark, "bucketed_notes"))
        assert "Exchange" not in gold._jdf.queryExecution().executedPlan().toString()
        assert gold.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_materialised_model(spark, make_raw, tmp_path):
    silver = models.silver(models.bronze(make_raw({"post_id": "a", "content": "b c d e f"})))
    stored = tables.materialise(silver, "silver_stored", 2, str(tmp_path / "silver"))
    assert same(stored, silver)


def test_views(spark, make_raw, make_annotations):
    raw = make_raw({"post_id": "a", "content": "x y"}, {"post_id": "b", "subreddit": "S"})
    notes = make_annotations({"post_id": "a", "keywords": ["Iron"], "safety_flags": ["urgent_pain"]})
    names = models.views(spark, raw, notes)
    assert [n for n in names if not spark.catalog.tableExists(n)] == []
    row = spark.sql(
        "select * from post_review join keywords_exploded using (post_id) join safety_booleans using (post_id)"
    ).first()
    assert (row.post_id, row.text_for_llm, row.keyword, row.is_urgent_pain) == ("a", "x y", "iron", True)

from __future__ import annotations

import random

from postlake.operators.dedupe import latest_posts
from postlake.schemas import RAW_POST
from postlake.streaming import incremental
from tests.conftest import utc


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def random_posts(make_raw, rng, n):
    return make_raw(
        *[
            {
                "post_id": f"p{rng.randint(0, 40)}",
                "score": rng.randint(0, 9),
                "content": rng.choice(["x", "y", None]),
                "scraped_at": rng.choice([None, utc(2024, 1, rng.randint(1, 9))]),
            }
            for _ in range(n)
        ]
    )


def test_daily_runs_equal_one_batch(spark, make_raw, tmp_path):
    """Files land in turns; runs without news add nothing."""
    rng = random.Random(5)
    landed, target, progress = (str(tmp_path / n) for n in ("landed", "target", "progress"))

    def run():
        incremental.take_in_new(spark, landed, RAW_POST, target, progress, files_per_batch=1)

    for _ in range(3):
        random_posts(make_raw, rng, 60).repartition(2).write.mode("append").parquet(landed)
        run()
    run()
    everything = spark.read.schema(RAW_POST).parquet(landed)
    assert same(incremental.current_posts(spark, target), latest_posts(everything))

    moved = str(tmp_path / "moved")
    incremental.compact(spark, target, moved)
    random_posts(make_raw, rng, 60).write.mode("append").parquet(landed)
    incremental.take_in_new(spark, landed, RAW_POST, moved, progress)
    assert same(incremental.current_posts(spark, moved), latest_posts(everything.unionAll(
        spark.read.schema(RAW_POST).parquet(landed))))


def test_repeated_batch_counts_once(spark, make_raw, tmp_path):
    """Without its progress a run repeats its batches and overwrites the same folders."""
    rng = random.Random(6)
    landed, target = str(tmp_path / "landed"), str(tmp_path / "target")
    random_posts(make_raw, rng, 50).coalesce(1).write.parquet(landed)
    for progress in ("one", "two"):
        incremental.take_in_new(spark, landed, RAW_POST, target, str(tmp_path / progress))
    assert same(
        incremental.current_posts(spark, target), latest_posts(spark.read.schema(RAW_POST).parquet(landed))
    )
    assert spark.read.parquet(f"{target}/batch=*").count() == incremental.current_posts(spark, target).count()


def test_merged_state_equals_one_batch(spark, make_raw, tmp_path):
    rng = random.Random(7)
    landed, target, progress = (str(tmp_path / n) for n in ("landed", "target", "progress"))

    def run():
        incremental.merge_new(spark, landed, RAW_POST, target, progress, 5, files_per_batch=1)

    for _ in range(3):
        random_posts(make_raw, rng, 60).repartition(2).write.mode("append").parquet(landed)
        run()
    run()
    everything = spark.read.schema(RAW_POST).parquet(landed)
    merged = incremental.merged_posts(spark, target)
    assert same(merged, latest_posts(everything))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_untouched_buckets_are_not_rewritten(spark, make_raw, tmp_path):
    landed, target, progress = (str(tmp_path / n) for n in ("landed", "target", "progress"))
    make_raw(*[{"post_id": f"p{i}"} for i in range(200)]).coalesce(1).write.parquet(landed)
    incremental.merge_new(spark, landed, RAW_POST, target, progress, 32)
    make_raw({"post_id": "p7", "score": 3}).coalesce(1).write.mode("append").parquet(landed)
    incremental.merge_new(spark, landed, RAW_POST, target, progress, 32)
    folders = {v.name: len(list(v.glob("bucket=*"))) for v in (tmp_path / "target").glob("version=*")}
    assert sorted(folders.values()) == [1, 32]
    posts = {r.post_id: r.score for r in incremental.merged_posts(spark, target).collect()}
    assert len(posts) == 200 and posts["p7"] == 3


def test_repeated_merge_counts_once(spark, make_raw, tmp_path):
    rng = random.Random(8)
    landed, target = str(tmp_path / "landed"), str(tmp_path / "target")
    random_posts(make_raw, rng, 50).coalesce(1).write.parquet(landed)
    for progress in ("one", "two"):
        incremental.merge_new(spark, landed, RAW_POST, target, str(tmp_path / progress), 4)
    assert same(
        incremental.merged_posts(spark, target), latest_posts(spark.read.schema(RAW_POST).parquet(landed))
    )


def test_state_is_read_by_a_scan_and_merged_by_one_shuffle(spark, make_raw, tmp_path):
    """However large the state: nothing that a merge or a read does depends on its statistics."""
    landed, target = str(tmp_path / "landed"), str(tmp_path / "target")
    make_raw(*[{"post_id": f"p{i}", "content": "x"} for i in range(20)]).write.parquet(landed)
    incremental.merge_new(spark, landed, RAW_POST, target, str(tmp_path / "progress"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = incremental.merged_posts(spark, target)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and plan.count("hashpartitioning(bucket") <= 1
    news = make_raw(*[{"post_id": f"p{i}"} for i in range(9)]).withColumn("bucket", incremental.bucket_of(4))
    merged = latest_posts(news.repartition("bucket"), ["bucket", "post_id"])
    assert merged._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    assert same(merged.drop("bucket"), latest_posts(news.drop("bucket")))

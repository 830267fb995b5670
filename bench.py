"""Time the headline queries and print one JSON line.

The documents, one row group in the given tables, are first stored anew in several
files, so that a scan has a task for every core. Every query runs in full into a
sink that drops the rows; the best of the runs counts, building the derived test
tables included. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS change the defaults.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import all_queries
from postlake.session import local_session, scratch_path

HEADLINES = [
    "bronze",
    "silver",
    "routing",
    "pending_posts",
    "gold",
    "model_views",
    "keywords_exploded",
    "top_keywords",
    "safety_kpis",
    "latest_annotated",
    "content_duplicates",
    "top_posts_period",
    "shape_archive",
    "loaded_subreddit_days",
    "prompt_render",
    "parse_annotations",
    "validate_annotations",
    "lexicon_tags",
]


def dealt_out(spark, sf_dir: str, files: int) -> str:
    """A copy of the two tables the headlines read, the documents in several files."""
    path = scratch_path(spark, "bench")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.repartition(files, "doc_id").write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    stored = dealt_out(spark, sf_dir, 2 * cores)
    rows = spark.read.parquet(f"{stored}/documents.parquet").count()
    for name in HEADLINES:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, stored).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "documents_per_second_per_core": {
                    name: round(rows / s / cores) for name, s in seconds.items()
                },
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

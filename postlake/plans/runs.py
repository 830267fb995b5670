"""Jobs: one daily ingest and one annotation run."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions import text
from postlake.functions.time import instant
from postlake.operators import annotate, dedupe, late, shape, summary
from postlake.plans import models
from postlake.sources import tables


def ingest_archive(records: DataFrame, table: str, run_ts: dt.datetime) -> DataFrame:
    """Shape landed archive records, append them, and report what was stored.

    The report reads the stored rows of this ``run_ts``, so the landed text is read
    and parsed once. ``tables.post_rejects`` lists what was too long to store.
    """
    spark = records.sparkSession
    tables.create_raw_table(spark, table)
    tables.append_posts(shape.shape_archive(records, run_ts), table)
    stored = tables.raw_table(spark, table).filter(F.col("scraped_at") == instant(run_ts))
    return summary.ingest_summary(stored)


# Prompts of one task of a run: what a lost task costs.
TASK_ROWS = 1000
# A task's file is in place once the task is done, not only when the whole job is.
COMMIT_BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def annotate_pending(
    spark: SparkSession,
    posts: DataFrame,
    table: str,
    annotator: annotate.Annotator,
    template: str,
    model_name: str,
    model_version: str,
    run_ts: dt.datetime,
    folder: str,
    limit: int | None = None,
    partitions: int | None = None,
    saves: int = 1,
    task_rows: int = TASK_ROWS,
    **asking,
) -> DataFrame:
    """Annotate what is pending and store it; returns all results of the run.

    ``posts`` is the raw table or a stored silver table, ``folder`` a place of this
    run's own that all executors reach. Replies are written there before anything
    reads them. Tasks of at most about ``task_rows`` prompts (or as many as
    ``partitions`` makes) commit their replies one by one, so a job that fails keeps
    those of all tasks that were done; ``saves`` cuts the run into as many jobs. A run
    repeated with the same folder reuses the replies that can be parsed and stored, and
    asks again for all others. ``asking`` goes to ``annotate``: batch, in_flight,
    retries, wait. Results carry a status, the reason of a failure, and the broken rules
    of the contract; what can't be parsed or stored is 'failed' and stays pending,
    everything else is appended.
    """
    tables.create_annotation_table(spark, table)
    known = tables.annotation_table(spark, table)
    if "needs_annotation" in posts.columns:
        todo = models.pending_of_silver(posts, known, limit)
    elif late.has_places(posts):
        todo = models.pending_of_scan(posts, known, limit)
    else:
        todo = models.pending(posts, known, limit)
    prompts = annotate.render_prompts(todo, template)
    template_hash = text.prompt_hash(F.lit(template))

    # An empty append makes the folder, whether or not the run was here before.
    kept, asked = f"{folder}/replies", f"{folder}/prompts-{uuid.uuid4().hex}"
    replies = T.StructType([*annotate.REPLY.fields, T.StructField("prompt_hash", T.StringType())])
    spark.createDataFrame([], replies).write.mode("append").parquet(kept)

    def judged() -> DataFrame:
        """Every attempt with this template so far, parsed and measured."""
        attempts = spark.read.schema(replies).parquet(kept)
        attempts = attempts.filter(F.col("prompt_hash") == template_hash).drop("prompt_hash")
        return annotate.check_widths(annotate.parse_responses(attempts))

    good = judged().filter(F.col("status") == "ok").select("post_id").distinct()
    prompts.join(good, "post_id", "left_anti").write.parquet(asked)
    open_ = spark.read.schema(prompts.schema).parquet(asked)
    turn = F.pmod(F.xxhash64("post_id"), F.lit(saves))
    for number in range(saves):
        some = open_.filter(turn == number)
        tasks = partitions
        if not tasks:
            least = spark.sparkContext.defaultParallelism
            tasks = max(least, -(-some.count() // task_rows))
        answers = annotate.annotate(some, annotator, tasks, **asking)
        answers = answers.withColumn("prompt_hash", template_hash)
        answers.write.mode("append").options(**COMMIT_BY_TASK).parquet(kept)

    # A prompt that failed in one attempt and succeeded in a later one is a success.
    parsed = judged()
    rest = [F.asc_nulls_last(c) for c in parsed.columns if c not in ("post_id", "status")]
    best = dedupe.first_by(parsed, ["post_id"], [F.desc("status"), *rest])
    results = annotate.with_metadata(best, model_name, model_version, template, run_ts)
    # Stored, as plans that read the replies at two times would share what they read.
    told = f"{folder}/results-{uuid.uuid4().hex}"
    annotate.validate(results).write.parquet(told)
    results = spark.read.parquet(told)
    tables.append_annotations(annotate.to_annotations(results), table)
    return results

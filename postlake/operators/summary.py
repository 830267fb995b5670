"""Aggregates and short reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.schemas import SAFETY_INDICATORS


def top_keywords(keywords: DataFrame, limit: int = 25) -> DataFrame:
    return (
        keywords.groupBy("keyword")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc("keyword"))
        .limit(limit)
    )


def safety_kpis(booleans: DataFrame) -> DataFrame:
    """How many posts raise each indicator; NULL counts as no."""
    names = {n: n.removeprefix("is_") + "_posts" for n in SAFETY_INDICATORS}
    return booleans.agg(*[F.count_if(F.col(n)).alias(out) for n, out in names.items()])


def latest_annotated(gold: DataFrame, limit: int = 50, annotated_only: bool = False) -> DataFrame:
    """The newest annotations with their posts; posts without one come first."""
    if annotated_only:
        gold = gold.filter(F.col("annotated_at").isNotNull())
    return (
        gold.select("post_id", "post_title", "post_summary", "care_response", "annotated_at")
        .orderBy(F.desc_nulls_first("annotated_at"), "post_id")
        .limit(limit)
    )


def ingest_summary(raw: DataFrame) -> DataFrame:
    """Collected posts and their time span per community."""
    return raw.groupBy("subreddit").agg(
        F.count("*").alias("n_posts"),
        F.min("post_date").alias("first_post_date"),
        F.max("post_date").alias("last_post_date"),
    )


def annotation_summary(results: DataFrame) -> DataFrame:
    """Total, successful and failed annotations of a run."""
    return results.agg(
        F.count("*").alias("n_total"),
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") != "ok").alias("n_failed"),
    )


def token_usage(annotations: DataFrame) -> DataFrame:
    """Token totals and means per model and prompt."""
    return annotations.groupBy("model_name", "prompt_hash").agg(
        F.count("*").alias("n_annotations"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.avg("input_tokens").alias("avg_input_tokens"),
        F.avg("output_tokens").alias("avg_output_tokens"),
    )


def repeated_annotations(annotations: DataFrame) -> DataFrame:
    """Post ids with more than one annotation; such posts fan out in gold."""
    counts = annotations.groupBy("post_id").agg(F.count("*").alias("n_annotations"))
    return counts.filter(F.col("n_annotations") > 1)

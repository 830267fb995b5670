"""Keep one row per key.

All of these rank with ``row_number`` and keep rank 1. Spark then trims every
map task to one row per key before the shuffle, so a key that holds a large
share of all rows reaches its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_order(columns: list[str]) -> list[Column]:
    """Newest scrape first, a missing scrape time before all; then every other column.

    ``content`` comes last, so that rows without it are in the same order but for ties.
    """
    order = [
        F.desc_nulls_first("scraped_at"),
        F.desc_nulls_last("post_timestamp"),
        F.desc_nulls_last("post_date"),
        F.desc_nulls_last("score"),
        F.desc_nulls_last("num_comments"),
        *[F.asc_nulls_last(c) for c in ("subreddit", "post_flair", "url", "title")],
    ]
    return [*order, F.asc_nulls_last("content")] if "content" in columns else order


def latest_posts(raw: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The most recent scrape of each post; a missing scrape time counts as newest.

    The order ends in every other column, so a tie can only be between equal
    rows and a task that runs twice keeps the same row. A frame without ``content``
    picks the same rows, so queries that need no text can drop it first and neither
    read nor shuffle it. ``keys`` may name a column made of the post id before it: rows
    that lie by that column are not shuffled again.
    """
    return first_by(raw, keys or ["post_id"], latest_order(raw.columns))


def first_seen(df: DataFrame, key: str, arrival: list[Column]) -> DataFrame:
    """The first arrival of each key, as a scraper that skips known ids keeps it."""
    return first_by(df, [key], arrival)


def latest_annotations_order(columns: list[str], keys: list[str]) -> list[Column]:
    """Newest first, then every other column."""
    rest = [c for c in columns if c not in (*keys, "annotated_at")]
    return [F.desc_nulls_last("annotated_at"), *[F.asc_nulls_last(c) for c in rest]]


def latest_annotations(annotations: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One annotation per post, the newest one; ``keys`` as for posts."""
    keys = keys or ["post_id"]
    return first_by(annotations, keys, latest_annotations_order(annotations.columns, keys))


def one_per_content(posts: DataFrame) -> DataFrame:
    """One post per content hash: the earliest. Documented feature, opt-in."""
    return first_by(posts, ["content_hash"], [F.asc_nulls_last("post_date"), F.asc("post_id")])


def content_duplicates(posts: DataFrame) -> DataFrame:
    """Content hashes that several posts share, with size and span of each group.

    Only counts and bounds leave the map tasks, never the list of members.
    """
    return (
        posts.groupBy("content_hash")
        .agg(
            F.count("*").alias("n_posts"),
            F.min("post_id").alias("first_post_id"),
            F.max("post_id").alias("last_post_id"),
            F.min("post_date").alias("first_post_date"),
            F.max("post_date").alias("last_post_date"),
        )
        .filter(F.col("n_posts") > 1)
    )

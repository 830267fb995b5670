"""Landed API records to raw posts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.time import instant
from postlake.operators.once import add_once
from postlake.schemas import ARCHIVE_RECORD, RAW_COLUMNS

# --- Fixed values: link prefixes of the two feeds -----------------------------
ARCHIVE_HOST = "https://reddit.com"
TOP_HOST = "https://www.reddit.com"


def _or_default(field: str, default) -> Column:
    """A field of the record, or the default when its key is absent.

    A key that is present with null stays null, as a dictionary lookup with a
    default has it. The keys are only looked at for rows where it matters.
    """
    value = F.col(f"r.{field}")
    present = F.array_contains(F.json_object_keys("value"), field)
    return F.when(value.isNotNull(), value).when(present, F.lit(None)).otherwise(F.lit(default))


def parse_archive(records: DataFrame) -> DataFrame:
    """JSON text in ``value`` next to its typed form ``r``; bad text gives nulls."""
    return add_once(records, "r", F.from_json("value", ARCHIVE_RECORD))


def _is_usable() -> Column:
    usable = F.col("r.id").isNotNull() & F.col("r.created_utc").isNotNull()
    return F.coalesce(usable, F.lit(False))


def shape_archive(records: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Archive records to raw posts; records without id or time are left out."""
    parsed = parse_archive(records).filter(_is_usable())
    seconds = F.col("r.created_utc").cast("bigint")
    selftext = F.nullif(F.col("r.selftext"), F.lit(""))
    return parsed.select(
        F.col("r.id").alias("post_id"),
        F.timestamp_seconds(seconds).alias("post_date"),
        seconds.alias("post_timestamp"),
        F.col("r.link_flair_text").alias("post_flair"),
        _or_default("title", "").alias("title"),
        F.concat(F.lit(ARCHIVE_HOST), F.coalesce("r.permalink", F.lit(""))).alias("url"),
        F.coalesce(selftext, _or_default("url", "")).alias("content"),
        _or_default("score", 0).cast("bigint").alias("score"),
        _or_default("num_comments", 0).cast("bigint").alias("num_comments"),
        _or_default("subreddit", "").alias("subreddit"),
        instant(run_ts).alias("scraped_at"),
    )


def archive_rejects(records: DataFrame) -> DataFrame:
    """The records ``shape_archive`` leaves out, with the reason."""
    reason = (
        F.when(F.col("r").isNull() | F.json_object_keys("value").isNull(), "not a JSON object")
        .when(F.col("r.id").isNull(), "no id")
        .otherwise("no created_utc")
    )
    return parse_archive(records).filter(~_is_usable()).withColumn("reason", reason).drop("r")


def shape_top(records: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Top-list submissions, one typed row each, to raw posts."""
    seconds = F.col("created_utc").cast("bigint")
    link = F.when(F.col("is_self"), F.concat(F.lit(TOP_HOST), "permalink")).otherwise(F.col("url"))
    shaped = records.filter(F.col("id").isNotNull() & F.col("created_utc").isNotNull()).select(
        F.col("id").alias("post_id"),
        F.timestamp_seconds(seconds).alias("post_date"),
        seconds.alias("post_timestamp"),
        F.col("link_flair_text").alias("post_flair"),
        "title",
        link.alias("url"),
        F.col("selftext").alias("content"),
        F.col("score").cast("bigint").alias("score"),
        F.col("num_comments").cast("bigint").alias("num_comments"),
        "subreddit",
        instant(run_ts).alias("scraped_at"),
    )
    return shaped.select(RAW_COLUMNS)


def rename_upper(df: DataFrame) -> DataFrame:
    """Column names in upper case, for export."""
    return df.toDF(*[c.upper() for c in df.columns])


def rename_lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])

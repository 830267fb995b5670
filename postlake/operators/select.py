"""Choosing posts: by day, community, flair, period and rank."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions.time import instant, start_of
from postlake.schemas import DAILY_COMMUNITIES

# Trailing periods of a top list; 'all' has no lower bound.
PERIODS = {
    "hour": dt.timedelta(hours=1),
    "day": dt.timedelta(days=1),
    "week": dt.timedelta(days=7),
    "month": dt.timedelta(days=30),
    "year": dt.timedelta(days=365),
    "all": None,
}

TOP_LIMIT = 1000
RANK_SALTS = 256


def _of_day(raw: DataFrame, community: str, day: dt.date) -> DataFrame:
    if "post_day" in raw.columns:
        raw = raw.filter(F.col("post_day") == F.lit(day))
    return raw.filter(
        (F.col("post_date") >= start_of(day))
        & (F.col("post_date") < start_of(day + dt.timedelta(days=1)))
        & (F.lower("subreddit") == community.lower())
    )


def posts_for_day(
    raw: DataFrame, community: str, day: dt.date, max_posts: int | None = None
) -> DataFrame:
    """Posts of one community created on one day (UTC), oldest first."""
    chosen = _of_day(raw, community, day).orderBy("post_date", "post_id")
    return chosen if max_posts is None else chosen.limit(max_posts)


def has_flair(flair: Column, wanted: str) -> Column:
    """Flair holds the wanted text, in any case; a missing flair never does."""
    return F.coalesce(F.contains(F.lower(flair), F.lit(wanted.lower())) & (flair != ""), F.lit(False))


def with_flair(raw: DataFrame, wanted: str) -> DataFrame:
    """Posts with a flair that holds the wanted text; all posts if none is wanted."""
    return raw.filter(has_flair(F.col("post_flair"), wanted)) if wanted else raw


def of_communities(raw: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Posts of several communities in one pass; names match in any case."""
    wanted = [name.lower() for name in (DAILY_COMMUNITIES if names is None else names)]
    return raw.filter(F.lower("subreddit").isin(wanted))


def in_period(posts: DataFrame, period: str, as_of: dt.datetime) -> DataFrame:
    """Posts of a trailing period that ends at ``as_of``.

    A post's creation time is the same in all its scrapes, so raw posts may be
    filtered before they are deduplicated: the bounds then reach the scan, and day
    folders outside the period stay closed.
    """
    span = PERIODS[period]
    if span is None:
        return posts
    if "post_day" in posts.columns:
        days = [(t if t.tzinfo is None else t.astimezone(dt.timezone.utc)).date() for t in (as_of - span, as_of)]
        posts = posts.filter(F.col("post_day").between(*map(F.lit, days)))
    return posts.filter(F.col("post_date").between(instant(as_of - span), instant(as_of)))


def top_posts(posts: DataFrame, limit: int = TOP_LIMIT) -> DataFrame:
    """The best posts of each community by score, ranked from 1.

    Communities are few and some are huge, so the rank is taken twice: first
    within a community and a salt of the post id, then over the survivors. The
    last step sees at most ``RANK_SALTS * limit`` rows of a community.
    """
    best = [F.desc_nulls_last("score"), F.asc("post_id")]
    salted = posts.withColumn("_salt", F.pmod(F.xxhash64("post_id"), F.lit(RANK_SALTS)))
    for keys in (["subreddit", "_salt"], ["subreddit"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        salted = salted.withColumn("top_rank", rank).filter(F.col("top_rank") <= limit)
    return salted.drop("_salt")


def loaded_communities(wanted: DataFrame, raw: DataFrame) -> DataFrame:
    """For each wanted ``subreddit``, in exact case, whether any post is stored."""
    stored = raw.select("subreddit").distinct().withColumn("_hit", F.lit(True))
    return wanted.join(stored, "subreddit", "left").select(
        "subreddit", F.coalesce("_hit", F.lit(False)).alias("is_loaded")
    )


def loaded_days(wanted: DataFrame, raw: DataFrame) -> DataFrame:
    """For each wanted (``subreddit`` in any case, ``day``): stored posts and a flag.

    Posts of other communities and days leave before they are counted; with day
    folders the join prunes those of other days.
    """
    day = F.col("post_day") if "post_day" in raw.columns else F.to_date("post_date")
    asked = wanted.select(F.upper("subreddit").alias("_name"), "day").distinct()
    stored = (
        raw.select(F.upper("subreddit").alias("_name"), day.alias("day"))
        .join(asked, ["_name", "day"], "left_semi")
        .groupBy("_name", "day")
        .agg(F.count("*").alias("_n"))
    )
    n_posts = F.coalesce("_n", F.lit(0))
    return (
        wanted.withColumn("_name", F.upper("subreddit"))
        .join(stored, ["_name", "day"], "left")
        .select("subreddit", "day", n_posts.alias("n_posts"), (n_posts > 0).alias("is_loaded"))
    )


def is_community_loaded(raw: DataFrame, name: str) -> bool:
    """Whether any post of a community is stored; stops at the first hit."""
    return not raw.filter(F.col("subreddit") == name).isEmpty()


def is_day_loaded(raw: DataFrame, name: str, day: dt.date) -> bool:
    """Whether any post of a community and day is stored."""
    return not _of_day(raw, name, day).isEmpty()

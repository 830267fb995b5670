"""Joins of posts and annotations on the post id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Annotations of one post that a task may join; posts with more get several parts.
PART_ROWS = 100_000


def hot_parts(annotations: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(post_id, _parts) of posts with more annotations than ``part_rows``.

    One pass over the ids, combined map-side. At most one in ``part_rows``
    annotations gives a row here.
    """
    counts = annotations.filter(F.col("post_id").isNotNull()).groupBy("post_id").count()
    parts = F.ceil(F.col("count") / part_rows).cast("int")
    return counts.select("post_id", parts.alias("_parts")).filter("_parts > 1")


def distinct_ids(df: DataFrame) -> DataFrame:
    """Each post id once, combined map-side."""
    return df.select("post_id").distinct()


def with_annotations(
    posts: DataFrame,
    annotations: DataFrame,
    part_rows: int | None = None,
    how: str = "left",
) -> DataFrame:
    """Join posts, unique on post id, with all their annotations.

    Appends keep stored annotations unique as well, then this is one shuffled join.
    Where a table may hold some ids very often give ``part_rows``, the number of
    annotations of one post that a task may join. AQE cannot split the annotations
    of a left join, so every post then gets as many parts as its count asks for, by
    the same path at every size: its annotations are dealt out over the parts, one
    copy of the post meets each, and of a post with annotations the copies that
    meet none are dropped. Posts are read once. The dealing numbers rows where they
    are read, which parts equal rows too; it is the same when a task that reads a
    stored table runs twice.
    """
    if not part_rows:
        return posts.join(annotations, "post_id", how)
    hot = hot_parts(annotations, part_rows)
    # Numbered where they are read: after a join the order of rows could differ when a
    # lost task runs again.
    numbered = annotations.withColumn("_number", F.monotonically_increasing_id())
    dealt = numbered.join(hot, "post_id", "left").withColumn(
        "_part",
        F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod("_number", "_parts")).cast("int"),
    )
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    spread = posts.join(hot, "post_id", "left").withColumn("_part", copies)
    met = dealt.drop("_parts", "_number").withColumn("_met", F.lit(True))
    joined = spread.join(met, ["post_id", "_part"], how)
    return joined.filter(F.col("_parts").isNull() | F.col("_met")).drop("_part", "_parts", "_met")


def without_annotation(posts: DataFrame, annotations: DataFrame) -> DataFrame:
    """Posts no annotation names yet.

    A left join on the distinct ids that keeps the misses: as the ids are unique
    no post is repeated, and unlike an anti-join the optimizer does not move it
    below the deduplication, where all scrapes of a post would be shuffled. An
    annotation without id matches nothing.
    """
    seen = distinct_ids(annotations.filter(F.col("post_id").isNotNull()))
    joined = posts.join(seen.withColumn("_seen", F.lit(True)), "post_id", "left")
    return joined.filter(F.col("_seen").isNull()).drop("_seen")

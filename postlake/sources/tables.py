"""Stored tables: scan, create, append, materialise."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators import dedupe, joins, select
from postlake.operators.annotate import sanitise_free_text
from postlake.schemas import (
    ANNOTATION,
    ANNOTATION_COLUMNS,
    ANNOTATION_DDL,
    ANNOTATION_WIDTHS,
    RAW_COLUMNS,
    RAW_POST,
    RAW_POST_BY_DAY,
    RAW_POST_DDL,
    RAW_WIDTHS,
)


def raw_posts(spark: SparkSession, path: str) -> DataFrame:
    """Raw posts under a path, with the declared schema."""
    return spark.read.schema(RAW_POST).parquet(path)


def raw_posts_by_day(spark: SparkSession, path: str) -> DataFrame:
    """Raw posts that ``append_posts_by_day`` wrote, with the folder's ``post_day``."""
    return spark.read.schema(RAW_POST_BY_DAY).parquet(path)


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Stored annotations under a path, with the declared schema."""
    return spark.read.schema(ANNOTATION).parquet(path)


def raw_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(RAW_COLUMNS)


def annotation_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(ANNOTATION_COLUMNS)


def _create(
    spark: SparkSession, table: str, columns: str, location: str | None, buckets: int | None
) -> None:
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    bucketing = f" CLUSTERED BY (post_id) INTO {buckets} BUCKETS" if buckets else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{bucketing}{place}")


def create_raw_table(
    spark: SparkSession, table: str, location: str | None = None, buckets: int | None = None
) -> None:
    """Create the raw table unless it is there; a schema in the name as well.

    With ``buckets`` the rows lie by post id, and deduplication and the joins
    behind it need no shuffle: it is paid once, on append. Leave it out where
    one post may be scraped so often that its bucket would be too large.
    """
    _create(spark, table, RAW_POST_DDL, location, buckets)


def create_annotation_table(
    spark: SparkSession, table: str, location: str | None = None, buckets: int | None = None
) -> None:
    """Create the annotation table unless it is there; a schema in the name as well."""
    _create(spark, table, ANNOTATION_DDL, location, buckets)


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether a table or view is there; the name matches in any case."""
    return spark.catalog.tableExists(table)


def community_loaded(spark: SparkSession, table: str, name: str) -> bool:
    """Whether the table is there and holds a post of the community (exact case)."""
    return table_exists(spark, table) and select.is_community_loaded(spark.table(table), name)


def day_loaded(spark: SparkSession, table: str, name: str, day: dt.date) -> bool:
    """Whether the table is there and holds a post of the community (any case) and day."""
    return table_exists(spark, table) and select.is_day_loaded(spark.table(table), name, day)


def _append(rows: DataFrame, table: str, buckets: int | None) -> None:
    if buckets:
        rows = rows.repartition(buckets, "post_id")
    rows.write.insertInto(table)


def _too_long(widths: dict[str, int]) -> Column:
    """The first column whose text is longer than the table allows, or null."""
    return F.coalesce(
        *[F.when(F.length(c) > n, F.lit(f"{c} is longer than {n}")) for c, n in widths.items()]
    )


def post_rejects(posts: DataFrame) -> DataFrame:
    """Raw posts that the table can't hold, with the ``reason``; appends leave them out."""
    reason = _too_long(RAW_WIDTHS)
    return posts.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def annotation_rejects(annotations: DataFrame) -> DataFrame:
    """Annotations that the table can't hold, with the ``reason``; appends leave them out."""
    reason = _too_long(ANNOTATION_WIDTHS)
    return annotations.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def append_posts(posts: DataFrame, table: str, buckets: int | None = None) -> None:
    """Append raw posts as they are. The table keeps every scrape of a post.

    Rows with a text too long for its column are left out, whole, so that one can't
    fail the append of all others; ``post_rejects`` lists them.

    For a bucketed table give its bucket count: each bucket then gets one file
    instead of one per task. An empty frame adds no rows; it is not tested for
    emptiness first, as that would run the plan behind it twice.
    """
    fitting = posts.select(RAW_COLUMNS).filter(_too_long(RAW_WIDTHS).isNull())
    _append(fitting, table, buckets)


def append_posts_by_day(posts: DataFrame, path: str) -> None:
    """Append raw posts below a path, in one folder per day of the post.

    Read with ``raw_posts_by_day``, a day slice opens the folder of its day only.
    Rows of a day are brought together before the write so that days do not fall
    into small files; the rebalance splits a day far larger than the others.
    """
    dated = posts.select(*RAW_COLUMNS, F.to_date("post_date").alias("post_day"))
    dated.hint("rebalance", "post_day").write.mode("append").partitionBy("post_day").parquet(path)


def new_annotations(annotations: DataFrame, stored: DataFrame) -> DataFrame:
    """Clean annotations, one per post, of posts the stored table does not hold."""
    named = annotations.filter(F.col("post_id").isNotNull()).select(ANNOTATION_COLUMNS)
    return sanitise_free_text(joins.without_annotation(dedupe.latest_annotations(named), stored))


def append_annotations(annotations: DataFrame, table: str, buckets: int | None = None) -> None:
    """Append annotations of new posts; running it again adds nothing.

    What is too long for its column stays out, see ``annotation_rejects``.
    """
    stored = annotations.sparkSession.table(table)
    fitting = annotations.filter(_too_long(ANNOTATION_WIDTHS).isNull())
    _append(new_annotations(fitting, stored).select(ANNOTATION_COLUMNS), table, buckets)


def materialise(model: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store a model bucketed and sorted by post id, and read it from there.

    Two models stored with the same bucket count join on the id without a
    shuffle. Store silver once per run when several reports read it; as a view
    it is computed for each of them.
    """
    writer = (
        model.repartition(buckets, "post_id")
        .write.mode("overwrite")
        .bucketBy(buckets, "post_id")
        .sortBy("post_id")
    )
    if path:
        writer = writer.option("path", path)
    writer.format("parquet").saveAsTable(table)
    return model.sparkSession.table(table)

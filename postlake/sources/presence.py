"""What is loaded, kept beside the raw table: posts by file, community and day.

Asking whether a day of a community is loaded reads two columns of the whole raw table.
The index answers from counts: for every data file of the table its posts by community
and day. ``refresh`` reads the files that are new since the last time, two columns of
them, and appends their counts; files that are gone no longer count. So the index may be
refreshed after an append, twice, or after an append whose refresh failed, and always
equals a scan. One refresh at a time may run on an index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators import select

INDEX = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("n", T.LongType()),
    ]
)
FILE = "_metadata.file_path"


def _files(raw: DataFrame) -> DataFrame:
    """The data files of the table, by the names under which its rows report them: these
    have one slash where there is no host."""
    names = [(name.replace(":///", ":/", 1),) for name in raw.inputFiles()]
    return raw.sparkSession.createDataFrame(names, "file string").distinct()


def _index(spark: SparkSession, path: str) -> DataFrame:
    # An empty append makes the folder that the first refresh would miss.
    spark.createDataFrame([], INDEX).write.mode("append").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def refresh(raw: DataFrame, path: str) -> int:
    """Take in the files of a raw table that the index at ``path`` lacks; their number.

    A file without rows gives a row without community, so that it is known too.
    """
    spark = raw.sparkSession
    known = _index(spark, path).select("file").distinct()
    new = _files(raw).join(known, "file", "left_anti")
    names = [row[0] for row in new.collect()]
    if not names:
        return 0
    # The metadata column is a filter of the file listing: other files stay closed.
    counts = (
        raw.filter(F.col(FILE).isin(names))
        .groupBy(F.col(FILE).alias("file"), "subreddit", F.to_date("post_date").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    filled = new.join(counts, "file", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    filled.select(INDEX.fieldNames()).write.mode("append").parquet(path)
    return len(names)


def counts(raw: DataFrame, path: str) -> DataFrame:
    """(subreddit, day, n) of the files that the table has now."""
    index = _index(raw.sparkSession, path).join(_files(raw), "file", "left_semi")
    # A refresh that was repeated after a failure may have written a file's rows twice.
    once = index.distinct().filter(F.col("n") > 0)
    return once.groupBy("subreddit", "day").agg(F.sum("n").alias("n"))


def loaded_communities(wanted: DataFrame, raw: DataFrame, path: str) -> DataFrame:
    """``select.loaded_communities`` from the index."""
    return select.loaded_communities(wanted, counts(raw, path))


def loaded_days(wanted: DataFrame, raw: DataFrame, path: str) -> DataFrame:
    """``select.loaded_days`` from the index."""
    stored = counts(raw, path).groupBy(F.upper("subreddit").alias("_name"), "day").agg(F.sum("n").alias("_n"))
    n_posts = F.coalesce("_n", F.lit(0)).cast("long")
    return (
        wanted.withColumn("_name", F.upper("subreddit"))
        .join(stored, ["_name", "day"], "left")
        .select("subreddit", "day", n_posts.alias("n_posts"), (n_posts > 0).alias("is_loaded"))
    )

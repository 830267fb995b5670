"""Incremental bronze: take in newly landed files only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators import late
from postlake.operators.dedupe import first_by, latest_annotations_order, latest_order, latest_posts
from postlake.schemas import ANNOTATION, RAW_POST
from postlake.streaming.state import State, bucket_of


def take_in_new(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_batch: int | None = None,
) -> None:
    """Process the files that landed since the last run, then stop.

    Each batch keeps the latest scrape of its posts and writes them to a folder
    named after the batch. A batch that is repeated after a failure overwrites
    its own folder, so it counts once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_posts(shape(batch)).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    _run(spark, source, schema, checkpoint, files_per_batch, write)


def _run(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    checkpoint: str,
    files_per_batch: int | None,
    write: Callable[[DataFrame, int], None],
    columns: Column | str = "*",
) -> None:
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    query = (
        stream.parquet(source)
        .select(columns)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_posts(spark: SparkSession, target: str) -> DataFrame:
    """Latest scrape of each post over all batches; equals one batch run over all."""
    return latest_posts(spark.read.schema(RAW_POST).parquet(f"{target}/batch=*"))


def compact(spark: SparkSession, target: str, new_target: str) -> DataFrame:
    """Write the current posts as the first batch of a new target.

    The old target is left as it is; point the next runs, with the same
    checkpoint, to the new one.
    """
    current_posts(spark, target).write.mode("overwrite").parquet(f"{new_target}/batch=compacted")
    return current_posts(spark, new_target)


# --- State merged by bucket of the post id ------------------------------------

NOTE = T.StructType([T.StructField(f.name, f.dataType) for f in ANNOTATION])
# What chooses between rows of a post in most cases, and how many orders these are.
POST_TIMES = ["scraped_at", "post_timestamp", "post_date", "score", "num_comments"]
NOTE_TIMES = ["annotated_at"]


def merge_new(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    buckets: int,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Like ``take_in_new``, but each batch is merged into a state of one row for each post.

    The state (``state``) lies in folders by version and bucket of the post id. A batch
    adds a version with the posts that it brings or changes, and says where their former
    rows lie. Rows are chosen by their times, counts and places; only rows that agree in
    all of these are compared, and shuffled, with their texts. Of equal rows the stored
    one stays, so a batch that is repeated adds nothing. Use the same number of buckets
    always. ``shape`` makes posts from landed rows; the posts of a batch are stored then.
    """
    write = _merging(spark, source, schema, State(target, RAW_POST), buckets, POST_TIMES, latest_order, shape)
    _run(spark, source, schema, checkpoint, files_per_batch, write, F.col(late.FILE).alias("_file"))


def merge_annotations(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    buckets: int,
    files_per_batch: int | None = None,
) -> None:
    """The same for annotations: of several for a post the newest stays."""

    def order(columns: list[str]) -> list[Column]:
        return latest_annotations_order(columns, ["post_id"])

    write = _merging(spark, source, NOTE, State(target, NOTE), buckets, NOTE_TIMES, order, None)
    _run(spark, source, NOTE, checkpoint, files_per_batch, write, F.col(late.FILE).alias("_file"))


def _merging(
    spark: SparkSession,
    source: str,
    landed: T.StructType,
    state: State,
    buckets: int,
    times: list[str],
    order: Callable[[list[str]], list[Column]],
    shape: Callable[[DataFrame], DataFrame] | None,
) -> Callable[[DataFrame, int], None]:
    columns = state.schema.fieldNames()

    def write(batch: DataFrame, batch_id: int) -> None:
        state.prepare(spark)
        files = [row[0] for row in batch.distinct().collect()]
        if not files:
            return
        scan = spark.read.schema(landed).parquet(source).filter(F.col(late.FILE).isin(files))
        if shape:
            scan = late.stored(shape(scan).select(columns), "news")
        news = scan.select(*columns, F.col(late.FILE).alias("_file"), F.col(late.ROW).alias("_row"))
        bucket = bucket_of(buckets).alias("bucket")
        heads = state.heads(spark)
        met = [row[0] for row in news.select(bucket).distinct().collect()]
        held = state.live(spark, met, heads).drop("bucket")
        choice = _choice(news, held, times, order(columns)[: len(times)])

        single = choice.filter("_news and not _tied")
        parts = [late.within(news, late.stored(late.bitmaps(single), "places"))]
        changed = [single.select("post_id", "_was")]
        ties = choice.filter("_tied")
        if not ties.isEmpty():
            won = _won(news, held, ties, order(columns))
            parts.append(won)
            ids = won.select(F.col("post_id").alias("_id"))
            same_id = F.col("post_id").eqNullSafe(F.col("_id"))
            changed.append(ties.select("post_id", "_was").distinct().join(ids, same_id, "left_semi"))
        touched = late.stored(reduce(DataFrame.unionAll, changed).select("post_id", "_was.*", bucket), "touched")
        written = sorted(row[0] for row in touched.select("bucket").distinct().collect())
        if not written:
            return

        version = 1 + max((head.version for head in heads.values()), default=-1)
        worn = state.worn(spark, written, heads)
        if worn:
            left = touched.filter(F.col("_row").isNotNull()).withColumn("_tied", F.lit(False))
            parts.append(late.without(state.live(spark, worn, heads), late.stored(late.bitmaps(left), "left")))
        whole = {number for number in written if number in worn or number not in heads}
        state.touch(spark, version, touched.filter(~F.col("bucket").isin(list(whole))), buckets)
        state.store(spark, version, parts, buckets, [(b, version, None, b in whole) for b in written])

    return write


def _choice(news: DataFrame, held: DataFrame, times: list[str], order: list[Column]) -> DataFrame:
    """(post_id, _file, _row, _news, _tied, _was): the first rows of each post in the news.

    ``_was`` is the place of the row that the state holds, ``_tied`` says that the columns
    looked at don't decide. Rows of the state are shuffled by id, and by these columns
    where the news have the id.
    """
    narrow = ["post_id", *times, "_file", "_row"]
    ids = news.select(F.col("post_id").alias("_id")).distinct()
    met = held.select(narrow).join(ids, F.col("post_id").eqNullSafe(F.col("_id")), "left_semi")
    both = news.select(*narrow, F.lit(True).alias("_news")).unionAll(met.withColumn("_news", F.lit(False)))
    post = Window.partitionBy("post_id")
    place = F.struct("_file", "_row")
    ranked = both.withColumns(
        {
            "_rank": F.rank().over(post.orderBy(*order)),
            "_was": F.max(F.when(~F.col("_news"), place)).over(post),
        }
    )
    first = ranked.filter("_rank = 1").withColumn("_tied", F.count("*").over(post) > 1)
    return late.stored(first.select("post_id", "_file", "_row", "_news", "_tied", "_was"), "choice")


def _won(news: DataFrame, held: DataFrame, ties: DataFrame, order: list[Column]) -> DataFrame:
    """Rows of the news that come first by all columns; of equal rows the state's is first."""
    sides = []
    for rows, is_news in ((news, True), (held, False)):
        maps = late.stored(late.bitmaps(ties.filter(F.col("_news") == is_news)), "tied")
        sides.append(late.within(rows, maps).withColumn("_news", F.lit(is_news)))
    first = first_by(sides[0].unionByName(sides[1]), ["post_id"], [*order, F.asc("_news")])
    return late.stored(first.filter("_news"), "won")


def merged_posts(spark: SparkSession, target: str) -> DataFrame:
    """Latest scrape of each post; no row is shuffled."""
    return State(target, RAW_POST).current(spark)

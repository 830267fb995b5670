"""Texts fetched late: rows are chosen without them and read afterwards where they lie.

A row of a Parquet file is known by its file and its number there. Choosing the newest
scrape of a post, or what has no annotation yet, needs narrow columns only. The chosen
places become one bitmap per 32,768 rows of a file, and the second reading of the files
keeps the rows whose bit is set: the bitmaps are broadcast, so texts are neither shuffled
nor sorted, those of old scrapes least of all, and files without a chosen row are not
opened again.

A bitmap has 4 KB, an eighth of a byte for each row of a file that holds a chosen one.
``BITMAP_BYTES`` bounds a broadcast: files are taken in blocks of that many bitmaps, each
block a scan of its own files, so beyond the bound there are more blocks and no other way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.operators.dedupe import latest_order, latest_posts
from postlake.session import scratch_path

FILE, ROW = "_metadata.file_path", "_metadata.row_index"
BITS = 32_768
BITMAP_BYTES = 32 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """A step written to the shared scratch folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def has_places(scan: DataFrame) -> bool:
    """Whether the rows come from Parquet files as they are, so that places are known."""
    try:
        return bool(scan.select(FILE, ROW).columns)
    except AnalysisException:
        return False


def latest_places(scan: DataFrame) -> DataFrame:
    """(post_id, _file, _row, _tied): where the newest scrape of each post lies.

    Scrapes that differ in nothing but the text are all kept, and marked as tied.
    """
    narrow = scan.select(
        *[c for c in scan.columns if c != "content"], F.col(FILE).alias("_file"), F.col(ROW).alias("_row")
    )
    post = Window.partitionBy("post_id")
    rank = F.rank().over(post.orderBy(*latest_order(narrow.columns)))
    first = narrow.withColumn("_rank", rank).filter(F.col("_rank") == 1)
    tied = F.count("*").over(post) > 1
    return first.select("post_id", "_file", "_row", tied.alias("_tied"))


def bitmaps(places: DataFrame) -> DataFrame:
    """(_file, _tied, _part, _bits): the places of each file, a bit for each row."""
    number = F.col("_row") + 1
    return places.groupBy("_file", "_tied", F.bitmap_bucket_number(number).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")
    )


def _blocks(maps: DataFrame) -> list[list[str]]:
    """Files in blocks whose bitmaps stay below the bound; a driver's list of files."""
    most = max(1, BITMAP_BYTES // (BITS // 8))
    blocks: list[list[str]] = []
    room = 0
    for file, count in maps.groupBy("_file").count().orderBy("_file").collect():
        if count > room:
            blocks.append([])
            room = most
        blocks[-1].append(file)
        room -= count
    return blocks


def _parted(placed: DataFrame, maps: DataFrame, inside: bool) -> DataFrame:
    """Rows with their place, ``_file`` and ``_row``: those whose bit is set, or the others."""

    def block(files: list[str]) -> DataFrame:
        own = placed.filter(F.col("_file").isin(files)).select(
            "*",
            (F.expr(f"_row div {BITS}") + 1).alias("_part"),
            F.expr(f"cast(_row % {BITS} as int)").alias("_at"),
        )
        few = F.broadcast(maps.filter(F.col("_file").isin(files)).select("_file", "_part", "_bits"))
        byte = "cast(conv(hex(substring(_bits, _at div 8 + 1, 1)), 16, 10) as int)"
        is_set = F.expr(f"(shiftright({byte}, _at % 8) & 1) = 1")
        if inside:
            kept = own.join(few, ["_file", "_part"]).filter(is_set)
        else:
            kept = own.join(few, ["_file", "_part"], "left").filter(~F.coalesce(is_set, F.lit(False)))
        return kept.select(placed.columns)

    blocks = _blocks(maps)
    parts = [block(files) for files in blocks]
    if not inside:
        # Files that no bitmap names are there whole.
        parts.append(placed.filter(~F.col("_file").isin([file for files in blocks for file in files])))
    return reduce(DataFrame.unionAll, parts) if parts else placed.filter(F.lit(False))


def within(placed: DataFrame, maps: DataFrame) -> DataFrame:
    """The rows whose bit is set, of rows with ``_file`` and ``_row``."""
    return _parted(placed, maps, True)


def without(placed: DataFrame, maps: DataFrame) -> DataFrame:
    """The rows whose bit is not set, of rows with ``_file`` and ``_row``."""
    return _parted(placed, maps, False)


def at_places(scan: DataFrame, maps: DataFrame) -> DataFrame:
    """The rows of the scan whose bit is set, with all columns."""
    placed = scan.select("*", F.col(FILE).alias("_file"), F.col(ROW).alias("_row"))
    return within(placed, maps).select(scan.columns)


def fetch(scan: DataFrame, places: DataFrame) -> DataFrame:
    """The rows at the places, one for each post: of tied scrapes the first by text."""
    maps = stored(bitmaps(places), "places")
    single = at_places(scan, maps.filter(~F.col("_tied")))
    tied = maps.filter("_tied")
    if tied.isEmpty():
        return single
    return single.unionAll(latest_posts(at_places(scan, tied)))


def latest_posts_late(scan: DataFrame) -> DataFrame:
    """The same rows as ``dedupe.latest_posts``, without a shuffle of texts."""
    return fetch(scan, latest_places(scan))

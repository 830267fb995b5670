"""Rows by bucket of the post id, in versions that only hold what changed.

A state lies in folders ``version=V/bucket=B``. The first version of a bucket is whole.
Later ones hold the rows of the posts that changed, and ``touched`` says for each of
them which posts these are and where their former rows lie; such rows no longer count.
So a version takes disk for what changed, not for what has been collected. What a read
leaves out becomes one bit for each row of a file (``late``): no row is shuffled or sorted.

The ``ledger`` says for each bucket which versions there are and which are whole. It is
one file for a version and is written last: a run that fails before leaves the state as
it was, and the next one overwrites its folders. A bucket with more rows that were
replaced than rows that count, or with many versions, is written whole again, so that
rows are written a few times at most. Versions before the newest whole one of all their
buckets may be removed at any time. One run at a time may write a state.

States from before there was a ledger hold whole buckets in each version, and are read
so. The driver sees one row per bucket, and the names of the files with replaced rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators import late

# Texts of states and models; denser than the default at little cost.
CODEC = "zstd"
# Versions of a bucket after a whole one, before it is written whole again.
MOST_VERSIONS = 64

PLACES = [T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())]
LEDGER = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("run", T.LongType()),
        T.StructField("inputs", T.MapType(T.StringType(), T.LongType())),
        T.StructField("whole", T.BooleanType()),
    ]
)
TOUCHED = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("_file", T.StringType()),
        T.StructField("_row", T.LongType()),
    ]
)
TOUCHED_ROWS = T.StructType([*TOUCHED.fields, *PLACES])


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("post_id"), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Head:
    """What counts of a bucket: the whole version ``base``, and all up to ``version``."""

    base: int
    version: int
    later: int


@dataclass(frozen=True)
class State:
    """Rows by bucket under a path: merged by batches, or carried by runs."""

    path: str
    schema: T.StructType
    carried: bool = False

    @property
    def data(self) -> str:
        return f"{self.path}/data" if self.carried else self.path

    def _beside(self, name: str) -> str:
        # Folders with an underscore are no data to Spark.
        return f"{self.path}/{name}" if self.carried else f"{self.path}/_{name}"

    def rows(self, spark: SparkSession) -> DataFrame:
        """All versions of all buckets, with ``version`` and ``bucket``."""
        return spark.read.schema(T.StructType([*self.schema.fields, *PLACES])).parquet(self.data)

    def ledger(self, spark: SparkSession) -> DataFrame:
        """(bucket, run, inputs, whole): a row for each version of a bucket."""
        try:
            return spark.read.schema(LEDGER).parquet(self._beside("ledger"))
        except AnalysisException:
            found = self.rows(spark).select("bucket", F.col("version").alias("run")).distinct()
            return found.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER[2:]))

    def heads(self, spark: SparkSession) -> dict[int, Head]:
        whole = F.coalesce("whole", F.lit(True))
        found = self.ledger(spark).groupBy("bucket").agg(
            F.max(F.when(whole, F.col("run"))).alias("base"),
            F.max("run").alias("version"),
            F.collect_set("run").alias("runs"),
        )
        later = F.size(F.filter("runs", lambda run: run > F.col("base")))
        rows = found.select("bucket", "base", "version", later).collect()
        return {bucket: Head(*rest) for bucket, *rest in rows}

    def prepare(self, spark: SparkSession) -> None:
        """Make the folders that a first read would miss, and a ledger of what is there."""
        try:
            spark.read.schema(LEDGER).parquet(self._beside("ledger"))
            return
        except AnalysisException:
            pass
        empty = spark.createDataFrame([], T.StructType([*self.schema.fields, *PLACES]))
        empty.write.mode("append").partitionBy("version", "bucket").parquet(self.data)
        kept = [(bucket, head.version, None, True) for bucket, head in self.heads(spark).items()]
        self._enter(spark, kept)

    def _enter(self, spark: SparkSession, rows: list[tuple]) -> None:
        entries = spark.createDataFrame(rows, LEDGER).coalesce(1)
        entries.write.mode("append").parquet(self._beside("ledger"))

    def _touched(self, spark: SparkSession, after: dict[int, tuple[int, int]]) -> DataFrame:
        """What the versions of each bucket touched, after the first given one up to the second."""
        spans = [(bucket, *span) for bucket, span in after.items()]
        known = spark.createDataFrame(spans, "bucket int, _after long, _to long")
        rows = spark.read.schema(TOUCHED_ROWS).parquet(self._beside("touched"))
        rows = rows.filter(F.col("bucket").isin(list(after))).join(F.broadcast(known), "bucket")
        return rows.filter("version > _after and version <= _to").drop("_after", "_to")

    def touched_ids(self, spark: SparkSession, after: dict[int, tuple[int, int]]) -> DataFrame:
        """(post_id, bucket) of the posts that these versions touched."""
        return self._touched(spark, after).select("post_id", "bucket")

    def live(
        self, spark: SparkSession, buckets: list[int] | None = None, heads: dict[int, Head] | None = None
    ) -> DataFrame:
        """The rows that count, with ``bucket`` and their place, ``_file`` and ``_row``.

        Of some buckets only their folders are opened. A file's name in a place is
        relative, so that a state may be moved.
        """
        heads = self.heads(spark) if heads is None else heads
        if buckets is not None:
            heads = {bucket: heads[bucket] for bucket in buckets if bucket in heads}
        name = F.concat_ws("/", F.col("version"), F.col("bucket"), F.col("_metadata.file_name"))
        placed = self.rows(spark).filter(F.col("bucket").isin(list(heads))).select(
            "*", name.alias("_file"), F.col(late.ROW).alias("_row")
        )
        spans = {bucket: (head.base, head.version) for bucket, head in heads.items() if head.later}
        if spans:
            replaced = self._touched(spark, spans).filter(F.col("_row").isNotNull())
            maps = late.stored(late.bitmaps(replaced.withColumn("_tied", F.lit(False))), "replaced")
            placed = late.without(placed, maps)
        counted = [(bucket, head.base, head.version) for bucket, head in heads.items()]
        known = spark.createDataFrame(counted, "bucket int, _base long, _head long")
        rows = placed.join(F.broadcast(known), "bucket")
        rows = rows.filter("version between _base and _head")
        return rows.select(*self.schema.fieldNames(), "bucket", "_file", "_row")

    def current(
        self, spark: SparkSession, buckets: list[int] | None = None, heads: dict[int, Head] | None = None
    ) -> DataFrame:
        """The rows that count; of some buckets only their folders are opened."""
        return self.live(spark, buckets, heads).select(self.schema.fieldNames())

    def of_posts(
        self, spark: SparkSession, buckets: list[int], ids: DataFrame, heads: dict[int, Head] | None = None
    ) -> DataFrame:
        """The rows of some posts; ids and places are shuffled, rows are read where they lie."""
        live = self.live(spark, buckets, heads)
        wanted = ids.select(F.col("post_id").alias("_id")).distinct()
        places = live.select("post_id", "_file", "_row").join(
            wanted, F.col("post_id").eqNullSafe(F.col("_id")), "left_semi"
        )
        maps = late.stored(late.bitmaps(places.withColumn("_tied", F.lit(False))), "places")
        return late.within(live, maps).select(self.schema.fieldNames())

    def worn(self, spark: SparkSession, buckets: list[int], heads: dict[int, Head]) -> list[int]:
        """Buckets that are due to be written whole again."""
        heads = {b: heads[b] for b in buckets if b in heads and heads[b].later}
        if not heads:
            return []
        spans = {bucket: (head.base, head.version) for bucket, head in heads.items()}
        replaced = self._touched(spark, spans).filter(F.col("_row").isNotNull())
        gone = {bucket: count for bucket, count in replaced.groupBy("bucket").count().collect()}
        live = self.live(spark, list(gone), heads).groupBy("bucket").count().collect() if gone else []
        full = {bucket for bucket, count in live if gone[bucket] > count}
        full |= set(gone) - {bucket for bucket, _ in live}
        return sorted(full | {b for b, head in heads.items() if head.later >= MOST_VERSIONS})

    def store(
        self,
        spark: SparkSession,
        version: int,
        parts: list[DataFrame],
        buckets: int,
        entries: list[tuple],
    ) -> None:
        """Write the rows of a version and enter it; ``touch`` comes before."""
        rows = reduce(DataFrame.unionAll, (part.select(self.schema.fieldNames()) for part in parts))
        writer = rows.withColumn("bucket", bucket_of(buckets)).write.mode("overwrite")
        writer.partitionBy("bucket").parquet(f"{self.data}/version={version}", compression=CODEC)
        self._enter(spark, entries)

    def touch(self, spark: SparkSession, version: int, touched: DataFrame, buckets: int) -> DataFrame:
        """Store which posts a version is about and where their former rows lie; returns this."""
        folder = f"{self._beside('touched')}/version={version}"
        rows = touched.select(TOUCHED.fieldNames()).withColumn("bucket", bucket_of(buckets))
        # Narrow rows, laid together: a file for each bucket.
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder, compression=CODEC)
        return spark.read.schema(T.StructType([*TOUCHED.fields, PLACES[1]])).parquet(folder)

"""Changes carried through: a model is made again for the posts whose inputs moved.

Merged states (``incremental``) hold each post in one bucket, and a bucket has a version
that rises when posts of it change. A model of them, silver or gold, is kept in the same
buckets (``state``). A run compares the versions of its inputs, bucket by bucket, with
those the model was last made from, and asks the buckets that differ which posts have
changed since. It reads and makes these only, and adds them as a version of the model. A
bucket is made again whole where the model has none of it, where an input has written it
whole since, or where most of its rows were replaced. What is read, made again and
written follows from what landed, not from what has been collected.

A carried model lies below its folder as ``data/version=RUN/bucket=B``, with a ``ledger``
that says for each bucket which runs hold it and which versions of the inputs it was made
from. The ledger is written last: a run that fails before leaves the model as it was, and
the next run overwrites its folder. One run at a time may write a model. All states of a
chain have the same number of buckets.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.plans import models
from postlake.schemas import RAW_POST
from postlake.streaming.incremental import NOTE
from postlake.streaming.state import TOUCHED, Head, State


def carry(
    spark: SparkSession,
    inputs: dict[str, State],
    target: State,
    buckets: int,
    build: Callable[[dict[str, DataFrame]], DataFrame],
) -> list[int]:
    """Bring the target up to its inputs; returns the buckets of which posts were made again.

    ``build`` makes the model from the inputs' rows by name, and must make the rows of a
    post from that post's rows alone.
    """
    target.prepare(spark)
    heads = {name: state.heads(spark) for name, state in inputs.items()}
    now: dict[int, dict[str, int]] = {}
    for name, found in heads.items():
        for bucket, head in found.items():
            now.setdefault(bucket, {})[name] = head.version
    made = target.ledger(spark).groupBy("bucket").agg(F.max("run"), F.max_by("inputs", "run")).collect()
    known = {bucket: versions for bucket, _, versions in made}
    changed = sorted(bucket for bucket, versions in now.items() if known.get(bucket) != versions)
    if not changed:
        return []
    run = 1 + max((number for _, number, _ in made), default=0)
    own = target.heads(spark)
    whole = set(target.worn(spark, changed, own)) | {b for b in changed if b not in known}
    for name, found in heads.items():
        whole |= {b for b in changed if b in found and found[b].base > known.get(b, {}).get(name, found[b].base)}
    some = [bucket for bucket in changed if bucket not in whole]

    parts = []
    if whole:
        parts.append(build({n: state.current(spark, sorted(whole), heads[n]) for n, state in inputs.items()}))
    places = spark.createDataFrame([], TOUCHED)
    if some:
        ids = [_changed_ids(spark, inputs[name], heads[name], name, known, some) for name in inputs]
        moved = reduce(DataFrame.unionAll, ids).select(F.col("post_id").alias("_id")).distinct()
        former = target.live(spark, some, own).select("post_id", "_file", "_row")
        met = moved.join(former, F.col("post_id").eqNullSafe(F.col("_id")), "left")
        places = met.select(F.col("_id").alias("post_id"), "_file", "_row")
    touched = target.touch(spark, run, places, buckets)
    if some:
        parts.append(build({n: state.of_posts(spark, some, touched, heads[n]) for n, state in inputs.items()}))
    target.store(spark, run, parts, buckets, [(b, run, now[b], b in whole) for b in changed])
    return changed


def _changed_ids(
    spark: SparkSession,
    state: State,
    heads: dict[int, Head],
    name: str,
    known: dict[int, dict[str, int]],
    buckets: list[int],
) -> DataFrame:
    """The posts of an input that changed since the versions that are known of it."""
    ids = spark.createDataFrame([], "post_id string")
    first = [b for b in buckets if b in heads and name not in known[b]]
    if first:
        ids = ids.unionAll(state.live(spark, first, heads).select("post_id"))
    after = {b: (known[b][name], heads[b].version) for b in buckets if b in heads and name in known[b]}
    after = {b: (then, now) for b, (then, now) in after.items() if then != now}
    return ids.unionAll(state.touched_ids(spark, after).select("post_id")) if after else ids


def _schema(spark: SparkSession, build: Callable[..., DataFrame], *inputs: T.StructType) -> T.StructType:
    made = build(*(spark.createDataFrame([], schema) for schema in inputs)).schema
    return T.StructType([T.StructField(f.name, f.dataType) for f in made])


def _silver_of(posts: DataFrame) -> DataFrame:
    return models.silver(models.bronze_of_latest(posts))


def silver_state(spark: SparkSession, path: str) -> State:
    return State(path, _schema(spark, _silver_of, RAW_POST), carried=True)


def gold_state(spark: SparkSession, path: str) -> State:
    silver = _schema(spark, _silver_of, RAW_POST)
    return State(path, _schema(spark, models.gold, silver, NOTE), carried=True)


# Up to so many bytes of an array are JSON text while they are shuffled.
PACK_BYTES = 1 << 20
ARRAYS = [f.name for f in NOTE if f.dataType == T.ArrayType(T.StringType())]


def _packed(notes: DataFrame) -> DataFrame:
    """Each array as (text, array), one of them null: a shuffled array has 16 bytes or more for a word.

    An array that JSON would not give back as it was, with text that is no UTF-8, stays one.
    """

    def pair(name: str) -> Column:
        words = F.array_join(name, " ")
        fits = F.is_valid_utf8(words) & (F.octet_length(words) < PACK_BYTES)
        return F.struct(F.when(fits, F.to_json(name)).alias("text"), F.when(~fits, F.col(name)).alias("array")).alias(name)

    return notes.select([pair(f.name) if f.name in ARRAYS else F.col(f.name) for f in NOTE])


def _unpacked(gold: DataFrame) -> DataFrame:
    def array(name: str) -> Column:
        return F.coalesce(F.from_json(f"{name}.text", "array<string>"), F.col(f"{name}.array")).alias(name)

    return gold.select([array(c) if c in ARRAYS else F.col(c) for c in gold.columns])


def carry_silver(spark: SparkSession, posts: str, silver: str, buckets: int) -> list[int]:
    """Silver of the posts that ``merge_new`` keeps. No text is shuffled."""
    source = State(posts, RAW_POST)
    return carry(
        spark, {"posts": source}, silver_state(spark, silver), buckets, lambda rows: _silver_of(rows["posts"])
    )


def carry_gold(spark: SparkSession, silver: str, notes: str, gold: str, buckets: int) -> list[int]:
    """Gold of a carried silver and of the annotations that ``merge_annotations`` keeps."""
    inputs = {"silver": silver_state(spark, silver), "notes": State(notes, NOTE)}

    def build(rows: dict[str, DataFrame]) -> DataFrame:
        return _unpacked(models.gold(rows["silver"], _packed(rows["notes"])))

    return carry(spark, inputs, gold_state(spark, gold), buckets, build)

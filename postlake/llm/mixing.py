"""Mixing sources to target weights by entropy balancing, in DataFrame code only.

Each document i of source s gets a rate r_i, how often the mix takes it. Among all
rates with ``sum(size_i * r_i) = target_s`` and ``r_i <= most`` the ones nearest to 1
in relative entropy are exponentially tilted: ``r_i = min(most, exp(l_s * x_i))``
with ``x_i`` the document's size over the mean size of its source. The multipliers
``l_s`` solve the convex dual. One Newton iteration is one aggregation: value and
slope of the dual's gradient per source, summed from a histogram of (source, size);
a step that leaves the bracket known so far is replaced by bisection.

Rates become copies by rounding up or down. A document is rounded up if its hash,
less the fraction of its rate, is under a threshold of its source; the threshold is
found from three histograms of 4096 bins, each refining one bin of the one before,
such that the words taken miss the target by about one document at most.

Defined results: a null text has size 0 and takes 0; null is a source, the last in
order; a source without words has target 0; repeated ids get equal copies (their
hash is equal, and a null id is hashed by its text); an empty table stays empty.
One row per source passes one task (rank and cumulative sums); documents never do,
and no join or sum brings the rows of one source together in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postlake.llm.common import stored

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
TOLERANCE = 1e-10
ITERATIONS = 80
LEVELS, BIN_BITS = 3, 12
SALTS = 32


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash) of every document; the hash has 52 bits."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), text), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        size.alias("size"),
        F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").alias("hash"),
    )


def proportional_targets(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """(source, docs, source_size, target): sources by code point, null last, weigh
    ``weights`` in turn and share ``share`` times all words; none gets more than
    ``most`` times its words, and what it can't take goes to the rest by weight."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(
        F.array(*(F.lit(w) for w in weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")
    )
    level = (
        share * F.sum("source_size").over(all_rows)
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    sources = (
        documents.groupBy("source")
        .agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(in_order))
        .withColumn("weight", weight)
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
    )
    # Sources under the water level are full; the first that isn't gives the level.
    first = F.min(
        F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))
    ).over(all_rows)
    share_of = F.least("cap", first["level"] * F.col("weight"))
    return sources.select(
        "source", "docs", "source_size", F.coalesce(share_of, "cap").alias("target")
    )


def _same_source(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def _join(left: DataFrame, right: DataFrame, salt: str) -> DataFrame:
    """Left rows with the columns of their source, of which ``right`` has one row each.

    Where the sources are too many to broadcast, a source with a third of all rows
    would fill one task; so each has ``SALTS`` rows, and a left row meets one of
    them by the number in its column ``salt``.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    right = right.withColumn("salt_", every)
    left = left.withColumn("salt_", F.pmod(F.col(salt), F.lit(SALTS)).cast("int"))
    same = _same_source(left, right) & (left["salt_"] == right["salt_"])
    return left.join(right, same).drop(right["source"], left["salt_"], right["salt_"])


def multipliers(documents: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """(source, docs, source_size, target, multiplier); infinite where all must be full."""
    histogram = stored(
        documents.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")),
        "mix-histogram",
    )
    state = stored(
        targets.select(
            "*",
            F.when(F.col("target") >= most * F.col("source_size"), F.lit(float("inf")))
            .otherwise(F.lit(0.0))
            .alias("multiplier"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            F.lit(1.0).alias("miss"),
        ),
        "mix-state",
    )
    for _ in range(ITERATIONS):
        state = stored(_newton(histogram, state, most), "mix-state")
        if (state.agg(F.max("miss")).first()[0] or 0.0) <= TOLERANCE:
            break
    return state.select("source", "docs", "source_size", "target", "multiplier")


def _tilt(multiplier: Column) -> Column:
    """The exponent of a document's rate."""
    return multiplier * F.col("size") * F.col("docs") / F.col("source_size")


def _newton(histogram: DataFrame, state: DataFrame, most: float) -> DataFrame:
    """One iteration over all sources that aren't solved yet."""
    open_ = state.filter((F.col("miss") > TOLERANCE) & ~F.col("multiplier").isin(float("inf")))
    exponent = _tilt(F.col("multiplier"))
    capped = exponent >= F.log(F.lit(most))
    words = F.col("n") * F.col("size")
    sums = (
        _join(histogram, open_.select("source", "docs", "source_size", "multiplier"), "size")
        .groupBy("source")
        .agg(
            F.sum(words * F.when(capped, most).otherwise(F.exp(exponent))).alias("value"),
            F.sum(
                F.when(capped, 0.0).otherwise(
                    words
                    * F.exp(exponent)
                    * (F.col("size") * F.col("docs") / F.col("source_size"))
                )
            ).alias("slope"),
        )
    )
    here, gap = F.col("multiplier"), F.col("value") - F.col("target")
    low = F.when(gap < 0, here).otherwise(F.col("low"))
    high = F.when(gap > 0, here).otherwise(F.col("high"))
    step = here - gap / F.when(F.col("slope") > 0, F.col("slope"))
    inside = (low.isNull() | (step > low)) & (high.isNull() | (step < high))
    middle = F.when(low.isNull(), here - 1 - F.abs(here)).when(
        high.isNull(), here + 1 + F.abs(here)
    )
    solved = F.col("value").isNull()
    step = F.when(F.coalesce(inside, F.lit(False)), step).otherwise(
        F.coalesce(middle, (low + high) / 2)
    )
    miss = F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0))
    return state.join(sums, _same_source(state, sums), "left").select(
        state["source"],
        "docs",
        "source_size",
        "target",
        F.when(solved | (miss <= TOLERANCE), here).otherwise(step).alias("multiplier"),
        low.alias("low"),
        high.alias("high"),
        F.coalesce(miss, F.lit(0.0)).alias("miss"),
    )


def copies(documents: DataFrame, solved: DataFrame, most: float = MOST) -> DataFrame:
    """The documents with their source's columns and the whole number of ``copies``."""
    exponent = _tilt(F.col("multiplier"))
    rate = F.when(F.col("size") == 0, 0.0).otherwise(
        F.when(exponent >= F.log(F.lit(most)), most).otherwise(F.exp(exponent))
    )
    bits = LEVELS * BIN_BITS
    order = F.col("hash") / float(1 << 52) - (F.col("rate") - F.col("whole")) + 1
    rated = (
        _join(documents, solved, "hash")
        .withColumn("rate", rate)
        .withColumn("whole", F.floor("rate"))
        .withColumn("order", F.floor(order * float(1 << (bits - 1))).cast("long"))
    )
    may_rise = (F.col("size") > 0) & (F.col("whole") < F.floor(F.lit(most)))
    limits = _thresholds(rated, may_rise, bits)
    up = may_rise & (F.col("order") < F.col("limit"))
    out = _join(rated, limits, "hash")
    return out.withColumn("copies", (F.col("whole") + F.when(up, 1).otherwise(0)).cast("long"))


def _thresholds(rated: DataFrame, may_rise: Column, bits: int) -> DataFrame:
    """(source, limit): documents whose order is below it are rounded up."""
    so_far = Window.partitionBy("source").orderBy("bin")
    limits = stored(
        rated.groupBy("source").agg(
            F.max("target").alias("target"),
            F.sum(F.col("whole") * F.col("size")).cast("double").alias("taken"),
            F.lit(0).cast("long").alias("limit"),
        ),
        "mix-limits",
    )
    for level in range(LEVELS):
        shift = bits - BIN_BITS * (level + 1)
        at = _join(rated.filter(may_rise).select("source", "size", "order"), limits, "order")
        inside = at.filter(
            F.shiftright("order", shift + BIN_BITS) == F.shiftright("limit", shift + BIN_BITS)
        )
        bins = (
            inside.groupBy("source", F.shiftright("order", shift).alias("bin"))
            .agg(F.sum("size").alias("words"), F.max("target").alias("target"),
                 F.max("taken").alias("before"))
            .withColumn("upto", F.col("before") + F.sum("words").over(so_far))
        )
        start = F.col("upto") - F.col("words")
        last = level == LEVELS - 1
        # The bin in which the target lies; the last level takes or leaves it whole.
        crossing = F.col("upto") > F.col("target")
        take = F.lit(last) & (F.col("upto") - F.col("target") < F.col("target") - start)
        found = bins.groupBy("source").agg(
            F.min(
                F.when(crossing, F.struct("bin", start.alias("taken"), take.alias("take")))
            ).alias("c"),
            F.max("bin").alias("end"),
            F.max("upto").alias("all"),
        )
        found = found.select(
            "source",
            F.coalesce(F.col("c.taken"), F.col("all")).alias("taken_"),
            F.shiftleft(
                F.coalesce(F.col("c.bin") + F.col("c.take").cast("long"), F.col("end") + 1), shift
            ).alias("limit_"),
        )
        limits = stored(
            limits.join(found, _same_source(limits, found), "left").select(
                limits["source"],
                "target",
                F.coalesce("taken_", "taken").alias("taken"),
                F.coalesce("limit_", "limit").alias("limit"),
            ),
            "mix-limits",
        )
    return limits.select("source", "limit")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        most: float = MOST) -> DataFrame:
    """Per document: its size, its source's size and target, the words taken, copies."""
    documents = stored(sized(docs), "mix-sizes")
    solved = multipliers(documents, proportional_targets(documents, weights, share, most), most)
    return copies(documents, solved, most).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )

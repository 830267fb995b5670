"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes ratios.

Features are the n-grams of ``LEAST`` to ``MOST`` bytes in a text's distinct words,
present or not, hashed into ``2**BITS`` buckets. From the labelled rows, one
distributed count per class gives each bucket's log-count ratio r (smoothed by one
document) and a likelihood-ratio statistic; buckets that tell the classes apart are
kept. A logistic regression with L2 penalty is fitted on features of value r.

Labelled rows for the fit: those the caller passes, of which a share chosen by hash
of the id is taken so that about ``SAMPLE`` rows remain. Everything else is whole:
each text is scored from all its words.

Defined results: an empty or null text has no features and gets the score of the
intercept alone; a null id is never a training row; labels that are null are left
out, and an id with several labels counts as toxic if one says so; without training
rows of both classes every score is the share of toxic rows, 0 without any; repeated
rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch, map_batches, split_of, stored
from postlake.llm.ngrams import grouped, hashed, words_of

SAMPLE = 20_000
LEAST, MOST, BITS = 3, 6, 20
# Least likelihood-ratio statistic of a feature, and how many features at most.
TELLING = 20.0
FEATURES = 1 << 13
PENALTY, STEPS = 2e-4, 300
COUNTS = "bucket int, toxic long, clean long"
# Features of whole rows that a step of the fit unfolds at a time.
ENTRIES = 1 << 18
ROWS = "toxic int, features binary"


def presence(texts: list[str | None], wanted: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct (text number, bucket) pairs, of wanted buckets if given."""
    for first, buffer, ends in grouped(list(set(words_of(t or ""))) for t in texts):
        pairs = []
        for at, bucket in hashed(buffer, LEAST, MOST, BITS):
            if wanted is not None:
                kept = wanted[bucket]
                at, bucket = at[kept], bucket[kept]
            owner = np.searchsorted(ends, at, side="right")
            pairs.append(np.unique((owner << BITS) | bucket))
        both = np.unique(np.concatenate(pairs))
        yield (both >> BITS) + first, both & ((1 << BITS) - 1)


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, most: int = SAMPLE) -> DataFrame:
    """(text, toxic) of about ``most`` usable labelled rows, spread anew over tasks."""
    known = labels.select(
        F.col("doc_id").cast("long").alias("labelled"), F.col("toxic").cast("int").alias("toxic")
    ).filter(F.col("toxic").isNotNull() & usable)
    known = known.groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    share = F.pmod(F.xxhash64("labelled"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, most / max(n, 1))))
    known = stored(known.filter(share), "toxicity-labels")
    # Bounded by `most` rows of two numbers.
    text = docs.select(F.col("doc_id").cast("long").alias("labelled"), F.col("text").cast("string").alias("text"))
    rows = text.join(F.broadcast(known), "labelled").select("text", "toxic")
    return stored(rows.repartition(24), "toxicity-rows")


def _counts(rows: DataFrame) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int32)
        for part in batches:
            toxic = part["toxic"].to_numpy(zero_copy_only=False)
            for owner, bucket in presence(part["text"].to_pylist(), None):
                for label in (0, 1):
                    np.add.at(counts[label], bucket[(toxic[owner] > 0) == label], 1)
        seen = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(seen), 1 << 16):
            some = seen[at : at + (1 << 16)]
            yield batch(
                COUNTS,
                pa.array(some.astype(np.int32)),
                pa.array(counts[1, some].astype(np.int64)),
                pa.array(counts[0, some].astype(np.int64)),
            )

    return map_batches(rows, step, COUNTS).groupBy("bucket").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )


def telling_features(rows: DataFrame, toxic: int, clean: int, most: int = FEATURES) -> DataFrame:
    """(bucket, ratio): at most ``most`` buckets with the largest statistics."""
    def part(seen: Column, of: int, here: Column) -> Column:
        expected = here * F.lit(of / (toxic + clean))
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    here = F.col("toxic") + F.col("clean")
    gone = F.lit(toxic + clean) - here
    statistic = 2 * (
        part(F.col("toxic"), toxic, here)
        + part(F.col("clean"), clean, here)
        + part(toxic - F.col("toxic"), toxic, gone)
        + part(clean - F.col("clean"), clean, gone)
    )
    ratio = F.log(((F.col("toxic") + 1) / (toxic + 2)) / ((F.col("clean") + 1) / (clean + 2)))
    return (
        _counts(rows)
        .select("bucket", ratio.alias("ratio"), statistic.alias("statistic"))
        .filter(F.col("statistic") >= TELLING)
        .orderBy(F.desc("statistic"), "bucket")
        .limit(most)
        .select("bucket", "ratio")
    )


def fit_linear(indptr: np.ndarray, indices: np.ndarray, ratio: np.ndarray, label: np.ndarray):
    """Weights and intercept of a penalised logistic regression, by Adam on all rows.

    What a step needs per feature of a row exists for some rows at a time.
    """
    n, width = len(label), len(ratio)
    cuts = np.searchsorted(indptr, np.arange(ENTRIES, indptr[-1], ENTRIES))
    cuts = np.unique(np.concatenate([[0], cuts, [n]]))
    weight, bias = np.zeros(width), float(np.log((label.sum() + 1) / (n - label.sum() + 1)))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        error, slope = np.zeros(n), np.zeros(width)
        for lo, hi in zip(cuts, cuts[1:]):
            at = indices[indptr[lo] : indptr[hi]].astype(np.intp)
            rows = np.repeat(np.arange(hi - lo), np.diff(indptr[lo : hi + 1]))
            values = ratio[at]
            margin = np.bincount(rows, values * weight[at], hi - lo) + bias
            error[lo:hi] = 1 / (1 + np.exp(-margin)) - label[lo:hi]
            # In the order of the rows, so that the sums don't depend on the cuts.
            np.add.at(slope, at, values * error[lo:hi][rows])
        slope = np.append(slope / n + PENALTY * weight, error.mean())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        move = 0.05 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        weight, bias = weight - move[:-1], bias - move[-1]
    return weight, bias


class Model:
    """Weight of each bucket (zero where not kept) and the intercept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights = weights
        self.wanted = weights != 0
        self.bias = bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        margin = np.full(len(texts), self.bias)
        for owner, bucket in presence(texts, self.wanted):
            margin += np.bincount(owner, self.weights[bucket], len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, usable: Column, most: int = SAMPLE) -> Model:
    """``usable`` is a condition on the column ``labelled``, the id of a label."""
    rows = training_rows(docs, labels, usable, most)
    n = dict(rows.groupBy("toxic").count().collect())
    toxic = sum(c for label, c in n.items() if label > 0)
    clean = sum(n.values()) - toxic
    weights = np.zeros(1 << BITS, np.float32)
    if not toxic or not clean:
        bias = {(True, False): 500.0}.get((bool(toxic), bool(clean)), -500.0)
        return Model(weights, bias)
    kept = telling_features(rows, toxic, clean).toPandas().sort_values("bucket")
    if kept.empty:
        return Model(weights, float(np.log(toxic / clean)))
    buckets, ratio = kept["bucket"].to_numpy(), kept["ratio"].to_numpy()
    wanted = np.zeros(1 << BITS, bool)
    wanted[buckets] = True

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = [b""] * part.num_rows
            for owner, bucket in presence(part["text"].to_pylist(), wanted):
                at = np.searchsorted(buckets, bucket).astype("<u4")
                own, first = np.unique(owner, return_index=True)
                for text, features in zip(own.tolist(), np.split(at, first[1:]), strict=False):
                    found[text] = features.tobytes()
            yield batch(ROWS, part["toxic"], found)

    # At most `most` rows; the features are kept ones only, four bytes each.
    fitted = map_batches(rows, step, ROWS).toPandas().sort_values("toxic", kind="stable")
    indptr = np.concatenate([[0], np.cumsum([len(x) // 4 for x in fitted["features"]])])
    indices = np.frombuffer(b"".join(fitted["features"]), "<u4")
    label = (fitted["toxic"].to_numpy() > 0).astype(float)
    fitted_weights, bias = fit_linear(indptr, indices, ratio, label)
    weights[buckets] = fitted_weights * ratio
    return Model(weights, float(bias))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``score`` as the last column, in place; no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    out = docs.withColumn("score", F.lit(0.0)).schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*held.value)
        for part in batches:
            texts = part["text"].cast(pa.string()).to_pylist()
            scores = pa.array(model.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns[: len(out) - 1], scores], out.names)

    return map_batches(docs, step, out)


def training_ids(modulus: int = 5, held_out: int = 0) -> Column:
    return split_of("labelled", modulus) != held_out


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    found = score(rows, train(docs, labels, training_ids()))
    return found.select(
        "doc_id",
        F.coalesce(split_of("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, scored under 0.5."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    carried = docs.select(
        *(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)),
        F.col("text").cast("string").alias("text"),
    )
    kept = score(carried, train(docs, labels, training_ids())).filter("score < 0.5")
    return kept.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))

"""Language ID as a mixture of languages, inferred per document.

A language is a distribution over hashed trigrams of bytes (within lower-case words,
the spaces beside a word included), counted over all training rows and smoothed. A
document's trigrams are drawn from a mixture of languages; expectation-maximisation
estimates its proportions. Languages are then admitted in the order of those
proportions, one by one, each new set fitted by EM of its own, as long as the
log-likelihood gains more than ``PENALTY`` times the log of the number of trigrams.
The largest proportion in the admitted set is the prediction and its score.

The model is one number per language and bucket; that the languages are few is the
only bound. Whole texts count, in training and in prediction.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so
is any text if nothing was learned; ties go to the language first by code point; rows
with a null ``lang`` or a null id train nothing; repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch, map_batches, split_of
from postlake.llm.ngrams import grouped, hashed, words_of

LENGTH, BITS = 3, 14
BUCKETS = 1 << BITS
SMOOTH = 0.1
PENALTY = 2.0
ROUNDS = 12
# Texts whose counts a task holds together: 8 MB.
GROUP = 64
UNKNOWN = "und"
COUNTS = "language string, bucket int, n long"
_LETTER = re.compile(r"[^\W\d_]")


def trigram_counts(texts: list[str | None], most_bytes: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray]]:
    """Counts per text and bucket, for a few texts at a time, with the first's number."""
    for first, buffer, ends in grouped((words_of(t or "") for t in texts), most_bytes, GROUP):
        n = len(ends)
        total = np.zeros(n * BUCKETS, np.int64)
        for at, bucket in hashed(buffer, LENGTH, LENGTH, BITS):
            owner = np.searchsorted(ends, at, side="right")
            total = np.bincount(owner * BUCKETS + bucket, minlength=n * BUCKETS)
        yield first, n, total


def language_counts(docs: DataFrame, usable: Column) -> DataFrame:
    """(language, bucket, n) over all rows with a language that are ``usable``."""
    rows = docs.filter(usable & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part in batches:
            names = part["lang"].to_pylist()
            for first, n, counts in trigram_counts(part["text"].to_pylist()):
                for i, row in enumerate(counts.reshape(n, BUCKETS)):
                    name = names[first + i]
                    if name not in totals:
                        totals[name] = np.zeros(BUCKETS, np.int64)
                    totals[name] += row
        for name, total in totals.items():
            seen = np.flatnonzero(total)
            yield batch(COUNTS, [name] * len(seen), seen.astype(np.int32), total[seen])

    return map_batches(rows, step, COUNTS).groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, usable: Column) -> tuple[list[str], np.ndarray]:
    """Languages by code point, and per bucket the probability under each."""
    found = language_counts(docs, usable).toPandas()
    names = sorted(set(found["language"]))
    counts = np.zeros((len(names), BUCKETS))
    place = {name: i for i, name in enumerate(names)}
    rows = found["language"].map(place).to_numpy(np.int64) if names else np.zeros(0, np.int64)
    counts[rows, found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    counts += SMOOTH
    return names, (counts / counts.sum(axis=1, keepdims=True)).T.copy()


def _mixture(owner, count, likely, total, share, allowed, rounds):
    """EM for the texts' proportions over the allowed languages, and log-likelihoods.

    ``owner``, ``count`` and ``likely`` are per seen (text, bucket); the rest per text.
    """
    n, languages = share.shape
    for _ in range(rounds):
        joint = likely * share[owner]
        weight = count / joint.sum(axis=1)
        share = np.stack(
            [np.bincount(owner, joint[:, k] * weight, n) for k in range(languages)], axis=1
        ) / total[:, None]
        share *= allowed
        share /= share.sum(axis=1, keepdims=True)
    mixed = (likely * share[owner]).sum(axis=1)
    return share, np.bincount(owner, count * np.log(mixed), n)


def infer(counts: np.ndarray, model: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """(language, proportion) for each row of trigram counts, all rows non-empty."""
    n, languages = len(counts), model.shape[1]
    owner, bucket = np.nonzero(counts)
    count = counts[owner, bucket].astype(float)
    likely = model[bucket]
    total = counts.sum(axis=1).astype(float)
    share, _ = _mixture(
        owner, count, likely, total, np.full((n, languages), 1 / languages),
        np.ones((n, languages)), ROUNDS,
    )
    order = np.argsort(-share, axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    alone = np.stack(
        [np.bincount(owner, count * np.log(likely[:, k]), n) for k in range(languages)], axis=1
    )
    # The best single language, whichever EM puts first.
    best = alone.argmax(axis=1)
    value, answer, proportion = alone.max(axis=1), best.copy(), np.ones(n)
    open_ = np.arange(n)
    for size in range(2, languages + 1):
        if not len(open_):
            break
        rows = np.zeros(n, np.int64) - 1
        rows[open_] = np.arange(len(open_))
        here = rows[owner] >= 0
        allowed = (place[open_] < size).astype(float)
        start = allowed / size
        mixed, reached = _mixture(
            rows[owner[here]], count[here], likely[here], total[open_], start, allowed, ROUNDS
        )
        gain = reached - value[open_] > penalty * np.log(total[open_] + 1)
        open_, mixed, reached = open_[gain], mixed[gain], reached[gain]
        value[open_] = reached
        answer[open_], proportion[open_] = mixed.argmax(axis=1), mixed.max(axis=1)
    return answer, proportion


def predict(texts: list[str | None], names: list[str], model: np.ndarray) -> tuple[list[str], np.ndarray]:
    languages, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not names:
        return languages, scores
    # A few megabytes of numbers at a time, however many languages there are.
    most_bytes = max(1 << 12, (1 << 20) // len(names))
    for first, n, counts in trigram_counts(texts, min(1 << 18, most_bytes)):
        counts = counts.reshape(n, BUCKETS)
        some = np.array(
            [i for i in range(n) if texts[first + i] and _LETTER.search(texts[first + i]) and counts[i].any()],
            np.int64,
        )
        if len(some):
            answer, proportion = infer(counts[some], model)
            for i, a, p in zip(some.tolist(), answer.tolist(), proportion.tolist(), strict=True):
                languages[first + i], scores[first + i] = names[a], p
    return languages, np.clip(scores, 0, 1)


OUT = "doc_id long, lang_pred string, score double"


def identify(docs: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score) of every document; no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast((names, model))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            languages, scores = predict(part["text"].to_pylist(), *held.value)
            yield batch(OUT, part["doc_id"], languages, pa.array(scores))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, step, OUT)


def report(docs: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    rest = split_of("doc_id", modulus)
    found = identify(docs, *train(docs, rest != held_out))
    return found.select(
        "doc_id",
        F.coalesce(split_of("doc_id", modulus) == held_out, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )

"""Rows that every operator on documents must bear."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, c0 string, key long, drop string, row long, fingerprint string, size string"
)
LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))
TEXTS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda.", "en", "s1"),
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda.", "en", "s1"),
    (2, None, None, None),
    (3, "", "en", ""),
    (None, "a row without an id has some words of its own", "en", "s1"),
    (None, None, "de", "s2"),
    (None, "a row without an id has some words of its own", "en", "s1"),
    (4, LONG, "en", "s2"),
    (5, " \n\t ", None, "s2"),
    (6, "Öl über\nÜBER 12 ñandú İstanbul \U0001f600 end", "de", None),
    (7, "x" * 200_000, "en", "s1"),
]


def documents(spark: SparkSession, rows=TEXTS) -> DataFrame:
    """Documents with more columns, named like those that operators make."""
    return spark.createDataFrame(
        [(*r, None, 0.5, "c", 1, "d", 2, "f", "s") for r in rows], SCHEMA
    )


def plain(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id long, text string")


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)

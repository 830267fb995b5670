"""One query per operator, over whole tables, and the SQL twins DuckDB can run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlake.llm import (
    chatformat,
    decontaminate,
    hmm,
    htmltext,
    langid,
    linededup,
    merkle,
    mixing,
    secrets,
    simhash,
    spelling,
    toxicity,
    vectors,
)
from postlake.llm.sql import CHAT, DECONTAMINATE, LINE_DEDUP, MERKLE, MIX, SPELLING

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.hits(
        table(spark, sf, "documents"), table(spark, sf, "benchmark"), ["doc_id"]
    )
    return decontaminate.report(found)


def op2_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op3_extract(spark: SparkSession, sf: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf, "pages"))


def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents"))


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return linededup.report(table(spark, sf, "documents"))


def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.report(simhash.near_duplicates(table(spark, sf, "documents")))


def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    return langid.report(table(spark, sf, "documents"))


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_hmm(spark: SparkSession, sf: str) -> DataFrame:
    return hmm.report(table(spark, sf, "documents"))


def op10_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf, "embeddings"))


def op11_merkle(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.report(table(spark, sf, "documents"))


def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.report(table(spark, sf, "documents"))


def op13_chat(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    # One more conversation, whose text looks like a template's control strings.
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chatformat.report(turns.unionAll(more))


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_mix": op2_mix,
    "op3_extract": op3_extract,
    "op4_secrets": op4_secrets,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash": op6_simhash,
    "op7_language": op7_language,
    "op8_toxicity": op8_toxicity,
    "op9_hmm": op9_hmm,
    "op10_vectors": op10_vectors,
    "op11_merkle": op11_merkle,
    "op12_spelling": op12_spelling,
    "op13_chat": op13_chat,
}
ORACLE: dict[str, str] = {
    "op1_decontaminate": DECONTAMINATE,
    "op2_mix": MIX,
    "op5_line_dedup": LINE_DEDUP,
    "op11_merkle": MERKLE,
    "op12_spelling": SPELLING,
    "op13_chat": CHAT,
}

"""From pending posts to stored annotations."""

from __future__ import annotations

import datetime as dt
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions import lexicon, text
from postlake.functions.time import instant
from postlake.operators.once import add_once
from postlake.schemas import (
    ANNOTATION_COLUMNS,
    ANNOTATION_WIDTHS,
    RESPONSE,
    SAFETY_FLAGS,
    SENTIMENTS,
    TOPICS,
    TRIMESTERS,
)

# What the caller's annotator returns for one prompt: response text and, when
# known, the numbers of input and output tokens.
Reply = tuple[str, int | None, int | None]
Annotator = Callable[[list[str]], list[Reply]]

# Replies that a task sends back together.
HELD_ROWS = 256

REPLY = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("input_tokens", T.IntegerType()),
        T.StructField("output_tokens", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def render_prompts(posts: DataFrame, template: str) -> DataFrame:
    """Prompt and template hash for each post."""
    return posts.select(
        "post_id",
        text.render_prompt(template, F.col("post_id"), F.col("text_for_llm")).alias("prompt"),
        text.prompt_hash(F.lit(template)).alias("prompt_hash"),
    )


def annotate(
    prompts: DataFrame,
    annotator: Annotator,
    partitions: int | None = None,
    batch: int = 64,
    in_flight: int = 1,
    retries: int = 0,
    wait: float = 1.0,
) -> DataFrame:
    """Run the caller's annotator over all prompts in distributed batches.

    ``partitions`` sets how many tasks ask side by side, by default as many as the
    session runs; prompts are always dealt out by number, since few or sorted
    prompts would otherwise sit in one task. The post id is the one of the input
    row. When a batch fails, each of its prompts is tried by itself; a failing
    prompt, or a reply that isn't text with two whole numbers or None, gives a row
    with status 'failed' and never stops the job.

    A task has up to ``in_flight`` batches of ``batch`` prompts under way at a time, in
    threads; no more are taken from the input until the oldest is done, and replies
    leave in the order of the prompts. A call that raises is made again up to
    ``retries`` times in all for a prompt, ``wait`` seconds later, then twice that, and
    so on; a reply of the wrong shape is an answer and is not asked for again.
    """
    tasks = partitions or prompts.sparkSession.sparkContext.defaultParallelism
    prompts = prompts.repartition(tasks, "post_id")

    # These functions travel to the workers by value, so the workers need not
    # have this package installed.
    def row_of(reply) -> tuple:
        if not isinstance(reply, (tuple, list)) or len(reply) != 3:
            return (None, None, None, "failed", "TypeError: a reply has three parts")
        response, *tokens = reply
        if not isinstance(response, str):
            kind = type(response).__name__
            return (None, None, None, "failed", f"TypeError: the response is {kind}, not text")
        for count in tokens:
            whole = isinstance(count, int) and not isinstance(count, bool)
            if count is not None and not (whole and 0 <= count < 1 << 31):
                return (None, None, None, "failed", f"TypeError: {count!r} is no number of tokens")
        return (response, *tokens, "ok", None)

    def ask(texts: list[str]) -> list[tuple]:
        for attempt in range(1 + (retries if len(texts) == 1 else 0)):
            if attempt:
                time.sleep(wait * 2 ** (attempt - 1))
            try:
                replies = annotator(texts)
                if len(replies) != len(texts):
                    raise ValueError(f"{len(replies)} replies to {len(texts)} prompts")
                return [row_of(reply) for reply in replies]
            except Exception as failure:
                why = f"{type(failure).__name__}: {failure}"
        if len(texts) == 1:
            return [(None, None, None, "failed", why)]
        return [row for one in texts for row in ask([one])]

    def answered(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names
        )

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        under_way: deque = deque()
        rows: list[tuple] = []

        def take() -> None:
            ids, replies = under_way.popleft()
            rows.extend((post_id, *row) for post_id, row in zip(ids, replies.result(), strict=True))

        with ThreadPoolExecutor(in_flight) as pool:
            for frame in frames:
                ids, texts = frame["post_id"].to_pylist(), frame["prompt"].to_pylist()
                for at in range(0, len(ids), batch):
                    if len(under_way) == in_flight:
                        take()
                    asked = pool.submit(ask, texts[at : at + batch])
                    under_way.append((ids[at : at + batch], asked))
                    if len(rows) >= held:
                        yield answered(rows)
                        rows.clear()
            while under_way:
                take()
            if rows:
                yield answered(rows)

    # Replies leave a worker in Arrow batches of several requests: one for each costs more
    # than the rows do.
    held, names = HELD_ROWS, REPLY.fieldNames()
    text_, count = pa.string(), pa.int32()
    kinds = [text_, text_, count, count, text_, text_]
    return prompts.select("post_id", "prompt").mapInArrow(run, REPLY)


def parse_responses(replies: DataFrame) -> DataFrame:
    """Response text to typed fields, the id of the input row kept.

    ``echoed_id`` is the id the response claims. Text that is not one JSON object
    from end to end turns the status to 'failed': text before or after it, a code
    fence, an array. A field of the wrong type becomes null, but a value given
    where a text is due is kept as its JSON text; of a repeated key the last counts.

    The JSON reader stops where its value ends. So the text is read as the only
    element of an array, which text behind it spoils unless it starts with the
    closing bracket, and as the only value of an object, which then is spoilt.
    """
    listed = F.from_json(
        F.concat(F.lit("["), "response", F.lit("]")),
        T.ArrayType(RESPONSE),
        {"allowSingleQuotes": "false"},
    )
    parsed = add_once(replies, "_l", listed).withColumn("r", F.get("_l", F.lit(0)))
    alone = F.json_object_keys(F.concat(F.lit('{"r":'), "response", F.lit("}")))
    is_object = F.coalesce(
        (F.array_size("_l") == 1) & F.col("r").isNotNull() & (alone == F.array(F.lit("r"))),
        F.lit(False),
    )

    def field(name: str) -> Column:
        return F.when(is_object, F.col(f"r.{name}"))

    fields = [field(name).alias(name) for name in RESPONSE.fieldNames() if name != "post_id"]
    has_status = "status" in replies.columns
    answered = (F.col("status") == "ok") if has_status else F.lit(True)
    known = F.col("error") if has_status else F.lit(None).cast("string")
    return parsed.select(
        "post_id",
        *fields,
        field("post_id").alias("echoed_id"),
        *[c for c in ("input_tokens", "output_tokens") if c in replies.columns],
        F.when(answered & is_object, "ok").otherwise("failed").alias("status"),
        F.when(answered & ~is_object, "not a JSON object")
        .otherwise(known)
        .alias("error"),
    )


def with_metadata(
    parsed: DataFrame,
    model_name: str,
    model_version: str,
    template: str,
    annotated_at: dt.datetime,
) -> DataFrame:
    """The columns that describe the run; they never come from the response."""
    return parsed.withColumns(
        {
            "model_name": F.lit(model_name),
            "model_version": F.lit(model_version),
            "prompt_hash": text.prompt_hash(F.lit(template)),
            "annotated_at": instant(annotated_at),
        }
    )


def sanitise_free_text(annotations: DataFrame) -> DataFrame:
    """Summary and reply without double quotes and line breaks; NULL stays NULL."""
    return annotations.withColumns(
        {name: text.sanitise(F.col(name)) for name in ("post_summary", "care_response")}
    )


def _none_of(array: Column, allowed: list[str]) -> Column:
    return F.array_size(F.array_except(array, F.array(*[F.lit(a) for a in allowed]))) > 0


def _violations(columns: list[str]) -> dict[str, Column]:
    """Contract rules; each condition is true where its rule is broken."""
    col = F.col
    topic_fits = F.lit(False)
    for group, topics in TOPICS.items():
        topic_fits = topic_fits | (
            (col("primary_group") == group) & col("primary_topic").isin(topics)
        )
    sentences = text.sentence_count(col("post_summary"))
    words = text.word_count(F.trim(col("care_response")))
    rules = {
        "primary_group": ~col("primary_group").isin(list(TOPICS)),
        "primary_topic": ~topic_fits,
        "secondary_topics": F.coalesce(F.array_size("secondary_topics"), F.lit(0)) > 3,
        "trimester": ~col("trimester").isin(TRIMESTERS),
        "sentiment": ~col("sentiment").isin(SENTIMENTS),
        "urgency_0_3": ~col("urgency_0_3").between(0, 3),
        "keyword_count": ~F.array_size("keywords").between(5, 20),
        "keyword_case": F.exists("keywords", lambda k: k != F.lower(k)),
        "safety_flags": _none_of(col("safety_flags"), SAFETY_FLAGS),
        "post_summary": col("post_summary").isNull() | ~sentences.between(1, 3),
        "care_response": ~words.between(120, 220),
    }
    if "echoed_id" in columns:
        rules["echoed_id"] = ~col("echoed_id").eqNullSafe(col("post_id"))
    return rules


def validate(annotations: DataFrame) -> DataFrame:
    """Add ``violations``, the broken rules by name, and ``is_valid``.

    A required field that is null breaks its rule. All rules read the row alone.
    """
    broken = [
        F.when(F.coalesce(condition, F.lit(True)), F.lit(name))
        for name, condition in _violations(annotations.columns).items()
    ]
    checked = annotations.withColumn("violations", F.array_compact(F.array(*broken)))
    return checked.withColumn("is_valid", F.array_size("violations") == 0)


def check_widths(results: DataFrame) -> DataFrame:
    """Results that the stored table can't hold become 'failed', with the column named.

    Nothing is cut: a text that is too long is an answer to ask for again.
    """
    reason = F.coalesce(
        *[
            F.when(F.length(name) > width, F.lit(f"{name} is longer than {width}"))
            for name, width in ANNOTATION_WIDTHS.items()
            if name in results.columns
        ]
    )
    too_long = F.col("status").eqNullSafe("ok") & reason.isNotNull()
    return results.withColumns(
        {
            "error": F.when(too_long, reason).otherwise(F.col("error")),
            "status": F.when(too_long, "failed").otherwise(F.col("status")),
        }
    )


def to_annotations(results: DataFrame) -> DataFrame:
    """Successful results in the column order of the stored table."""
    return sanitise_free_text(results.filter(F.col("status") == "ok")).select(ANNOTATION_COLUMNS)


def tag_by_lexicon(posts: DataFrame, column: str = "text_for_llm") -> DataFrame:
    """Keyword domains, terms, safety flags and stage by whole-word triggers."""
    domains, triggers, stages = (
        lexicon.KEYWORD_DOMAINS,
        lexicon.SAFETY_TRIGGERS,
        lexicon.STAGE_TRIGGERS,
    )
    lines = posts.select("post_id", lexicon.word_line(F.col(column)).alias("_l"))
    lines = add_once(lines, "_f", lexicon.anchors_found(F.col("_l"), domains, triggers, stages))
    line, found = F.col("_l"), F.col("_f")
    lines = add_once(lines, "_t", lexicon.terms_found(line, found, domains))
    return lines.select(
        "post_id",
        lexicon.lists_of(F.col("_t"), domains).alias("domains"),
        F.col("_t").alias("keywords"),
        lexicon.tags(line, found, triggers).alias("safety_flags"),
        lexicon.first_tag(line, found, stages, "unclear").alias("trimester"),
    )

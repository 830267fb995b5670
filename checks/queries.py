"""One query per operator; each reads the whole test tables.

Array columns are given as JSON text, since the comparison of results knows
no arrays.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from postlake.operators import annotate, dedupe, joins, late, select, shape, summary
from postlake.plans import catalog_functions, catalog_views, models, runs
from postlake.schemas import ANNOTATION, RAW_POST
from postlake.session import configure, scratch_path
from postlake.sources import files, presence, tables
from postlake.streaming import carry, incremental
from postlake.streaming.state import CODEC

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = dt.datetime(2024, 6, 1, 12, 0, tzinfo=dt.timezone.utc)
AS_OF = dt.datetime(2024, 1, 9, 6, 0, tzinfo=dt.timezone.utc)
DAY = dt.date(2024, 1, 15)
COMMUNITIES = ["src0", "SRC3", "Src5", "src8", "src11", "SRC13", "src17"]


def arrays_as_text(df: DataFrame) -> DataFrame:
    return df.select(
        [
            F.to_json(f.name).alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return models.bronze(fx.raw_posts(spark, sf))


def silver(spark: SparkSession, sf: str, **routing) -> DataFrame:
    return models.silver(bronze(spark, sf), **routing)


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return models.gold(silver(spark, sf), fx.annotations(spark, sf), joins.PART_ROWS)


def review(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    stored = fx.annotations(spark, sf)
    return models.review_of_ids(
        fx.raw_posts(spark, sf), stored, list(columns), joins.PART_ROWS
    )


# --- Sources and sinks -------------------------------------------------------


def scan_raw_posts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    fx.raw_posts(spark, sf).write.parquet(path)
    return tables.raw_posts(spark, path)


def scan_annotations(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "annotations")
    fx.annotations(spark, sf).write.parquet(path)
    return arrays_as_text(tables.annotations(spark, path))


def _new_tables(spark: SparkSession) -> tuple[str, str]:
    """A raw and an annotation table of this run, both empty."""
    tag = uuid.uuid4().hex
    raw, stored = f"raw_posts_{tag}", f"annotations_{tag}"
    for _ in range(2):  # the second time finds them there
        tables.create_raw_table(spark, raw, scratch_path(spark, "raw"))
        tables.create_annotation_table(spark, stored, scratch_path(spark, "annotations"))
    return raw, stored


def create_tables(spark: SparkSession, sf: str) -> DataFrame:
    raw, stored = _new_tables(spark)
    tables.append_posts(fx.raw_posts(spark, sf), raw)
    tables.append_annotations(fx.annotations(spark, sf), stored)
    counts = [
        spark.table(name).agg(
            F.lit(kind).alias("stored"),
            F.count("*").alias("n_rows"),
            F.count_distinct("post_id").alias("n_posts"),
        )
        for kind, name in (("raw_posts", raw), ("annotations", stored))
    ]
    return counts[0].unionAll(counts[1])


def append_posts(spark: SparkSession, sf: str) -> DataFrame:
    raw, _ = _new_tables(spark)
    posts = fx.raw_posts(spark, sf)
    tables.append_posts(posts, raw)
    tables.append_posts(posts.filter(F.lit(False)), raw)
    return tables.raw_table(spark, raw)


def append_posts_by_day(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw_by_day")
    tables.append_posts_by_day(fx.raw_posts(spark, sf), path)
    stored = tables.raw_posts_by_day(spark, path)
    return stored.groupBy("post_day").agg(
        F.count("*").alias("n_posts"), F.sum(F.length("content")).alias("n_chars")
    )


def append_annotations(spark: SparkSession, sf: str) -> DataFrame:
    _, stored = _new_tables(spark)
    for _ in range(2):  # the second run adds nothing
        tables.append_annotations(fx.annotations(spark, sf), stored)
    return arrays_as_text(tables.annotation_table(spark, stored))


def roundtrip_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_csv(fx.raw_posts(spark, sf), path)
    return files.read_csv(spark, path, RAW_POST)


def roundtrip_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "json")
    files.write_json(fx.raw_posts(spark, sf), path)
    return files.read_json(spark, path, RAW_POST)


def annotations_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "annotations_csv")
    files.write_csv(fx.annotations(spark, sf), path)
    return arrays_as_text(files.read_csv(spark, path, ANNOTATION))


def model_views(spark: SparkSession, sf: str) -> DataFrame:
    models.views(spark, fx.raw_posts(spark, sf), fx.annotations(spark, sf))
    return spark.sql(
        """
        select subreddit, count(*) as n_posts, sum(n_words) as n_words,
               count(annotated_at) as n_annotated
        from post_review group by subreddit
        """
    )


def model_views_all(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and posts of each of the seven views."""
    names = models.views(spark, fx.raw_posts(spark, sf), fx.annotations(spark, sf))
    counts = [
        spark.sql(f"select '{n}' as view, count(*) as n_rows, count(distinct post_id) as n_posts from {n}")
        for n in names
    ]
    return reduce(DataFrame.unionAll, counts)


def catalog_views_all(spark: SparkSession, sf: str) -> DataFrame:
    """The same figures from views of the catalog over stored tables."""
    raw, stored = _new_tables(spark)
    tables.append_posts(fx.raw_posts(spark, sf), raw)
    tables.append_annotations(fx.annotations(spark, sf), stored)
    home = f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}"
    names = catalog_views.create_views(spark, f"{home}.{raw}", f"{home}.{stored}", f"models_{uuid.uuid4().hex}")
    counts = [
        spark.sql(
            f"select '{n.split('.')[1]}' as view, count(*) as n_rows, "
            f"count(distinct post_id) as n_posts from {n}"
        )
        for n in names
    ]
    return reduce(DataFrame.unionAll, counts)


def loaded_subreddits(spark: SparkSession, sf: str) -> DataFrame:
    names = fx.documents(spark, sf).select("source").distinct()
    wanted = names.select(F.explode(F.array("source", F.upper("source"))).alias("subreddit"))
    return select.loaded_communities(wanted, fx.raw_posts(spark, sf))


def loaded_subreddit_days(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date(F.timestamp_seconds(fx.EPOCH + F.col("doc_id") * 3600))
    wanted = (
        fx.documents(spark, sf)
        .select(
            F.col("source").alias("subreddit"),
            F.explode(F.array(day, F.date_add(day, 1))).alias("day"),
        )
        .distinct()
    )
    return select.loaded_days(wanted, fx.raw_posts(spark, sf))


def _appended_twice(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """A raw table filled by two appends, its index refreshed after each and once more."""
    raw, _ = _new_tables(spark)
    index, posts = scratch_path(spark, "index"), fx.raw_posts(spark, sf)
    for half in ("score % 2 = 0", "score % 2 <> 0"):
        tables.append_posts(posts.filter(half), raw)
        presence.refresh(tables.raw_table(spark, raw), index)
    table = tables.raw_table(spark, raw)
    presence.refresh(table, index)
    return table, index


def loaded_subreddits_indexed(spark: SparkSession, sf: str) -> DataFrame:
    names = fx.documents(spark, sf).select("source").distinct()
    wanted = names.select(F.explode(F.array("source", F.upper("source"))).alias("subreddit"))
    return presence.loaded_communities(wanted, *_appended_twice(spark, sf))


def loaded_subreddit_days_indexed(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date(F.timestamp_seconds(fx.EPOCH + F.col("doc_id") * 3600))
    days = F.explode(F.array(day, F.date_add(day, 1))).alias("day")
    wanted = fx.documents(spark, sf).select(F.col("source").alias("subreddit"), days).distinct()
    return presence.loaded_days(wanted, *_appended_twice(spark, sf))


def catalog_functions_all(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every table function of the catalog, called from SQL."""
    raw, _ = _new_tables(spark)
    tables.append_posts(fx.raw_posts(spark, sf), raw)
    home = f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}"
    before, schema = spark.catalog.currentDatabase(), f"functions_{uuid.uuid4().hex}"
    catalog_functions.create_functions(spark, f"{home}.{raw}", schema)
    names = ", ".join(f"'{c}'" for c in COMMUNITIES)
    calls = [
        f"select 'day' as asked, post_id, score, cast(null as int) as top_rank from posts_for_day('Src1', date'{DAY}')",
        "select 'flair', post_id, score, null from posts_with_flair('eN qUEST')",
        f"select 'of', post_id, score, null from posts_of(array({names}))",
    ]
    calls += [
        f"select '{period}', post_id, score, top_rank from top_posts('{period}', timestamp'{AS_OF:%F %T}', 3)"
        for period in select.PERIODS
    ]
    spark.catalog.setCurrentDatabase(schema)
    try:
        return spark.sql(" union all ".join(calls))
    finally:
        spark.catalog.setCurrentDatabase(before)


def tables_present(spark: SparkSession, sf: str) -> DataFrame:
    """What the guards say of a filled table, in any case of its name, and of none."""
    raw, _ = _new_tables(spark)
    tables.append_posts(fx.raw_posts(spark, sf), raw)
    said = [
        ("table", tables.table_exists(spark, raw)),
        ("table in upper case", tables.table_exists(spark, raw.upper())),
        ("no table", tables.table_exists(spark, f"{raw}_not")),
        ("community", tables.community_loaded(spark, raw, "SRC1")),
        ("community in lower case", tables.community_loaded(spark, raw, "src1")),
        ("day", tables.day_loaded(spark, raw, "src1", dt.date(2024, 1, 1))),
        ("day before all", tables.day_loaded(spark, raw, "src1", dt.date(2023, 12, 31))),
        ("community of no table", tables.community_loaded(spark, f"{raw}_not", "SRC1")),
    ]
    return spark.createDataFrame(said, "asked string, is_there boolean")


def renamed_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Some columns of the annotations as an export names them."""
    stored = arrays_as_text(fx.annotations(spark, sf))
    upper = shape.rename_upper(stored)
    return upper.select("POST_ID", "PRIMARY_GROUP", "KEYWORDS", "ANNOTATED_AT")


# --- Shaping -----------------------------------------------------------------


def shape_archive(spark: SparkSession, sf: str) -> DataFrame:
    return shape.shape_archive(fx.archive_records(spark, sf), RUN_TS)


def shape_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return shape.archive_rejects(fx.archive_records(spark, sf)).select("doc_id", "reason")


def shape_top(spark: SparkSession, sf: str) -> DataFrame:
    return shape.shape_top(fx.top_records(spark, sf), RUN_TS)


# --- Choosing ----------------------------------------------------------------


def posts_for_day(spark: SparkSession, sf: str) -> DataFrame:
    return select.posts_for_day(fx.raw_posts(spark, sf), "Src1", DAY, max_posts=100)


def flair_filter(spark: SparkSession, sf: str) -> DataFrame:
    return select.with_flair(fx.raw_posts(spark, sf), "eN qUEST")


def subreddit_batch(spark: SparkSession, sf: str) -> DataFrame:
    return select.of_communities(fx.raw_posts(spark, sf), COMMUNITIES)


def top_posts_period(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.raw_posts(spark, sf)
    as_of = raw.agg(F.max("post_timestamp")).first()[0]
    posts = models.bronze_without_text(raw)
    period = select.in_period(posts, "month", dt.datetime.fromtimestamp(as_of, dt.timezone.utc))
    return select.top_posts(period).select("subreddit", "top_rank", "post_id", "score", "post_title")


def top_posts_periods(spark: SparkSession, sf: str) -> DataFrame:
    """The three best posts of each community for every period up to a fixed time."""
    raw = fx.raw_posts(spark, sf)
    tops = []
    for period in select.PERIODS:
        posts = models.bronze_without_text(select.in_period(raw, period, AS_OF))
        top = select.top_posts(posts, limit=3)
        tops.append(top.select(F.lit(period).alias("period"), "subreddit", "top_rank", "post_id", "score"))
    return reduce(DataFrame.unionByName, tops)


def posts_for_day_limited(spark: SparkSession, sf: str) -> DataFrame:
    """A day of one large community, cut to its first ten posts, with their places."""
    raw = fx.raw_posts(spark, sf).withColumn("subreddit", F.lit("Everyone"))
    chosen = select.posts_for_day(raw, "everyone", DAY, max_posts=10)
    place = F.row_number().over(Window.orderBy("post_date", "post_id", "score"))
    return chosen.select("post_id", "score", place.alias("place"))


def bronze_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.latest_posts(fx.raw_posts(spark, sf))


def first_seen(spark: SparkSession, sf: str) -> DataFrame:
    arrival = [F.asc_nulls_last("scraped_at"), F.asc("score")]
    return dedupe.first_seen(fx.raw_posts(spark, sf), "post_id", arrival)


def content_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.content_duplicates(bronze(spark, sf))


def one_per_content(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.one_per_content(bronze(spark, sf))


# --- Text --------------------------------------------------------------------


def redact(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf).select("post_id", "text_raw", "text_for_llm")


def text_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf).select(
        "post_id", "n_chars", "n_words", "n_sentences", "n_questions", "n_exclaims", "token_estimate"
    )


def redaction_counts(spark: SparkSession, sf: str) -> DataFrame:
    tokens = ["urls", "emails", "phones", "usernames", "subreddits"]
    return silver(spark, sf).select("post_id", *[f"n_{t}_redacted" for t in tokens])


def routing(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf).select("post_id", "n_words", "token_estimate", "needs_annotation")


def routing_guarded(spark: SparkSession, sf: str) -> DataFrame:
    limits = {"min_chars": 10, "token_limit": 8000, "english_only": True}
    return silver(spark, sf, **limits).select("post_id", "needs_annotation")


def lang_hint(spark: SparkSession, sf: str) -> DataFrame:
    hinted = models.with_heuristics(silver(spark, sf))
    return hinted.select("post_id", "lang_hint")


def heuristic_flags(spark: SparkSession, sf: str) -> DataFrame:
    hinted = models.with_heuristics(fx.tagged_posts(spark, sf))
    return hinted.select("post_id", "has_medical_terms", "trimester_hint", "engagement_level")


def lexicon_tags(spark: SparkSession, sf: str) -> DataFrame:
    return arrays_as_text(annotate.tag_by_lexicon(fx.tagged_posts(spark, sf)))


# --- Marts -------------------------------------------------------------------


def gold_text(spark: SparkSession, sf: str) -> DataFrame:
    return arrays_as_text(gold(spark, sf))


def gold_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Gold where one post holds a third of all annotations, some of them equal rows."""
    stored = fx.crowded_annotations(spark, sf)
    joined = models.gold(silver(spark, sf), stored, part_rows=20)
    return joined.select("post_id", "n_words", "primary_topic", "urgency_0_3", "output_tokens")


def catalog_gold_hot(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the gold view of the catalog."""
    raw, stored = _new_tables(spark)
    tables.append_posts(fx.raw_posts(spark, sf), raw)
    fx.crowded_annotations(spark, sf).write.insertInto(stored)
    home = f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}"
    schema = f"models_{uuid.uuid4().hex}"
    catalog_views.create_views(spark, f"{home}.{raw}", f"{home}.{stored}", schema, part_rows=20)
    joined = spark.table(f"{schema}.gold")
    return joined.select("post_id", "n_words", "primary_topic", "urgency_0_3", "output_tokens")


def post_review(spark: SparkSession, sf: str) -> DataFrame:
    return arrays_as_text(models.post_review(gold(spark, sf)))


def keywords_exploded(spark: SparkSession, sf: str) -> DataFrame:
    return models.keywords_exploded(review(spark, sf, "keywords"))


def safety_flags_exploded(spark: SparkSession, sf: str) -> DataFrame:
    return models.safety_flags_exploded(review(spark, sf, "safety_flags"))


def safety_booleans(spark: SparkSession, sf: str) -> DataFrame:
    return models.safety_booleans(review(spark, sf, "safety_flags"))


def safety_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return summary.safety_kpis(safety_booleans(spark, sf))


def top_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return summary.top_keywords(keywords_exploded(spark, sf))


def latest_annotated(spark: SparkSession, sf: str) -> DataFrame:
    stored = fx.annotations(spark, sf)
    posts = models.bronze_without_text(fx.raw_posts(spark, sf))
    return summary.latest_annotated(joins.with_annotations(posts, stored, joins.PART_ROWS))


def ingest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summary.ingest_summary(fx.raw_posts(spark, sf))


# --- Annotation --------------------------------------------------------------


def pending_posts(spark: SparkSession, sf: str) -> DataFrame:
    return models.pending(fx.raw_posts(spark, sf), fx.annotations(spark, sf))


def pending_batch(spark: SparkSession, sf: str) -> DataFrame:
    return models.pending(fx.raw_posts(spark, sf), fx.annotations(spark, sf), limit=10)


def _raw_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Raw posts as several files hold them, old scrapes apart from new ones."""
    path = scratch_path(spark, "raw")
    fx.raw_posts(spark, sf).repartition(7).write.parquet(path)
    return tables.raw_posts(spark, path)


def latest_by_place(spark: SparkSession, sf: str) -> DataFrame:
    return late.latest_posts_late(_raw_scan(spark, sf))


def pending_by_place(spark: SparkSession, sf: str) -> DataFrame:
    """All pending posts of raw files, and the first ten by way of a limit."""
    scan, notes = _raw_scan(spark, sf), fx.annotations(spark, sf)
    every = models.pending_of_scan(scan, notes).withColumn("choice", F.lit("all"))
    some = models.pending_of_scan(scan, notes, limit=10).withColumn("choice", F.lit("ten"))
    return every.unionByName(some)


def _silver_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    silver(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def pending_of_silver(spark: SparkSession, sf: str) -> DataFrame:
    """All pending posts of a stored silver table, and the first ten by way of a limit."""
    stored, notes = _silver_table(spark, sf), fx.annotations(spark, sf)
    every = models.pending_of_silver(stored, notes).withColumn("choice", F.lit("all"))
    some = models.pending_of_silver(stored, notes, limit=10).withColumn("choice", F.lit("ten"))
    return every.unionByName(some)


def annotation_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs in one folder over all pending posts, every kind of bad reply in the first.

    Rows are what is stored after both, and the posts that fail in each.
    """

    def annotator(broken: bool):
        def label(texts: list[str]) -> list:
            replies = []
            for size in map(len, texts):
                answer = {"sentiment": "neutral", "urgency_0_3": size % 4, "post_summary": "It is."}
                reply = (json.dumps(answer), size // 4, size % 100)
                kind = size % 13 if broken or size % 13 == 5 else 0
                if kind == 1:
                    reply = (json.dumps(answer | {"post_summary": "x" * 1001}), 1, 1)
                elif kind == 2:
                    reply = reply[:2]
                elif kind == 3:
                    reply = (reply[0], 1.5, 1)
                elif kind == 4:
                    reply = (answer, 1, 1)
                elif kind == 5:
                    raise ValueError("no answer")
                elif kind == 6:
                    reply = (reply[0] + " and more", 1, 1)
                replies.append(reply)
            return replies

        return label

    _, table = _new_tables(spark)
    # Stored once, so that both runs read the same posts.
    posts, outcome = _silver_table(spark, sf), []
    folder = scratch_path(spark, "run")
    for number, broken in ((1, True), (2, False)):
        results = runs.annotate_pending(
            spark, posts, table, annotator(broken), fx.TEMPLATE, "by-length", "1.0.0", RUN_TS,
            folder, saves=2, task_rows=100, batch=16, in_flight=4,
        )
        failed = results.filter("status = 'failed'")
        outcome.append(
            failed.select("post_id", F.lit(number).alias("run"), "error", F.lit(None).cast("int").alias("urgency_0_3"))
        )
    kept = tables.annotation_table(spark, table)
    outcome.append(kept.select("post_id", F.lit(0).alias("run"), F.lit(None).cast("string").alias("error"), "urgency_0_3"))
    return outcome[0].unionByName(outcome[1]).unionByName(outcome[2])


def prompt_render(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.render_prompts(silver(spark, sf), fx.TEMPLATE)


def annotate_batch(spark: SparkSession, sf: str) -> DataFrame:
    def label_by_length(texts: list[str]) -> list[annotate.Reply]:
        """A stand-in annotator whose answers follow from the prompt's length."""
        replies = []
        for size in map(len, texts):
            if size % 50 == 0:
                raise ValueError("no answer")
            answer = {"sentiment": "neutral", "urgency_0_3": size % 4, "keywords": [f"k{size}"]}
            replies.append((json.dumps(answer), size // 4, size % 100))
        return replies

    prompts = annotate.render_prompts(pending_posts(spark, sf), fx.TEMPLATE)
    replies = annotate.annotate(prompts, label_by_length, partitions=8)
    results = annotate.with_metadata(
        annotate.parse_responses(replies), "by-length", "1.0.0", fx.TEMPLATE, RUN_TS
    )
    return arrays_as_text(
        results.select(
            "post_id",
            "sentiment",
            "urgency_0_3",
            "keywords",
            "model_name",
            "model_version",
            "prompt_hash",
            "input_tokens",
            "output_tokens",
            "annotated_at",
            "status",
            "error",
        )
    )


def parse_annotations(spark: SparkSession, sf: str) -> DataFrame:
    return arrays_as_text(annotate.parse_responses(fx.responses(spark, sf)))


def validate_annotations(spark: SparkSession, sf: str) -> DataFrame:
    checked = annotate.validate(annotate.parse_responses(fx.responses(spark, sf)))
    return checked.select(
        "post_id", F.array_join("violations", ",").alias("violations"), "is_valid"
    )


def sanitize_text(spark: SparkSession, sf: str) -> DataFrame:
    parsed = annotate.parse_responses(fx.responses(spark, sf))
    return annotate.sanitise_free_text(parsed).select("post_id", "post_summary", "care_response")


def annotation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summary.annotation_summary(annotate.parse_responses(fx.responses(spark, sf)))


def token_usage(spark: SparkSession, sf: str) -> DataFrame:
    return summary.token_usage(fx.annotations(spark, sf))


def repeated_annotations(spark: SparkSession, sf: str) -> DataFrame:
    return summary.repeated_annotations(fx.crowded_annotations(spark, sf))


def incremental_bronze(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_path(spark, "bronze_batches")
    incremental.take_in_new(
        spark,
        f"{sf}/documents*.parquet",
        fx.documents(spark, sf).schema,
        target,
        scratch_path(spark, "bronze_progress"),
        shape=fx.raw_posts_of,
    )
    return models.bronze(tables.raw_posts(spark, f"{target}/batch=*"))


def _land_in_turns(spark: SparkSession, sf: str, landed: str, take_in: Callable[[], None]) -> None:
    """Three landings, the last with scrapes of posts that came before."""
    posts = fx.raw_posts(spark, sf).withColumn(
        "landing",
        F.when(F.col("content").contains(" See https://x.example.com/a?b="), 2).otherwise(
            F.col("post_timestamp") % 2
        ),
    )
    for number in range(3):
        landing = posts.filter(F.col("landing") == number).drop("landing")
        landing.write.mode("append").parquet(landed, compression=CODEC)
        take_in()


def incremental_current(spark: SparkSession, sf: str) -> DataFrame:
    landed, target, progress = (scratch_path(spark, n) for n in ("landed", "state", "progress"))
    _land_in_turns(
        spark, sf, landed, lambda: incremental.take_in_new(spark, landed, RAW_POST, target, progress)
    )
    return incremental.current_posts(spark, target)


def incremental_merged(spark: SparkSession, sf: str) -> DataFrame:
    landed, target, progress = (scratch_path(spark, n) for n in ("landed", "state", "progress"))
    _land_in_turns(
        spark, sf, landed, lambda: incremental.merge_new(spark, landed, RAW_POST, target, progress, 16)
    )
    return incremental.merged_posts(spark, target)


def incremental_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold after posts in three landings and annotations in two, carried through."""
    names = ("landed", "state", "progress", "notes_landed", "notes", "notes_progress", "silver", "gold")
    landed, state, progress, notes_landed, notes, notes_progress, silver_path, gold_path = (
        scratch_path(spark, n) for n in names
    )
    stored = fx.annotations(spark, sf)
    turns = [stored.filter(F.lit(False)), stored.filter("urgency_0_3 < 2"), stored.filter("urgency_0_3 >= 2")]

    def take_in() -> None:
        turns.pop(0).write.mode("append").parquet(notes_landed, compression=CODEC)
        incremental.merge_new(spark, landed, RAW_POST, state, progress, 16)
        incremental.merge_annotations(spark, notes_landed, notes, notes_progress, 16)
        carry.carry_silver(spark, state, silver_path, 16)
        carry.carry_gold(spark, silver_path, notes, gold_path, 16)

    _land_in_turns(spark, sf, landed, take_in)
    return arrays_as_text(carry.gold_state(spark, gold_path).current(spark))


QUERIES: dict[str, Query] = {
    "scan_raw_posts": scan_raw_posts,
    "scan_annotations": scan_annotations,
    "create_tables": create_tables,
    "append_posts": append_posts,
    "append_posts_by_day": append_posts_by_day,
    "append_annotations": append_annotations,
    "roundtrip_csv": roundtrip_csv,
    "roundtrip_json": roundtrip_json,
    "annotations_csv": annotations_csv,
    "model_views": model_views,
    "model_views_all": model_views_all,
    "catalog_views_all": catalog_views_all,
    "catalog_functions_all": catalog_functions_all,
    "catalog_gold_hot": catalog_gold_hot,
    "loaded_subreddits": loaded_subreddits,
    "loaded_subreddits_indexed": loaded_subreddits_indexed,
    "loaded_subreddit_days_indexed": loaded_subreddit_days_indexed,
    "loaded_subreddit_days": loaded_subreddit_days,
    "tables_present": tables_present,
    "renamed_columns": renamed_columns,
    "shape_archive": shape_archive,
    "shape_rejects": shape_rejects,
    "shape_top": shape_top,
    "posts_for_day": posts_for_day,
    "flair_filter": flair_filter,
    "subreddit_batch": subreddit_batch,
    "top_posts_period": top_posts_period,
    "top_posts_periods": top_posts_periods,
    "posts_for_day_limited": posts_for_day_limited,
    "bronze_dedup": bronze_dedup,
    "first_seen": first_seen,
    "content_duplicates": content_duplicates,
    "one_per_content": one_per_content,
    "bronze": bronze,
    "redact": redact,
    "text_metrics": text_metrics,
    "redaction_counts": redaction_counts,
    "routing": routing,
    "routing_guarded": routing_guarded,
    "silver": silver,
    "lang_hint": lang_hint,
    "heuristic_flags": heuristic_flags,
    "lexicon_tags": lexicon_tags,
    "gold": gold_text,
    "gold_hot": gold_hot,
    "post_review": post_review,
    "keywords_exploded": keywords_exploded,
    "safety_flags_exploded": safety_flags_exploded,
    "safety_booleans": safety_booleans,
    "safety_kpis": safety_kpis,
    "top_keywords": top_keywords,
    "latest_annotated": latest_annotated,
    "ingest_summary": ingest_summary,
    "pending_posts": pending_posts,
    "pending_batch": pending_batch,
    "pending_of_silver": pending_of_silver,
    "latest_by_place": latest_by_place,
    "pending_by_place": pending_by_place,
    "annotation_run": annotation_run,
    "prompt_render": prompt_render,
    "annotate_batch": annotate_batch,
    "parse_annotations": parse_annotations,
    "validate_annotations": validate_annotations,
    "sanitize_text": sanitize_text,
    "annotation_summary": annotation_summary,
    "token_usage": token_usage,
    "repeated_annotations": repeated_annotations,
    "incremental_bronze": incremental_bronze,
    "incremental_current": incremental_current,
    "incremental_merged": incremental_merged,
    "incremental_gold": incremental_gold,
}


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return query(configure(spark), sf.rstrip("/"))

    return run


def all_queries() -> dict[str, Query]:
    return {name: _configured(query) for name, query in QUERIES.items()}

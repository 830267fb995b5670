"""The layered models: raw -> bronze -> silver -> gold -> marts.

Each function takes and returns DataFrames and triggers no job, so a chain of
them is one plan. ``views`` gives the same chain names for SQL users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import lexicon, text
from postlake.operators import arrays, clean, dedupe, joins, late
from postlake.operators.once import add_once
from postlake.schemas import ANNOTATION_COLUMNS, GOLD_COLUMNS, SILVER_COLUMNS


def bronze(raw: DataFrame) -> DataFrame:
    """Latest scrape per post with clean title, content and community.

    Rows are chosen first and cleaned after, so old scrapes cost no cleaning.
    """
    return bronze_of_latest(dedupe.latest_posts(raw))


def bronze_of_latest(latest: DataFrame) -> DataFrame:
    """Bronze of posts that are there once."""
    return latest.select(
        "post_id",
        "post_date",
        "post_timestamp",
        "post_flair",
        F.trim("title").alias("post_title"),
        "url",
        text.normalise(F.col("content")).alias("post_content_raw"),
        "score",
        "num_comments",
        F.lower("subreddit").alias("subreddit"),
        "scraped_at",
        text.content_hash(F.col("title"), F.col("content")).alias("content_hash"),
    )


def bronze_without_text(raw: DataFrame) -> DataFrame:
    """The bronze columns that need no content, from the same chosen rows.

    For reports on titles, scores and dates: the text is neither read nor moved.
    """
    latest = dedupe.latest_posts(raw.drop("content"))
    return latest.select(
        "post_id",
        "post_date",
        "post_timestamp",
        "post_flair",
        F.trim("title").alias("post_title"),
        "url",
        "score",
        "num_comments",
        F.lower("subreddit").alias("subreddit"),
        "scraped_at",
    )


def silver(bronze_posts: DataFrame, **routing) -> DataFrame:
    """Redacted text, its metrics and the routing flag."""
    base = bronze_posts.filter(F.col("post_content_raw").isNotNull()).withColumnsRenamed(
        {"url": "post_url", "post_content_raw": "text_raw"}
    )
    redacted = clean.redact(base, "text_raw", "text_for_llm", collapsed=True)
    measured = redacted.withColumns(text.text_metrics(F.col("text_for_llm")))
    flag = text.needs_annotation(
        F.col("text_for_llm"), F.col("n_words"), F.col("token_estimate"), **routing
    )
    return measured.withColumn("needs_annotation", flag).select(SILVER_COLUMNS)


def gold(
    silver_posts: DataFrame,
    annotations: DataFrame,
    part_rows: int | None = None,
    redacted_only: bool = False,
) -> DataFrame:
    """Posts with their annotations, 41 columns.

    ``part_rows`` splits posts with more annotations than that, see the join.
    ``redacted_only`` leaves out the columns that still hold unredacted text.
    """
    joined = joins.with_annotations(
        silver_posts, annotations.select(ANNOTATION_COLUMNS), part_rows
    )
    unsafe = {"post_title", "post_url", "post_flair", "text_raw"} if redacted_only else set()
    return joined.select([c for c in GOLD_COLUMNS if c not in unsafe])


def post_review(gold_posts: DataFrame) -> DataFrame:
    """Stable alias of gold for reports."""
    return gold_posts.select("*")


def keywords_exploded(review: DataFrame, distinct: bool = False) -> DataFrame:
    return arrays.flatten(review, "keywords", "keyword", distinct)


def safety_flags_exploded(review: DataFrame, distinct: bool = False) -> DataFrame:
    return arrays.flatten(review, "safety_flags", "safety_flag", distinct)


def safety_booleans(review: DataFrame) -> DataFrame:
    return review.select(
        "post_id", *[column.alias(name) for name, column in arrays.safety_indicators().items()]
    )


def review_of_ids(
    raw: DataFrame, annotations: DataFrame, columns: list[str], part_rows: int | None = None
) -> DataFrame:
    """The post id and some annotation columns of the review, without post text.

    Bronze holds each post id once, whichever scrape wins, so the distinct ids
    of the raw table stand for it. The marts on annotation arrays need no more,
    and this reads one column of the raw table instead of all text.
    """
    ids = joins.distinct_ids(raw)
    return joins.with_annotations(ids, annotations.select("post_id", *columns), part_rows)


def pending(raw: DataFrame, annotations: DataFrame, limit: int | None = None) -> DataFrame:
    """Posts that still need an annotation, with redacted and raw text.

    Known posts leave before the text is cleaned, so a daily run cleans only
    what is new. The order by id makes the limited choice repeatable.
    """
    unseen = joins.without_annotation(bronze(raw), annotations)
    return _to_annotate(silver(unseen), limit)


def pending_of_scan(scan: DataFrame, annotations: DataFrame, limit: int | None = None) -> DataFrame:
    """The same as ``pending`` from raw posts as files or a table hold them.

    The newest scrapes are chosen, and known posts left out, on rows without text; then
    the texts of the chosen are read where they lie (``late``). No text is shuffled. With
    a limit, texts are fetched for the first ids only, more of them in every round until
    enough posts have been found that need an annotation.
    """
    chosen = joins.without_annotation(late.latest_places(scan), annotations)
    if limit is None:
        return _to_annotate(silver(bronze_of_latest(late.fetch(scan, chosen))), None)
    chosen = late.stored(chosen, "chosen")
    some, found, after, step = None, 0, None, max(1, 4 * limit)
    while True:
        rest = chosen if after is None else chosen.filter(F.col("post_id") > after)
        ids = rest.select("post_id").distinct().orderBy("post_id").limit(step)
        count, last = ids.agg(F.count("*"), F.max("post_id")).first()
        part = rest if last is None else rest.filter(F.col("post_id").isNull() | (F.col("post_id") <= last))
        texts = late.fetch(scan, part)
        made = late.stored(_to_annotate(silver(bronze_of_latest(texts)), limit), "pending")
        some = made if some is None else some.unionAll(made)
        found, after, step = found + made.count(), last, 4 * step
        if found >= limit or last is None or count < step // 4:
            return some.orderBy("post_id").limit(limit)


def pending_of_silver(
    silver_posts: DataFrame, annotations: DataFrame, limit: int | None = None
) -> DataFrame:
    """The same from a stored silver table, whose flag is a filter of the scan."""
    wanted = silver_posts.filter("needs_annotation")
    if limit is None:
        return _to_annotate(joins.without_annotation(wanted, annotations), None)
    # The choice is made on ids; only the texts of the chosen are fetched.
    chosen = joins.without_annotation(wanted.select("post_id"), annotations)
    chosen = chosen.orderBy("post_id").limit(limit)
    return _to_annotate(wanted.join(chosen, "post_id", "left_semi"), None)


def _to_annotate(unseen: DataFrame, limit: int | None) -> DataFrame:
    chosen = unseen.filter("needs_annotation").select("post_id", "text_for_llm", "text_raw")
    return chosen if limit is None else chosen.orderBy("post_id").limit(limit)


def with_heuristics(
    silver_posts: DataFrame,
    high: tuple[int, int] = (200, 50),
    medium: tuple[int, int] = (50, 10),
) -> DataFrame:
    """Documented-only hint columns; rules and cut-offs are our own.

    ``high`` and ``medium`` are the score and comment counts, either of which
    is enough for the level.
    """

    def reaches(level: tuple[int, int]) -> Column:
        return (F.col("score") >= level[0]) | (F.col("num_comments") >= level[1])

    clinical = {"clinical": lexicon.KEYWORD_DOMAINS["clinical"]}
    lines = add_once(silver_posts, "_l", lexicon.word_line(F.col("text_for_llm")))
    line, found = F.col("_l"), F.col("_f")
    lines = add_once(lines, "_f", lexicon.anchors_found(line, clinical, lexicon.PHASE_TRIGGERS))
    hints = F.struct(
        text.lang_hint(F.col("text_for_llm")).alias("lang_hint"),
        lexicon.mentions(line, found, clinical["clinical"]).alias("has_medical_terms"),
        lexicon.first_tag(line, found, lexicon.PHASE_TRIGGERS, None).alias("trimester_hint"),
    )
    hinted = add_once(lines, "_h", hints)
    level = F.when(reaches(high), "high").when(reaches(medium), "medium").otherwise("low")
    return hinted.select(
        *silver_posts.columns, "_h.*", level.alias("engagement_level")
    )


def views(spark: SparkSession, raw: DataFrame, annotations: DataFrame) -> list[str]:
    """Register every model as a temporary view; returns the view names.

    The marts on arrays equal those of ``post_review`` but read no text.
    """
    models = {"bronze": bronze(raw)}
    models["silver"] = silver(models["bronze"])
    models["gold"] = gold(models["silver"], annotations, joins.PART_ROWS)
    models["post_review"] = post_review(models["gold"])
    arrays_only = review_of_ids(
        raw, annotations, ["keywords", "safety_flags"], joins.PART_ROWS
    )
    models["keywords_exploded"] = keywords_exploded(arrays_only)
    models["safety_flags_exploded"] = safety_flags_exploded(arrays_only)
    models["safety_booleans"] = safety_booleans(arrays_only)
    for name, model in models.items():
        model.createOrReplaceTempView(name)
    return list(models)

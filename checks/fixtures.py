"""Post tables derived from the generated test tables, at any scale.

Every row of ``documents`` becomes a post, and some posts are scraped a second
time with text that holds each kind of personal data. ``RAW_SQL`` and its
siblings state the same tables for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import text
from postlake.schemas import (
    ANNOTATION_COLUMNS,
    RAW_COLUMNS,
    SENTIMENTS,
    TOPICS,
    TRIMESTERS,
)

EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
DOCUMENTS = "doc_id bigint, text string, lang string, source string"
LABELS = "doc_id bigint, quality int, toxic int"
TEMPLATE = (
    "Label the post below and answer with one JSON object.\n"
    'post_id: "{{POST_ID}}"\n'
    'post_text: "{{POST_TEXT}}"\n'
    "Keep {{braces}} as they are.\n"
)


def _id() -> Column:
    return F.col("doc_id")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def _at(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def raw_posts_of(docs: DataFrame) -> DataFrame:
    """Raw posts, with one pass over the documents."""
    created = EPOCH + _id() * 3600
    community = F.upper("source")
    scrapes = F.when(_id() % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    content = F.when(_id() % 89 != 0, F.col("text"))
    again = F.concat(
        F.coalesce(content, F.lit("")),
        F.lit(" See https://x.example.com/a?b="),
        _id().cast("string"),
        F.lit("). WWW.Example.org/p mail Bob"),
        _id().cast("string"),
        F.lit("@x.io! by U/user_"),
        _id().cast("string"),
        F.lit(" in r/"),
        community,
        F.lit(" call +1 (743) 555-"),
        (1000 + _id()).cast("string"),
        F.lit("?"),
    )
    first = F.col("scrape") == 0
    return docs.select("*", F.explode(scrapes).alias("scrape")).select(
        F.concat(F.lit("d"), _id().cast("string")).alias("post_id"),
        _at(created).alias("post_date"),
        created.alias("post_timestamp"),
        F.when(_id() % 10 != 0, F.concat(F.upper("lang"), F.lit(" Question"))).alias("post_flair"),
        F.when(
            _id() % 97 != 0, F.concat(F.lit("  "), F.substring("text", 1, 40), F.lit(" "))
        ).alias("title"),
        F.concat(
            F.lit("https://www.reddit.com/r/"),
            "source",
            F.lit("/comments/"),
            _id().cast("string"),
        ).alias("url"),
        F.when(first, content).otherwise(again).alias("content"),
        ((_id() * 37) % 500 + 10 * F.col("scrape")).alias("score"),
        ((_id() * 13) % 80 + F.col("scrape")).alias("num_comments"),
        community.alias("subreddit"),
        F.when(~first, _at(created + 172800))
        .when(_id() % 50 != 0, _at(created + 86400))
        .alias("scraped_at"),
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_posts_of(documents(spark, sf_dir))


def _texts(values: list[str]) -> str:
    """An array of text literals in Spark SQL."""
    return "array(" + ", ".join(f'r"{v}"' for v in values) + ")"


def _pick_sql(values: list[str], index: str) -> str:
    return f"element_at({_texts(values)}, cast({index} % {len(values)} + 1 as int))"


def _pick(values: list[str], index: str = "doc_id") -> Column:
    return F.expr(_pick_sql(values, index))


def _topic() -> Column:
    """A topic of the post's group."""
    cases = " ".join(
        f"when {at} then {_pick_sql(topics, 'doc_id div 6')}"
        for at, topics in enumerate(TOPICS.values())
    )
    return F.expr(f"case doc_id % 6 {cases} end")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One annotation for each labelled document."""
    labels = spark.read.schema(LABELS).parquet(f"{sf_dir}/labels.parquet")
    docs = documents(spark, sf_dir)
    flags = (
        F.when(F.col("toxic") == 1, F.array(F.lit("urgent_bleeding"), F.lit("mental_health_crisis")))
        .when(_id() % 7 == 0, F.array(F.lit("Urgent_Pain")))
        .when(_id() % 11 == 0, F.array(F.lit("urgent_pain"), F.lit("urgent_fetal_concern")))
        .otherwise(F.array().cast("array<string>"))
    )
    secondary = F.slice(
        F.array(F.lit("sleep_fatigue"), F.lit("insurance_costs"), F.lit("labor_delivery")),
        1,
        (_id() % 4).cast("int"),
    )
    columns = {
        "post_id": F.concat(F.lit("d"), _id().cast("string")),
        "primary_group": _pick(list(TOPICS)),
        "primary_topic": _topic(),
        "secondary_topics": secondary,
        "trimester": _pick(TRIMESTERS),
        "sentiment": F.when(F.col("quality") == 1, SENTIMENTS[2]).otherwise(SENTIMENTS[0]),
        "urgency_0_3": (_id() % 4).cast("int"),
        "keywords": F.split("text", " "),
        "safety_flags": flags,
        "post_summary": F.concat(F.lit('Post "'), _id().cast("string"), F.lit('"\nwas labelled.')),
        "care_response": F.trim(F.repeat(F.lit("kind words "), (50 + _id() % 70).cast("int"))),
        "model_name": _pick(["model-a", "model-b"]),
        "model_version": F.lit("1.0.0"),
        "prompt_hash": text.prompt_hash(F.lit(TEMPLATE)),
        "input_tokens": F.ceil(F.length("text") / 4.0).cast("int"),
        "output_tokens": (100 + _id() % 300).cast("int"),
        "annotated_at": _at(EPOCH + _id() * 60),
    }
    joined = labels.join(docs, "doc_id")
    return joined.select(*[columns[name].alias(name) for name in ANNOTATION_COLUMNS])


def crowded_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotations, a third of them of one post, and those twice over."""
    notes = annotations(spark, sf_dir)
    third = F.substring("post_id", 2, 20).cast("long") % 3 == 0
    crowd = notes.filter(third).withColumn("post_id", F.lit("d5"))
    return notes.filter(~third).unionByName(crowd).unionByName(crowd)


def archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed archive records: some keys absent, some null, some unusable."""

    def absent_every(k: int, value: Column) -> Column:
        return F.when(_id() % k != 0, value)

    record = F.to_json(
        F.struct(
            absent_every(31, F.concat(F.lit("d"), _id().cast("string"))).alias("id"),
            absent_every(37, EPOCH + _id() * 3600).alias("created_utc"),
            F.when(_id() % 30 == 0, F.lit("")).when(_id() % 30 != 1, F.col("text")).alias("selftext"),
            absent_every(4, F.concat(F.lit("https://ex.org/"), _id().cast("string"))).alias("url"),
            absent_every(6, F.concat(F.lit("/r/"), "source", F.lit("/"), _id().cast("string"))).alias("permalink"),
            absent_every(10, F.col("lang")).alias("link_flair_text"),
            absent_every(11, F.substring("text", 1, 40)).alias("title"),
            absent_every(13, (_id() * 37) % 500).alias("score"),
            absent_every(17, (_id() * 13) % 80).alias("num_comments"),
            absent_every(19, F.col("source")).alias("subreddit"),
        )
    )
    null_title = F.replace(record, F.lit("}"), F.lit(',"title":null}'))
    value = (
        F.when(_id() % 41 == 0, F.lit("{broken"))
        .when((_id() % 11 == 0) & (_id() % 2 == 0) & ~F.contains("text", F.lit("}")), null_title)
        .otherwise(record)
    )
    return documents(spark, sf_dir).select("doc_id", value.alias("value"))


def top_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-list submissions: text posts and link posts."""
    return documents(spark, sf_dir).select(
        F.concat(F.lit("d"), _id().cast("string")).alias("id"),
        (EPOCH + _id() * 3600 + 0.75).alias("created_utc"),
        F.when(_id() % 10 != 0, F.upper("lang")).alias("link_flair_text"),
        F.substring("text", 1, 40).alias("title"),
        F.concat(F.lit("https://ex.org/"), _id().cast("string")).alias("url"),
        F.concat(F.lit("/r/"), "source", F.lit("/"), _id().cast("string")).alias("permalink"),
        (_id() % 30 != 0).alias("is_self"),
        F.when(_id() % 30 != 0, F.col("text")).otherwise("").alias("selftext"),
        ((_id() * 37) % 500).alias("score"),
        ((_id() * 13) % 80).alias("num_comments"),
        F.col("source").alias("subreddit"),
    )


def _numbered(stem: str, n: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit(stem), i.cast("string")))


def _spoilt(body: Column) -> Column:
    """A sound object with more around it, in five ways; a repeated key is no fault."""
    forms = [
        F.concat(body, F.lit(" and more")),
        F.concat(F.lit("```json\n"), body, F.lit("\n```")),
        F.concat(F.lit("["), body, F.lit("]")),
        F.concat(body, F.lit("]")),
        F.concat(F.lit('{"sentiment":"positive",'), F.substr(body, F.lit(2))),
    ]
    return F.element_at(F.array(*forms), (_id() % 5 + 1).cast("int"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotator output: mostly sound objects, and each kind of broken one."""
    kind = _id() % 9
    group = _pick(list(TOPICS))
    topic = F.when(kind == 3, F.lit("no_such_topic")).otherwise(_topic())
    n_secondary = F.when(kind == 4, 4).otherwise(_id() % 4).cast("int")
    n_keywords = F.when(kind == 5, 4).when(kind == 6, 21).otherwise(5 + _id() % 16).cast("int")
    secondary = F.when(n_secondary > 0, _numbered("t", n_secondary)).otherwise(
        F.array().cast("array<string>")
    )
    body = F.to_json(
        F.struct(
            F.concat(F.when(kind == 7, "x").otherwise("d"), _id().cast("string")).alias("post_id"),
            group.alias("primary_group"),
            topic.alias("primary_topic"),
            secondary.alias("secondary_topics"),
            _pick(TRIMESTERS).alias("trimester"),
            F.lit("neutral").alias("sentiment"),
            (_id() % 4).cast("int").alias("urgency_0_3"),
            _numbered("k", n_keywords).alias("keywords"),
            F.when(_id() % 5 == 0, F.array(F.lit("urgent_pain")))
            .otherwise(F.array().cast("array<string>"))
            .alias("safety_flags"),
            F.concat(F.lit('It "is" so.\r\nSay: '), "text").alias("post_summary"),
            F.trim(F.repeat(F.lit("kind words "), (50 + _id() % 70).cast("int"))).alias("care_response"),
        )
    )
    response = (
        F.when(kind == 1, F.substring(body, 1, 30))
        .when(kind == 8, _spoilt(body))
        .when(kind == 2, F.regexp_replace(body, '"urgency_0_3":([0-9])', '"urgency_0_3":"$1"'))
        .otherwise(body)
    )
    return documents(spark, sf_dir).select(
        F.concat(F.lit("d"), _id().cast("string")).alias("post_id"), response.alias("response")
    )


# Sentences with trigger words; each document gets one of them appended.
TRIGGER_PHRASES = [
    "I am 20 weeks PREGNANT and there is heavy bleeding.",
    "Trying to conceive; asked the mid-wife about Iron.",
    "Gave birth by C-Section, breastfeeding and pumping, so stressed!",
    "Severe anxiety and panic after a pregnancy loss.",
    "Second trimester: no fetal movement, reduced kick counts?",
    "Shortness of breath and chest pain, third-trimester.",
    "Nothing to report here.",
    "Does Medicaid cover an OB-GYN appointment in rural Texas?",
    "Fever, chills and a wound infection in the first trimester.",
]


def tagged_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with a sentence of trigger words at the end."""
    return documents(spark, sf_dir).select(
        F.concat(F.lit("d"), _id().cast("string")).alias("post_id"),
        F.concat("text", F.lit(" "), _pick(TRIGGER_PHRASES)).alias("text_for_llm"),
        ((_id() * 37) % 500).alias("score"),
        ((_id() * 13) % 80).alias("num_comments"),
    )


# --- The same tables for DuckDB ----------------------------------------------


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def sql_ts(seconds: str) -> str:
    return f"make_timestamp(cast({seconds} as bigint) * 1000000)"


RAW_SQL = f"""
base as (
  select 'd' || cast(doc_id as varchar) as post_id, doc_id,
    {sql_ts(f'{EPOCH} + doc_id * 3600')} as post_date,
    {EPOCH} + doc_id * 3600 as post_timestamp,
    case when doc_id % 10 = 0 then null else upper(lang) || ' Question' end as post_flair,
    case when doc_id % 97 = 0 then null else '  ' || substr(text, 1, 40) || ' ' end as title,
    'https://www.reddit.com/r/' || source || '/comments/' || cast(doc_id as varchar) as url,
    case when doc_id % 89 = 0 then null else text end as content,
    (doc_id * 37) % 500 as score, (doc_id * 13) % 80 as num_comments,
    upper(source) as subreddit,
    case when doc_id % 50 = 0 then null
         else {sql_ts(f'{EPOCH} + doc_id * 3600 + 86400')} end as scraped_at
  from documents),
again as (
  select post_id, doc_id, post_date, post_timestamp, post_flair, title, url,
    coalesce(content, '') || ' See https://x.example.com/a?b=' || cast(doc_id as varchar)
      || '). WWW.Example.org/p mail Bob' || cast(doc_id as varchar)
      || '@x.io! by U/user_' || cast(doc_id as varchar) || ' in r/' || subreddit
      || ' call +1 (743) 555-' || cast(1000 + doc_id as varchar) || '?' as content,
    score + 10 as score, num_comments + 1 as num_comments, subreddit,
    {sql_ts(f'{EPOCH} + doc_id * 3600 + 172800')} as scraped_at
  from base where doc_id % 5 = 0),
raw_posts as (
  select {", ".join(RAW_COLUMNS)} from base
  union all select {", ".join(RAW_COLUMNS)} from again)"""

TOPIC_SQL = "case doc_id % 6 " + " ".join(
    f"when {at} then {sql_list(topics)}[(doc_id // 6) % {len(topics)} + 1]"
    for at, topics in enumerate(TOPICS.values())
) + " end"

ANNOTATION_SQL = f"""
annotations as (
  select 'd' || cast(doc_id as varchar) as post_id,
    {sql_list(list(TOPICS))}[doc_id % 6 + 1] as primary_group,
    {TOPIC_SQL} as primary_topic,
    ['sleep_fatigue', 'insurance_costs', 'labor_delivery'][1:doc_id % 4] as secondary_topics,
    {sql_list(TRIMESTERS)}[doc_id % 8 + 1] as trimester,
    case quality when 1 then 'positive' else 'negative' end as sentiment,
    cast(doc_id % 4 as int) as urgency_0_3,
    string_split(text, ' ') as keywords,
    case when toxic = 1 then ['urgent_bleeding', 'mental_health_crisis']
         when doc_id % 7 = 0 then ['Urgent_Pain']
         when doc_id % 11 = 0 then ['urgent_pain', 'urgent_fetal_concern']
         else cast([] as varchar[]) end as safety_flags,
    'Post "' || cast(doc_id as varchar) || '"' || chr(10) || 'was labelled.' as post_summary,
    trim(repeat('kind words ', 50 + doc_id % 70)) as care_response,
    ['model-a', 'model-b'][doc_id % 2 + 1] as model_name,
    '1.0.0' as model_version,
    substr(sha256({quoted(TEMPLATE)}), 1, 16) as prompt_hash,
    cast(ceil(length(text) / 4.0) as int) as input_tokens,
    cast(100 + doc_id % 300 as int) as output_tokens,
    {sql_ts(f'{EPOCH} + doc_id * 60')} as annotated_at
  from labels join documents using (doc_id))"""

CROWDED_SQL = """
numbered as (select *, cast(substr(post_id, 2) as bigint) % 3 = 0 as third from annotations),
crowded as (
  select * exclude (third) from numbered where not third
  union all
  select n.* exclude (third) replace ('d5' as post_id)
  from numbered n, range(2) t where third)"""

"""The expected result of each query as SQL for DuckDB on the same test tables."""

from __future__ import annotations

from functools import reduce

from checks import fixtures as fx
from checks.queries import COMMUNITIES, DAY
from postlake.functions import lexicon
from postlake.schemas import (
    ANNOTATION_COLUMNS,
    RAW_COLUMNS,
    SAFETY_FLAGS,
    SENTIMENTS,
    SILVER_COLUMNS,
    TOPICS,
    TRIMESTERS,
)

RAW = ", ".join(RAW_COLUMNS)
ARRAYS = ("secondary_topics", "keywords", "safety_flags")
RUN_TS = "timestamp '2024-06-01 12:00:00'"
HASH = f"substr(sha256({fx.quoted(fx.TEMPLATE)}), 1, 16)"


def as_json(name: str) -> str:
    return f"case when {name} is null then null else cast(to_json({name}) as varchar) end as {name}"


def listed(columns: list[str], prefix: str = "") -> str:
    return ", ".join(as_json(prefix + c) if c in ARRAYS else prefix + c for c in columns)


LATEST = """
latest as (
  select * from (
    select *, row_number() over (partition by post_id
      order by scraped_at desc nulls first, post_timestamp desc, score desc, content) as rn
    from raw_posts)
  where rn = 1)"""

BRONZE = r"""
bronze as (
  select post_id, post_date, post_timestamp, post_flair, trim(title) as post_title, url,
    regexp_replace(trim(coalesce(content, '')), '\s+', ' ', 'g') as post_content_raw,
    score, num_comments, lower(subreddit) as subreddit, scraped_at,
    md5(coalesce(title, '') || '|' || coalesce(content, '')) as content_hash
  from latest)"""

# What is redacted, in order, with the flags of the search.
REDACTED = [
    (r"https?://\S+|\bwww\.[^\s]+", "[URL]", "gi"),
    (r"[a-z0-9][a-z0-9._%+-]*@[a-z0-9][a-z0-9.-]*\.[a-z]{2,}", "[EMAIL]", "gi"),
    (r"(\+?[0-9][0-9\-\s\(\)]{7,}[0-9])", "[PHONE]", "g"),
    (r"\bu/[a-z0-9_\-]+", "u/[USER]", "gi"),
    (r"\br/[a-z0-9_]+", "r/[SUB]", "gi"),
    (r"\s+", " ", "g"),
]

# Metric columns that count the matches of a pattern.
COUNTED = {
    "n_questions": r"\?",
    "n_exclaims": r"!",
    "n_urls_redacted": r"\[URL\]",
    "n_emails_redacted": r"\[EMAIL\]",
    "n_phones_redacted": r"\[PHONE\]",
    "n_usernames_redacted": r"u/\[USER\]",
    "n_subreddits_redacted": r"r/\[SUB\]",
}


def _matches(pattern: str) -> str:
    return f"len(regexp_extract_all(text_for_llm, '{pattern}'))"


REDACTED_TEXT = reduce(
    lambda sql, rule: f"regexp_replace({sql}, '{rule[0]}', '{rule[1]}', '{rule[2]}')",
    REDACTED,
    "post_content_raw",
)
COUNTS = ", ".join(f"cast({_matches(p)} as int) as {name}" for name, p in COUNTED.items())

SILVER = f"""
redacted as (
  select * rename (url as post_url, post_content_raw as text_raw),
    {REDACTED_TEXT} as text_for_llm
  from bronze),
measured as (
  select *, {COUNTS},
    cast(length(text_for_llm) as int) as n_chars,
    cast(len(string_split(text_for_llm, ' ')) as int) as n_words,
    cast(greatest({_matches("[.!?]+")}, 1) as int) as n_sentences,
    cast(ceil(length(text_for_llm) / 4.0) as bigint) as token_estimate
  from redacted),
silver as (
  select *, (n_words between 5 and 1000) and token_estimate < 4000 as needs_annotation
  from measured)"""

GOLD = f"""
gold as (
  select p.*, {", ".join(f"a.{c}" for c in ANNOTATION_COLUMNS if c != "post_id")}
  from silver p left join annotations a on p.post_id = a.post_id)"""

PENDING = """
pending as (
  select post_id, text_for_llm, text_raw from silver s
  where needs_annotation
    and not exists (select 1 from annotations a where a.post_id = s.post_id))"""

KEYWORDS = """
keywords as (select post_id, lower(k) as keyword from
  (select post_id, unnest(keywords) as k from gold))"""

BOOLEANS = """
booleans as (
  select post_id,
    list_contains(safety_flags, 'urgent_bleeding') as is_urgent_bleeding,
    list_contains(safety_flags, 'urgent_pain') as is_urgent_pain,
    list_contains(safety_flags, 'urgent_fetal_concern') as is_urgent_fetal_concern,
    list_contains(safety_flags, 'mental_health_crisis') as is_mh_crisis
  from gold)"""


def with_(parts: list[str], select: str) -> str:
    return f"with {','.join(parts)}\n{select}"


TO_BRONZE = [fx.RAW_SQL, LATEST, BRONZE]
TO_SILVER = [*TO_BRONZE, SILVER]
TO_GOLD = [*TO_SILVER, fx.ANNOTATION_SQL, GOLD]


def silver_of(columns: str) -> str:
    return with_(TO_SILVER, f"select {columns} from silver")


# --- Shaping -----------------------------------------------------------------

# What the landed archive records hold, field by field. A key is absent where
# the test record leaves it out; the title is also null on purpose at times.
ARCHIVE = f"""
archive as (
  select doc_id, doc_id % 41 = 0 as is_broken,
    case when doc_id % 31 = 0 then null else 'd' || cast(doc_id as varchar) end as id,
    case when doc_id % 37 = 0 then null else {fx.EPOCH} + doc_id * 3600 end as created_utc,
    case doc_id % 30 when 0 then '' when 1 then null else text end as selftext,
    case when doc_id % 4 = 0 then '' else 'https://ex.org/' || cast(doc_id as varchar) end as url,
    case when doc_id % 6 = 0 then ''
      else '/r/' || source || '/' || cast(doc_id as varchar) end as permalink,
    case when doc_id % 10 = 0 then null else lang end as link_flair_text,
    case when doc_id % 11 <> 0 then substr(text, 1, 40)
      when doc_id % 2 = 0 and not contains(text, '}}') then null else '' end as title,
    case when doc_id % 13 = 0 then 0 else (doc_id * 37) % 500 end as score,
    case when doc_id % 17 = 0 then 0 else (doc_id * 13) % 80 end as num_comments,
    case when doc_id % 19 = 0 then '' else source end as subreddit
  from documents)"""

SHAPE_ARCHIVE = with_(
    [ARCHIVE],
    f"""
    select id as post_id, {fx.sql_ts("created_utc")} as post_date, created_utc as post_timestamp,
      link_flair_text as post_flair, title, 'https://reddit.com' || permalink as url,
      case when selftext is null or selftext = '' then url else selftext end as content,
      score, num_comments, subreddit, {RUN_TS} as scraped_at
    from archive where not is_broken and id is not null and created_utc is not null
    """,
)

SHAPE_TOP = f"""
select 'd' || cast(doc_id as varchar) as post_id,
  {fx.sql_ts(f"{fx.EPOCH} + doc_id * 3600")} as post_date,
  {fx.EPOCH} + doc_id * 3600 as post_timestamp,
  case when doc_id % 10 = 0 then null else upper(lang) end as post_flair,
  substr(text, 1, 40) as title,
  case when doc_id % 30 <> 0
    then 'https://www.reddit.com/r/' || source || '/' || cast(doc_id as varchar)
    else 'https://ex.org/' || cast(doc_id as varchar) end as url,
  case when doc_id % 30 <> 0 then text else '' end as content,
  (doc_id * 37) % 500 as score, (doc_id * 13) % 80 as num_comments,
  source as subreddit, {RUN_TS} as scraped_at
from documents"""

# --- Responses ---------------------------------------------------------------

# The fields a sound reader finds in each response, from how it was made.
RESPONSES = f"""
made as (
  select 'd' || cast(doc_id as varchar) as post_id,
    doc_id % 9 = 1 or (doc_id % 9 = 8 and doc_id % 5 <> 4) as is_broken,
    {fx.sql_list(list(TOPICS))}[doc_id % 6 + 1] as primary_group,
    case when doc_id % 9 = 3 then 'no_such_topic' else {fx.TOPIC_SQL} end as primary_topic,
    case when doc_id % 9 = 4 then 4 else doc_id % 4 end as n_secondary,
    {fx.sql_list(TRIMESTERS)}[doc_id % 8 + 1] as trimester,
    'neutral' as sentiment,
    case when doc_id % 9 = 2 then null else cast(doc_id % 4 as int) end as urgency_0_3,
    case doc_id % 9 when 5 then 4 when 6 then 21 else 5 + doc_id % 16 end as n_keywords,
    case when doc_id % 5 = 0 then ['urgent_pain'] else cast([] as varchar[]) end as safety_flags,
    'It "is" so.' || chr(13) || chr(10) || 'Say: ' || text as post_summary,
    trim(repeat('kind words ', 50 + doc_id % 70)) as care_response,
    case when doc_id % 9 = 7 then 'x' else 'd' end || cast(doc_id as varchar) as echoed_id
  from documents),
parsed as (
  select post_id, primary_group, primary_topic,
    list_transform(range(1, n_secondary + 1), lambda i: 't' || cast(i as varchar))
      as secondary_topics,
    trimester, sentiment, urgency_0_3,
    list_transform(range(1, n_keywords + 1), lambda i: 'k' || cast(i as varchar)) as keywords,
    safety_flags, post_summary, care_response, echoed_id,
    'ok' as status, cast(null as varchar) as error
  from made where not is_broken
  union all
  select post_id, null, null, null, null, null, null, null, null, null, null, null,
    'failed', 'not a JSON object'
  from made where is_broken)"""

PARSED_COLUMNS = [
    "post_id",
    "primary_group",
    "primary_topic",
    "secondary_topics",
    "trimester",
    "sentiment",
    "urgency_0_3",
    "keywords",
    "safety_flags",
    "post_summary",
    "care_response",
    "echoed_id",
    "status",
    "error",
]


def _violations() -> str:
    pairs = ", ".join(fx.quoted(f"{g}/{t}") for g, topics in TOPICS.items() for t in topics)

    def known(column: str, values: list[str]) -> str:
        return f"coalesce({column} in ({', '.join(map(fx.quoted, values))}), false)"

    rules = {
        "primary_group": known("primary_group", list(TOPICS)),
        "primary_topic": f"coalesce(primary_group || '/' || primary_topic in ({pairs}), false)",
        "secondary_topics": "coalesce(len(secondary_topics), 0) <= 3",
        "trimester": known("trimester", TRIMESTERS),
        "sentiment": known("sentiment", SENTIMENTS),
        "urgency_0_3": "coalesce(urgency_0_3 in (0, 1, 2, 3), false)",
        "keyword_count": "coalesce(len(keywords) between 5 and 20, false)",
        "keyword_case": "keywords is not null and "
        "len(list_filter(keywords, lambda k: k <> lower(k))) = 0",
        "safety_flags": "safety_flags is not null and "
        f"list_has_all({fx.sql_list(SAFETY_FLAGS)}, safety_flags)",
        "post_summary": r"coalesce(greatest(len(regexp_extract_all(post_summary, '[.!?]+')), 1)"
        " between 1 and 3, false) and post_summary is not null",
        "care_response": "coalesce(len(string_split(trim(care_response), ' '))"
        " between 120 and 220, false)",
        "echoed_id": "echoed_id is not distinct from post_id",
    }
    parts = ", ".join(f"case when not ({ok}) then '{name}' end" for name, ok in rules.items())
    return f"""
    checked as (
      select post_id, list_filter([{parts}], lambda v: v is not null) as broken from parsed)"""


# --- Lexicon -----------------------------------------------------------------

TAGGED = rf"""
tagged as (
  select 'd' || cast(doc_id as varchar) as post_id,
    text || ' ' || {fx.sql_list(fx.TRIGGER_PHRASES)}[doc_id % {len(fx.TRIGGER_PHRASES)} + 1]
      as text_for_llm,
    (doc_id * 37) % 500 as score, (doc_id * 13) % 80 as num_comments
  from documents),
lines as (
  select *, ' ' || trim(regexp_replace(lower(text_for_llm), '[^a-z0-9]+', ' ', 'g')) || ' ' as line
  from tagged)"""


def _has(terms: list[str]) -> str:
    return " or ".join(f"contains(line, {fx.quoted(' ' + t.replace('-', ' ') + ' ')})" for t in terms)


def _tags(words: dict[str, list[str]]) -> str:
    cases = ", ".join(f"case when {_has(t)} then {fx.quoted(n)} end" for n, t in words.items())
    return f"list_filter([{cases}], lambda v: v is not null)"


def _first(words: dict[str, list[str]], otherwise: str) -> str:
    cases = " ".join(f"when {_has(t)} then {fx.quoted(n)}" for n, t in words.items())
    return f"case {cases} else {otherwise} end"


TERMS = dict.fromkeys(t for listed_ in lexicon.KEYWORD_DOMAINS.values() for t in listed_)

LEXICON_TAGS = with_(
    [
        TAGGED,
        f"""
        found as (select post_id, {_tags(lexicon.KEYWORD_DOMAINS)} as domains,
          {_tags({t: [t] for t in TERMS})} as keywords,
          {_tags(lexicon.SAFETY_TRIGGERS)} as safety_flags,
          {_first(lexicon.STAGE_TRIGGERS, "'unclear'")} as trimester
        from lines)""",
    ],
    f"select post_id, {as_json('domains')}, {as_json('keywords')}, {as_json('safety_flags')},"
    " trimester from found",
)

HEURISTICS = with_(
    [TAGGED],
    f"""
    select post_id, {_has(lexicon.KEYWORD_DOMAINS["clinical"])} as has_medical_terms,
      {_first(lexicon.PHASE_TRIGGERS, "null")} as trimester_hint,
      case when score >= 200 or num_comments >= 50 then 'high'
        when score >= 50 or num_comments >= 10 then 'medium' else 'low' end as engagement_level
    from lines""",
)

ASCII_SHARE = (
    r"length(regexp_replace(text_for_llm, '[\x00-\x7F]', '', 'g'))"
    " / cast(nullif(length(text_for_llm), 0) as double)"
)

# --- Annotation run ----------------------------------------------------------

PROMPTS = f"""
prompts as (
  select post_id, replace(replace({fx.quoted(fx.TEMPLATE)}, '{{{{POST_ID}}}}', post_id),
    '{{{{POST_TEXT}}}}', substr(text_for_llm, 1, 2000)) as prompt
  from FROM_TABLE)"""

ANNOTATE_BATCH = with_(
    [*TO_SILVER, fx.ANNOTATION_SQL, PENDING, PROMPTS.replace("FROM_TABLE", "pending")],
    f"""
    select post_id,
      case when n % 50 <> 0 then 'neutral' end as sentiment,
      case when n % 50 <> 0 then n % 4 end as urgency_0_3,
      case when n % 50 <> 0 then '["k' || cast(n as varchar) || '"]' end as keywords,
      'by-length' as model_name, '1.0.0' as model_version, {HASH} as prompt_hash,
      case when n % 50 <> 0 then n // 4 end as input_tokens,
      case when n % 50 <> 0 then n % 100 end as output_tokens,
      {RUN_TS} as annotated_at,
      case when n % 50 = 0 then 'failed' else 'ok' end as status,
      case when n % 50 = 0 then 'ValueError: no answer' end as error
    from (select post_id, cast(length(prompt) as int) as n from prompts)
    """,
)

RUN_ERRORS = """
  case n % 13 when 1 then 'post_summary is longer than 1000'
    when 2 then 'TypeError: a reply has three parts'
    when 3 then 'TypeError: 1.5 is no number of tokens'
    when 4 then 'TypeError: the response is dict, not text'
    when 5 then 'ValueError: no answer' when 6 then 'not a JSON object' end"""

# After two runs only prompts the annotator can't answer at all are left.
ANNOTATION_RUN = with_(
    [
        *TO_SILVER,
        "wanted as (select * from silver where needs_annotation)",
        PROMPTS.replace("FROM_TABLE", "wanted"),
        f"""
        asked as (select post_id, n, {RUN_ERRORS} as error
          from (select post_id, cast(length(prompt) as int) as n from prompts))""",
    ],
    """
    select post_id, 1 as run, error, cast(null as int) as urgency_0_3 from asked where error is not null
    union all
    select post_id, 2, error, null from asked where n % 13 = 5
    union all
    select post_id, 0, null, n % 4 from asked where n % 13 <> 5
    """,
)

_SINCE = {"hour": "1 hour", "day": "1 day", "week": "7 day", "month": "30 day", "year": "365 day"}
_AS_OF = "timestamp '2024-01-09 06:00:00'"
_PERIODS = {p: f"post_date between {_AS_OF} - interval {span} and {_AS_OF}" for p, span in _SINCE.items()}
TOP_PERIODS = with_(
    TO_BRONZE,
    " union all ".join(
        f"""
        select '{period}' as period, subreddit, top_rank, post_id, score from (
          select *, cast(row_number() over (
            partition by subreddit order by score desc, post_id) as int) as top_rank
          from bronze where {condition})
        where top_rank <= 3"""
        for period, condition in (_PERIODS | {"all": "true"}).items()
    ),
)

ALL_VIEWS = with_(
    [
        *TO_GOLD,
        KEYWORDS,
        BOOLEANS,
        "flags as (select post_id, unnest(safety_flags) as f from gold)",
    ],
    " union all ".join(
        f"select '{view}' as view, count(*) as n_rows, count(distinct post_id) as n_posts from {table}"
        for view, table in {
            "bronze": "bronze",
            "silver": "silver",
            "gold": "gold",
            "post_review": "gold",
            "keywords_exploded": "keywords",
            "safety_flags_exploded": "flags",
            "safety_booleans": "booleans",
        }.items()
    ),
)

ALL_RAW = with_([fx.RAW_SQL], f"select {RAW} from raw_posts")
ALL_ANNOTATIONS = with_([fx.ANNOTATION_SQL], f"select {listed(ANNOTATION_COLUMNS)} from annotations")
ALL_GOLD = with_(
    TO_GOLD,
    "select "
    + listed(SILVER_COLUMNS + [c for c in ANNOTATION_COLUMNS if c != "post_id"])
    + " from gold",
)
ALL_BRONZE = with_(TO_BRONZE, "select * from bronze")


def _clean(name: str) -> str:
    cleaned = f"""replace(replace(replace({name}, '"', ''''), chr(10), ' '), chr(13), ' ')"""
    return f"{cleaned} as {name}"


ORACLE: dict[str, str] = {
    "scan_raw_posts": ALL_RAW,
    "scan_annotations": ALL_ANNOTATIONS,
    "create_tables": with_(
        [fx.RAW_SQL, fx.ANNOTATION_SQL],
        """
        select 'raw_posts' as stored, count(*) as n_rows, count(distinct post_id) as n_posts
        from raw_posts
        union all
        select 'annotations', count(*), count(distinct post_id) from annotations
        """,
    ),
    "append_posts": ALL_RAW,
    "append_posts_by_day": with_(
        [fx.RAW_SQL],
        """
        select cast(post_date as date) as post_day, count(*) as n_posts,
          cast(sum(length(content)) as bigint) as n_chars
        from raw_posts group by 1
        """,
    ),
    "append_annotations": with_(
        [fx.ANNOTATION_SQL],
        "select "
        + listed([c for c in ANNOTATION_COLUMNS if c not in ("post_summary", "care_response")])
        + f", {_clean('post_summary')}, {_clean('care_response')} from annotations",
    ),
    "roundtrip_csv": ALL_RAW,
    "roundtrip_json": ALL_RAW,
    "annotations_csv": ALL_ANNOTATIONS,
    "model_views": with_(
        TO_GOLD,
        """
        select subreddit, count(*) as n_posts, cast(sum(n_words) as bigint) as n_words,
          count(annotated_at) as n_annotated
        from gold group by subreddit
        """,
    ),
    "model_views_all": ALL_VIEWS,
    "catalog_views_all": ALL_VIEWS,
    "loaded_subreddits": with_(
        [fx.RAW_SQL],
        """
        select subreddit, exists (select 1 from raw_posts r where r.subreddit = w.subreddit)
          as is_loaded
        from (select distinct source as subreddit from documents
              union all select distinct upper(source) from documents) w
        """,
    ),
    "loaded_subreddit_days": with_(
        [
            fx.RAW_SQL,
            f"""
            wanted as (
              select source as subreddit, cast({fx.sql_ts(f"{fx.EPOCH} + doc_id * 3600")} as date)
                as day from documents
              union
              select source, cast({fx.sql_ts(f"{fx.EPOCH} + doc_id * 3600")} as date) + 1
              from documents)""",
        ],
        """
        select w.subreddit, w.day, count(r.post_id) as n_posts, count(r.post_id) > 0 as is_loaded
        from wanted w left join raw_posts r
          on upper(r.subreddit) = upper(w.subreddit) and cast(r.post_date as date) = w.day
        group by 1, 2
        """,
    ),
    "shape_archive": SHAPE_ARCHIVE,
    "shape_rejects": with_(
        [ARCHIVE],
        """
        select doc_id, case when is_broken then 'not a JSON object'
          when id is null then 'no id' else 'no created_utc' end as reason
        from archive where is_broken or id is null or created_utc is null
        """,
    ),
    "shape_top": SHAPE_TOP,
    "posts_for_day": with_(
        [fx.RAW_SQL],
        f"""
        select {RAW} from raw_posts
        where post_date >= timestamp '2024-01-15' and post_date < timestamp '2024-01-16'
          and lower(subreddit) = 'src1'
        order by post_date, post_id limit 100
        """,
    ),
    "flair_filter": with_(
        [fx.RAW_SQL], f"select {RAW} from raw_posts where contains(lower(post_flair), 'en quest')"
    ),
    "subreddit_batch": with_(
        [fx.RAW_SQL],
        f"select {RAW} from raw_posts where lower(subreddit) in "
        f"({', '.join(fx.quoted(c.lower()) for c in COMMUNITIES)})",
    ),
    "top_posts_period": with_(
        TO_BRONZE,
        """
        select * from (
          select subreddit, cast(row_number() over (
              partition by subreddit order by score desc, post_id) as int) as top_rank,
            post_id, score, post_title
          from bronze
          where post_date >= (select max(post_date) from raw_posts) - interval 30 day)
        where top_rank <= 1000
        """,
    ),
    "top_posts_periods": TOP_PERIODS,
    "posts_for_day_limited": with_(
        [fx.RAW_SQL],
        """
        select post_id, score,
          cast(row_number() over (order by post_date, post_id, score) as int) as place
        from (
          select * from raw_posts
          where post_date >= timestamp '2024-01-15' and post_date < timestamp '2024-01-16'
          order by post_date, post_id limit 10)
        """,
    ),
    "bronze_dedup": with_([fx.RAW_SQL, LATEST], f"select {RAW} from latest"),
    "first_seen": with_(
        [fx.RAW_SQL],
        f"""
        select {RAW} from (
          select *, row_number() over (partition by post_id
            order by scraped_at asc nulls last, score) as rn from raw_posts)
        where rn = 1
        """,
    ),
    "content_duplicates": with_(
        TO_BRONZE,
        """
        select content_hash, count(*) as n_posts, min(post_id) as first_post_id,
          max(post_id) as last_post_id, min(post_date) as first_post_date,
          max(post_date) as last_post_date
        from bronze group by content_hash having count(*) > 1
        """,
    ),
    "one_per_content": with_(
        TO_BRONZE,
        """
        select * exclude (rn) from (
          select *, row_number() over (partition by content_hash order by post_date, post_id) as rn
          from bronze)
        where rn = 1
        """,
    ),
    "bronze": ALL_BRONZE,
    "redact": silver_of("post_id, text_raw, text_for_llm"),
    "text_metrics": silver_of(
        "post_id, n_chars, n_words, n_sentences, n_questions, n_exclaims, token_estimate"
    ),
    "redaction_counts": silver_of(
        "post_id, n_urls_redacted, n_emails_redacted, n_phones_redacted,"
        " n_usernames_redacted, n_subreddits_redacted"
    ),
    "routing": silver_of("post_id, n_words, token_estimate, needs_annotation"),
    "routing_guarded": silver_of(
        f"post_id, coalesce(n_words between 5 and 1000 and token_estimate < 8000 and n_chars >= 10"
        f" and {ASCII_SHARE} < 0.1, false) as needs_annotation"
    ),
    "silver": silver_of(", ".join(SILVER_COLUMNS)),
    "lang_hint": silver_of(
        f"post_id, case when {ASCII_SHARE} < 0.1 then 'en'"
        f" when {ASCII_SHARE} >= 0.1 then 'other' end as lang_hint"
    ),
    "heuristic_flags": HEURISTICS,
    "lexicon_tags": LEXICON_TAGS,
    "gold": ALL_GOLD,
    "gold_hot": with_(
        [*TO_SILVER, fx.ANNOTATION_SQL, fx.CROWDED_SQL],
        "select p.post_id, n_words, primary_topic, urgency_0_3, output_tokens"
        " from silver p left join crowded a on p.post_id = a.post_id",
    ),
    "post_review": ALL_GOLD,
    "keywords_exploded": with_([*TO_GOLD, KEYWORDS], "select post_id, keyword from keywords"),
    "safety_flags_exploded": with_(
        TO_GOLD,
        "select post_id, lower(f) as safety_flag from"
        " (select post_id, unnest(safety_flags) as f from gold)",
    ),
    "safety_booleans": with_([*TO_GOLD, BOOLEANS], "select * from booleans"),
    "safety_kpis": with_(
        [*TO_GOLD, BOOLEANS],
        """
        select count(*) filter (is_urgent_bleeding) as urgent_bleeding_posts,
          count(*) filter (is_urgent_pain) as urgent_pain_posts,
          count(*) filter (is_urgent_fetal_concern) as urgent_fetal_concern_posts,
          count(*) filter (is_mh_crisis) as mh_crisis_posts
        from booleans
        """,
    ),
    "top_keywords": with_(
        [*TO_GOLD, KEYWORDS],
        "select keyword, count(*) as cnt from keywords group by 1 order by 2 desc, 1 limit 25",
    ),
    "latest_annotated": with_(
        TO_GOLD,
        """
        select post_id, post_title, post_summary, care_response, annotated_at from gold
        order by annotated_at desc nulls first, post_id limit 50
        """,
    ),
    "ingest_summary": with_(
        [fx.RAW_SQL],
        """
        select subreddit, count(*) as n_posts, min(post_date) as first_post_date,
          max(post_date) as last_post_date
        from raw_posts group by subreddit
        """,
    ),
    "pending_posts": with_([*TO_SILVER, fx.ANNOTATION_SQL, PENDING], "select * from pending"),
    "pending_batch": with_(
        [*TO_SILVER, fx.ANNOTATION_SQL, PENDING], "select * from pending order by post_id limit 10"
    ),
    "pending_of_silver": with_(
        [*TO_SILVER, fx.ANNOTATION_SQL, PENDING],
        "select *, 'all' as choice from pending union all"
        " select *, 'ten' from (select * from pending order by post_id limit 10)",
    ),
    "pending_by_place": with_(
        [*TO_SILVER, fx.ANNOTATION_SQL, PENDING],
        "select *, 'all' as choice from pending union all"
        " select *, 'ten' from (select * from pending order by post_id limit 10)",
    ),
    "latest_by_place": with_([fx.RAW_SQL, LATEST], f"select {RAW} from latest"),
    "annotation_run": ANNOTATION_RUN,
    "prompt_render": with_(
        [*TO_SILVER, PROMPTS.replace("FROM_TABLE", "silver")],
        f"select post_id, prompt, {HASH} as prompt_hash from prompts",
    ),
    "annotate_batch": ANNOTATE_BATCH,
    "parse_annotations": with_([RESPONSES], f"select {listed(PARSED_COLUMNS)} from parsed"),
    "validate_annotations": with_(
        [RESPONSES, _violations()],
        "select post_id, array_to_string(broken, ',') as violations, len(broken) = 0 as is_valid"
        " from checked",
    ),
    "sanitize_text": with_(
        [RESPONSES],
        f"select post_id, {_clean('post_summary')}, {_clean('care_response')} from parsed",
    ),
    "annotation_summary": with_(
        [RESPONSES],
        "select count(*) as n_total, count(*) filter (status = 'ok') as n_ok,"
        " count(*) filter (status <> 'ok') as n_failed from parsed",
    ),
    "token_usage": with_(
        [fx.ANNOTATION_SQL],
        """
        select model_name, prompt_hash, count(*) as n_annotations,
          cast(sum(input_tokens) as bigint) as input_tokens,
          cast(sum(output_tokens) as bigint) as output_tokens,
          avg(input_tokens) as avg_input_tokens, avg(output_tokens) as avg_output_tokens
        from annotations group by 1, 2
        """,
    ),
    "repeated_annotations": with_(
        [fx.ANNOTATION_SQL, fx.CROWDED_SQL],
        "select post_id, count(*) as n_annotations from crowded group by 1 having count(*) > 1",
    ),
    "incremental_bronze": ALL_BRONZE,
    "incremental_current": with_([fx.RAW_SQL, LATEST], f"select {RAW} from latest"),
    "incremental_gold": ALL_GOLD,
    "incremental_merged": with_([fx.RAW_SQL, LATEST], f"select {RAW} from latest"),
}

# Queries that reach the same rows another way.
ORACLE["catalog_gold_hot"] = ORACLE["gold_hot"]
ORACLE["loaded_subreddits_indexed"] = ORACLE["loaded_subreddits"]
ORACLE["loaded_subreddit_days_indexed"] = ORACLE["loaded_subreddit_days"]
ORACLE["catalog_functions_all"] = with_(
    [fx.RAW_SQL],
    f"""
    select 'day' as asked, post_id, score, cast(null as int) as top_rank from raw_posts
      where lower(subreddit) = 'src1' and cast(post_date as date) = date '{DAY}'
    union all
    select 'flair', post_id, score, null from raw_posts where lower(post_flair) like '%en quest%'
    union all
    select 'of', post_id, score, null from raw_posts
      where lower(subreddit) in ({', '.join(fx.quoted(c.lower()) for c in COMMUNITIES)})
    union all
    select period, post_id, score, top_rank from ({TOP_PERIODS})
    """,
)
ORACLE["tables_present"] = with_(
    [fx.RAW_SQL],
    """
    select unnest(['table', 'table in upper case']) as asked, true as is_there
    union all select unnest(['no table', 'community of no table']), false
    union all select 'community', exists (select * from raw_posts where subreddit = 'SRC1')
    union all select 'community in lower case', exists (select * from raw_posts where subreddit = 'src1')
    union all select 'day', exists (select * from raw_posts
      where lower(subreddit) = 'src1' and cast(post_date as date) = date '2024-01-01')
    union all select 'day before all', exists (select * from raw_posts
      where lower(subreddit) = 'src1' and cast(post_date as date) = date '2023-12-31')
    """,
)
ORACLE["renamed_columns"] = with_(
    [fx.ANNOTATION_SQL],
    """
    select post_id as "POST_ID", primary_group as "PRIMARY_GROUP",
      cast(to_json(keywords) as varchar) as "KEYWORDS", annotated_at as "ANNOTATED_AT"
    from annotations
    """,
)

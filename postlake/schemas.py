"""Table schemas and the annotation contract."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# --- Fixed values: columns and types of the tables ----------------------------

RAW_POST = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("post_date", T.TimestampType()),
        T.StructField("post_timestamp", T.LongType()),
        T.StructField("post_flair", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)

RAW_POST_BY_DAY = T.StructType([*RAW_POST.fields, T.StructField("post_day", T.DateType())])

ANNOTATION = T.StructType(
    [
        T.StructField("post_id", T.StringType(), False),
        T.StructField("primary_group", T.StringType()),
        T.StructField("primary_topic", T.StringType()),
        T.StructField("secondary_topics", T.ArrayType(T.StringType())),
        T.StructField("trimester", T.StringType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("urgency_0_3", T.IntegerType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("safety_flags", T.ArrayType(T.StringType())),
        T.StructField("post_summary", T.StringType()),
        T.StructField("care_response", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("prompt_hash", T.StringType()),
        T.StructField("input_tokens", T.IntegerType()),
        T.StructField("output_tokens", T.IntegerType()),
        T.StructField("annotated_at", T.TimestampType()),
    ]
)

# One record of the archive API, landed as a JSON string. ``created_utc`` may
# arrive as an integer or a float, so it is read as a double.
ARCHIVE_RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("permalink", T.StringType()),
        T.StructField("link_flair_text", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("subreddit", T.StringType()),
    ]
)

# The object the annotator returns as JSON text; metadata is attached by us.
RESPONSE = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("primary_group", T.StringType()),
        T.StructField("primary_topic", T.StringType()),
        T.StructField("secondary_topics", T.ArrayType(T.StringType())),
        T.StructField("trimester", T.StringType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("urgency_0_3", T.IntegerType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("safety_flags", T.ArrayType(T.StringType())),
        T.StructField("post_summary", T.StringType()),
        T.StructField("care_response", T.StringType()),
    ]
)

# Column types of the two stored tables. Lengths are enforced on insert.
RAW_POST_DDL = """
    post_id VARCHAR(255), post_date TIMESTAMP, post_timestamp BIGINT,
    post_flair VARCHAR(500), title VARCHAR(2000), url VARCHAR(2000),
    content VARCHAR(16777216), score BIGINT, num_comments BIGINT,
    subreddit VARCHAR(255), scraped_at TIMESTAMP
"""

ANNOTATION_DDL = """
    post_id VARCHAR(255), primary_group VARCHAR(50), primary_topic VARCHAR(100),
    secondary_topics ARRAY<STRING>, trimester VARCHAR(20), sentiment VARCHAR(20),
    urgency_0_3 INT, keywords ARRAY<STRING>, safety_flags ARRAY<STRING>,
    post_summary VARCHAR(1000), care_response VARCHAR(2000),
    model_name VARCHAR(100), model_version VARCHAR(50), prompt_hash VARCHAR(50),
    input_tokens INT, output_tokens INT, annotated_at TIMESTAMP
"""


def _widths(ddl: str) -> dict[str, int]:
    return {name: int(width) for name, width in re.findall(r"(\w+) VARCHAR\((\d+)\)", ddl)}


RAW_WIDTHS = _widths(RAW_POST_DDL)
ANNOTATION_WIDTHS = _widths(ANNOTATION_DDL)

RAW_COLUMNS = RAW_POST.fieldNames()
ANNOTATION_COLUMNS = ANNOTATION.fieldNames()

SILVER_COLUMNS = [
    "post_id",
    "post_date",
    "post_timestamp",
    "post_flair",
    "post_title",
    "post_url",
    "subreddit",
    "score",
    "num_comments",
    "scraped_at",
    "content_hash",
    "text_raw",
    "text_for_llm",
    "n_chars",
    "n_words",
    "n_sentences",
    "n_questions",
    "n_exclaims",
    "n_urls_redacted",
    "n_emails_redacted",
    "n_phones_redacted",
    "n_usernames_redacted",
    "n_subreddits_redacted",
    "token_estimate",
    "needs_annotation",
]

GOLD_COLUMNS = SILVER_COLUMNS + [c for c in ANNOTATION_COLUMNS if c != "post_id"]

# --- Fixed values of the annotation contract ---------------------------------

TOPICS = {
    "clinical": [
        "symptoms_body_changes",
        "medications_supplements",
        "test_results_labs",
        "pregnancy_complications",
        "labor_delivery",
    ],
    "mental_health": [
        "anxiety_fear_uncertainty",
        "mood_depression",
        "body_image_identity",
        "relationship_stress",
        "peer_support_requests",
    ],
    "lifestyle_parenting": [
        "nutrition_diet",
        "exercise_movement",
        "sleep_fatigue",
        "work_leave_career",
        "postpartum_care",
    ],
    "access_navigation": [
        "choosing_provider",
        "hospital_clinic_experiences",
        "insurance_costs",
        "telehealth_virtual_care",
        "system_barriers_equity",
    ],
    "community_info": [
        "ask_experiences_advice",
        "share_stories_outcomes",
        "product_device_discussions",
        "information_validation_misinformation",
    ],
    "meta_context": [
        "question_seeking_info",
        "experience_sharing_narrative",
        "opinion_rant_vent",
        "announcement_milestone",
        "policy_advocacy_news",
    ],
}

TRIMESTERS = [
    "preconception",
    "first",
    "second",
    "third",
    "pregnant",
    "postpartum",
    "miscarriage",
    "unclear",
]

SENTIMENTS = ["negative", "neutral", "positive"]

SAFETY_FLAGS = [
    "urgent_bleeding",
    "urgent_pain",
    "urgent_fever_infection",
    "urgent_dizziness_fainting",
    "urgent_breathing_chest",
    "urgent_fetal_concern",
    "urgent_postpartum",
    "mental_health_crisis",
    "miscarriage_or_loss",
    "medication_safety",
    "infection_or_sepsis",
    "other_concern",
]

# Boolean indicator -> the flag it stands for.
SAFETY_INDICATORS = {
    "is_urgent_bleeding": "urgent_bleeding",
    "is_urgent_pain": "urgent_pain",
    "is_urgent_fetal_concern": "urgent_fetal_concern",
    "is_mh_crisis": "mental_health_crisis",
}

# Communities of the daily batch.
DAILY_COMMUNITIES = [
    "pregnant",
    "BabyBumps",
    "TryingForABaby",
    "beyondthebump",
    "newborns",
    "Miscarriage",
    "NewParents",
]

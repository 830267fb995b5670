"""The models as views of the catalog, found by other sessions and by BI tools.

A catalog keeps a view as SQL text, so the models are stated here once more, from
the same patterns, column lists and order. Tests hold each view against its model.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from postlake.functions import text
from postlake.operators import joins
from postlake.schemas import ANNOTATION_COLUMNS, SAFETY_INDICATORS, SILVER_COLUMNS

_NEWEST = ["post_timestamp", "post_date", "score", "num_comments"]
_TIES = ["subreddit", "post_flair", "url", "title", "content"]
LATEST_ORDER = ", ".join(
    [
        "scraped_at DESC NULLS FIRST",
        *(f"{c} DESC NULLS LAST" for c in _NEWEST),
        *(f"{c} ASC NULLS LAST" for c in _TIES),
    ]
)

# The redactions in order; each is tried only where its literal test holds.
_RULES = [
    (text.URL, "[URL]", "contains({t}, '://') OR contains(lower({t}), 'www.')"),
    (text.EMAIL, "[EMAIL]", "contains({t}, '@')"),
    (text.PHONE, "[PHONE]", "true"),
    (text.USER, "u/[USER]", "contains({t}, '/') AND (contains({t}, 'u/') OR contains({t}, 'U/'))"),
    (text.COMMUNITY, "r/[SUB]", "contains({t}, '/') AND (contains({t}, 'r/') OR contains({t}, 'R/'))"),
]

_TOKENS = {
    "n_urls_redacted": "[URL]",
    "n_emails_redacted": "[EMAIL]",
    "n_phones_redacted": "[PHONE]",
    "n_usernames_redacted": "u/[USER]",
    "n_subreddits_redacted": "r/[SUB]",
}


def _count(column: str, token: str) -> str:
    gone = f"octet_length({column}) - octet_length(replace({column}, '{token}', ''))"
    return f"CAST(({gone}) / {len(token)} AS INT)"


def _redacted() -> str:
    """A chain of one-row generators, so that every step is computed once."""
    steps = ["LATERAL VIEW explode(array(text_raw)) AS t0"]
    for i, (pattern, token, test) in enumerate(_RULES):
        now = f"t{i}"
        change = f"regexp_replace({now}, r'{pattern}', '{token}')"
        value = f"CASE WHEN {test.format(t=now)} THEN {change} ELSE {now} END"
        steps.append(f"LATERAL VIEW explode(array({value})) AS t{i + 1}")
    return "\n".join(steps)


def bronze_sql(raw: str) -> str:
    return f"""
    SELECT post_id, post_date, post_timestamp, post_flair, trim(title) AS post_title, url,
      regexp_replace(trim(coalesce(content, '')), r'{text.WHITESPACE}', ' ') AS post_content_raw,
      score, num_comments, lower(subreddit) AS subreddit, scraped_at,
      md5(concat(coalesce(title, ''), '|', coalesce(content, ''))) AS content_hash
    FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY {LATEST_ORDER}) AS _rank
          FROM {raw})
    WHERE _rank = 1"""


def silver_sql(bronze: str) -> str:
    counts = ", ".join(f"{_count('text_for_llm', token)} AS {c}" for c, token in _TOKENS.items())
    return f"""
    SELECT {", ".join(SILVER_COLUMNS[:-1])},
      coalesce(n_words BETWEEN 5 AND 1000 AND token_estimate < 4000, false) AS needs_annotation
    FROM (
      SELECT *, length(text_for_llm) AS n_chars,
        {_count('text_for_llm', ' ')} + 1 AS n_words,
        greatest(regexp_count(text_for_llm, r'{text.SENTENCE_END}'), 1) AS n_sentences,
        {_count('text_for_llm', '?')} AS n_questions, {_count('text_for_llm', '!')} AS n_exclaims,
        {counts}, ceil(length(text_for_llm) / 4.0D) AS token_estimate
      FROM (
        SELECT *, t{len(_RULES)} AS text_for_llm
        FROM (SELECT *, url AS post_url, post_content_raw AS text_raw FROM {bronze}
              WHERE post_content_raw IS NOT NULL)
        {_redacted()}))"""


def gold_sql(silver: str, notes: str, part_rows: int = joins.PART_ROWS) -> str:
    """The join of ``joins.with_annotations``: posts with more annotations than
    ``part_rows`` meet them in parts."""
    added = ", ".join(f"n.{c}" for c in ANNOTATION_COLUMNS if c != "post_id")
    return f"""
    WITH hot AS (
      SELECT post_id, CAST(ceil(count(*) / {part_rows}) AS INT) AS _parts FROM {notes}
      WHERE post_id IS NOT NULL GROUP BY post_id HAVING count(*) > {part_rows}),
    dealt AS (
      SELECT n.*, CAST(CASE WHEN h._parts IS NULL THEN 0 ELSE pmod(n._number, h._parts) END AS INT) AS _part,
        true AS _met
      FROM (SELECT *, monotonically_increasing_id() AS _number FROM {notes}) n
      LEFT JOIN hot h ON n.post_id = h.post_id),
    spread AS (
      SELECT s.*, h._parts FROM {silver} s LEFT JOIN hot h ON s.post_id = h.post_id)
    SELECT {", ".join(f"p.{c}" for c in SILVER_COLUMNS)}, {added}
    FROM (SELECT * FROM spread LATERAL VIEW explode(sequence(0, coalesce(_parts, 1) - 1)) AS _part) p
    LEFT JOIN dealt n ON p.post_id = n.post_id AND p._part = n._part
    WHERE p._parts IS NULL OR n._met"""


def _review(raw: str, notes: str, column: str) -> str:
    """Ids and one array; bronze holds each id once, so the distinct ids stand for it."""
    return f"""(SELECT p.post_id, n.{column} FROM (SELECT DISTINCT post_id FROM {raw}) p
      LEFT JOIN {notes} n ON p.post_id = n.post_id)"""


def view_texts(
    raw: str, notes: str, schema: str, part_rows: int = joins.PART_ROWS
) -> dict[str, str]:
    """The SQL of each view by its name, in the order in which they build on each other."""
    flags = ", ".join(
        f"array_contains(safety_flags, '{flag}') AS {name}" for name, flag in SAFETY_INDICATORS.items()
    )

    def flat(column: str, name: str) -> str:
        review = _review(raw, notes, column)
        return f"SELECT post_id, lower(v) AS {name} FROM {review} LATERAL VIEW explode({column}) AS v"

    return {
        "bronze": bronze_sql(raw),
        "silver": silver_sql(f"{schema}.bronze"),
        "gold": gold_sql(f"{schema}.silver", notes, part_rows),
        "post_review": f"SELECT * FROM {schema}.gold",
        "keywords_exploded": flat("keywords", "keyword"),
        "safety_flags_exploded": flat("safety_flags", "safety_flag"),
        "safety_booleans": f"SELECT post_id, {flags} FROM {_review(raw, notes, 'safety_flags')}",
    }


def create_views(
    spark: SparkSession, raw: str, notes: str, schema: str, part_rows: int = joins.PART_ROWS
) -> list[str]:
    """Create or replace the views in a schema, over two stored tables by full name."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    texts = view_texts(raw, notes, schema, part_rows)
    for name, sql in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS {sql}")
    return [f"{schema}.{name}" for name in texts]

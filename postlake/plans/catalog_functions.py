"""Views with arguments: table functions of the catalog over a stored raw table.

A view can't be asked for a day or a community that its caller names. These functions
can, from any SQL session: ``SELECT * FROM top_posts('week', now(), 10)``. Spark puts a
call's arguments into the body before it plans, so constant ones become filters of the
scan. A function is found in the current schema (``USE schema``), as Spark takes no
schema's name before a table function.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from postlake.operators.select import PERIODS, RANK_SALTS
from postlake.plans.catalog_views import LATEST_ORDER
from postlake.schemas import RAW_COLUMNS, RAW_POST

_RAW_TABLE = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_POST)
_RAW = ", ".join(RAW_COLUMNS)
_BEST = "ORDER BY score DESC NULLS LAST, post_id"
_NARROW_ORDER = LATEST_ORDER.removesuffix(", content ASC NULLS LAST")


def _since() -> str:
    spans = {p: int(span.total_seconds()) for p, span in PERIODS.items() if span is not None}
    cases = " ".join(f"WHEN '{p}' THEN as_of - INTERVAL '{n}' SECOND" for p, n in spans.items())
    return f"CASE period {cases} END"


def function_texts(raw: str) -> dict[str, tuple[str, str, str]]:
    """For each function its arguments, its columns and its query over the raw table.

    ``top_posts`` of an unknown period has no rows.
    """
    top = f"""
      SELECT subreddit, top_rank, post_id, score, post_title FROM (
        SELECT *, row_number() OVER (PARTITION BY subreddit {_BEST}) AS top_rank FROM (
          SELECT *, row_number() OVER (PARTITION BY subreddit, _salt {_BEST}) AS _salted FROM (
            SELECT post_id, score, trim(title) AS post_title, lower(subreddit) AS subreddit,
              pmod(xxhash64(post_id), {RANK_SALTS}) AS _salt
            FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY {_NARROW_ORDER}) AS _rank
                  FROM {raw} WHERE period = 'all' OR post_date BETWEEN {_since()} AND as_of)
            WHERE _rank = 1))
        WHERE _salted <= k)
      WHERE top_rank <= k"""
    return {
        "posts_for_day": (
            "community STRING, day DATE",
            _RAW_TABLE,
            f"""
      SELECT {_RAW} FROM {raw}
      WHERE post_date >= timestamp(day) AND post_date < timestamp(date_add(day, 1))
        AND lower(subreddit) = lower(community)""",
        ),
        "posts_with_flair": (
            "wanted STRING",
            _RAW_TABLE,
            f"""
      SELECT {_RAW} FROM {raw}
      WHERE wanted = '' OR (post_flair <> '' AND contains(lower(post_flair), lower(wanted)))""",
        ),
        "posts_of": (
            "communities ARRAY<STRING>",
            _RAW_TABLE,
            f"""
      SELECT {_RAW} FROM {raw}
      WHERE array_contains(transform(communities, c -> lower(c)), lower(subreddit))""",
        ),
        "top_posts": (
            "period STRING, as_of TIMESTAMP, k INT",
            "subreddit STRING, top_rank INT, post_id STRING, score BIGINT, post_title STRING",
            top,
        ),
    }


def create_functions(spark: SparkSession, raw: str, schema: str) -> list[str]:
    """Create or replace the functions in a schema, over a raw table by its full name."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    texts = function_texts(raw)
    for name, (arguments, columns, query) in texts.items():
        spark.sql(
            f"CREATE OR REPLACE FUNCTION {schema}.{name}({arguments}) RETURNS TABLE ({columns}) RETURN {query}"
        )
    return [f"{schema}.{name}" for name in texts]

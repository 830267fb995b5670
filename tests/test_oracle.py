"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks import oracle
from checks.compare import difference
from checks.queries import all_queries
from tests.conftest import SMALL, TINY


def test_every_query_has_sql():
    assert set(oracle.ORACLE) == set(all_queries())
    assert set(oracle.ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, duck_tiny, name):
    assert difference(spark, duck_tiny, TINY, name) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == entry.queries()["silver"](spark, TINY).columns
    assert df.count() > 0


def test_known_figures(spark):
    """Totals worked out independently for the small test tables."""
    queries = entry.queries()
    silver = queries["silver"](spark, SMALL)
    totals = silver.selectExpr(
        "count(*)",
        "sum(n_urls_redacted)",
        "sum(n_emails_redacted)",
        "sum(n_phones_redacted)",
        "sum(n_usernames_redacted)",
        "sum(n_subreddits_redacted)",
        "count_if(needs_annotation)",
    ).first()
    assert tuple(totals) == (1000, 360, 192, 230, 180, 180, 910)
    assert queries["scan_raw_posts"](spark, SMALL).count() == 1200
    assert queries["scan_annotations"](spark, SMALL).count() == 399
    assert queries["pending_posts"](spark, SMALL).count() == 542
    prompts = queries["prompt_render"](spark, SMALL)
    assert prompts.filter("not contains(prompt, post_id) or contains(prompt, 'POST_')").isEmpty()
    kpis = queries["safety_kpis"](spark, SMALL).first()
    assert (kpis["urgent_bleeding_posts"], kpis["urgent_pain_posts"]) == (51, 26)

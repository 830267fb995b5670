"""Table functions of the catalog: arguments reach the scan, odd ones are harmless."""

from __future__ import annotations

import pytest

from checks import fixtures as fx
from postlake.plans import catalog_functions
from postlake.sources import tables
from tests.conftest import TINY


@pytest.fixture(scope="module")
def functions(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("functions") / "raw")
    tables.create_raw_table(spark, "function_posts", path)
    tables.append_posts(fx.raw_posts(spark, TINY), "function_posts")
    catalog_functions.create_functions(spark, "default.function_posts", "post_functions")
    spark.catalog.setCurrentDatabase("post_functions")
    yield spark
    spark.catalog.setCurrentDatabase("default")
    spark.sql("DROP SCHEMA post_functions CASCADE")
    spark.sql("DROP TABLE function_posts")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_arguments_reach_the_scan(functions):
    text = plan(functions.sql("select post_id from posts_for_day('src1', date'2024-01-03')"))
    assert "GreaterThanOrEqual(post_date,2024-01-03" in text and "content" not in text
    text = plan(functions.sql("select * from top_posts('day', timestamp'2024-01-03 05:00:00', 2)"))
    assert "GreaterThanOrEqual(post_date,2024-01-02 05:00:00" in text and "content" not in text
    assert text.count("WindowGroupLimit") == 6


@pytest.mark.parametrize(
    "call, rows",
    [
        ("top_posts('fortnight', timestamp'2024-01-09', 3)", 0),
        ("top_posts('all', null, 0)", 0),
        ("posts_with_flair(null)", 0),
        ("posts_of(array())", 0),
        ("posts_for_day(null, null)", 0),
    ],
)
def test_odd_arguments(functions, call, rows):
    assert functions.sql(f"select * from {call}").count() == rows


def test_without_flair_all_posts(functions):
    every = functions.table("default.function_posts").count()
    assert functions.sql("select * from posts_with_flair('')").count() == every

from __future__ import annotations

import pytest

from checks import fixtures as fx
from postlake.operators import joins
from postlake.plans import catalog_views, models
from postlake.sources import tables
from tests.conftest import TINY


@pytest.fixture(scope="module")
def views(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("catalog")
    tables.create_raw_table(spark, "catalog_raw", str(root / "raw"))
    tables.create_annotation_table(spark, "catalog_notes", str(root / "notes"))
    tables.append_posts(fx.raw_posts(spark, TINY), "catalog_raw")
    tables.append_annotations(fx.annotations(spark, TINY), "catalog_notes")
    names = ("spark_catalog.default.catalog_raw", "spark_catalog.default.catalog_notes")
    for _ in range(2):  # the second time replaces them
        made = catalog_views.create_views(spark, *names, "models_schema")
    return made


def test_every_model_has_a_view(spark, views):
    raw, notes = (tables.raw_table(spark, "catalog_raw"), tables.annotation_table(spark, "catalog_notes"))
    assert [v.split(".")[1] for v in views] == models.views(spark, raw, notes)


def test_views_equal_models_in_another_session(spark, views):
    raw, notes = (tables.raw_table(spark, "catalog_raw"), tables.annotation_table(spark, "catalog_notes"))
    models.views(spark, raw, notes)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    for view in views:
        wanted, got = spark.table(view.split(".")[1]), other.table(view)
        assert got.columns == wanted.columns and [t for _, t in got.dtypes] == [t for _, t in wanted.dtypes]
        a, b = sorted(map(repr, got.collect())), sorted(map(repr, wanted.collect()))
        assert a == b and a, view


def test_views_redact_once(spark, views):
    silver = spark.table("models_schema.silver")
    plans = [
        df._jdf.queryExecution().executedPlan().toString()
        for df in (silver, silver.filter("n_urls_redacted > 0 and needs_annotation"))
    ]
    assert plans[0].count("[EMAIL]") == plans[1].count("[EMAIL]")
    assert plans[0].count("regexp_replace") == plans[1].count("regexp_replace")


def test_hot_parts_are_a_matter_of_the_join_only(spark, views):
    notes = tables.annotation_table(spark, "catalog_notes")
    silver = spark.table("models_schema.silver")
    split = models.gold(silver, notes, part_rows=1)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, spark.table("models_schema.gold").collect()))
    assert joins.PART_ROWS > 1

"""Queries against their SQL, on the smallest tables."""

from __future__ import annotations

from collections import Counter

import pytest
from postlake.llm.queries import ORACLE, QUERIES

from tests.conftest import TINY


def value(x):
    return float(f"{x:.10g}") if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck_tiny, name):
    df = QUERIES[name](spark, TINY)
    order = sorted(df.columns)
    got = Counter(tuple(value(r[c]) for c in order) for r in df.collect())
    result = duck_tiny.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    places = [columns.index(c) for c in order]
    assert sorted(columns) == order
    assert got == Counter(tuple(value(r[i]) for i in places) for r in result.fetchall())

"""Costly columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column by a generator that makes one row of one row.

    A filter on the column, or on anything computed from it, is otherwise pushed
    below the projection, and each use in the filter computes the column again.
    It stops at a generator. Generators are part of generated code, so this costs
    next to nothing. The price is that the column is computed even where nobody
    reads it; plans that need no text start from frames without it.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(column)).alias(name))

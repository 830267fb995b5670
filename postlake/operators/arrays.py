"""Flattening and testing the array columns of annotated posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.schemas import SAFETY_INDICATORS


def flatten(posts: DataFrame, array: str, name: str, distinct: bool = False) -> DataFrame:
    """One row per element, in lower case; a null or empty array gives no row.

    Elements are not made distinct, so one that repeats counts each time.
    """
    values = F.array_distinct(array) if distinct else F.col(array)
    rows = posts.select("post_id", F.explode(values).alias(name))
    return rows.withColumn(name, F.lower(name))


def safety_indicators() -> dict[str, Column]:
    """Membership booleans in exact case; NULL when there are no flags at all."""
    return {
        name: F.array_contains("safety_flags", F.lit(flag))
        for name, flag in SAFETY_INDICATORS.items()
    }

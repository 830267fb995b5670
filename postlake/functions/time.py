"""Time arguments as instants."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_utc(moment: dt.datetime) -> dt.datetime:
    """The moment with a zone; one without is taken as UTC, not as host time."""
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)


def instant(moment: dt.datetime) -> Column:
    return F.lit(as_utc(moment)).cast("timestamp")


def start_of(day: dt.date) -> Column:
    return instant(dt.datetime.combine(day, dt.time()))

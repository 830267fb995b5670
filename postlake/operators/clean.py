"""Redaction of personal data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import text
from postlake.operators.once import add_once


@dataclass(frozen=True)
class Rule:
    """A pattern, its replacement, and a cheap test no matching text fails."""

    pattern: str
    token: str
    may_match: Callable[[Column], Column] | None = None


# Applied in this order, each to all occurrences in the result of the one before.
RULES = [
    Rule(text.URL, "[URL]", lambda t: text.holds(t, "://") | text.holds(F.lower(t), "www.")),
    Rule(text.EMAIL, "[EMAIL]", lambda t: text.holds(t, "@")),
    Rule(text.PHONE, "[PHONE]"),
    Rule(text.USER, "u/[USER]", lambda t: text.holds(t, "/") & text.holds(t, "u/", "U/")),
    Rule(text.COMMUNITY, "r/[SUB]", lambda t: text.holds(t, "/") & text.holds(t, "r/", "R/")),
]

COLLAPSE = Rule(text.WHITESPACE, " ")


def redact(df: DataFrame, source: str, target: str, collapsed: bool = False) -> DataFrame:
    """Add ``target``: the source text with personal data replaced by tokens.

    Most texts lack most kinds, and finding that by literal search is many
    times cheaper than by pattern. Each rule is a projection of its own, so the
    text it tests and changes is computed once.

    The last rule turns runs of whitespace into single spaces. ``collapsed``
    says that the source has none: as no token is empty or holds whitespace, the
    other rules cannot make one, and the pass is left out.

    The result is added so that no filter repeats the rules below it.
    """
    step = df.withColumn(target, F.col(source))
    for rule in RULES if collapsed else [*RULES, COLLAPSE]:
        now = F.col(target)
        changed = F.regexp_replace(now, F.lit(rule.pattern), F.lit(rule.token))
        if rule.may_match:
            changed = F.when(rule.may_match(now), changed).otherwise(now)
        step = step.withColumn(target, changed)
    return add_once(step, target, F.col(target))

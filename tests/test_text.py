from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from postlake.functions import lexicon, text
from postlake.operators import clean

# The patterns as plainly stated, without the start condition of the e-mail one.
PLAIN = [
    (r"(?i)https?://\S+|\bwww\.[^\s]+", "[URL]"),
    (r"(?i)[a-z0-9][a-z0-9._%+-]*@[a-z0-9][a-z0-9.-]*\.[a-z]{2,}", "[EMAIL]"),
    (r"\+?[0-9][0-9\-\s\(\)]{7,}[0-9]", "[PHONE]"),
    (r"(?i)\bu/[a-z0-9_\-]+", "u/[USER]"),
    (r"(?i)\br/[a-z0-9_]+", "r/[SUB]"),
    (r"\s+", " "),
]


def plain_redact(value: str) -> str:
    for pattern, token in PLAIN:
        value = re.sub(pattern, token, value, flags=re.ASCII)
    return value


def silver_text(spark, values: list[str]) -> list[tuple[str, int]]:
    """Normalised and redacted text with its word count, in order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, content string")
    df = df.withColumn("raw", text.normalise(F.col("content")))
    rows = clean.redact(df, "raw", "t").select("i", "t", text.word_count(F.col("t")).alias("n"))
    return [(r.t, r.n) for r in rows.orderBy("i").collect()]


CASES = [
    (
        "Call (555) 123-4567 on 2024-01-15 or 555.123.4567",
        "Call ([PHONE] on [PHONE] or 555.123.4567",
        6,
    ),
    (
        "U/S at 20wks, r/o preeclampsia, u/12345678901 wrote",
        "u/[USER] at 20wks, r/[SUB] preeclampsia, u/[PHONE] wrote",
        7,
    ),
    ("\n hello\n\nworld \t", " hello world ", 4),
    ("", "", 1),
    ("see https://a.b/c?x=1). mail Bob@x.io!", "see [URL] mail [EMAIL]!", 4),
    ("literal [URL] stays", "literal [URL] stays", 3),
    ("WWW.Example.org/p HTTPS://X", "[URL] [URL]", 2),
    # Outside ASCII: no word boundary between the letters, and a non-breaking
    # space is not whitespace.
    ("caf\u00e9www.x.com", "caf\u00e9www.x.com", 1),
    ("a\u00a0\u00a0b", "a\u00a0\u00a0b", 1),
]


def test_cases(spark):
    got = silver_text(spark, [case[0] for case in CASES])
    assert got == [(expected, words) for _, expected, words in CASES]


def test_redaction_equals_plain_patterns(spark):
    """Random texts, dense in what the rules look for."""
    rng = random.Random(7)
    parts = list("abur019@@@..--_%+/ \n\t()") + [
        "www.", "WWW.", "http://", "HttpS://", "u/", "U/", "r/", "R/", ".co", "@x.io", "a@b.com",
        "+1 (743) 555-0199", "  ", "\r\n", "\x0b", "\f",
    ]
    values = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(6000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    got = clean.redact(df, "s", "t").orderBy("i").collect()
    wrong = [(r.s, r.t, plain_redact(r.s)) for r in got if r.t != plain_redact(r.s)]
    assert not wrong, wrong[:3]


def test_collapsed_source_needs_no_last_pass(spark):
    rng = random.Random(11)
    parts = list("abur01@@..-/ ()") + ["www.", "http://", "u/", "r/", "a@b.com", "+1 (743) 555-0199"]
    values = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    df = df.withColumn("s", text.normalise(F.col("s")))
    both = clean.redact(clean.redact(df, "s", "short", collapsed=True), "s", "full")
    assert both.filter("short <> full").isEmpty()


def test_second_redaction_changes_nothing(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "s string")
    once = clean.redact(df, "s", "t")
    twice = clean.redact(once, "t", "again")
    assert twice.filter("t <> again").isEmpty()


def test_email_rule_is_linear_on_long_runs(spark):
    """A megabyte without a break; quadratic matching would take hours."""
    df = spark.range(1).select(F.repeat(F.lit("a"), 1_000_000).alias("s"))
    df = df.select(F.concat("s", F.lit(" x@y.org")).alias("s"))
    assert clean.redact(df, "s", "t").select(F.right("t", F.lit(8)).alias("e")).first().e == " [EMAIL]"


def test_missing_text(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert clean.redact(df, "s", "t").first().t is None
    assert df.select(text.count_of_rare(F.col("s"), "[URL]", "[").alias("n")).first().n is None
    assert df.select(text.normalise(F.col("s")).alias("n")).first().n == ""


@pytest.mark.parametrize(
    "value",
    ["", "a", "one two", " edge ", "Hi! What?? No... yes.", "[URL][URL] u/[USER] [PHONE]!", "é? ñ!"],
)
def test_metrics(spark, value):
    df = spark.createDataFrame([(value,)], "t string")
    got = df.select(*[c.alias(n) for n, c in text.text_metrics(F.col("t")).items()]).first()
    assert got.n_chars == len(value)
    assert got.n_words == len(value.split(" "))
    assert got.n_sentences == max(len(re.findall(r"[.!?]+", value)), 1)
    assert got.n_questions == value.count("?")
    assert got.n_exclaims == value.count("!")
    assert got.n_urls_redacted == value.count("[URL]")
    assert got.n_usernames_redacted == value.count("u/[USER]")
    assert got.token_estimate == -(-len(value) // 4)


@pytest.mark.parametrize(
    ("words", "length", "expected"),
    [
        (4, 20, False),
        (5, 20, True),
        (1000, 3000, True),
        (1001, 3000, False),
        (10, 4 * 3999, True),
        (10, 4 * 3999 + 1, False),
    ],
)
def test_routing_bounds(spark, words, length, expected):
    value = " ".join(["a"] * (words - 1))
    value += " " + "b" * (length - len(value) - 1)
    df = spark.createDataFrame([(value,)], "t string")
    t = F.col("t")
    flag = text.needs_annotation(t, text.word_count(t), text.token_estimate(t))
    assert df.select(flag.alias("f")).first().f is expected


def test_routing_is_never_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    t = F.col("t")
    flag = text.needs_annotation(t, text.word_count(t), text.token_estimate(t))
    assert df.select(flag.alias("f")).first().f is False


def test_prompt(spark):
    """Literal replacement, cut at 2000 characters also beyond the basic plane."""
    template = "id {{POST_ID}} text {{POST_TEXT}} {{x}}"
    body = "\U0001f600" * 1999 + "ab"
    df = spark.createDataFrame([("p$1", body), ("q", "{{POST_ID}}")], "id string, t string")
    rows = df.select(text.render_prompt(template, F.col("id"), F.col("t")).alias("p")).collect()
    assert rows[0].p == "id p$1 text " + "\U0001f600" * 1999 + "a" + " {{x}}"
    assert rows[1].p == "id q text {{POST_ID}} {{x}}"
    digest = df.select(text.prompt_hash(F.lit(template)).alias("h")).first().h
    assert digest == hashlib.sha256(template.encode()).hexdigest()[:16]


def test_sanitise(spark):
    df = spark.createDataFrame([('say "hi"\r\nthere',), (None,)], "s string")
    rows = df.select(text.sanitise(F.col("s")).alias("s")).collect()
    assert [r.s for r in rows] == ["say 'hi'  there", None]


def test_lang_hint(spark):
    values = ["plain text", "é" * 9 + "a" * 91, "é" * 10 + "a" * 90, ""]
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    rows = df.select("i", text.lang_hint(F.col("t")).alias("h")).orderBy("i").collect()
    assert [r.h for r in rows] == ["en", "en", "other", None]


def test_lexicon_finds_whole_words_only(spark):
    words = {"a": ["c-section", "pain"], "b": ["leave policy"]}
    values = ["C-Section!", "painful", "leave, policy", "leave of policy", "(pain) leave-policy"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    df = df.withColumn("l", lexicon.word_line(F.col("t")))
    df = df.withColumn("f", lexicon.anchors_found(F.col("l"), words))
    rows = df.select("i", lexicon.tags(F.col("l"), F.col("f"), words).alias("x")).orderBy("i").collect()
    assert [r.x for r in rows] == [["a"], [], ["b"], [], ["a", "b"]]


def test_lexicon_equals_search_of_every_term(spark):
    """The short list of first words must not lose a term."""
    terms = [t for d in (lexicon.KEYWORD_DOMAINS, lexicon.SAFETY_TRIGGERS) for ts in d.values() for t in ts]
    rng = random.Random(3)
    pool = sorted({w for t in terms for w in t.replace("-", " ").split()}) + terms + ["x", "y"]
    values = [" ".join(rng.choices(pool, k=rng.randint(0, 12))) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    df = df.withColumn("l", lexicon.word_line(F.col("t")))
    df = df.withColumn("f", lexicon.anchors_found(F.col("l"), lexicon.SAFETY_TRIGGERS))
    rows = df.select("l", lexicon.tags(F.col("l"), F.col("f"), lexicon.SAFETY_TRIGGERS).alias("x"))
    for row in rows.collect():
        expected = [
            name
            for name, listed in lexicon.SAFETY_TRIGGERS.items()
            if any(f" {t.replace('-', ' ')} " in row.l for t in listed)
        ]
        assert row.x == expected

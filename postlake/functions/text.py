"""Column expressions on post text. Everything here stays inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: patterns of personal data, and the tokens they become ------
#
# The e-mail pattern may begin only where no letter or digit precedes it, or
# right after the previous match. That finds the same addresses as a pattern
# without this condition (a run of letters that fails from its first position
# fails from all), but in linear time on long unbroken runs such as encoded
# blobs.
URL = r"(?i)https?://\S+|\bwww\.[^\s]+"
EMAIL = r"(?i)(?:\G|(?<![a-z0-9]))[a-z0-9][a-z0-9._%+-]*+@[a-z0-9][a-z0-9.-]*\.[a-z]{2,}"
PHONE = r"\+?[0-9][0-9\-\s\(\)]{7,}[0-9]"
USER = r"(?i)\bu/[a-z0-9_\-]+"
COMMUNITY = r"(?i)\br/[a-z0-9_]+"
WHITESPACE = r"\s+"
SENTENCE_END = r"[.!?]+"

PROMPT_ID = "{{POST_ID}}"
PROMPT_TEXT = "{{POST_TEXT}}"
PROMPT_TEXT_CHARS = 2000


def normalise(content: Column) -> Column:
    """Missing content as '', outer spaces (only spaces) off, runs collapsed."""
    return F.regexp_replace(F.trim(F.coalesce(content, F.lit(""))), WHITESPACE, " ")


def content_hash(title: Column, content: Column) -> Column:
    """Hash of title and content; a missing part counts as ''."""
    none = F.lit("")
    return F.md5(F.concat(F.coalesce(title, none), F.lit("|"), F.coalesce(content, none)))


def holds(text: Column, *literals: str) -> Column:
    """Whether the text has any of the literals in it."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in literals])


def count_of(text: Column, token: str) -> Column:
    """How often a literal ASCII token occurs.

    From the bytes that go when it is taken out: byte lengths are stored with a
    string, while its characters would have to be counted.
    """
    gap = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(token), F.lit("")))
    return gap if len(token) == 1 else (gap / len(token)).cast("int")


def count_of_rare(text: Column, token: str, sign: str) -> Column:
    """The same for a token that most texts lack, as they lack its sign.

    Looking for the sign is several times cheaper than taking the token out.
    """
    return F.when(holds(text, sign), count_of(text, token)).when(text.isNotNull(), F.lit(0))


def word_count(text: Column) -> Column:
    """Pieces between single spaces: '' is one word, edge spaces add empty ones."""
    return count_of(text, " ") + 1


def sentence_count(text: Column) -> Column:
    return F.greatest(F.regexp_count(text, F.lit(SENTENCE_END)), F.lit(1))


def token_estimate(text: Column) -> Column:
    """About four characters per token, rounded up."""
    return F.ceil(F.length(text) / 4.0)


def text_metrics(text: Column) -> dict[str, Column]:
    """The metric columns of the silver table, by name."""
    return {
        "n_chars": F.length(text),
        "n_words": word_count(text),
        "n_sentences": sentence_count(text),
        "n_questions": count_of_rare(text, "?", "?"),
        "n_exclaims": count_of_rare(text, "!", "!"),
        "n_urls_redacted": count_of_rare(text, "[URL]", "["),
        "n_emails_redacted": count_of_rare(text, "[EMAIL]", "["),
        "n_phones_redacted": count_of_rare(text, "[PHONE]", "["),
        "n_usernames_redacted": count_of_rare(text, "u/[USER]", "["),
        "n_subreddits_redacted": count_of_rare(text, "r/[SUB]", "["),
        "token_estimate": token_estimate(text),
    }


def is_english_like(text: Column, max_share: float = 0.1) -> Column:
    """Share of non-ASCII characters below a limit; NULL for empty text."""
    foreign = F.length(F.regexp_replace(text, r"[\x00-\x7F]+", ""))
    return foreign / F.nullif(F.length(text), F.lit(0)) < max_share


def lang_hint(text: Column) -> Column:
    """'en' or 'other'; NULL for empty text. Documented heuristic, opt-in."""
    english = is_english_like(text)
    return F.when(english, "en").when(~english, "other")


def needs_annotation(
    text: Column,
    n_words: Column,
    tokens: Column,
    *,
    min_words: int = 5,
    max_words: int = 1000,
    token_limit: int = 4000,
    min_chars: int = 0,
    english_only: bool = False,
) -> Column:
    """Routing flag, true or false but never NULL.

    The defaults are the coded rule. ``min_chars`` and ``english_only`` are
    guard rails that were only ever documented, so they are off.
    """
    rule = n_words.between(min_words, max_words) & (tokens < token_limit) & text.isNotNull()
    if min_chars:
        rule = rule & (F.length(text) >= min_chars)
    if english_only:
        rule = rule & is_english_like(text)
    return F.coalesce(rule, F.lit(False))


def sanitise(text: Column) -> Column:
    """Double quotes as single ones, line feeds and returns as spaces."""
    return F.translate(text, '"\n\r', "'  ")


def render_prompt(template: str, post_id: Column, text: Column) -> Column:
    """Fill the two placeholders; the text is cut to its first 2000 characters."""
    with_id = F.replace(F.lit(template), F.lit(PROMPT_ID), post_id)
    body = F.substring(text, 1, PROMPT_TEXT_CHARS)
    return F.replace(with_id, F.lit(PROMPT_TEXT), body)


def prompt_hash(template: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the unfilled template."""
    return F.substring(F.sha2(template, 256), 1, 16)

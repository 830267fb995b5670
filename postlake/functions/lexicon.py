"""Trigger words and the tags they stand for.

Tagging by word list is an offline stand-in for the annotator, not an equal of
it: it works on whole words and phrases and knows no context.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: keyword domains and their example terms --------------------

KEYWORD_DOMAINS = {
    "clinical": [
        "bleeding",
        "cramping",
        "pain",
        "spotting",
        "swelling",
        "contractions",
        "nausea",
        "headache",
        "preeclampsia",
        "ultrasound",
        "hcg",
        "glucose test",
        "infection",
    ],
    "medications_labs": [
        "iron",
        "tylenol",
        "prenatal vitamin",
        "magnesium",
        "zofran",
        "insulin",
        "antibiotic",
        "lab results",
    ],
    "mental_health": [
        "anxiety",
        "depression",
        "panic",
        "therapy",
        "postpartum depression",
        "lonely",
        "stressed",
    ],
    "access_insurance": [
        "medicaid",
        "insurance",
        "copay",
        "appointment",
        "ob-gyn",
        "midwife",
        "telehealth",
        "clinic",
    ],
    "parenting_postpartum": [
        "breastfeeding",
        "bottle feeding",
        "sleep",
        "c-section",
        "nicu",
        "pumping",
        "maternity leave",
    ],
    "policy_social": [
        "texas",
        "rural",
        "law",
        "policy",
        "coverage",
        "equity",
        "leave policy",
    ],
}

# --- Fixed values: safety flags and their triggers ----------------------------

SAFETY_TRIGGERS = {
    "urgent_bleeding": ["heavy bleeding", "soaking pads", "hemorrhage"],
    "urgent_pain": [
        "severe abdominal pain",
        "severe pelvic pain",
        "severe back pain",
        "contractions",
        "cramps",
    ],
    "urgent_fever_infection": ["fever", "chills", "discharge", "infection", "wound"],
    "urgent_dizziness_fainting": ["fainting", "dizziness", "low blood pressure", "weakness"],
    "urgent_breathing_chest": ["shortness of breath", "chest pain", "heart racing"],
    "urgent_fetal_concern": [
        "no fetal movement",
        "reduced fetal movement",
        "kick count",
    ],
    "urgent_postpartum": [
        "bleeding after delivery",
        "pain after delivery",
        "fever after delivery",
    ],
    "mental_health_crisis": ["suicidal", "panic", "hopelessness", "severe anxiety"],
    "miscarriage_or_loss": ["miscarriage", "pregnancy loss", "stillbirth"],
    "medication_safety": ["unsafe drug use", "dosing", "substance exposure"],
    "infection_or_sepsis": ["uterine infection", "endometritis", "wound infection"],
    "other_concern": ["swelling", "blurred vision", "hypertension"],
}

# --- Fixed values: stage of pregnancy, most specific stage first --------------

STAGE_TRIGGERS = {
    "miscarriage": ["miscarriage", "pregnancy loss"],
    "postpartum": ["postpartum", "after giving birth", "gave birth"],
    "first": ["first trimester", "1st trimester"],
    "second": ["second trimester", "2nd trimester"],
    "third": ["third trimester", "3rd trimester"],
    "preconception": ["trying to conceive", "ttc", "planning pregnancy"],
    "pregnant": ["pregnant", "pregnancy"],
}

# --- Fixed values: early, middle or late pregnancy (our own rule) -------------

PHASE_TRIGGERS = {
    "early": ["first trimester", "early pregnancy", "positive test"],
    "mid": ["second trimester", "anatomy scan", "halfway"],
    "late": ["third trimester", "due date", "full term"],
}


def word_line(text: Column) -> Column:
    """Lower-case words parted and surrounded by single spaces."""
    words = F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def _words(term: str) -> list[str]:
    return term.replace("-", " ").split(" ")


def anchors(*lexicons: dict[str, list[str]]) -> list[str]:
    """The first words of all terms: a text without any of them has no term."""
    terms = (term for lexicon in lexicons for listed in lexicon.values() for term in listed)
    return list(dict.fromkeys(_words(term)[0] for term in terms))


def anchors_found(line: Column, *lexicons: dict[str, list[str]]) -> Column:
    """The first words of terms that the line holds: one pass with a hash set.

    Each term is then tested on this short list, and only a phrase whose first
    word is there is searched in the whole line.
    """
    return F.array_intersect(F.split(line, " "), F.array(*[F.lit(a) for a in anchors(*lexicons)]))


def has_term(line: Column, found: Column, term: str) -> Column:
    """Whether the line holds a term as whole words."""
    first, *rest = _words(term)
    begins = F.array_contains(found, F.lit(first))
    return begins & F.contains(line, F.lit(f" {' '.join([first, *rest])} ")) if rest else begins


def mentions(line: Column, found: Column, terms: list[str]) -> Column:
    """Whether the line holds any of the terms."""
    return reduce(lambda a, b: a | b, [has_term(line, found, term) for term in terms])


def tags(line: Column, found: Column, lexicon: dict[str, list[str]]) -> Column:
    """Names of all lists with a term in the line, in list order."""
    return F.array_compact(
        F.array(*[F.when(mentions(line, found, ts), F.lit(name)) for name, ts in lexicon.items()])
    )


def terms_found(line: Column, found: Column, lexicon: dict[str, list[str]]) -> Column:
    """All terms of all lists that the line holds, each once."""
    terms = dict.fromkeys(term for listed in lexicon.values() for term in listed)
    return F.array_compact(
        F.array(*[F.when(has_term(line, found, term), F.lit(term)) for term in terms])
    )


def lists_of(terms: Column, lexicon: dict[str, list[str]]) -> Column:
    """Names of all lists that share a term with those found, in list order."""
    return F.array_compact(
        F.array(
            *[
                F.when(F.arrays_overlap(terms, F.array(*map(F.lit, listed))), F.lit(name))
                for name, listed in lexicon.items()
            ]
        )
    )


def first_tag(
    line: Column, found: Column, lexicon: dict[str, list[str]], otherwise: str | None
) -> Column:
    """Name of the first list with a term in the line."""
    return F.coalesce(
        *[F.when(mentions(line, found, ts), F.lit(name)) for name, ts in lexicon.items()],
        F.lit(otherwise),
    )

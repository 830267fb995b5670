"""The fixed values, counted and spelt here a second time."""

from __future__ import annotations

from postlake.functions import lexicon
from postlake.schemas import SAFETY_FLAGS, SENTIMENTS, TOPICS, TRIMESTERS


def test_word_lists():
    assert {name: len(words) for name, words in lexicon.KEYWORD_DOMAINS.items()} == {
        "clinical": 13,
        "medications_labs": 8,
        "mental_health": 7,
        "access_insurance": 8,
        "parenting_postpartum": 7,
        "policy_social": 7,
    }
    # The two words of three letters.
    short = {w for words in lexicon.KEYWORD_DOMAINS.values() for w in words if len(w) == 3}
    assert short == {"hcg", "law"}
    assert {w for w in lexicon.KEYWORD_DOMAINS["medications_labs"] if " " in w} == {"prenatal vitamin", "lab results"}
    assert lexicon.KEYWORD_DOMAINS["mental_health"][-1] == "stressed"


def test_flags_and_enumerations():
    assert list(lexicon.SAFETY_TRIGGERS) == SAFETY_FLAGS
    assert len(SAFETY_FLAGS) == 12 and len(TRIMESTERS) == 8 and len(SENTIMENTS) == 3
    assert [len(topics) for topics in TOPICS.values()] == [5, 5, 5, 5, 4, 5]
    assert set(lexicon.STAGE_TRIGGERS) <= set(TRIMESTERS)
    assert len(set(t for topics in TOPICS.values() for t in topics)) == 29

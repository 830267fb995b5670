from __future__ import annotations

import hashlib
import random
import re

import pytest
from postlake.llm import secrets as s

from tests.llm.cases import TEXTS, documents, empty


def brute(text):
    """Base spans by the patterns as stated, failing matches dropped afterwards."""
    text = text or ""
    name = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token"))
    assign = re.compile(
        rf"""({name}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_against_brute_force():
    rng = random.Random(1)
    pieces = ["password", "PassWd", "toKen", "Key", "api_key", "APIKEY", "ſecret", "secret", '"', "'", " ", "  ", ":", "=",
              "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "0123456789abcdef", "x", "é", "\U0001f600", "\n", "\t", "abc", "+/_.-"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 14)))
        assert s.base_spans(text) == brute(text), text


@pytest.mark.parametrize(
    "weak", ["password1", "P@ssw0rd", "qwertyuiop", "aaaaaaaaaaaaaaaa", "abcdefghij", "20240115", "1987-06-05", "abcabcabcabc", "zxcvbnm", "monkey1999"]
)
def test_guessable_values_are_cheap(weak):
    assert s.guess_cost(weak) < 7 < s.guess_cost("x7Kq9!vLp2Wz")


def test_cost_is_the_least_over_segmentations():
    """Against a plain search over all segmentations into words and brute force."""

    def search(value, at=0, brute_before=False):
        if at == len(value):
            return 0.0
        gap = s.BREAK if at else 0.0
        costs = [s._brute(value[at]) + (0 if brute_before else gap) + search(value, at + 1, True)]
        for end in range(at + 2, len(value) + 1):
            if (word := s._word(value[at:end])) < float("inf"):
                costs.append(gap + word + search(value, end))
        return min(costs)

    for value in ("loveXdragon", "zqLove9k", "testadmin", "Dr4gonq", "xqzjw"):
        assert s.guess_cost(value) == pytest.approx(search(value))


def test_limit_only_ends_early():
    rng = random.Random(2)
    for _ in range(200):
        value = "".join(rng.choices("aab1!Qx", k=rng.randint(6, 200))) + rng.choice(["", "password" * 20, "a" * 99])
        assert (s.guess_cost(value, 10.0) >= 10.0) == (s.guess_cost(value) >= 10.0)


def test_values_in_context():
    text = 'my password is hunter2; db_password: "p@ss#W0rd!9xQz", pwd: Zk3#9xLw!2q. secret = abcdef1 passphrase: password1 bearer=\'qT7!xM2$vB9\' see: x7Kq9!vLp2Wz'
    base = s.base_spans(text)
    got = [text[a:b] for a, _, b in s.value_spans(text, base)]
    assert got == ["p@ss#W0rd!9xQz", "Zk3#9xLw!2q", "qT7!xM2$vB9"]
    assert s.joined(base) == f"assign:{text.index('secret')}:{text.index('secret') + 16}"


def test_scheme_word_before_a_value():
    for text in ("Authorization: Bearer qT7xM2vLp9Zk3uW8", "authorization = Basic\t'qT7xM2vLp9Zk3uW8'"):
        assert ["qT7xM2vLp9Zk3uW8"] == [text[a:b] for a, _, b in s.value_spans(text, s.base_spans(text))]
    text = "Authorization: Bearer password1"
    assert s.value_spans(text, s.base_spans(text)) == []


def test_long_chains_take_linear_time():
    import time

    start = time.perf_counter()
    for text in ("a_" * 200_000 + "=", "--" * 200_000 + "=", "x" * 400_000 + ":", "pass-" * 100_000 + ": b"):
        s.value_spans(text, s.base_spans(text))
    assert time.perf_counter() - start < 20
    text = "--db.password := Zk3#9xLw!2q"
    assert [text[a:b] for a, _, b in s.value_spans(text, s.base_spans(text))] == ["Zk3#9xLw!2q"]


def test_hard_rows(spark):
    rows = {r.doc_id: r for r in s.scan(documents(spark, [*TEXTS, (20, "\U0001f600 token = 'abcdef12'", "en", "s")])).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert s.scan(documents(spark)).count() == len(TEXTS)
    assert all(rows[i].spans == "" and rows[i].base_sha256 == none for i in (1, 2, 3, 5, 7))
    assert rows[20].spans == "assign:2:19" and rows[20].n_assign == 1
    assert rows[20].base_sha256 == hashlib.sha256(b"assign:2:19").hexdigest()
    assert s.scan(empty(spark)).count() == 0
    assert s.guess_cost("") == 0

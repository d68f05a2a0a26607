import re

import cases
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstream.llm import secrets

LONG = "0123456789abcdef" * 3
TEXTS = [
    'password = "hunter2hunter"',
    "secret=token: abcdef",  # the first match fails and takes `token` with it
    "PassWD:abc api_key='x' APIKEY= zzzzzz",
    "tokenſecret paſſword=abcdefgh",  # long s is no s
    "AKIA" + "Z" * 16 + " AKIA" + "Z" * 15 + " xAKIAAKIA" + "7" * 20,
    f"{LONG}g{LONG[:23]} {LONG[:24]}A",
    "é😀" * 5 + f" token={LONG} 😀 secret : abcdefg",
    "ghp_" + "a1B2" * 10 + " gho_short xoxb-123456789012-abc",
    "see https://user:pass@example.com/x and ftp://example.com",
    "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0x.abc-_ sk_live_" + "9" * 20,
    "-----BEGIN RSA PRIVATE KEY-----\nabc",
    "AIza" + "x" * 35,
    "pas ass ssw swo wor ord",  # all trigrams, no match
    None,
    "",
]


def plain(text):
    found = []
    for kind, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or "", re.A):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), kind, m.end()))
    names = [r.name for r in secrets.RULES]
    return [(names[k], a, b, secrets.RULES[k].base) for a, k, b in sorted(found)]


def found_in(spark, rows, **options):
    got = secrets.find_secrets(cases.frame(spark, rows), **options)
    return [(r["_id"], [tuple(s) for s in r.spans]) for r in got.collect()]


def folds_more(text):
    """Python folds long s and the Kelvin sign to letters; the rules fold A-Z only."""
    return bool(re.search("[ſK]", text or ""))


def test_equals_rules_on_whole_texts(spark):
    rows = [(k, t, "en", "s") for k, t in enumerate(TEXTS)]
    rows += cases.corpus(seed=6) + [(900, "x" * 300_000 + " secret=abcdef" * 2000, "en", "s")]
    wanted = [(d, [] if folds_more(t) else plain(t)) for d, t, *_ in rows]
    assert {s[0] for _, spans in wanted for s in spans} == {r.name for r in secrets.RULES}
    assert cases.order(found_in(spark, rows)) == cases.order(wanted)


def test_rows_with_equal_id_and_text(spark):
    rows = [(1, TEXTS[0], "en", "s")] * 4 + [(None, TEXTS[5], "en", "s")] * 2 + [(1, "other", "en", "s")]
    wanted = [(d, plain(t)) for d, t, *_ in rows]
    assert cases.order(found_in(spark, rows)) == cases.order(wanted)


def test_empty_table_and_no_rules(spark):
    assert found_in(spark, []) == []
    assert found_in(spark, [(1, TEXTS[0], "en", "s")], rules=()) == [(1, [])]
    only = (secrets.Rule("digits", "[0-9]+"),)  # no trigram at all
    assert found_in(spark, [(1, "a1b22", "en", "s")], rules=only) == [
        (1, [("digits", 1, 2, False), ("digits", 3, 5, False)])
    ]


def test_queries_are_derived_from_the_patterns():
    query = secrets.trigram_query
    assert query("abcd") == [frozenset({"abc", "bcd"})]
    assert query("ABCD.*xyz") == [frozenset({"abc", "bcd", "xyz"})]
    assert query("ab(c|d)e") == [frozenset({"abc", "bce"}), frozenset({"abd", "bde"})]
    assert query("abx?cd") == [frozenset({"abc", "bcd"}), frozenset({"abx", "bxc", "xcd"})]
    assert query("(abc)+def") == [frozenset({"abc", "def"})]
    assert query("abcdef|abcd") == [frozenset({"abc", "bcd"})]
    for free in ("[0-9a-f]{24,}", "ab", "abc|x", "(abc)*", "a.b.c"):
        assert query(free) is None
    # Too many ways: what is left out asks for less.
    assert query("abc" + "[xyz]" * 9) is not None


@pytest.mark.parametrize("rule", [r for r in secrets.RULES if secrets.trigram_query(r.pattern)], ids=lambda r: r.name)
def test_every_match_holds_a_whole_set(rule):
    query = secrets.trigram_query(rule.pattern)

    @settings(max_examples=40, deadline=None)
    @given(st.from_regex(re.compile(rule.pattern, re.A), fullmatch=True))
    def check(text):
        lowered = cases.lower_ascii(text)
        assert folds_more(text) or any(all(t in lowered for t in wanted) for wanted in query)

    check()

import re
import tracemalloc

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstream.llm import pii


def plain(text):
    """The patterns over the whole text, as they are stated."""
    found = [(0, *m.span()) for m in pii.EMAIL.finditer(text)]
    for m in pii.IP.finditer(text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((1, *m.span()))
    for m in pii.CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        odd, even = digits[-1::-2], digits[-2::-2]
        total = sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            found.append((2, *m.span()))
    for m in pii.PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((3, *m.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1 .@-+()_%0249é²\n", max_size=60))
def test_base_equals_patterns(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a@b.co", "x." * 70, "@", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (743) 555-3824", "-", " "]), max_size=12))
def test_base_equals_patterns_on_pieces(pieces):
    assert pii.base_spans("".join(pieces)) == plain("".join(pieces))


@pytest.fixture(scope="module")
def model():
    return pii.train()


def spans(model, text):
    return [(pii.KINDS[k], text[a:b]) for k, a, b in pii.model_spans([text], model)[0]]


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("you can call (614) 555-2368 tonight", [("phone", "(614) 555-2368")]),
        ("her number: 646-555-0190.", [("phone", "646-555-0190")]),
        ("write to kim (at) example.com please", [("email", "kim (at) example.com")]),
        ("seen at 10[.]1[.]2[.]3 again", [("ip", "10[.]1[.]2[.]3")]),
        ("nothing here but plain words", []),
        ("Version 3.1 of 2021-05-06, page 12", []),
        ('token = "0f1e2d3c4b5a69788796a5b4c3d2e1f0"', []),
        ("order 1234567812345678 was sent", []),
    ],
)
def test_model_adds_what_patterns_miss(model, text, wanted):
    assert spans(model, text) == wanted


LONG = "christopher.montgomery-lancaster (at) physics.uni-heidelberg (dot) example (dot) org"


@pytest.mark.parametrize("address", [LONG, "anna.baker at example dot org"])
def test_addresses_without_signs_are_whole(model, address):
    assert spans(model, f"please mail {address} today") == [("email", address)]


def test_chains_hold_whole_tokens(model):
    text = "internationalisation " * 9 + "x" * 90 + " 12 " + "y" * 90 + " word" * 30
    ((low, high),) = pii.chains_of(text)
    assert text[low:high].strip().startswith("x" * 90) and text[low:high].strip().endswith("y" * 90)


def test_chains_equal_the_whole_text(model, monkeypatch):
    """No span is cut where a chain ends."""
    texts = [f"{'plain words go here ' * n}mail {LONG} or call (614) 555-2368 at noon{' and more words' * n}" for n in (0, 1, 5, 40)]
    near = pii.model_spans(texts, model)
    monkeypatch.setattr(pii, "REACH", 100_000)
    assert near == pii.model_spans(texts, model)


def whole_text_spans(text, model):
    """One chain over all of a text."""
    tokens = [m.span() for m in pii._TOKEN.finditer(text)]
    if not tokens:
        return []
    (path,) = model.decode([model.scores(pii.token_features(text, tokens))])
    return [s for s in pii._label_spans(tokens, path) if pii._CHECKS[s[0]](text[s[1] : s[2]])]


def test_chains_equal_whole_texts_of_the_given_table(spark, model):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = pii.model_spans(texts, model)
    assert sum(map(len, found)) > 20
    assert [sorted(f) for f in found] == [sorted(whole_text_spans(t, model)) for t in texts]


def numbers(count):
    rng = np.random.default_rng(1)
    parts = [str(n) for n in rng.integers(0, 10**6, count)]
    for k in range(40, count, 97):
        parts[k] = ("call (614) 555-2368 at noon", "a.b (at) c (dot) org", "4111 1111 1111 1111")[k % 3]
    return ", ".join(parts)


def test_pieces_equal_the_whole_chain(model, monkeypatch):
    texts = [numbers(3000), "7 " * 4000, "1-" * 3000, f"x {numbers(700)} {'9' * 5000} {numbers(300)}"]
    whole = [sorted(whole_text_spans(t, model)) for t in texts]
    assert len(whole[0]) > 20
    for piece in (600, 4000):
        monkeypatch.setattr(pii, "PIECE", piece)
        assert [sorted(f) for f in pii.model_spans(texts, model)] == whole


def test_memory_of_a_long_text_of_numbers(model):
    text = numbers(40_000)
    tracemalloc.start()
    pii.model_spans([text], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 300_000 and peak < 40_000_000


def test_viterbi_finds_the_best_path(model):
    """Against all paths of short chains, decoded together."""
    rng = np.random.default_rng(0)
    chains = [rng.normal(size=(n, pii.LABELS)) * 3 for n in (1, 2, 3, 4, 3)]
    for scores, path in zip(chains, model.decode(chains), strict=True):
        best = max(
            np.ndindex(*[pii.LABELS] * len(scores)),
            key=lambda p: scores[range(len(p)), p].sum()
            + pii._START[p[0]]
            + sum(model.steps[a, b] for a, b in zip(p[:-1], p[1:], strict=True)),
        )
        assert tuple(path) == best


def test_base_spans_stay_and_added_ones_touch_none():
    base = [(2, 10, 20), (3, 18, 30)]
    assert pii.added_spans(base, [(0, 0, 10), (0, 5, 11), (1, 25, 28), (1, 30, 33)]) == [
        (0, 0, 10),
        (1, 30, 33),
    ]


def test_whole_table(spark, model):
    rows = cases.corpus()
    rows += [
        (900, "mail a.b@example.org, +49 30 5550 1234 and 4111-1111-1111-1111 or 10.0.0.1", "en", "s"),
        (901, "😀😀 a@b.co " * 3000, "en", "s"),
        (902, "0" * 6000 + ".1.1.1", "en", "s"),
    ]
    found = pii.find_pii(cases.frame(spark, rows)).collect()

    def listed(spans):
        return [(pii.KINDS.index(s.kind), s.start, s.end) for s in spans]

    got = [(r["_id"], listed(r.base)) for r in found]
    assert cases.order(got) == cases.order([(r[0], plain(r[1] or "")) for r in rows if r[0] != 902] + [(902, [(1, 0, 6006)])])
    by_id = {r["_id"]: r for r in found}
    assert not by_id[901].added and not by_id[303].added


def test_empty_table(spark):
    assert pii.find_pii(cases.frame(spark, [])).count() == 0


def test_no_examples_adds_nothing():
    nothing = pii.train([])
    assert pii.model_spans(["call (614) 555-2368"], nothing) == [[]]

import random
import re
from collections import Counter

import cases
import numpy as np
import pytest

from tillstream.llm import phrases


def plain(rows, least=30, covered=80, top=2000):
    counts, sizes = {}, Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", cases.lower_ascii(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(1, 5):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    found = []
    for lang, own in counts.items():
        frequent = {p: a for p, a in own.items() if a >= least}
        kept = []
        for phrase, a in frequent.items():
            if len(phrase) == 1:
                continue
            around = [
                b
                for other, b in frequent.items()
                if len(other) > len(phrase)
                and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
            ]
            if any(100 * b >= covered * a for b in around):
                continue
            cuts = []
            for k in range(1, len(phrase)):
                left, right = own[phrase[:k]], own[phrase[k:]]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            kept.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return found


def rows_of(found):
    return [tuple(r) for r in found.collect()]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    fixed = ["new york city", "as well as", "one of the", "of the", "Ärzte ohne Grenzen", "a a a a a"]
    rows = []
    for doc_id in range(400):
        parts = [*cases.words(rng, 25, 12), *rng.sample(fixed, 3)]
        rng.shuffle(parts)
        text = "".join(p + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " ", " ", " "]) for p in parts)
        rows.append((doc_id, text.title() if doc_id % 5 == 0 else text, rng.choice(["en", "de", None]), "s"))
    return rows + cases.corpus(seed=9, count=10)


@pytest.mark.parametrize(
    "options",
    [{}, {"bits": 10, "filter_bits": 64}, {"min_count": 20, "top": 7, "covered_pct": 30}],
    ids=str,
)
def test_equals_plain_version(spark, texts, options):
    """Also with fingerprints of few bits, which many phrases share, and a filter that is full."""
    named = {"min_count": "least", "covered_pct": "covered", "top": "top"}
    wanted = plain(texts, **{named[k]: v for k, v in options.items() if k in named})
    assert len(wanted) > 10
    found = phrases.collocations(cases.frame(spark, texts), **options)
    assert cases.order(rows_of(found)) == cases.order(wanted)


def test_chunks_of_words_give_the_same_phrases(texts):
    data = "\n".join(t for _, t, _, _ in texts[:40]).encode()
    words = phrases.Words(np.frombuffer(data, np.uint8), np.array([0, len(data) // 2, len(data)]))
    tags, of = np.arange(2, dtype=np.uint64), phrases.Fingerprints()

    def found(step):
        rows = set()
        for low in range(0, len(words), step):
            high = min(low + step, len(words))
            for n, firsts, prints, checks in of.of(words, low, high, (1, 2, 3, 4), tags):
                rows |= {(n, words.text(int(f), n), int(p), int(c), int(f)) for f, p, c in zip(firsts, prints, checks)}
        return rows

    assert found(3) == found(len(words)) and len(found(7)) > 1000


def test_same_compares_words(texts):
    data = b"x y x y x z"
    words = phrases.Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert words.same(np.array([0]), np.array([2]), 2)
    assert not words.same(np.array([0, 1]), np.array([2, 3]), 2) or words.text(1, 2) == words.text(3, 2)
    assert not words.same(np.array([2]), np.array([4]), 2)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**12
    rows = [("en", "a", 1, big + 7), ("en", "b", 1, big + 2), ("en", "a b", 2, big)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, words int, a bigint")
    found = phrases._scored_cuts(counts.filter("words > 1"), counts).first()
    assert found.score == 2_000_000 * big // (2 * big + 9)


def test_empty_tables_and_texts(spark):
    assert phrases.collocations(cases.frame(spark, [])).count() == 0
    rows = [(1, None, "en", "s"), (2, "", None, "s"), (3, " .,\n", "de", "s")]
    assert phrases.collocations(cases.frame(spark, rows), min_count=1).count() == 0


def test_repeated_rows_count_each_time(spark):
    rows = [(1, "big data", "en", "s")] * 40
    assert rows_of(phrases.collocations(cases.frame(spark, rows))) == [
        ("en", 1, "big data", 40, 40, 40, 80, 1_000_000)
    ]

import random
import re

import cases
import numpy as np
import pytest

from tillstream.llm import contamination as C
from tillstream.llm.contamination import drop_contaminated, find_contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(cases.lower_ascii(text or ""))


def plain(rows, items):
    windows = {}
    for item, text in items:
        own = split(text)
        n = min(13, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + n]), set()).add(item)
    found = []
    for doc_id, text, *_ in rows:
        own, hit, ids = split(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(own) - n + 1):
                if match := windows.get(tuple(own[k : k + n])):
                    hit.update(range(k, k + n))
                    ids |= match
        names = sorted(str(i) for i in ids if i is not None)
        bad = bool(hit) and 20 * len(hit) >= len(own)
        found.append((doc_id, len(own), len(hit), names, bad))
    return found


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    rows = cases.corpus(seed=2)
    items = [(k, " ".join(cases.words(rng, n))) for k, n in enumerate([40, 13, 14, 30, 60, 12, 5, 3, 1])]
    for k, (_, text) in enumerate(items):
        around = cases.words(rng, 30 * k), cases.words(rng, 11)
        rows.append((1000 + k, " ".join([*around[0], text.upper(), *around[1]]), "en", "s"))
        part = " ".join(text.split()[1:14])
        rows.append((1100 + k, f"{part}! {part}? {part}", "en", "s"))
        rows.append((1200 + k, " ".join(text.split()[:12]), "en", "s"))  # one word short
    items += [(20, None), (21, ""), (22, "!!!"), (0, items[0][1]), (30, items[0][1]), (None, items[3][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return rows, items, cases.frame(spark, rows), benchmark


def test_equals_plain_version(tables):
    rows, items, docs, benchmark = tables
    wanted = plain(rows, items)
    assert sum(r[4] for r in wanted) > 10
    got = [
        (r["_id"], r.n_words, r.n_hit, r["items"], r.contaminated)
        for r in find_contamination(docs, benchmark).collect()
    ]
    assert cases.order(got) == cases.order(wanted)


def test_full_filter_loses_nothing(tables):
    rows, items, docs, benchmark = tables
    got = find_contamination(docs, benchmark, bits=64)
    assert got.filter("contaminated").count() == sum(r[4] for r in plain(rows, items))


def test_clean_documents_stay_whole(tables):
    rows, items, docs, benchmark = tables
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    clean = [(r[0], r[1]) for r, p in zip(rows, plain(rows, items), strict=True) if not p[4]]
    assert cases.order([(r.doc_id, r.text) for r in kept.collect()]) == cases.order(clean)


def test_empty_tables(spark, tables):
    rows, _, docs, benchmark = tables
    nothing = benchmark.limit(0)
    assert find_contamination(docs, nothing).filter("n_hit = 0 and not contaminated").count() == len(rows)
    assert find_contamination(cases.frame(spark, []), benchmark).count() == 0


def places_of(texts, window=13):
    data = np.frombuffer("\n".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) + 1 for t in texts]])
    offsets[-1] -= 1
    of = C._Winnower(window, 5)
    words, first_words = of.words(data, offsets)
    return words, first_words, of.select(words, first_words)[0]


def test_equal_windows_keep_the_same_place():
    """A window's place holds its least gram; few places stand for many windows."""
    rng = random.Random(3)
    shared = cases.words(rng, 40)
    texts = [" ".join([*cases.words(rng, n), *shared, *cases.words(rng, 50 - n)]) for n in (0, 7, 50)]
    texts += ["a " * 60, "one two three", ""]
    words, first_words, places = places_of(texts)
    grams = C.gram_hashes(words, 5)
    kept = set(places.tolist())
    for low, high in zip(first_words[:-1], first_words[1:], strict=True):
        for start in range(low, high - 12):
            own = grams[start : start + 9]
            assert start + max(k for k in range(9) if own[k] == own.min()) in kept
    of_shared = [
        {p - (first_words[k] + n) for p in kept if first_words[k] + n <= p <= first_words[k] + n + 35}
        for k, n in enumerate((0, 7, 50))
    ]
    inside = [{p for p in s if 8 <= p <= 27} for s in of_shared]
    assert inside[0] and inside[0] == inside[1] == inside[2]
    random_text = [p for p in kept if p < first_words[3]]
    assert len(random_text) < 0.4 * first_words[3]


def test_fingerprints_decide(spark, tables, monkeypatch):
    """Without selected places nothing but the short items is found."""
    rows, items, docs, benchmark = tables
    short = [(i, t) for i, t in items if len(split(t)) < 13]
    prints = C.benchmark_prints(benchmark).filter("length < 13")
    monkeypatch.setattr(C, "benchmark_prints", lambda *_: prints)
    got = [(r["_id"], r.n_hit) for r in find_contamination(docs, benchmark).collect()]
    assert cases.order(got) == cases.order([(r[0], r[2]) for r in plain(rows, short)])


def test_repeated_words_and_frequent_grams(spark):
    """Texts of one word, and a gram that stands in many different windows."""
    rng = random.Random(8)
    common = ["aa", "bb", "cc", "dd", "ee"]
    items = [(k, " ".join([*cases.words(rng, 9), *common, *cases.words(rng, 9)])) for k in range(40)]
    items += [(50, "same " * 30), (51, "same " * 12)]
    rows = [(k, " ".join([*cases.words(rng, 20), *common, *cases.words(rng, 20)]), "en", "s") for k in range(30)]
    rows += [(100 + k, f"x {t} y", "en", "s") for k, (_, t) in enumerate(items)]
    rows += [(200, "same " * 5000, "en", "s"), (201, "same " * 11, "en", "s")]
    found = find_contamination(cases.frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r["_id"], r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect()]
    assert cases.order(got) == cases.order(plain(rows, items))

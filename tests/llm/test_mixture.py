import random
from collections import Counter
from operator import add, mul

import cases
import pytest
from pyspark.sql import functions as F

from tillstream.llm.mixture import _pair_up, mix_sources, source_targets, take_mixture


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share out, cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        target = {s: most * sizes[s] for s in capped}
        target |= {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 1000, None: 3},
        {"a": 5, "b": 7, "c": 0, "d": 9000, "e": 1, "f": 2},
        {"only": 10},
        {"a": 0, None: 0},
        {f"s{k:03}": k * k for k in range(120)},
    ],
)
def test_targets_equal_repeated_sharing(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "_source string, source_size long")
    got = {r["_source"]: r.target for r in source_targets(table, (5, 2, 1), 3).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_words_taken_meet_targets(spark):
    rows = cases.corpus(count=400)
    found = mix_sources(cases.frame(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes, largest, taken, target = Counter(), Counter(), Counter(), {}
    for r in found:
        sizes[r["_source"]] += r.size
        largest[r["_source"]] = max(largest[r["_source"]], r.size)
        taken[r["_source"]] += r.taken
        target[r["_source"]] = r.target
        assert r.taken == r.copies * r.size <= 3 * r.size
        assert r.source_size >= r.size
    assert target == pytest.approx(plain_targets(sizes))
    for source in sizes:
        assert abs(taken[source] - target[source]) <= largest[source]


def test_reruns_and_partitions_agree(spark):
    docs = cases.frame(spark, cases.corpus(count=300))

    def taken(df):
        return cases.order([(r["_id"], r["_source"], r.size, r.taken) for r in mix_sources(df).collect()])

    assert taken(docs) == taken(docs) == taken(docs.repartition(7))


def test_more_blocks_than_one(spark):
    rows = [(k, "one two three four", "en", "big") for k in range(2000)]
    rows += [(5000 + k, "one two", "en", "small") for k in range(100)]
    found = mix_sources(cases.frame(spark, rows)).collect()
    for source in ("big", "small"):
        own = [r for r in found if r["_source"] == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 4


def test_pairing_keeps_words_and_expectations(spark):
    rng, shares, sizes = random.Random(9), [0.3, 0.6, 0.6, 0.9, 0.25], [50, 20, 9, 3, 1]
    blocks = [
        ([(k, p, float(s), rng.random()) for k, (p, s) in enumerate(zip(shares, sizes, strict=True))],)
        for _ in range(4000)
    ]
    schema = "items array<struct<place:int,share:double,size:double,chance:double>>"
    ended = spark.createDataFrame(blocks, schema).select(_pair_up(F.col("items")).alias("e"))
    total = [0.0] * len(shares)
    for (end,) in ended.collect():
        last = [float(k in end.won) for k in range(len(shares))]
        last[end.open] = end.share
        assert sum(map(mul, last, sizes)) == pytest.approx(sum(map(mul, shares, sizes)))
        assert all(0 <= x <= 1 for x in last)
        total = list(map(add, total, last))
    assert [t / 4000 for t in total] == pytest.approx(shares, abs=0.03)


def test_mixture_repeats_documents(spark):
    rows = cases.corpus()
    docs = cases.frame(spark, rows)
    copies = Counter()
    for r in mix_sources(docs).collect():
        copies[r["_id"]] += r.copies
    got = take_mixture(docs)
    assert got.columns[: 5] == docs.columns[:5]
    assert Counter(r.doc_id for r in got.collect()) == +copies
    assert {r.copy for r in got.collect()} <= {1, 2, 3}


def repeated():
    """A third of all rows is one row, and there are copies of a few others."""
    rows = [(7, "one row many times over, " * 13, "en", "a")] * 300
    rows += [(100 + k, "some words of its own " * (k % 9), "en", "a") for k in range(300)]
    rows += [(900 + k // 7, "seven times each", "en", None) for k in range(300)]
    return rows


def test_repeated_rows_meet_targets(spark):
    rows = repeated()
    docs = cases.frame(spark, rows)
    found = mix_sources(docs).collect()
    assert Counter((r["_id"], r["_source"]) for r in found) == Counter((r[0], r[3]) for r in rows)
    for source in ("a", None):
        own = [r for r in found if r["_source"] == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(r.taken <= 3 * r.size for r in own)
    copies = [r.copies for r in found if r["_id"] == 7]
    assert len(copies) == 300 and max(copies) - min(copies) == 1
    wanted = Counter()
    for r in found:
        wanted[r["_id"]] += r.copies
    for parts in (1, 5):
        got = Counter(r.doc_id for r in take_mixture(docs.repartition(parts)).collect())
        assert got == +wanted


def test_rows_beyond_a_chunk(spark):
    docs = spark.range(25_003).selectExpr("1L as doc_id", "'two words' as text", "'en' as lang", "'a' as source")
    found = mix_sources(docs)
    assert found.count() == 25_003
    assert found.agg(F.sum("taken")).first()[0] == 2 * 25_003


def test_the_root_is_drawn(spark):
    """The one open document of a source with a fraction below a half is taken at times."""
    docs = cases.frame(spark, [(1, "one two three four", "en", "a"), (2, "one two three", "en", "b")])
    seen = Counter()
    for seed in range(9):
        found = {r["_id"]: r for r in mix_sources(docs, seed=seed).collect()}
        assert found[1].target == pytest.approx(5.0) and found[1].copies in (1, 2)
        seen[found[1].copies] += 1
    assert seen[1] > seen[2] > 0


def test_empty_and_wordless_tables(spark):
    assert mix_sources(cases.frame(spark, [])).count() == 0
    rows = [(1, None, None, None), (2, "", None, "a"), (3, " \n", None, "a")]
    got = mix_sources(cases.frame(spark, rows)).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 3
    assert take_mixture(cases.frame(spark, rows)).count() == 0

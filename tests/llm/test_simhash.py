import random

import cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillstream.llm import simhash as S


def plain_print(text):
    own = (text or "").encode().lower().split()
    if not own:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(own[k : k + 3]), 42) for k in range(max(1, len(own) - 2))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius=2):
    parent = list(range(len(ids)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[top(i)] = top(j)
    least = {}
    for k, doc_id in enumerate(ids):
        held = [x for x in (least.get(top(k)), doc_id) if x is not None]
        least[top(k)] = min(held) if held else None
    return [least[top(k)] for k in range(len(ids))]


def test_equals_plain_version(spark):
    rows = cases.corpus()
    prints = [plain_print(r[1]) for r in rows]
    roots = plain_components([r[0] for r in rows], prints)
    assert roots[[r[0] for r in rows].index(104)] == 100, "near copies must link"
    wanted = [(r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, roots, strict=True)]
    found = S.near_duplicates(cases.frame(spark, rows)).collect()
    got = [(r["_id"], r.fingerprint, r.component_id) for r in found]
    assert cases.order(got) == cases.order(wanted)


def test_hash_equals_sparks(spark):
    text = "one two three"
    row = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first()
    assert S.simhash(text.encode()) == row.h % (1 << 64)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(cases.words(rng, n)) for n in (1, 2, 3, 4, 50, 1000)]
    texts += ["  \n a\t\tb  ", "x" * 300 + " y " + "z" * 300 + "\x0b q"]
    for size in (1, 7, 50, 1 << 20):
        monkeypatch.setattr(S, "PIECE_BYTES", size)
        assert [S.simhash(t.encode()) for t in texts] == [plain_print(t) for t in texts]


@pytest.mark.parametrize("tile", [(4096, 16384), (8, 16)])
def test_links_connect_what_pairs_connect(spark, monkeypatch, tile):
    monkeypatch.setattr(S, "TILE_ROWS", tile[0])
    monkeypatch.setattr(S, "TILE_COLUMNS", tile[1])
    rng = random.Random(4)
    prints = {0, (1 << 64) - 1, 1, 3, 7, 1 << 63}
    for _ in range(30):
        start = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            prints.add(start)
            # A walk of one to three bits: long chains, some of them broken.
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                start ^= 1 << bit
    prints = sorted(prints)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    links = S.near_links(spark.createDataFrame([(x,) for x in signed], "fingerprint long"))
    roots = {r.node: r.root for r in S.components(links).collect()}
    groups = {}
    for p, s, c in zip(prints, signed, plain_components(signed, prints), strict=True):
        groups.setdefault(c, set()).add(roots.get(s, s))
    assert all(len(v) == 1 for v in groups.values())
    assert len(groups) == len({next(iter(v)) for v in groups.values()})


def test_dense_group_gives_few_pairs():
    near = np.array([(0x0F0F << 20) ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)], np.uint64)
    pairs = S._stars_of_tile(near, near, 2)
    assert len(pairs[0]) < 2 * len(near)
    assert set(pairs[1].tolist()) == {near.view(np.int64).min()}


def test_stars_of_a_tile_connect_what_its_links_do():
    rng = random.Random(6)
    for size in (0, 1, 2, 40):
        rows, columns = (
            np.array([rng.getrandbits(6) | rng.getrandbits(4) << 60 for _ in range(n)], np.uint64)
            for n in (size, size + 1)
        )
        both = sorted({*rows.tolist(), *columns.tolist()})
        parent = {x: x for x in both}

        def top(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in rows.tolist():
            for c in columns.tolist():
                if (r ^ c).bit_count() <= 2:
                    parent[top(r)] = top(c)
        wanted = {}
        for x in both:
            wanted.setdefault(top(x), set()).add(x)
        parent = {x: x for x in both}
        for a, b in zip(*S._stars_of_tile(rows, columns, 2), strict=True):
            parent[top(int(a) % (1 << 64), parent)] = top(int(b) % (1 << 64), parent)
        got = {}
        for x in both:
            got.setdefault(top(x, parent), set()).add(x)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, wanted.values()))


def test_one_of_each_component_stays(spark):
    rows = cases.corpus()
    docs = cases.frame(spark, rows)
    kept = S.drop_near_duplicates(docs)
    roots = plain_components([r[0] for r in rows], [plain_print(r[1]) for r in rows])
    assert kept.columns == docs.columns
    assert cases.order([r.doc_id for r in kept.collect()]) == cases.order(set(roots))


def test_empty_tables(spark):
    docs = cases.frame(spark, [])
    assert S.near_duplicates(docs).count() == 0 and S.drop_near_duplicates(docs).count() == 0

import hashlib

import cases
import pytest
from pyspark.sql import functions as F

from tillstream.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    tree = [nodes]
    while len(tree[-1]) > 1:
        below = tree[-1]
        tree.append([hashed("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return tree


def folded(tree, place, digest):
    siblings = []
    for level in tree[:-1]:
        run, k = level[place // 3 * 3 :][:3], place % 3
        siblings += run[:k] + run[k + 1 :]
        digest = hashed("".join([*run[:k], digest, *run[k + 1 :]]))
        place //= 3
    return digest, siblings


def plain(rows, tamper):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, text, lang, source)."""
    leaves = {}
    for doc_id, text, lang, source in rows:
        n_chars = None if text is None else len(text)

        def leaf(text, doc_id=doc_id, lang=lang, source=source, n_chars=n_chars):
            return hashed("".join(map(field, (doc_id, source, lang, n_chars, text))))

        row = doc_id, leaf(text), leaf(tamper(doc_id, text))
        leaves.setdefault(source, []).append(row)
    sources = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    for own in leaves.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [levels([r[1] for r in leaves[s]]) for s in sources]
    top = levels([tree[-1][0] for tree in trees]) if trees else None
    found = []
    for rank, (source, tree) in enumerate(zip(sources, trees, strict=True)):
        for place, (doc_id, leaf, claimed) in enumerate(leaves[source]):
            digest, below = folded(tree, place, claimed)
            digest, above = folded(top, rank, digest)
            root = top[-1][0]
            proof = hashed("".join(below + above))
            found.append((doc_id, leaf, tree[-1][0], root, proof, digest, digest == root))
    return found


def untouched(doc_id, text):
    return text


def cut_lines(doc_id, text):
    return text.replace("\n", "") if text and doc_id is not None and doc_id % 2 else text


def proven(docs, claimed=None):
    manifest = merkle.build_manifest(docs, field_cols=FIELDS, claimed=claimed)
    return [tuple(r) for r in merkle.prove(manifest).collect()]


@pytest.mark.parametrize("block_levels", [7, 2])
def test_equals_plain_version(spark, monkeypatch, block_levels):
    # With small blocks most nodes are above them and are repeated for each.
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**block_levels)
    rows = cases.corpus(seed=4)
    docs = cases.frame(spark, rows)
    text = F.when(F.col("doc_id") % 2 == 1, F.replace("text", F.lit("\n"), F.lit("")))
    columns = [F.col(c) for c in FIELDS[:-1]]
    claimed = merkle.digest_of(*columns, F.when(F.col("doc_id").isNull(), F.col("text")).otherwise(F.coalesce(text, "text")))
    wanted = plain(rows, cut_lines)
    assert {r[6] for r in wanted} == {True, False}
    assert cases.order(proven(docs, claimed)) == cases.order(wanted)


@pytest.mark.parametrize("count", [1, 4, 10])
def test_every_shape_of_tree(spark, count):
    one_source = [(k, f"text {k}", "en", "s") for k in range(count)]
    lone_leaves = [(k, None, None, f"s{k}") for k in range(count)]
    for rows in (one_source, lone_leaves):
        found = proven(cases.frame(spark, rows))
        assert cases.order(found) == cases.order(plain(rows, untouched))
        assert all(r[6] for r in found)


def test_repeated_rows_and_null_sources_are_leaves_of_their_own(spark):
    rows = [(1, "same", "en", None)] * 5 + [(None, "same", "en", None)] * 2 + [(None, None, None, "")]
    found = proven(cases.frame(spark, rows))
    assert cases.order(found) == cases.order(plain(rows, untouched))


def test_empty_table_has_no_root(spark):
    manifest = merkle.build_manifest(cases.frame(spark, []))
    assert manifest.root is None and merkle.prove(manifest).count() == 0


def test_rows_of_a_dataset_are_numbered_in_order(spark):
    rows = spark.range(1000).selectExpr("id % 7 as a", "id as b").repartition(5)
    found = merkle.numbered(rows, "a", "b", name="at").orderBy("at").collect()
    assert [r["at"] for r in found] == list(range(1000))
    assert [(r.a, r.b) for r in found] == sorted((k % 7, k) for k in range(1000))


def test_any_number_of_rows_may_climb(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.prove(merkle.build_manifest(cases.frame(spark, [(1, "a", "b", "c")]))).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before

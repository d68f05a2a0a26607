"""The pipeline against its stages written plainly, on the given documents and edge cases."""

from collections import Counter

import cases
import corpus_pipeline as P
import duckdb
import pytest
import test_contamination
import test_lines
import test_mixture
import test_simhash
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage makes of its predecessor's rows, and the columns it returns."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, folder, found = docs.columns, tmp_path_factory.mktemp("pipeline"), {}
    odd = [(-1, None, "en", None), (-2, "1 2 3", "en", "s"), (-3, "", None, "s"), (-4, "\n\n", "de", "s")]
    docs = docs.unionByName(cases.frame(spark, odd).select(*columns))
    found["documents"] = docs.collect()
    for name, stage in P.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        found[name] = docs.collect()
        assert docs.columns[: len(columns)] == columns
        assert name == P.STAGES[-1][0] or docs.columns == columns
    return found


def tuples(rows):
    return [(r.doc_id, r.text, r.lang, r.source) for r in rows]


def test_language_stage_drops_texts_without_letters_only(stages):
    gone = {r.doc_id for r in stages["documents"]} - {r.doc_id for r in stages["language_id"]}
    letterless = {r.doc_id for r in stages["documents"] if not any(c.isalpha() for c in r.text or "")}
    assert gone == letterless


def test_line_stage(stages):
    wanted = [(d, t) for d, t, *_ in test_lines.plain(tuples(stages["language_id"]))]
    got = stages["line_dedup"]
    assert cases.order([(r.doc_id, r.text) for r in got]) == cases.order(wanted)
    assert all(r.n_chars == len(r.text) for r in got)


def test_near_dedup_stage(stages):
    rows = stages["line_dedup"]
    ids = [r.doc_id for r in rows]
    prints = [test_simhash.plain_print(r.text) for r in rows]
    assert sorted(r.doc_id for r in stages["simhash_near_dedup"]) == sorted(
        set(test_simhash.plain_components(ids, prints))
    )


def test_decontamination_stage(stages):
    rows = tuples(stages["simhash_near_dedup"])
    items = duckdb.connect().execute(f"select item_id, text from '{SF_DIR}/benchmark.parquet'").fetchall()
    clean = [r[0] for r in test_contamination.plain(rows, items) if not r[4]]
    assert len(clean) < len(rows)
    assert sorted(r.doc_id for r in stages["decontaminate"]) == sorted(clean)


def test_mixing_stage(stages):
    size = {r.doc_id: len(cases.blank_words(r.text)) for r in stages["decontaminate"]}
    sources, largest, taken = Counter(), Counter(), Counter()
    for r in stages["decontaminate"]:
        sources[r.source] += size[r.doc_id]
        largest[r.source] = max(largest[r.source], size[r.doc_id])
    for r in stages["mix_sources"]:
        assert r.size == size[r.doc_id] and 1 <= r.copy <= 3
        taken[r.source] += r.size
    target = test_mixture.plain_targets(sources)
    # The last open document is drawn by its fraction: off by less than a document.
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1e-6 for s in sources)


def test_run_applies_all_stages(spark, stages):
    whole = P.run(spark, SF_DIR)
    assert whole.columns[-4:] == ["copy", "size", "source_size", "target"]
    assert whole.filter(F.col("copy") < 1).count() == 0
    assert whole.select("doc_id", "copy").distinct().count() == whole.count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0

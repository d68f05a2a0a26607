from collections import defaultdict

import cases
from tillstream.llm.lines import dedup_lines


def plain(rows):
    holders = defaultdict(set)

    def key(line):
        return cases.lower_ascii(line.strip(cases.BLANK))

    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(-1 if doc_id is None else doc_id)
    shared = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    found = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        own = -1 if doc_id is None else doc_id
        kept = [x for x in lines if shared.get(key(x), own) == own]
        found.append(
            (doc_id, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept))
        )
    return found


def test_equals_plain_version(spark):
    rows = cases.corpus()
    found = dedup_lines(cases.frame(spark, rows))
    assert sum(r[3] for r in plain(rows)) > 20
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
    assert cases.order(got) == cases.order(plain(rows))


def test_other_columns_come_back(spark):
    rows = cases.corpus()
    found = dedup_lines(cases.frame(spark, rows))
    assert set(found.columns) == {f.name for f in cases.SCHEMA} | {"n_dropped"}
    assert found.filter("_id = 'x' and _row = 'x'").count() == len(rows)


def test_line_of_all_documents_stays_in_the_last(spark):
    line = "the very same line in each of them"
    rows = [(k, f"own text {k}\n  {line.upper()}\t\n{line}", "en", "s") for k in range(500)]
    found = {r.doc_id: r for r in dedup_lines(cases.frame(spark, rows)).collect()}
    assert [k for k, r in found.items() if r.n_dropped == 0] == [499]
    assert found[0].text == "own text 0" and found[0].n_dropped == 2


def test_two_documents_or_short_lines_do_not_count(spark):
    rows = [(1, "a line of some length here", "", ""), (2, "a line of some length here", "", "")]
    rows += [(k, "nineteen characters", "", "") for k in range(3, 9)]
    assert dedup_lines(cases.frame(spark, rows)).agg({"n_dropped": "sum"}).first()[0] == 0


def test_empty_table(spark):
    assert dedup_lines(cases.frame(spark, [])).count() == 0

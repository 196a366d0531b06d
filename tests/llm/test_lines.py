from collections import defaultdict

import pytest
import regex
from helpers import clashing, docs, edge_rows

from orbita.llm import common, line_dedup

BOILER = "This very line is on all of the sites."


@pytest.mark.parametrize("sites,all_sites", [(7, 20), (8, 20), (9, 40), (15, 40), (16, 40), (17, 40), (40, 40), (7, 100), (2, 6), (3, 6), (2, 2), (4, 10), (3, 10)])
def test_threshold_is_exact(spark, sites, all_sites):
    rows = [(i, f"own text number {i} of this document\n{BOILER}", f"s{i % sites}") for i in range(3 * sites)]
    rows += [(1000 + i, f"other text {i}", f"s{i}") for i in range(all_sites)]
    least = min(8, max(3, -(-2 * all_sites // 5)))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    for i, text, _ in rows:
        gone = sites >= least and 0 < i < 1000
        assert got[i].text == (text.split("\n")[0] if gone else text)
        assert got[i].n_removed == int(gone) and got[i].n_removed_chars == (len(BOILER) + 1) * gone


def test_edges(spark):
    rows = edge_rows() + [(100 + i, f"x\n {BOILER}\t\n\n{BOILER}\ny", f"s{i}") for i in range(10)]
    rows += [(100, f"x\n {BOILER}\t\n\n{BOILER}\ny", "s0"), (300, BOILER, None), (301, "short\nshort")]
    df = clashing(docs(spark, rows), "_gone", "_kept", "_id", "_body", "pos", "line", "a", "n_lines")
    got = line_dedup.dedup_lines(df, counts=("lines_", "removed_", "lost_")).collect()
    assert len(got) == len(rows)
    assert all(r._gone == r.pos == r.n_lines == "kept" for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    # The first place stays, in each equal row; that of "x" is in document 7.
    assert [r.text for r in by[100]] == [f" {BOILER}\t\n\ny"] * 2
    assert all(r.text == "" and r.removed_ == 4 for i in range(101, 110) for r in by[i])
    assert by[300][0].text == "" and by[301][0].text == "short\nshort"
    assert by[2][0].text is None and by[2][0].lines_ == 0 and by[3][0].lines_ == 1
    whole = {i: t for i, t, *_ in edge_rows()}
    assert by[5][0].text == whole[5] and by[7][0].text == whole[7]
    assert line_dedup.dedup_lines(docs(spark, [])).collect() == []


def test_clean_documents_keeps_what_is_left(spark):
    lines = [f"line number {k} of a text that was copied to all the sites" for k in range(6)]
    rows = [(i, "\n".join(lines), f"s{i}") for i in range(9)]
    rows += [(20 + i, "\n".join(lines[:5] + [f"an edited line at the end {i}"]), f"s{i}") for i in range(9)]
    rows += [(50 + i, f"{BOILER}\nown {i}", f"s{i}") for i in range(9)] + [(90, ""), (91, None)]
    df = clashing(docs(spark, rows), "_removed", "n_removed")
    kept = line_dedup.clean_documents(df)
    assert kept.columns == df.columns
    kept = {r.doc_id: r for r in kept.collect()}
    assert sorted(kept) == [0, *range(20, 29), *range(50, 59), 90, 91]
    assert kept[23].text == "an edited line at the end 3"
    assert kept[50].text == f"{BOILER}\nown 0" and kept[51].text == "own 1"
    assert kept[51].n_chars == 5 and kept[91].n_chars is None


def test_clean_documents_counts_short_lines(spark):
    rows = [(i, f"Reply\nown text number {i} of this document\n}}", f"s{i}") for i in range(9)]
    kept = {r.doc_id: r.text for r in line_dedup.clean_documents(docs(spark, rows)).collect()}
    assert kept == {i: ("Reply\n" if i == 0 else "") + f"own text number {i} of this document\n}}" for i in range(9)}
    two = [r for r in rows if r[0] < 2]  # too few sites: all stays
    assert {r.text for r in line_dedup.clean_documents(docs(spark, two)).collect()} == {r[1] for r in two}


def test_the_stage_against_brute_force(spark):
    """Threshold, first place and removal of every line of a whole table."""
    rows = common.documents(spark, "/root/testdata/sf0.01").collect()
    sites, first = defaultdict(set), {}
    cut = lambda line: line.strip(" \t\r\x0b\x0c")
    for r in sorted(rows, key=lambda r: r.doc_id):
        for pos, line in enumerate((r.text or "").split("\n")):
            if regex.search(r"[\p{L}\p{N}]", line):
                sites[cut(line)].add(r.source)
                first.setdefault(cut(line), (r.doc_id, pos))
    least = min(8, max(3, -(-2 * len({r.source for r in rows}) // 5)))
    want = {}
    for r in rows:
        lines = (r.text or "").split("\n")
        left = [x for p, x in enumerate(lines) if len(sites.get(cut(x), ())) < least or first[cut(x)] == (r.doc_id, p)]
        if len(left) == len(lines) or "\n".join(left).strip(" \t\n\r\x0b\x0c"):
            want[r.doc_id] = r.text if len(left) == len(lines) else "\n".join(left)
    got = line_dedup.clean_documents(common.documents(spark, "/root/testdata/sf0.01")).collect()
    assert {r.doc_id: r.text for r in got} == want and len(got) == len(want)
    assert sum(want[r.doc_id] != r.text for r in rows) > 20


def test_no_python_in_the_plan(spark):
    plan = line_dedup.dedup_lines(docs(spark, edge_rows()))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

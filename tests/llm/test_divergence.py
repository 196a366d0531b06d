import re
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, clashing, docs, edge_rows

from orbita.llm import divergence as D


def brute(rows, min_docs, top):
    """The contract, one group at a time."""
    cells, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        cells[lang, source].update(found)
        seen[lang].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in seen[lang].items() if n >= min_docs)
        members = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in members:
            whole.update(cells[lang, s])

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q, p = shares(whole), {s: shares(cells[lang, s]) for s in members}
        for s in members:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in members if o != s]
            over = [(q[t] - p[s][t], t.encode()) for t in kept if cells[lang, s][t] and p[s][t] > q[t]]
            for part, items, cap in (("pair", pairs, None), ("term", over, top)):
                out |= {(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(sorted(items)[:cap], 1)}
    return out


def table(spark, rows):
    return spark.createDataFrame([(k, t, lang, s, 0) for k, (t, lang, s) in enumerate(rows)], DOCS)


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus():
    words = "the of and Über naïve Zeta alpha beta gamma delta été one two".split()
    out = []
    for k in range(60):
        body = " ".join(words[(k * i + i * i) % len(words)] + ("." if i % 3 else "42") for i in range(5 + k % 17))
        out.append((body, ["en", "de", None][k % 3], [f"s{k % 5}", None, "hot", "hot"][k % 4]))
    return out + [(None, "en", "s1"), ("", "xx", "lonely"), ("12 34", "xx", "other"), ("solo term", "yy", "only")]


@pytest.mark.parametrize("min_docs,top", [(1, 50), (3, 4), (8, 2), (500, 50)])
def test_equals_brute_force(spark, min_docs, top):
    rows = corpus()
    assert got(D.audit(table(spark, rows), min_docs, top)) == brute(rows, min_docs, top)


def test_blocks_of_sources_and_chunks_of_terms(spark):
    rows = corpus()
    table_ = table(spark, rows)
    kept = D.kept_terms(table_, 1)
    want = {r for r in brute(rows, 1, 50) if r[2] == "pair"}
    for chunk, block in ((3, 2), (1, 1), (100, 3)):
        assert got(D.source_pairs(kept, D.group_totals(table_, kept), chunk, block)) == want


def test_tables_that_fill_up_give_the_same_counts(spark):
    rows = table(spark, corpus())
    total = lambda df: {(r.lang, r.source, bytes(r.term)): (r.n, r.d) for r in df.groupBy("lang", "source", "term").agg(
        {"n": "sum", "docs": "sum"}).withColumnsRenamed({"sum(n)": "n", "sum(docs)": "d"}).collect()}
    assert total(D.tally(rows, 1)) == total(D.tally(rows))


def test_ties_expand_in_utf8_order(spark):
    rows = [("zz Zeta éa ea \U0001F642x", "en", "a")] * 3 + [("other", "en", "b")] * 3
    terms = sorted((r.rank, r.item) for r in D.audit(table(spark, rows), 3, 3).where("part = 'term' and source = 'a'").collect())
    assert terms == [(1, "ea"), (2, "zeta"), (3, "zz")]


def test_edges(spark):
    assert D.audit(docs(spark, []), 1).count() == 0
    rows = edge_rows()
    want = brute([(t, "en", "src0") for _, t in rows], 1, 50)
    assert got(D.audit(clashing(docs(spark, rows), "n", "term", "first", "V"), 1)) == want

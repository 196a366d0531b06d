import random

import numpy as np
import pytest
import xxhash
from helpers import clashing, docs, edge_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from orbita.llm import simhash
from orbita.llm.components import components


def brute_fingerprint(text, k=3):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(fps, radius):
    """Least index of each index's component."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@given(st.text(alphabet="abAB É\n\t ", max_size=40))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_of_a_text_longer_than_a_step(monkeypatch):
    text = " ".join(f"w{i % 91}" for i in range(1000))
    for step in (1, 7, 64, 5000):
        monkeypatch.setattr(simhash, "STEP", step)
        for t in (text, text[:9], "a", " a  b ", "", "\n\n", "x" * 300 + " y z"):
            assert simhash.fingerprint(t) == brute_fingerprint(t)


def near_values(rng, groups=12, size=9):
    out = []
    for _ in range(groups):
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, size)):
            out.append(v)
            for _ in range(rng.randrange(0, 3)):
                v ^= 1 << rng.randrange(64)
    return list(dict.fromkeys(out))


def test_forest_connects_what_links_connect():
    rng = random.Random(1)
    for _ in range(20):
        a = near_values(rng)
        b = [v ^ (1 << rng.randrange(64)) for v in rng.sample(a, 5)]
        b = [v for v in dict.fromkeys(b) if v not in a]
        both = a + b
        left, right = simhash.forest(np.array(a, np.uint64), np.array(b, np.uint64), 2)
        across = [(i, j) for i, x in enumerate(a) for j, y in enumerate(both) if j >= len(a) and (x ^ y).bit_count() <= 2]
        assert components_of(len(both), across) == components_of(
            len(both), [(both.index(x), both.index(y)) for x, y in zip(left, right)])
        left, right = simhash.forest(np.array(a, np.uint64), None, 2)
        inside = [(i, j) for i, x in enumerate(a) for j, y in enumerate(a) if i < j and (x ^ y).bit_count() <= 2]
        assert components_of(len(a), inside) == components_of(len(a), [(a.index(x), a.index(y)) for x, y in zip(left, right)])
        assert len(left) < len(a)


def components_of(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in edges:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("segments", [1, 4, 8])
def test_links_over_split_tiles_give_all_components(spark, segments):
    rng = random.Random(7)
    fps = near_values(rng, groups=60, size=14)
    signed = [v - (1 << 64) if v >> 63 else v for v in fps]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = simhash.links(df, "fp", 2, tile=2, segments=segments).collect()
    assert components_of(len(fps), [(signed.index(r.a), signed.index(r.b)) for r in found]) == brute_components(fps, 2)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 499), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 500: 499, 499: 499}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(50)]
    rows = []
    for i in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        for k in range(rng.choice([1, 1, 2, 4])):
            w = list(base)
            if k and w:
                w[rng.randrange(len(w))] = "changed"
            rows.append((1000 - len(rows), " ".join(w)))
    rows += edge_rows()
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps, 2)
    least = {}
    for r, (i, _) in zip(roots, rows):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), f"{f:016x}", str(least.get(r))) for (i, _), f, r in zip(rows, fps, roots))
    got = simhash.near_duplicates(clashing(docs(spark, rows), "fp", "_fp", "component_id", "row")).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    kept = simhash.keep_one(clashing(docs(spark, rows), "_fp", "_row", "_key")).collect()
    assert len(kept) == len(set(roots))
    assert kept[0]._fp == "kept"
    by_id = {}
    for (i, _), r in zip(rows, roots):
        by_id.setdefault(i, set()).add(r)
    assert all(k.doc_id == least.get(r) for k in kept for r in by_id[k.doc_id] if len(by_id[k.doc_id]) == 1)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []
    assert simhash.keep_one(docs(spark, [])).collect() == []


def test_a_hot_group_of_copies(spark):
    rows = [(i, "the very same text in all of these rows") for i in range(400)] + [(1000 + i, f"own {i} text {i * i}") for i in range(200)]
    got = simhash.near_duplicates(docs(spark, rows).repartition(4)).collect()
    assert sum(r.component_id == 0 for r in got) >= 400 and len(got) == 600

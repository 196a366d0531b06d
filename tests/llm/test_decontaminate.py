import random

import numpy as np
from helpers import clashing, docs, edge_rows

from orbita.llm import common, decontaminate as D

SF = "/root/testdata/sf0.001"
SCHEMA = "item_id long, text string"


def word_list(text):
    w = D.Words([(text or "").lower()], D.NOT_ALNUM)
    raw = w.raw.tobytes()
    return [raw[s:s + n] for s, n in zip(w.start, w.size)]


def best(item, text):
    """Greatest similarity over all item-sized windows."""
    w, size = word_list(text), len(word_list(item))
    have = D.shingles(word_list(item))
    return max((D.similarity(have, D.shingles(w[p:p + size])) for p in range(max(1, len(w) - size + 1))), default=0.0)


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    queries = fps[rng.integers(0, 400, 500)].copy()
    for k in range(500):
        for b in rng.choice(64, rng.integers(0, 20), replace=False):
            queries[k] ^= np.uint64(1) << np.uint64(b)
    q, r = D.MultiIndex(fps).within(queries, D.RADIUS)
    near = np.bitwise_count(queries[:, None] ^ fps[None, :]) <= D.RADIUS
    assert sorted(zip(q.tolist(), r.tolist())) == [tuple(x) for x in np.argwhere(near).tolist()]


def test_window_fingerprints_match_brute_force():
    hashes = np.random.default_rng(2).integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for size in (1, 3, 5, 9, 40):
        k = min(D.SHINGLE, size)
        shingles = [int(x) for x in D.shingle_hashes(hashes, k)]
        at = np.arange(0, 300 - size + 1, 3)
        for a, fp in zip(at, D.fingerprints(hashes, size, at)):
            own = shingles[a:a + size - k + 1]
            assert int(fp) == sum((2 * sum(h >> b & 1 for h in own) > len(own)) << b for b in range(64))


def test_edited_copies_are_found_as_brute_force_finds_them():
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(900)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([1, 3, 4, 5, 6, 9, 12, 17, 25, 38, 47, 60, 95, 140, 260])]
    index = D.Index(items)
    texts, want = [], []
    for k, item in items:
        for _ in range(12):
            w = item.split()
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + ["new"] + w[at:], w[:max(0, at - 1)] + w[at:], w[:max(0, at - 1)] + ["put"] + w[at:], w[1:], w[:-1]])
                w = w or ["new"]
            lead, tail = ([rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))] for _ in range(2))
            texts.append(" ".join(lead + w + tail).upper().replace(" ", rng.choice([" ", "\n", ", "])))
            want.append((k, best(item, texts[-1])))
    got = index.match(texts)
    found = [dict((i, s) for i, s, _ in row) for row in got]
    hits = [(k in f) for (k, _), f in zip(want, found)]
    assert all(s >= D.THRESHOLD for (_, s), h in zip(want, hits) if h)
    due = [h for (_, s), h in zip(want, hits) if s >= D.THRESHOLD]
    assert sum(due) >= 0.98 * len(due) and len(due) > 60


def edit(rng, item, kind):
    """A copy edited as far as similarity stays at THRESHOLD or above."""
    now, have = item, D.shingles(item)
    for _ in range(60):
        at = rng.randrange(len(now))
        word = b"new%d" % rng.randrange(10**9)
        new = {"change": now[:at] + [word] + now[at + 1:], "put in": now[:at] + [word] + now[at:], "left out": now[:at] + now[at + 1:],
               "cut off": rng.choice([now[1:], now[:-1]])}[kind if kind != "all" else rng.choice(["change", "put in", "left out", "cut off"])]
        if len(new) < 5 or D.similarity(have, D.shingles(new)) < D.THRESHOLD:
            break
        now = new
    return now


def test_recall_of_the_radius_on_edited_copies(monkeypatch):
    rng = random.Random(11)
    word = lambda: b"w%d" % rng.randrange(10**9)
    items = [(k, b" ".join(word() for _ in range(n)).decode()) for k, n in enumerate([10, 16, 21, 33, 40, 54, 59, 90, 130, 210, 400])]
    texts, due = [], []
    for kind in ("change", "put in", "left out", "cut off", "all"):
        for k, item in items:
            for _ in range(8):
                copy = edit(rng, item.encode().split(), kind)
                texts.append(b" ".join([word() for _ in range(rng.randrange(80))] + copy + [word() for _ in range(rng.randrange(80))]).decode())
                due.append((k, best(item, texts[-1])))
    index = D.Index(items)

    def recall():
        rows = [{i for i, _, _ in row} for row in index.match(texts)]
        hits = [k in row for (k, s), row in zip(due, rows) if s >= D.THRESHOLD]
        return sum(hits) / len(hits), len(hits)

    share, n = recall()
    assert n > 200 and share >= 0.98
    monkeypatch.setattr(D, "RADIUS", 3)
    assert recall()[0] < 0.8  # the radius does the work


def test_query_matches_brute_force(spark):
    docs_, items = common.documents(spark, SF).toPandas(), common.table(spark, SF, "benchmark").toPandas()
    got = {(r.doc_id, r.item_id): r.similarity for r in
           D.find_leaks(common.documents(spark, SF), common.table(spark, SF, "benchmark"), block_bytes=4000).collect()}
    runs = {i: set(D.shingles(word_list(t))) for i, t in zip(items.item_id, items.text)}
    texts = dict(zip(items.item_id, items.text))
    want = {}
    for d, text in zip(docs_.doc_id, docs_.text):
        have = set(D.shingles(word_list(text)))
        for i, r in runs.items():
            if len(r & have) * 2 > len(r):
                s = best(texts[i], text)
                if s >= D.THRESHOLD:
                    want[d, i] = s
    assert got == want and want


def test_edges(spark):
    item = "these nine words are one benchmark item for testing"
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, item), (5, "two words"), (6, item)], SCHEMA)
    rows = edge_rows() + [(200, f"start, {item.upper()}; end"), (200, f"start, {item.upper()}; end"), (201, "Two\nwords!"),
                          (202, item), (203, "these nine words are one benchmark item")]
    df = clashing(docs(spark, rows), "_found", "item_id", "similarity", "found")
    got = sorted((r.doc_id, r.item_id or 0) for r in D.find_leaks(df, items).collect())
    assert got == sorted([(200, 0), (200, 1), (200, 6)] * 2 + [(201, 5)] + [(202, 0), (202, 1), (202, 6)])
    kept = D.drop_contaminated(df, items)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted([i or 0 for i, *_ in edge_rows()] + [203])
    assert D.find_leaks(docs(spark, []), items).collect() == []
    assert D.find_leaks(df, items.limit(0)).collect() == [] and D.drop_contaminated(df, items.limit(0)).count() == len(rows)


def test_very_long_text_in_steps(monkeypatch):
    monkeypatch.setattr(D, "STEP", 100)
    item = " ".join(f"i{k}" for k in range(30))
    index = D.Index([(4, item)])
    for at in (0, 71, 95, 99, 100, 250, 470):
        text = [f"t{k}" for k in range(500)]
        text[at:at] = item.split()
        assert [(i, p) for i, _, p in index.match([" ".join(text)])[0]] == [(4, at)]

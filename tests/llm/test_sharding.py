import math
import zlib

import numpy as np
from helpers import clashing, docs, edge_rows

from orbita.llm import sharding
from orbita.session import scratch_path


def test_hypergeometric_moments_and_support():
    rng = np.random.default_rng(1)
    for good, bad, draws in [(5, 7, 6), (300, 900, 400), (10**12, 3 * 10**12, 10**6), (1, 10**9, 5), (4, 0, 3), (0, 4, 3)]:
        x = np.array([sharding.hypergeometric(rng, good, bad, draws) for _ in range(3000)])
        total = good + bad
        assert x.min() >= max(0, draws - bad) and x.max() <= min(good, draws)
        mean = draws * good / total
        var = mean * (bad / total) * (total - draws) / (total - 1)
        assert abs(x.mean() - mean) <= 5 * math.sqrt(var / len(x)) + 1e-9
        assert var == 0 or abs(x.var() / var - 1) < 0.2 or var < 0.01


def test_hypergeometric_probabilities():
    rng = np.random.default_rng(2)
    x = np.bincount([sharding.hypergeometric(rng, 4, 5, 3) for _ in range(20000)], minlength=4) / 20000
    want = [math.comb(4, k) * math.comb(5, 3 - k) / math.comb(9, 3) for k in range(4)]
    assert np.abs(x - want).max() < 0.02


def test_matrix_has_both_margins():
    m = sharding.communication_matrix([5, 0, 17, 300], [81, 81, 80, 80], 3)
    assert m.sum(axis=1).tolist() == [5, 0, 17, 300] and m.sum(axis=0).tolist() == [81, 81, 80, 80] and (m >= 0).all()


def check(got, n, shards=16):
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == n and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n


def test_documents(spark):
    rows = edge_rows()
    got = sharding.shard_documents(clashing(docs(spark, rows), "shard", "slot", "_key", "_cell")).collect()
    check(got, len(rows))
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    assert sharding.shard_documents(docs(spark, [])).collect() == []


def test_many_cells_and_buckets(spark):
    df = spark.range(5000).repartition(7)
    got = sharding.shard_rows(df, shards=4, rows_per_cell=50).collect()
    check(got, 5000, 4)
    # A uniform shuffle: neither shard nor slot follows the input order.
    for s in range(4):
        ids = [r.id for r in sorted((r for r in got if r.shard == s), key=lambda r: r.slot)]
        assert abs(np.mean(ids) - 2500) < 250 and abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.1


def test_equal_rows_are_dealt_evenly(spark):
    rows = [(7, "same text")] * 700 + [(i, f"text {i}") for i in range(300)]
    check(sharding.shard_documents(docs(spark, rows)).collect(), 1000)


def test_written_shards_hold_whole_rows_in_slot_order(spark):
    path = scratch_path(spark, "shards")
    rows = [(i, f"text {i}") for i in range(100)]
    sharding.write_shards(docs(spark, rows), path, shards=4)
    back = spark.read.parquet(path)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
    assert [r["count"] for r in back.groupBy("shard").count().collect()] == [25] * 4


def test_no_python_in_the_plan(spark):
    plan = sharding.shard_documents(docs(spark, edge_rows()))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

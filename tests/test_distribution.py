import numpy as np
import pandas as pd
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orbita.operators import distribution as D


def _dist(spark, values, buckets=4):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    return D.cumulative(D.to_long(df, ["x"]), buckets)


def test_percent_rank_average_ties(spark):
    pct = D.percent_rank_avg(_dist(spark, [1, 2, 2, 4])).orderBy(D.V).collect()
    assert [r["pct"] for r in pct] == [0.25, 0.625, 1.0]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40))
def test_percent_rank_matches_pandas(spark, values):
    got = {r[D.V]: r["pct"] for r in D.percent_rank_avg(_dist(spark, values, 3)).collect()}
    s = pd.Series(values, dtype=float)
    want = s.rank(pct=True)
    for v, p in zip(s, want):
        assert got[v] == p


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40),
       st.sampled_from([0.25, 0.33, 0.5, 0.6, 0.75]))
def test_quantile_matches_numpy(spark, values, q):
    dist = _dist(spark, values, 5)
    got = D.quantiles(dist, [("x", "t", q)]).collect()[0][D.V]
    assert got == float(np.quantile(np.array(values, float), q))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_median_matches_numpy(spark, values):
    got = D.medians(_dist(spark, values, 2)).collect()[0][D.V]
    assert got == float(np.median(np.array(values, float)))


def test_a_hot_value_is_one_counter(spark):
    values = [7.0] * 300 + list(range(100))
    dist = _dist(spark, values, 8)
    row = dist.filter(F.col(D.V) == 7.0).collect()[0]
    assert row["cnt"] == 301 and row["before"] == 7 and row["n"] == 400


def _largest_share(spark, values, buckets):
    """Distinct values in the largest bucket, as a multiple of the mean over all buckets."""
    df = spark.createDataFrame(pd.DataFrame({"x": np.asarray(values, float)}))
    rows = D.bucketed(D.to_long(df, ["x"]), buckets).groupBy("_b").count().collect()
    sizes = [r["count"] for r in rows]
    assert sum(sizes) == len(set(values)) and len(sizes) <= buckets
    return max(sizes) / (sum(sizes) / buckets)


def test_heavy_tails_and_outliers_fill_no_bucket(spark):
    rng = np.random.default_rng(3)
    lognormal = rng.lognormal(0, 4, 20_000)
    for values in (lognormal, np.append(rng.normal(size=20_000), 1e12), np.append(lognormal, [-1e300, 1e300])):
        assert _largest_share(spark, values.tolist(), 100) <= 3


def test_buckets_follow_the_order_of_values(spark):
    values = np.random.default_rng(5).lognormal(0, 6, 5000)
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    rows = D.bucketed(D.to_long(df, ["x"]), 16).orderBy(D.V).collect()
    buckets = [r["_b"] for r in rows]
    assert buckets == sorted(buckets) and set(buckets) == set(range(16))


def test_skewed_columns_match_pandas(spark):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame({"a": np.append(rng.lognormal(0, 5, 3000).round(1), 1e12), "b": np.repeat(7.0, 3001),
                          "c": np.append(rng.integers(0, 4, 3000), -1e9).astype(float)})
    dist = D.distribution(spark.createDataFrame(frame), ["a", "b", "c"], 32)
    got = {(r[D.K], r[D.V]): r["pct"] for r in D.percent_rank_avg(dist).collect()}
    for c in frame:
        for v, p in zip(frame[c], frame[c].rank(pct=True)):
            assert got[c, v] == p
    want = {(c, q): float(np.quantile(frame[c], q)) for c in frame for q in (0.25, 0.5, 0.9)}
    found = {(r[D.K], float(r["tag"])): r[D.V] for r in D.quantiles(dist, [(c, str(q), q) for c, q in want]).collect()}
    assert found == want


def test_no_values_no_rows(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert D.distribution(empty, ["x"], 4).count() == 0

import re
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, docs, edge_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from orbita.llm import common, features, quality, queries, weak_rules

SF = "/root/testdata/sf0.01"


def brute_counts(text):
    w = words(text)
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    seen, twice = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            twice += line in seen
            seen.add(line)
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), twice, len(covered)]


@given(st.lists(st.text(alphabet="ab é#|\n\t日", max_size=60), max_size=5))
@settings(max_examples=200, deadline=None)
def test_counts_of_a_batch(texts):
    c = features.count(texts)
    assert [[int(c[k][i]) for k in weak_rules.BASE] for i in range(len(texts))] == [brute_counts(t) for t in texts]
    assert [int(x) for x in c["distinct_words"]] == [len(set(words(t))) for t in texts]


def test_em_recovers_rule_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20000) < 0.8
    accuracy, v = [0.95, 0.9, 0.85, 0.8, 0.9], []
    for a in accuracy:
        right = rng.random(len(truth)) < a
        vote = np.where(right == truth, 1, -1)
        v.append(np.where(rng.random(len(truth)) < 0.3, 0, vote))
    v = np.column_stack(v)
    patterns, back, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    prior, p, evidence = weak_rules.fit(patterns, counts)
    assert ((evidence > 0.7) & (evidence <= 1)).all()  # independent rules
    assert abs(prior - 0.8) < 0.05
    for r, a in enumerate(accuracy):
        assert abs(p[r, 1] - a) < 0.04 and abs(p[r, 0] - a) < 0.06
    post = weak_rules.posterior(patterns, prior, p, evidence)[back.ravel()]
    assert ((post >= 0.5) == truth).mean() > 0.95
    assert (weak_rules.decode(weak_rules.codes(patterns), 5) == patterns).all()


def test_rules_that_vote_alike_count_as_one():
    rng = np.random.default_rng(6)
    truth = rng.random(5000) < 0.7
    votes = [np.where((rng.random(5000) < 0.85) == truth, 1, -1) for _ in range(3)]
    v = np.column_stack([*votes, votes[0], votes[0]])
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    evidence = weak_rules.dependence(patterns, counts)
    assert np.allclose(evidence[[0, 3, 4]], 1 / 3, atol=0.05) and (evidence[1:3] > 0.8).all()


def test_no_rule_is_a_veto(spark):
    """Accuracies stay off 0 and 1, single bad votes can be outvoted, and the posterior beats passing every rule."""
    docs_ = common.documents(spark, "/root/testdata/sf0.1")
    rows = common.written(weak_rules.counted(docs_), "votes-test")
    patterns = rows.groupBy("votes").count().toPandas().sort_values("votes")
    v = weak_rules.decode(patterns["votes"].to_numpy(dtype=np.int64))
    prior, p, evidence = weak_rules.fit(v, patterns["count"].to_numpy())
    assert (p > 0.001).all() and (p < 0.999).all()
    post = dict(zip(patterns["votes"], weak_rules.posterior(v, prior, p, evidence)))
    table = rows.join(common.table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where(~weak_rules.base_failed()).toPandas()
    bad = (weak_rules.decode(table["votes"].to_numpy(dtype=np.int64)) == -1).sum(axis=1)
    kept = table["votes"].map(post).to_numpy() >= weak_rules.KEEP
    assert kept[bad == 1].any() and kept[bad == 0].all()
    agree = lambda k: (k == (table["quality"].to_numpy() == 1)).mean()
    assert agree(kept) > agree(bad == 0) > 0.9  # labels are only read here


def test_rules_query(spark):
    rows = queries.QUERIES["op9_quality_rules"](spark, SF).toPandas().set_index("doc_id")
    table = common.documents(spark, SF).toPandas().set_index("doc_id")
    assert len(rows) == len(table)
    for i, text in table.text.items():
        base = brute_counts(text)
        assert rows.loc[i, weak_rules.BASE].tolist() == base
        assert rows.base_failed[i] == (base[0] < 20 or 100 * base[4] > 30 * base[0])
    assert not rows.kept[rows.base_failed].any()
    labels = common.table(spark, SF, "labels").toPandas().set_index("doc_id").join(rows)
    good = labels[(labels.quality == 1) & ~labels.base_failed]
    assert good.kept.mean() > 0.98 and labels[labels.quality == 0].kept.mean() < 0.05


def test_rules_edges(spark):
    df = clashing(docs(spark, edge_rows()), "votes", "n_words", "kept", "posterior")
    got = weak_rules.judge(df).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in got) == sorted((i or 0, len(words(t))) for i, t in edge_rows())
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 20)
    assert weak_rules.judge(docs(spark, [])).collect() == []


def test_classifier_held_out_accuracy(spark):
    got = queries.QUERIES["op7_quality"](spark, SF).toPandas().set_index("doc_id")
    labels = common.table(spark, SF, "labels").toPandas().set_index("doc_id").join(got)
    assert len(got) == common.documents(spark, SF).count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    held = labels[labels.held_out]
    assert (held.quality == held.predicted).mean() >= 0.95


def test_held_out_labels_are_never_read(spark):
    d, labels = common.documents(spark, SF), common.table(spark, SF, "labels")
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(quality.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(d, labels), quality.train(d, flipped)
    assert np.allclose(a["w"], b["w"]) and a["cut"] == b["cut"]


def test_pairs_give_the_order_of_a_linear_truth():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, quality.ratios(features.count(["a b"])).shape[1]))
    truth = x @ np.linspace(-1, 1, x.shape[1])
    y = (truth + rng.normal(size=3000) * 0.3 > np.quantile(truth, 0.2)).astype(int)
    model = quality.fit(x, y)
    s = quality.score(model, x)
    assert np.corrcoef(np.argsort(np.argsort(truth)), np.argsort(np.argsort(s)))[0, 1] > 0.95
    assert abs((s < quality.CUT).mean() - (y == 0).mean()) < 0.01  # the quantile


def test_classifier_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (3, None, 0), (None, 1, 0), (99, 1, 1), (7, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    df = clashing(docs(spark, edge_rows()), "_score", "score", "x", "y", "id", "quality")
    got = quality.classify(df, labels).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in got)
    none = quality.classify(docs(spark, edge_rows()), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(quality.CUT, 1)}
    assert quality.classify(docs(spark, []), labels).collect() == []


@pytest.mark.parametrize("n", [0, 3])
def test_sample_of_labels_is_bounded(spark, n):
    d, labels = common.documents(spark, SF), common.table(spark, SF, "labels")
    assert quality.train(d, labels, max_labelled=n)["cut"] is not None


def test_every_labelled_row_is_fitted_on(spark, monkeypatch):
    """More rows than a group holds, repeated ones and a rare class: mean, threshold and weights are those of all rows."""
    rng = np.random.default_rng(8)
    d = quality.ratios(features.count([""])).shape[1]
    x = np.round(rng.normal(size=(300, d)), 3)
    y = (x @ np.linspace(-1, 1, d) + rng.normal(size=300) > -3.5).astype(int)
    rows = [(int(a), b.tolist(), float(1 + i % 3)) for i, (a, b) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "y int, x array<double>, c double").repartition(3)
    times = np.arange(300) % 3 + 1
    whole = quality.fit(np.repeat(x, times, axis=0), np.repeat(y, times))
    got = quality.fit_rows(df)  # one group
    for k in ("mean", "scale", "w", "cut", "slope"):
        assert np.allclose(whole[k], got[k], atol=1e-6)
    monkeypatch.setattr(quality, "GROUP", 40)
    groups = quality.dealt(df, 300, int((y == 0).sum()), 0).collect()
    assert len(groups) == 8 and {tuple(r.x) for g in groups for r in g.rows} == {tuple(r) for r in x.tolist()}
    assert all({r.y for r in g.rows} == {0, 1} for g in groups)  # the rare class is in every group
    values = spark.createDataFrame([(float(v), 2.0) for v in rng.permutation(500)], "s double, c double")
    assert [quality.order_statistic(values, k, few=5) for k in (0, 1, 2, 501, 998, 999)] == [0, 0, 1, 250, 499, 499]

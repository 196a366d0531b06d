import numpy as np
import pytest
from helpers import clashing, docs, edge_rows
from pyspark.sql import functions as F

from orbita.llm import common, queries
from orbita.llm import toxicity as T

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_noisy_or_gradient_and_blame():
    """Bags: pattern 0 stands in toxic ones only, pattern 1 in both."""
    bags = [(1, 3, [[0], [1]])] * 20 + [(0, 5, [[1], [1]])] * 80 + [(0, 40, [])] * 20
    w, b = T.fit(bags, 2)
    p = lambda *k: float(T.sigmoid(b + sum(w[i] for i in k)))
    assert p(0) > 0.9 and p(1) < 0.1 and p() < 0.05

    def loss(theta):
        total = 0.0
        for y, blank, found in bags:
            q = (1 - T.sigmoid(theta[-1])) ** blank * np.prod([1 - T.sigmoid(theta[-1] + theta[s].sum()) for s in found])
            total -= np.log(1 - q) if y else np.log(q)
        return total / len(bags) + T.PRIOR / len(bags) / 2 * (theta[:-1] ** 2).sum()

    theta = np.append(w, b)
    best = loss(theta)
    for k in range(3):
        for step in (-0.3, 0.3):
            moved = theta.copy()
            moved[k] += step
            assert loss(moved) > best


def test_patterns_and_sentences():
    assert T.patterns_of(b"Ab, AB") == {" ab", "ab ", " ab "}
    text = "One. Two words! 3.5 is one\nlast é".encode()
    ends = T.sentence_ends(text)
    assert [text[a:b].strip() for a, b in zip([0, *ends], ends)] == [b"One.", b"Two words!", b"3.5 is one", "last é".encode()]
    assert T.sentence_ends(b"").tolist() == [0]
    m = T.Matcher([" two ", "one", " last "])
    assert m.sentences(text, ends) == {0: [1], 1: [0], 2: [1], 3: [2]}
    assert T.Matcher([]).sentences(text, ends) == {}
    # brute force: every pattern in every sentence on its own
    names = sorted(T.patterns_of(text))
    got = T.Matcher(names).sentences(text, ends)
    for s, (a, b) in enumerate(zip([0, *ends], ends)):
        assert {names[k] for k in got[s]} == T.patterns_of(text[a:b])


def small(spark):
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        middle = ["calm words here.", "You vileone of them."][bad]
        rows.append((i, f"Some clean text number w{i % 37}. {middle}\nThe end of it é {'x' * (i % 9)}."))
        labels.append((i, 1, int(bad)))
    return docs(spark, rows), spark.createDataFrame(labels, LABELS)


def test_documents_teach_sentences(spark):
    table, labels = small(spark)
    result = {r.doc_id: r for r in T.classify(table, labels).collect()}
    assert all(result[i].predicted == (i % 5 == 0) for i in range(600))
    model = T.train(table, labels)
    found = T.offending_sentences(table, model).collect()
    assert sorted(r.doc_id for r in found) == list(range(0, 600, 5))
    assert {r.sentence.strip() for r in found} == {"You vileone of them."}


def test_held_out_labels_are_never_read(spark):
    table, labels = small(spark)
    turned = labels.withColumn("toxic", F.when(T.is_held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    rows = lambda df: sorted((r.doc_id, round(r.score, 9)) for r in df.collect())
    assert rows(T.classify(table, labels)) == rows(T.classify(table, turned))


def test_held_out_accuracy(spark):
    result = queries.QUERIES["op11_toxicity"](spark, SF)
    rows = result.join(common.table(spark, SF, "labels"), "doc_id").where("held_out and toxic is not null").collect()
    clean = [r for r in rows if not r.toxic]
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in clean) <= 0.005 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= T.CUT) for r in rows)


def test_edges(spark):
    table, labels = small(spark)
    odd = clashing(docs(spark, edge_rows()), "found", "score", "_found")
    out = T.classify(odd, labels).collect()
    assert len(out) == len(edge_rows())
    assert {r.score for r in out if r.doc_id in (2, 3)} == {0.0} and sum(r.doc_id is None for r in out) == 2
    assert len({r.score for r in out if r.doc_id == 1}) == 1
    assert not any(r.held_out for r in out if r.doc_id is None)
    nulls = spark.createDataFrame([(None, 1, 1), (1, None, None), (999_999, 1, 1)], LABELS)
    for bad in (nulls, labels.where("toxic = 0"), labels.where("toxic = 1"), labels.limit(0)):
        assert all(0 <= r.score <= T.CUT / 2 and not r.predicted for r in T.classify(table, bad).collect())
    assert T.classify(docs(spark, []), labels).count() == 0
    model = T.train(table, labels)
    assert T.with_findings(odd, model, "mine").columns == [*odd.columns, "mine"]
    assert T.offending_sentences(odd, model).count() == 0


@pytest.mark.parametrize("text", ["", " ", "\n\n", "é" * 10, "vile. " * 5000])
def test_spans_cover_text(text):
    model = T.Model(["vile"], np.array([30.0]), -10.0)
    score, spans = model.judge(text.encode())
    assert (score > 0.5) == ("vile" in text) and all(text[a:b].strip() == "vile." for a, b, _ in spans)

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from orbita.contracts import ID
from orbita.errors import ModelInputRefused
from orbita.functions.kneedle import elbow_convex_decreasing
from orbita.operators import certificates as CE
from orbita.operators import elbow as EL
from orbita.operators import screening as SCR
from orbita.operators import segment as SG


def frame(n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 50, 0.01] + [0, 1e6, 3]
    y = 2 * x[:, 0] - 0.5 * x[:, 1] + 100 * x[:, 2] + rng.normal(size=n)
    return pd.DataFrame({ID: np.arange(n), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y,
                         "l": (x[:, 0] + rng.normal(size=n) > 0.4).astype(int)})


def test_ols_matches_numpy(spark):
    data = frame()
    got = {r["variable"]: r for r in CE.ols(spark.createDataFrame(data), ["a", "b", "c"], "y").collect()}
    x = np.column_stack([data[["a", "b", "c"]].to_numpy() - data[["a", "b", "c"]].to_numpy().mean(0), np.ones(len(data))])
    want = np.linalg.lstsq(x, data["y"], rcond=None)[0]
    for k, f in enumerate("abc"):
        assert abs(got[f]["coeficiente"] / want[k] - 1) < 1e-6 and abs(got[f]["residuo"]) < 1e-9


def test_ols_refuses_ambiguous_input(spark):
    data = frame().assign(d=lambda t: 2 * t["a"] + t["b"], k=1.0)
    for features in (["a", "b", "d"], ["a", "k"]):
        with pytest.raises(ModelInputRefused):
            CE.ols(spark.createDataFrame(data), features, "y")
    with pytest.raises(ModelInputRefused):
        CE.ols(spark.createDataFrame(data).limit(0), ["a"], "y")


def test_the_gradient_is_that_of_the_penalised_loss(spark):
    data = frame()
    got = {r["variable"]: r for r in CE.logistic(spark.createDataFrame(data), ["a", "b"], "l").collect()}
    assert max(abs(r["gradiente"]) for r in got.values()) < 1e-7
    z = (data[["a", "b"]] - data[["a", "b"]].mean()) / data[["a", "b"]].std(ddof=0)
    w, b = np.array([got["a"]["peso"], got["b"]["peso"]]), got["(intercepto)"]["peso"]

    def loss(w, b):
        m = z.to_numpy() @ w + b
        return np.mean(np.logaddexp(0, m) - data["l"] * m) + 0.5 / len(data) * (w @ w)

    assert all(loss(w + d, b) > loss(w, b) for d in 1e-3 * np.array([[1, 0], [-1, 0], [0, 1], [0, -1]]))
    assert loss(w, b + 1e-3) > loss(w, b) < loss(w, b - 1e-3)


def test_components_solve_the_eigen_equation(spark):
    data = spark.createDataFrame(frame())
    rows = CE.pca_certificate(data, ["a", "b", "c", "y"], 3).collect()
    corr = np.corrcoef(frame()[["a", "b", "c", "y"]].to_numpy().T)
    assert np.allclose([r["varianza"] for r in rows], np.sort(np.linalg.eigvalsh(corr))[::-1][:3])
    assert all(r["residuo"] < 1e-9 and abs(r["varianza_filas"] - r["varianza"]) < 1e-9 for r in rows)
    scores = CE.pca_scores(data, ["a", "b", "c", "y"], ID).toPandas()
    assert abs(np.corrcoef(scores["pc1"], scores["pc2"])[0, 1]) < 1e-9


def brute_silhouette(x, labels, i):
    d = np.sqrt(((x - x[i]) ** 2).sum(1))
    own = labels == labels[i]
    if own.sum() == 1:
        return 0.0
    a = d[own].sum() / (own.sum() - 1)
    b = min(d[labels == k].mean() for k in set(labels.tolist()) - {labels[i]})
    return (b - a) / max(a, b) if max(a, b) else 0.0


def test_silhouette_sample_is_exact(spark):
    rng = np.random.default_rng(2)
    labels = np.array(["p"] * 40 + ["q"] * 25 + ["r"])
    x = rng.normal(size=(66, 3)) + (labels == "q")[:, None] * 2.0
    x[5] = x[6] = x[7]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(**{ID: np.arange(66), "seg": labels}))
    got = {r["seg"]: r for r in SG.silhouette_sample(df.repartition(5), "seg", list("abc"), per_segment=100, tile=7).collect()}
    for k in "pqr":
        mean = np.mean([brute_silhouette(x, labels, i) for i in np.flatnonzero(labels == k)])
        assert abs(got[k]["silhouette"] - mean) < 1e-9 and got[k]["margen"] == 0
        assert got[k]["muestra"] == got[k]["usuarios"] == (labels == k).sum()
    part = {r["seg"]: r for r in SG.silhouette_sample(df, "seg", list("abc"), per_segment=10).collect()}
    assert part["p"]["muestra"] == 10 and part["p"]["margen"] > 0 and abs(part["p"]["silhouette"] - got["p"]["silhouette"]) < 3 * part["p"]["margen"]
    with pytest.raises(ModelInputRefused):
        SG.check_segments(df, ID, most=20)


def curves(spark, ys):
    rows = [(c, k + 1, float(v)) for c, y in enumerate(ys) for k, v in enumerate(y)]
    return spark.createDataFrame(rows, "c int, k int, y double")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=9), min_size=1, max_size=25))
def test_elbows_by_windows_equal_the_loop(spark, ys):
    got = {r["c"]: r["elbow"] for r in EL.elbow_k(curves(spark, ys), "c", "k", "y").collect()}
    for c, y in enumerate(ys):
        assert got[c] == elbow_convex_decreasing(list(range(1, len(y) + 1)), y), y


def test_a_plain_elbow(spark):
    assert [r["elbow"] for r in EL.elbow_k(curves(spark, [[100, 40, 12, 10, 9, 8, 7]]), "c", "k", "y").collect()] == [3]


def test_screening_equals_plain_folds(spark):
    data = frame(120).assign(fold=lambda t: t[ID] * 7 % 4, k=1.0)
    got = {r["modelo"]: r for r in SCR.cv_single_features(spark.createDataFrame(data).repartition(5), ["a", "b", "c", "k"], "y").collect()}
    for f in "abc":
        scores = []
        for k in range(4):
            train, test = data[data["fold"] != k], data[data["fold"] == k]
            b, a = np.polyfit(train[f] - train[f].mean(), train["y"], 1)
            left = test["y"] - a - b * (test[f] - train[f].mean())
            scores.append(1 - (left ** 2).sum() / ((test["y"] - test["y"].mean()) ** 2).sum())
        assert abs(got[f]["cv_mean"] - np.mean(scores)) < 1e-8 and abs(got[f]["cv_std"] - np.std(scores)) < 1e-8
    assert got["k"]["cv_mean"] is None  # a constant has no line

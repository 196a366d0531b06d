import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder

from orbita.operators import grown as G
from orbita.operators import ledger as L
from orbita.operators import models as M
from orbita.operators import supervised as SV
from orbita.sources import shared


def data(n=150, d=4, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.normal(size=n) * 1e6, np.ones(n)])[:, :d]
    return x, x[:, 0] * 3 + x[:, 1] ** 2 + rng.normal(size=n), rng.integers(0, 3, n)


def plainly(x, y, w, depth):
    """The answer of each row, by trying every cut."""
    inside = w > 0
    out = np.full(len(y), np.average(y, weights=w))
    if depth == 0 or np.ptp(y[inside]) == 0:
        return out
    best = (np.inf, None)
    for j in range(x.shape[1]):
        v = np.unique(x[inside, j])
        for cut in (v[1:] + v[:-1]) / 2:
            sides = [(x[:, j] <= cut), (x[:, j] > cut)]
            loss = sum((w[s] * (y[s] - np.average(y[s], weights=w[s])) ** 2).sum() for s in sides)
            if loss < best[0] - 1e-9:
                best = (loss, sides)
    for s in best[1] or []:
        out[s] = plainly(x[s], y[s], w[s], depth - 1)
    return out


@pytest.mark.parametrize("classes", [False, True])
def test_every_cut_is_tried(classes):
    x, y, w = data()
    y = (y > 6).astype(float) if classes else y
    f, v, c, imp, seen = G.grow(x, y, G.presorted(x), w, 3, x.shape[1], None, x, [1, 2, 3])
    for depth, got in zip((1, 2, 3), seen):
        assert got == pytest.approx(plainly(x, y, w, depth))
        short = G.grow(x, y, G.presorted(x), w, depth, x.shape[1], None)  # the top of a deeper tree
        assert G.answers(x, *short[:3]) == pytest.approx(got)
    assert imp[0] > 0 and imp[3] == 0 and (f >= 0).sum() <= 7


def test_trees_split_until_rows_agree_and_few_columns_are_drawn():
    x, y, w = data()
    f, v, c, _, _ = G.grow(x, y, G.presorted(x), w, 200, 4, None)
    assert np.array_equal(G.answers(x[w > 0], f, v, c), y[w > 0]) and 3 not in f
    f, v, c, _, _ = G.grow(x, y, G.presorted(x), w, 200, 1, np.random.default_rng(0))
    assert np.array_equal(G.answers(x[w > 0], f, v, c), y[w > 0]) and {0, 1, 2} <= set(f)
    same = np.ones((5, 2))  # alike rows of other targets, and one target
    assert list(G.grow(same, np.arange(5.0), G.presorted(same), np.ones(5, int), 9, 2, None)[1]) == [2.0]
    assert list(G.grow(x, np.full(len(x), 7.5), G.presorted(x), w, 9, 4, None)[1]) == [7.5]


@pytest.fixture(scope="module")
def rows(spark):
    of = [(i, float(i % 17), float(i % 5), 3.0 * (i % 17) - (i % 5) + (i * 37 % 11) / 7, int((i * 37 % 11) + i % 5 > 7)) for i in range(1, 201)]
    return SV.folds(spark.createDataFrame(of, "id_cliente long, a double, b double, y double, c int")).coalesce(1).cache()


def forest(label, trees, depth=4):
    rf = G.GrownForest(featuresCol="v", labelCol=label, seed=3, maxDepth=depth, numTrees=trees, idCol="id_cliente", classes=2 * (label == "c"))
    return Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v"), rf])


@pytest.mark.parametrize("label", ["y", "c"])
def test_a_model_is_the_mean_of_its_trees(spark, rows, tmp_path, label):
    model = forest(label, 13).fit(rows.repartition(3))
    model.write().save(str(tmp_path / "m"))
    got = PipelineModel.load(str(tmp_path / "m")).transform(rows).orderBy("id_cliente")
    trees = model.stages[-1].table().orderBy("tree").collect()
    assert [t["tree"] for t in trees] == list(range(13))
    x = np.array(rows.orderBy("id_cliente").select("a", "b").collect())
    y = np.array([float(r[0]) for r in rows.orderBy("id_cliente").select(label).collect()])
    presort, want = G.presorted(x), 0
    for t in range(13):  # each tree draws from the seed and its number, not from partitions
        rng = np.random.default_rng([3, t])
        w = np.bincount(rng.integers(0, 200, 200), minlength=200)
        want = want + G.answers(x, *G.grow(x, y, presort, w, 4, 2, rng)[:3]) / 13
    if label == "y":
        assert [r["prediction"] for r in got.collect()] == pytest.approx(list(want))
    else:
        for r, p in zip(got.select("prediction", vector_to_array("probability").alias("p")).collect(), want):
            assert r["p"] == pytest.approx([1 - p, p]) and r["prediction"] == float(p > 0.5)
    imp = model.stages[-1].featureImportances.toArray()
    assert imp.sum() == pytest.approx(1) and [r["variable"] for r in M.feature_importance(model, ["a", "b"]).collect()][0] == "ab"[imp.argmax()]


@pytest.mark.parametrize("label", ["y", "c"])
def test_a_tree_is_grown_once_a_fold_for_the_whole_grid(spark, rows, tmp_path, label):
    p, evaluator = forest(label, 1), M.r2_evaluator("y") if label == "y" else M.f1_evaluator("c")
    rf = p.getStages()[-1]
    grid = ParamGridBuilder().addGrid(rf.numTrees, [5, 12]).addGrid(rf.maxDepth, [2, 5]).build()
    cand = [M.Candidate("forest", p, grid, lambda pm: f"{pm[rf.numTrees]},{pm[rf.maxDepth]}")]
    ledger = L.FitLedger(spark, "t", rows, root=str(tmp_path))
    found = M.select(rows, rows, cand, evaluator, 2, ledger)
    n, depth = map(int, found.winner_params.split(","))
    written = [r for r in shared.names(spark, f"{ledger.folder}/votes") if r.endswith(".json")]
    assert len(written) == 2 * 3 + 2 * len(G.blocks(forest(label, n)))  # 0-5, 5-10, 10-12 of each fold, then the refits
    for trees, d in [(12, 5), (5, 2)] if label == "y" else [(12, 5)]:  # with columns drawn, a deeper tree's top has draws of its own
        model = forest(label, trees, d).fit(rows.where("fold != 0"))
        want = evaluator.evaluate(model.transform(rows.where("fold = 0")))
        assert ledger.scores()["forest", f"{trees},{d}", 0] == pytest.approx(want)
    assert len(ledger.scores()) == 8
    again = M.select(rows, rows, cand, None, 2, ledger)  # everything is recorded
    at = lambda m: [r[0] for r in m.transform(rows).orderBy("id_cliente").select("prediction").collect()]
    assert at(again.production_model) == pytest.approx(at(forest(label, n, depth).fit(rows)))


def test_forests_of_a_table_that_fits_a_task_are_grown_there(spark):
    at = lambda n: [G.is_grown(c[1].pipeline) for c in (M.regression_candidates(["a"], "y", rows=n),
                                                         M.classification_candidates(["a"], "c", 10, rows=n))]
    assert at(G.LOCAL_ROWS) == [True, True] and at(G.LOCAL_ROWS + 1) == at(None) == [False, False]

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from orbita.operators import grown as G
from orbita.operators import ledger as L
from orbita.operators import models as M
from orbita.operators import supervised as SV


@pytest.fixture(scope="module")
def rows(spark):
    of = [(i, float(i % 17), float(i % 5), 3.0 * (i % 17) - (i % 5) + (i * 37 % 11) / 7, int((i * 37 % 11) + i % 5 > 7)) for i in range(1, 121)]
    return SV.folds(spark.createDataFrame(of, "id_cliente long, a double, b double, y double, c int")).coalesce(1).cache()


def forest_of(label, size):
    """The selection's forest for a table of this size."""
    found = M.regression_candidates(["a", "b"], "y", rows=size) if label == "y" else M.classification_candidates(["a", "b"], "c", 100, rows=size)
    return found[1]


@pytest.mark.parametrize("label", ["y", "c"])
def test_a_forest_does_not_depend_on_the_size_of_the_table(spark, rows, label):
    told = []
    for size in (G.LOCAL_ROWS, G.LOCAL_ROWS + 1):
        p = forest_of(label, size).pipeline
        rf = p.getStages()[-1]
        model = p.copy({rf.numTrees: 12, rf.maxDepth: 5}).fit(rows.repartition(2))
        answer = "prediction" if label == "y" else vector_to_array("probability")[1].alias("p")
        told.append([r[0] for r in model.transform(rows).orderBy("id_cliente").select(answer).collect()])
    assert told[0] == told[1]


@pytest.mark.parametrize("label", ["y", "c"])
def test_selection_scores_and_model_do_not_depend_on_the_size_of_the_table(spark, rows, tmp_path, label):
    told = []
    for size in (G.LOCAL_ROWS, G.LOCAL_ROWS + 1):
        cand = forest_of(label, size)
        rf = cand.pipeline.getStages()[-1]
        few = [{rf.numTrees: 3, rf.maxDepth: 2}, {rf.numTrees: 3, rf.maxDepth: 30}]
        cand = M.Candidate(cand.name, cand.pipeline, few, cand.describe)
        ledger = L.FitLedger(spark, f"t{size}", rows, root=str(tmp_path))
        found = M.select(rows, rows, [cand], M.r2_evaluator("y") if label == "y" else M.f1_evaluator("c"), 2, ledger)
        told.append((ledger.scores(), found.winner_params, [r[0] for r in found.holdout_model.transform(rows).orderBy("id_cliente").select("prediction").collect()]))
    assert told[0] == told[1]


def test_columns_in_files_give_the_same_tree():
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=300), rng.integers(0, 5, 300), np.ones(300)]).astype(float)
    y = np.round(x[:, 0] * 3 + x[:, 1] + rng.normal(size=300), 2)
    both = []
    for filed in (False, True):
        store = G.Store(filed)
        table = store.stacked([x[:100], x[100:101], x[101:]])
        assert np.array_equal(table, x) and np.array_equal(store.columns(table, np.arange(300)[::-1]), x[::-1])
        both.append(list(G.bootstrapped(table, y, 30, 2, 5, range(2), x[:20], [1, 30], store)))
    for a, b in zip(*both):
        assert all(np.array_equal(p, q) for p, q in zip(a, b))


def test_rows_without_an_id_are_grown_from(spark, rows):
    more = rows.unionByName(rows.limit(1).selectExpr("cast(null as long) id_cliente", "a", "b", "y", "c", "cast(null as int) fold"))
    p = forest_of("y", 10).pipeline
    block = G.blocks(p.copy({p.getStages()[-1].numTrees: 2}))[0]
    assert block.votes(more, 0, "id_cliente").count() == rows.where("fold = 0").count()

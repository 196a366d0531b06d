import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from orbita.operators import forest as FO
from orbita.operators import ledger as L
from orbita.operators import models as M
from orbita.operators import supervised as SV
from orbita.sources import shared


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(FO, "DEEP", 2)
    monkeypatch.setattr(FO, "DEEP_BLOCK", 2)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, float(i % 17), float(i % 5), 3.0 * (i % 17) - (i % 5) + (i * 37 % 11) / 7, int((i * 37 % 11) + i % 5 > 7)) for i in range(1, 201)]
    return SV.folds(spark.createDataFrame(data, "id_cliente long, a double, b double, y double, c int")).coalesce(1).cache()


def forest(kind, label, trees):
    rf = kind(featuresCol="v", labelCol=label, seed=3, maxDepth=3, numTrees=trees, cacheNodeIds=True)
    return Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v"), rf])


def fitted(pipeline, rows):
    return FO.joined([FO.with_vote_column(p, b).fit(rows) for b, p in enumerate(FO.blocks(pipeline))])


def test_blocks_hold_every_tree_and_a_shorter_forest_is_a_prefix(spark, small_blocks):
    names = [FO.block_name(p) for p in FO.blocks(forest(RandomForestRegressor, "y", 5))]
    assert [n.split("numTrees=")[1].split(",")[0] for n in names] == ["2", "2", "1"] and len(set(names)) == 3
    assert names[:2] == [FO.block_name(p) for p in FO.blocks(forest(RandomForestRegressor, "y", 4))]
    one = forest(RandomForestRegressor, "y", 2)
    assert FO.blocks(one) == [one]


@pytest.mark.parametrize("kind, label", [(RandomForestRegressor, "y"), (RandomForestClassifier, "c")])
def test_a_joined_forest_answers_with_all_its_trees(spark, rows, small_blocks, tmp_path, kind, label):
    model = fitted(forest(kind, label, 5), rows)
    model.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    got = [r.asDict() for r in loaded.transform(rows).orderBy("id_cliente").collect()]
    assert "votes" not in got[0] and not [c for c in got[0] if c.startswith("votes_")]
    trees = [t for s in model.stages if hasattr(s, "trees") for t in s.trees]
    assert len(trees) == 5
    x = model.stages[0].transform(rows).orderBy("id_cliente").collect()
    for want, r in list(zip(x, got))[::20]:
        if kind is RandomForestRegressor:
            assert r["prediction"] == pytest.approx(sum(t.predict(want["v"]) for t in trees) / 5, rel=1e-12)
        else:
            p = sum(t.predictProbability(want["v"])[1] for t in trees) / 5
            assert r["probability"][1] == pytest.approx(p, abs=1e-12) and sum(r["probability"]) == pytest.approx(1)
            assert r["prediction"] == float(r["probability"][1] > r["probability"][0])
    votes = [FO.block_votes(p.fit(rows), rows, "id_cliente") for p in FO.blocks(forest(kind, label, 5))]
    joined = FO.joined_votes(votes[0].unionByName(votes[1]).unionByName(votes[2]), "id_cliente", 5, label)
    for a, r in zip(joined.orderBy("id_cliente").collect(), got):
        assert a["prediction"] == pytest.approx(r["prediction"], rel=1e-12) and a[label] == r[label]
    imp = FO.importances(loaded)
    each = sum(t.featureImportances.toArray() for t in trees) / 5
    assert imp == pytest.approx(each, rel=1e-9) and imp.sum() == pytest.approx(1)
    assert [r["variable"] for r in M.feature_importance(loaded, ["a", "b"]).collect()] == ["a", "b"][:: 1 if imp[0] > imp[1] else -1]


def test_one_block_is_the_plain_forest(rows):
    p = forest(RandomForestClassifier, "c", 3)
    a, b = p.fit(rows).transform(rows), FO.blocks(p)[0].fit(rows).transform(rows)
    at = lambda df: [list(r[0]) for r in df.orderBy("id_cliente").select(vector_to_array("probability")).collect()]
    assert at(a) == at(b)


def test_selection_fits_each_block_once(spark, rows, small_blocks, tmp_path):
    p = forest(RandomForestClassifier, "c", 2)
    rf = p.getStages()[-1]
    grid = ParamGridBuilder().addGrid(rf.numTrees, [4, 6]).build()
    cand = [M.Candidate("forest", p, grid, lambda pm: f"t={pm[rf.numTrees]}")]
    ledger = L.FitLedger(spark, "t", rows, root=str(tmp_path))
    found = M.select(rows, rows, cand, M.f1_evaluator("c"), 2, ledger)
    # Two folds of three blocks: the forest of 4 trees has none of its own; each refit has those of the winner.
    assert len([n for n in shared.names(spark, f"{ledger.folder}/votes") if n.endswith(".json")]) == 6
    assert len(ledger.scores()) == 4
    n = int(found.winner_params.split("=")[1])
    assert sum(s.getNumTrees for s in found.production_model.stages if hasattr(s, "trees")) == n
    for k in range(2):
        model = fitted(forest(RandomForestClassifier, "c", 4), rows.where(F.col("fold") != k))
        want = M.f1_evaluator("c").evaluate(model.transform(rows.where(F.col("fold") == k)))
        assert ledger.scores()["forest", "t=4", k] == pytest.approx(want, abs=1e-12)
    again = M.select(rows, rows, cand, None, 2, ledger)  # everything is recorded
    at = lambda m: [r[0] for r in m.transform(rows).orderBy("id_cliente").select("prediction").collect()]
    assert at(again.holdout_model) == at(found.holdout_model)

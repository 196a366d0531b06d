import json
from threading import Barrier

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from orbita.operators import ledger as L
from orbita.operators import models as M
from orbita.operators import supervised as SV
from orbita.sources import shared


def table(spark):
    rows = [(i, float(i % 17), float(i % 5), 3.0 * (i % 17) - (i % 5) + (i * 37 % 11) / 7) for i in range(1, 201)]
    return SV.folds(spark.createDataFrame(rows, "id_cliente long, a double, b double, y double")).cache()


def candidates():
    va = VectorAssembler(inputCols=["a", "b"], outputCol="v")
    rf = RandomForestRegressor(featuresCol="v", labelCol="y", seed=1)
    grid = ParamGridBuilder().addGrid(rf.numTrees, [2, 3]).addGrid(rf.maxDepth, [2]).build()
    return [M.Candidate("lin", Pipeline(stages=[va, LinearRegression(featuresCol="v", labelCol="y")]), [{}], lambda pm: "ols"),
            M.Candidate("forest", Pipeline(stages=[va, rf]), grid, lambda pm: f"t={pm[rf.numTrees]}")]


class Flaky:
    """An evaluator that dies after some calls."""

    def __init__(self, inner, calls):
        self.inner, self.left = inner, calls

    def evaluate(self, df):
        if self.left == 0:
            raise RuntimeError("killed")
        self.left -= 1
        return self.inner.evaluate(df)


def test_a_killed_selection_goes_on(spark, tmp_path):
    rows, at = table(spark), str(tmp_path)
    r2 = M.r2_evaluator("y")
    with pytest.raises(RuntimeError):
        M.select(rows, rows, candidates(), Flaky(r2, 6), 5, L.FitLedger(spark, "t", rows, root=at), parallelism=1)
    again = L.FitLedger(spark, "t", rows.repartition(3), root=at)  # a new session finds the same records
    assert len(again.scores()) == 6
    count = Flaky(r2, 9)  # the nine fits that are left, and no more
    found = M.select(rows, rows, candidates(), count, 5, again, parallelism=2)
    assert count.left == 0 and len(again.scores()) == 15
    assert (found.winner_name, found.winner_params) == ("lin", "ols")
    once = M.select(rows, rows, candidates(), Flaky(r2, 0), 5, again)  # everything is recorded, the models too
    assert sorted(map(tuple, once.cv_table.collect())) == sorted(map(tuple, found.cv_table.collect()))
    fresh = M.select(rows, rows, candidates(), r2, 5, L.FitLedger(spark, "t", rows, root=f"{at}/other"))
    for a, b in zip(sorted(fresh.cv_table.collect()), sorted(found.cv_table.collect())):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9 and abs(a[3] - b[3]) < 1e-9
    p = lambda m: [r["prediction"] for r in m.transform(rows.orderBy("id_cliente")).collect()]
    assert p(once.production_model) == p(found.production_model)


def test_cv_scores_are_those_of_plain_fits(spark, tmp_path):
    rows = table(spark)
    found = M.select(rows, rows, candidates()[:1], M.r2_evaluator("y"), 5, L.FitLedger(spark, "t", rows, root=str(tmp_path)))
    scores = []
    for k in range(5):
        model = candidates()[0].pipeline.fit(rows.where(F.col("fold") != k))
        scores.append(M.r2_evaluator("y").evaluate(model.transform(rows.where(F.col("fold") == k))))
    mean = sum(scores) / 5
    row = found.cv_table.first()
    assert abs(row["cv_mean"] - mean) < 1e-12 and abs(row["cv_std"] - (sum((s - mean) ** 2 for s in scores) / 5) ** 0.5) < 1e-12


def test_other_rows_other_ledger(spark, tmp_path):
    rows, at = table(spark), str(tmp_path)
    folder = lambda *dfs: L.FitLedger(spark, "t", *dfs, root=at).folder
    assert folder(rows) == folder(rows.repartition(7).select(*reversed(rows.columns)))
    changed = rows.withColumn("a", F.when(F.col("id_cliente") == 7, 99.0).otherwise(F.col("a")))
    assert len({folder(rows), folder(changed), folder(rows.unionByName(rows)), folder(rows.limit(199)), folder(rows, rows),
                folder(rows.withColumnRenamed("a", "z"))}) == 6


def test_a_model_is_recorded_when_it_is_whole(spark, tmp_path):
    rows, calls = table(spark), []
    ledger = L.FitLedger(spark, "t", rows, root=str(tmp_path))

    def fit():
        calls.append(1)
        return candidates()[0].pipeline.fit(rows)

    (tmp_path / "x").mkdir()
    first = ledger.model("production", fit)
    assert isinstance(first, PipelineModel) and isinstance(ledger.model("production", fit), PipelineModel) and len(calls) == 1
    assert json.loads(shared.read(spark, f"{ledger.folder}/production.json"))["path"].startswith(ledger.folder)


def test_both_refits_run_at_once(spark, tmp_path):
    rows, ledger = table(spark), L.FitLedger(spark, "t", spark.range(1), root=str(tmp_path))
    everything = rows.unionByName(rows.where("fold = 0"))
    plain, met, fitted = candidates()[0], Barrier(2, timeout=60), []

    class Meeting:
        def copy(self, pm):
            return self

        def fit(self, df):  # each refit waits until the other has begun
            met.wait()
            fitted.append(df.count())
            return plain.pipeline.fit(df)

    for k in range(5):
        ledger.record("lin", "ols", k, 0.5)
    found = M.select(rows, everything, [M.Candidate("lin", Meeting(), [{}], lambda pm: "ols")], M.r2_evaluator("y"), 5, ledger)
    assert sorted(fitted) == [rows.count(), everything.count()]
    for model, df in ((found.holdout_model, rows), (found.production_model, everything)):
        assert list(model.stages[-1].coefficients) == list(plain.pipeline.fit(df).stages[-1].coefficients)

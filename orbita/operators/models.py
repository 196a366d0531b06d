"""Supervised model selection with Spark ML.

Every candidate (estimator x grid point) is cross-validated on the
deterministic ``fold`` column (stratified for classification), so folds do not
depend on partitioning.  The winner is chosen by mean CV score only; the
test split is an audit.  Candidate fits run concurrently from driver threads,
each one distributed, and are kept in a ledger (:mod:`.ledger`).  Forests over a table that fits
a task are grown in tasks, a tree for all its depths at once (:mod:`.grown`); those over larger tables are Spark ML's,
fitted in blocks of trees (:mod:`.forest`).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import FOREST_DEPTHS, FOREST_TREES, ID, LOGISTIC_C, RANDOM_STATE
from . import forest as FO
from . import grown as G
from .ledger import FitLedger

VEC = "features_vec"
# Spark trees are capped at depth 30: "no limit" maps to the cap.
SPARK_MAX_DEPTH = 30


def _depth(d):
    return SPARK_MAX_DEPTH if d is None else d


def _forest(rows: int | None) -> type:
    """Where a task keeps its rows; the trees are the same."""
    return G.GrownForest if rows is not None and rows <= G.LOCAL_ROWS else G.FiledForest


@dataclass
class Candidate:
    name: str
    pipeline: Pipeline
    grid: list
    describe: callable


@dataclass
class Selection:
    cv_table: DataFrame  # modelo, parametros, cv_mean, cv_std
    winner_name: str
    winner_params: str
    holdout_model: PipelineModel  # fitted on train
    production_model: PipelineModel  # refit on all rows


def regression_candidates(features: list[str], target: str, seed: int = RANDOM_STATE, rows: int | None = None) -> list[Candidate]:
    """``rows``: number of all rows; tasks keep at most ``LOCAL_ROWS`` in memory."""
    va = VectorAssembler(inputCols=features, outputCol=VEC)
    lin = LinearRegression(featuresCol=VEC, labelCol=target, regParam=0.0, solver="normal")
    # all features per split for regression, sqrt for classification (the usual forest defaults)
    rf = _forest(rows)(featuresCol=VEC, labelCol=target, seed=seed, idCol=ID)
    rf_grid = ParamGridBuilder().addGrid(rf.numTrees, FOREST_TREES) \
        .addGrid(rf.maxDepth, [_depth(d) for d in FOREST_DEPTHS]).build()
    return [
        Candidate("linear_regression", Pipeline(stages=[va, lin]), [{}], lambda pm: "ols"),
        Candidate("random_forest", Pipeline(stages=[va, rf]), rf_grid,
                  lambda pm: f"numTrees={pm[rf.numTrees]},maxDepth={pm[rf.maxDepth]}"),
    ]


def classification_candidates(features: list[str], target: str, n_train: int,
                              seed: int = RANDOM_STATE, rows: int | None = None) -> list[Candidate]:
    """L2 logistic regression with C in the reference grid: regParam = 1 / (C * n)."""
    va = VectorAssembler(inputCols=features, outputCol=VEC)
    lr = LogisticRegression(featuresCol=VEC, labelCol=target, elasticNetParam=0.0, maxIter=1000)
    lr_grid = ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n_train) for c in LOGISTIC_C]).build()
    rf = _forest(rows)(featuresCol=VEC, labelCol=target, seed=seed, idCol=ID, classes=2)
    rf_grid = ParamGridBuilder().addGrid(rf.numTrees, FOREST_TREES) \
        .addGrid(rf.maxDepth, [_depth(d) for d in FOREST_DEPTHS]).build()
    return [
        Candidate("logistic_regression", Pipeline(stages=[va, lr]), lr_grid,
                  lambda pm: f"C={1.0 / (pm[lr.regParam] * n_train):.4g}"),
        Candidate("random_forest", Pipeline(stages=[va, rf]), rf_grid,
                  lambda pm: f"numTrees={pm[rf.numTrees]},maxDepth={pm[rf.maxDepth]}"),
    ]


def _fits(candidates: list[Candidate], n_folds: int) -> list[tuple]:
    """(candidate, grid point, description, fold) of every fit, the most expensive first."""
    out = []
    for cand in candidates:
        for pm in cand.grid:
            cost = 1
            for param, value in pm.items():
                cost *= value if param.name in ("numTrees", "maxDepth") else 1
            out += [(cost, cand, pm, cand.describe(pm), fold) for fold in range(n_folds)]
    return [f[1:] for f in sorted(out, key=lambda f: (-f[0], f[4]))]


def select(train: DataFrame, everything: DataFrame, candidates: list[Candidate], evaluator, n_folds: int,
           ledger: FitLedger, parallelism: int | None = None) -> Selection:
    """Cross-validate every candidate on ``fold``; winner by mean CV score, refitted on train and on all rows.

    Every fit is looked up in the ledger first and recorded when it is done, so an interrupted selection
    repeats no fit.  Fits run concurrently from ``parallelism`` driver threads, each one distributed; so do those of the
    two refits, which wait for the winner only.  The blocks of a large forest are such fits, and two candidates
    of other numbers of trees share theirs.
    """
    workers = parallelism or max(4, min(16, train.sparkSession.sparkContext.defaultParallelism))
    known = ledger.scores()
    open_fits = [f for f in _fits(candidates, n_folds) if (f[0].name, f[2], f[3]) not in known]

    def score(fit, predicted: DataFrame) -> None:
        cand, _, desc, fold = fit
        ledger.record(cand.name, desc, fold, float(evaluator.evaluate(predicted)))

    def whole(fit) -> None:
        cand, pm, _, fold = fit
        model = cand.pipeline.copy(pm).fit(train.filter(F.col("fold") != fold))
        score(fit, model.transform(train.filter(F.col("fold") == fold)))

    def block(unit) -> str:
        (name, fold, named), pipeline = unit
        if isinstance(pipeline, G.Block):
            return ledger.votes(name, named, fold, lambda: pipeline.votes(train, fold, ID))
        return ledger.votes(name, named, fold, lambda: FO.block_votes(
            pipeline.fit(train.filter(F.col("fold") != fold)), train.filter(F.col("fold") == fold), ID))

    units, in_blocks = {}, []  # every block once, the dearest first, as in open_fits
    for fit in open_fits:
        cand, pm, _, fold = fit
        if G.has_blocks(cand.pipeline):  # its blocks answer for the whole grid
            forest = cand.pipeline.copy(pm).getStages()[-1]
            parts = [b for b in G.blocks(cand.pipeline, cand.grid) if b.stop <= forest.getNumTrees()]
            keys = [(cand.name, fold, b.name) for b in parts]
            units.update(zip(keys, parts))
            in_blocks.append((fit, keys, forest))
            continue
        parts = FO.blocks(cand.pipeline.copy(pm))
        if len(parts) == 1:
            units[cand.name, fold, fit[2]] = fit
            continue
        keys = [(cand.name, fold, FO.block_name(p)) for p in parts]
        units.update({k: units.get(k, p) for k, p in zip(keys, parts)})
        in_blocks.append((fit, keys, parts))

    def one(unit):
        return block(unit) if isinstance(unit[1], (Pipeline, G.Block)) else whole(unit[1])

    def join(of) -> None:
        fit, keys, parts = of
        if isinstance(parts, G.Forest):
            votes = G.block_votes(train.sparkSession.read.parquet(*[paths[k] for k in keys]), parts, ID)
            score(fit, FO.joined_votes(votes, ID, parts.getNumTrees(), parts.getLabelCol()))
            return
        forest = [p.getStages()[-1] for p in parts]
        votes = train.sparkSession.read.parquet(*[paths[k] for k in keys])
        score(fit, FO.joined_votes(votes, ID, sum(f.getNumTrees() for f in forest), forest[0].getLabelCol()))

    if open_fits:
        with ThreadPoolExecutor(max_workers=workers) as pool:
            paths = dict(zip(units, pool.map(one, units.items())))
            list(pool.map(join, in_blocks))
    table = cv_table(ledger)
    first = {(c.name, c.describe(pm)): -k for k, (c, pm) in enumerate((c, pm) for c in candidates for pm in c.grid)}
    rows = [r for r in table.collect() if (r["modelo"], r["parametros"]) in first]  # one row per candidate
    top = max(rows, key=lambda r: (r["cv_mean"], first[r["modelo"], r["parametros"]]))
    cand = next(c for c in candidates if c.name == top["modelo"])
    point = next(pm for pm in cand.grid if cand.describe(pm) == top["parametros"])
    best = cand.pipeline.copy(point)
    parts = G.blocks(best) if G.has_blocks(best) else FO.blocks(best)
    jobs = [(which, rows, b) for which, rows in (("holdout", train), ("production", everything)) for b in range(len(parts))]

    def refit(job) -> PipelineModel | str:
        which, rows, b = job
        if isinstance(parts[b], G.Block):
            return ledger.votes(f"{which}:{cand.name}", parts[b].name, -1, lambda: parts[b].trees(rows, ID))
        if len(parts) == 1:
            return ledger.model(which, lambda: parts[0].fit(rows))
        return ledger.model(f"{which}-{b}", lambda: FO.with_vote_column(parts[b], b).fit(rows))

    with ThreadPoolExecutor(max_workers=max(2, workers)) as pool:  # one partition's fit holds one core
        models = list(pool.map(refit, jobs))
    n = len(parts)
    halves = [("holdout", models[:n]), ("production", models[n:])]
    if G.has_blocks(best):
        both = [ledger.model(which, lambda: G.joined(parts[0].head, parts[0].forest, paths)) for which, paths in halves]
    else:
        both = [m[0] if n == 1 else FO.joined(m) for _, m in halves]
    return Selection(table, top["modelo"], top["parametros"], *both)


def cv_table(ledger: FitLedger) -> DataFrame:
    """(modelo, parametros, cv_mean, cv_std) from the recorded fits (population standard deviation over folds)."""
    return (ledger.table().groupBy("modelo", "parametros")
            .agg(F.avg("score").alias("cv_mean"), F.stddev_pop("score").alias("cv_std")))


def r2_evaluator(target: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=target, predictionCol="prediction", metricName="r2")


def f1_evaluator(target: str) -> MulticlassClassificationEvaluator:
    """F1 of the positive class (label 1)."""
    return MulticlassClassificationEvaluator(labelCol=target, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def positive_probability(col: str = "probability") -> F.Column:
    return vector_to_array(F.col(col))[1]


def feature_importance(model: PipelineModel, features: list[str]) -> DataFrame | None:
    """(variable, importancia) sorted descending; empty when the model has none."""
    imp = FO.importances(model)
    rows = [] if imp is None else [(f, float(v)) for f, v in zip(features, imp)]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "variable string, importancia double").orderBy(F.desc("importancia"))


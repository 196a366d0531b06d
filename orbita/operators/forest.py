"""Forests grown in blocks of trees.

The trees of a random forest do not depend on each other, but one fit of Spark ML grows
all of them in the tasks of one input partition and holds them on the driver.  Here a forest
is a sequence of blocks, each an ordinary fit with a seed of its own: blocks
run at once and are recorded one by one, and two forests that differ only in
their number of trees share their first blocks, as the reference's forests of one ``random_state`` share
their first trees.  A forest's answer is that of all its trees: the mean of their predictions, or the class with the
largest sum of their probabilities.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trees a block, by depth: a shallow tree costs little beside what any fit costs.
DEEP, DEEP_BLOCK, SHALLOW_BLOCK = 10, 20, 100
# Spark ML draws from the seed plus the number of a partition: blocks keep well apart.
SEED_STEP = 1_000_003
VOTES = "votes"


def blocks(pipeline) -> list[Pipeline]:
    """The pipelines of a forest's blocks; any other pipeline, and a forest of one block, as it is."""
    rf = pipeline.getStages()[-1] if isinstance(pipeline, Pipeline) else None
    if not isinstance(rf, (RandomForestClassifier, RandomForestRegressor)):
        return [pipeline]
    n, size = rf.getNumTrees(), DEEP_BLOCK if rf.getMaxDepth() > DEEP else SHALLOW_BLOCK
    if n <= size:
        return [pipeline]
    return [Pipeline(stages=[*pipeline.getStages()[:-1],
                             rf.copy({rf.numTrees: min(size, n - at), rf.seed: rf.getSeed() + SEED_STEP * (at // size)})])
            for at in range(0, n, size)]


def block_name(block: Pipeline) -> str:
    """What tells a block from the other blocks of its candidate."""
    rf = block.getStages()[-1]
    return f"maxDepth={rf.getMaxDepth()},numTrees={rf.getNumTrees()},seed={rf.getSeed()}"


def block_votes(model: PipelineModel, rows: DataFrame, id_col: str) -> DataFrame:
    """(id, label, votes): the sum over the block's trees, one number, or one a class."""
    forest = model.stages[-1]
    label = F.col(forest.getLabelCol()).alias("label")
    votes = (vector_to_array(F.col(forest.getRawPredictionCol())) if hasattr(forest, "numClasses")
             else F.array(F.col(forest.getPredictionCol()) * forest.getNumTrees))
    return model.transform(rows).select(id_col, label, votes.alias(VOTES))


def joined_votes(votes: DataFrame, id_col: str, trees: int, label: str) -> DataFrame:
    """(id, label, prediction) of a forest of ``trees`` trees from its blocks' votes; ids are unique in the rows scored."""
    width = votes.select(F.max(F.size(VOTES))).first()[0] or 1  # classes, or 1
    sums = votes.groupBy(id_col, "label").agg(F.array(*[F.sum(F.col(VOTES)[k]) for k in range(width)]).alias(VOTES))
    return sums.select(id_col, F.col("label").alias(label), _answer(F.col(VOTES), trees, width).alias("prediction"))


def _answer(votes: Column, trees: int, width: int) -> Column:
    if width == 1:
        return votes[0] / trees
    return (F.array_position(votes, F.array_max(votes)) - 1).cast("double")  # the first of equals, as in Spark ML


class ForestVote(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Last stage of a forest in blocks: joins what the blocks' stages left in ``votes_0``, ``votes_1``, ..."""

    blockTrees = Param(Params._dummy(), "blockTrees", "trees of each block", TypeConverters.toListInt)
    classes = Param(Params._dummy(), "classes", "number of classes, 0 in regression", TypeConverters.toInt)

    def __init__(self, trees: list[int] | None = None, classes: int = 0):
        super().__init__()
        self._set(blockTrees=trees or [], classes=classes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, classes = self.getOrDefault(self.blockTrees), self.getOrDefault(self.classes)
        names = [f"{VOTES}_{b}" for b in range(len(trees))]
        if not classes:
            total = reduce(lambda a, b: a + b, [F.col(c) * n for c, n in zip(names, trees)])
            return dataset.withColumn("prediction", total / sum(trees)).drop(*names)
        sums = F.array(*[reduce(lambda a, b: a + b, [vector_to_array(F.col(c))[k] for c in names]) for k in range(classes)])
        return (dataset.withColumn(VOTES, sums).withColumn("rawPrediction", array_to_vector(VOTES))
                .withColumn("probability", array_to_vector(F.transform(VOTES, lambda v: v / sum(trees))))
                .withColumn("prediction", _answer(F.col(VOTES), sum(trees), classes)).drop(VOTES, *names))


def with_vote_column(block: Pipeline, b: int) -> Estimator:
    """The block, leaving nothing but its votes in a column of its own."""
    *head, rf = block.getStages()
    columns = {rf.predictionCol: f"{VOTES}_{b}"}
    if isinstance(rf, RandomForestClassifier):
        columns = {rf.rawPredictionCol: f"{VOTES}_{b}", rf.probabilityCol: "", rf.predictionCol: ""}
    return Pipeline(stages=[*head, rf.copy(columns)])


def joined(models: list[PipelineModel]) -> PipelineModel:
    """One model of the fitted blocks (fitted by ``with_vote_column``'s pipelines)."""
    forests = [m.stages[-1] for m in models]
    vote = ForestVote([f.getNumTrees for f in forests], getattr(forests[0], "numClasses", 0))
    return PipelineModel([*models[0].stages[:-1], *forests, vote])


def importances(model: PipelineModel) -> np.ndarray | None:
    """Feature importances of a forest, in blocks or not; None for any other model."""
    found = [s for s in model.stages if hasattr(s, "featureImportances")]
    if len(found) < 2:
        return found[0].featureImportances.toArray() if found else None
    # Spark ML gives a block's mean over its trees that split.
    weights = [sum(t.numNodes > 1 for t in s.trees) for s in found]
    total = sum(w * s.featureImportances.toArray() for w, s in zip(weights, found))
    return total / max(1, sum(weights))

"""Forests whose trees are grown whole in Spark tasks, the same trees whatever the size of the table.

A task keeps the columns of at most ``LOCAL_ROWS`` rows in memory, and those of more in files of its own that it passes over in order.

Spark ML keeps ``features x bins`` statistics a node, also for nodes of two rows, and shuffles them: at full depth that is nearly all of
its time.  Here a task reads the rows once and grows a block of trees from presorted columns, level by level, with
exact splits (a cut between any two neighbouring values, not between 32 bins).  As in the reference, a tree draws its bootstrap
from its seed alone, splits until its rows are of one target or alike, and
forests of one seed share trees: the forest of 100 is the first half of that of 200, and a tree of depth 5 is the top of the
unlimited one.  So each tree is grown once a fold and answers for every number of trees and depth of the grid.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .segment import LOCAL_ROWS  # noqa: F401  (the bound of this module too)

#: Trees a block: enough that a fit's fixed part is small, few enough that the cores end together.
BLOCK = 10
TREES = "tree int, feature binary, cut binary, child binary, importance array<double>"
X, Y = "_x", "_y"


# ---- where columns are kept ---------------------------------------------------------------

class Store:
    """Arrays of a task: in memory, or (``filed``) in nameless temporary files that go with the task, of which the system keeps in memory what it can.

    Trees do not depend on it."""

    def __init__(self, filed: bool = False):
        self.filed = filed

    def empty(self, shape: tuple, dtype) -> np.ndarray:
        if not self.filed or 0 in shape:
            return np.empty(shape, dtype)
        with tempfile.TemporaryFile() as f:
            return np.asarray(np.memmap(f, dtype, "w+", shape=shape))

    def stacked(self, parts) -> np.ndarray:
        """These pieces of rows (one at least) as one table."""
        if not self.filed:
            return np.concatenate(list(parts))
        n = 0
        with tempfile.TemporaryFile() as f:
            for p in parts:
                f.write(np.ascontiguousarray(p, float))
                n += len(p)
            f.flush()
            return np.asarray(np.memmap(f, float, "r", shape=(n, p.shape[1])))

    def columns(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """These rows, kept column by column."""
        out = self.empty((x.shape[1], len(rows)), float)
        for j in range(len(out)):
            out[j] = x[:, j][rows]
        return out.T


# ---- one tree ---------------------------------------------------------------------------

def presorted(x: np.ndarray, store: Store = Store()) -> tuple[np.ndarray, np.ndarray]:
    """(order, code) of each column: rows by value, and each row's rank among the distinct values."""
    n, d = x.shape
    whole = np.int32 if n < 2**31 else np.int64
    order, code = store.empty((d, n), whole), store.empty((d, n), whole)
    for j in range(d):
        o = np.argsort(x[:, j], kind="stable")
        v = x[:, j][o]
        order[j] = o
        code[j][o] = np.cumsum(np.r_[0, v[1:] != v[:-1]][:n])
    return order, code


def grow(x: np.ndarray, y: np.ndarray, presort: tuple, weight: np.ndarray, depth: int, subset: int, rng,
         held: np.ndarray | None = None, depths: list[int] = (), store: Store = Store()) -> tuple:
    """One tree: (feature or -1, cut or answer, left child) of each node, importances, and ``held``'s answers at ``depths``.

    Least squares, which for targets 0 and 1 chooses the cuts of the Gini index.  At each node ``subset`` of the columns that vary there
    are drawn.  A node's right child follows its left one; rows above the cut go right.
    """
    bag, d, code = np.flatnonzero(weight), x.shape[1], presort[1]
    rows, moved = (store.empty((d, len(bag)), presort[0].dtype) for _ in range(2))
    for j, o in enumerate(presort[0]):  # a column: rows by (open node, value)
        rows[j] = o[weight.take(o) > 0]
    w = weight.astype(float)
    mean = np.average(y[bag], weights=w[bag])
    wy = w * (y - mean)
    most = 2 * len(bag)
    feature, cut, child = np.full(most, -1, np.int16), np.empty(most), np.zeros(most, np.int32)
    answer, importance = np.empty(most), np.zeros(d)
    answer[0], n_nodes = mean, 1
    nodes, counts = np.zeros(1, np.int64), np.array([len(bag)])
    where, seen, level = np.zeros(0 if held is None else len(held), np.int64), {}, 0
    right, side = np.zeros(len(y), bool), np.zeros(len(y), np.int8)
    if y[bag].min() == y[bag].max():
        answer[0], nodes = y[bag[0]], nodes[:0]
    while len(nodes) and level < depth:
        m, node = counts.sum(), np.repeat(np.arange(len(nodes)), counts)
        starts, ends, r = np.cumsum(counts) - counts, np.cumsum(counts) - 1, rows[0, :m].astype(np.intp)
        total_w, total = np.add.reduceat(w[r], starts), np.add.reduceat(wy[r], starts)
        taken = np.stack([code[j].take(rows[j].take(starts)) != code[j].take(rows[j].take(ends)) for j in range(d)], axis=1)
        if subset < d:
            draw = np.where(taken, rng.random(taken.shape), 2.0)
            taken &= draw <= np.partition(draw, subset - 1, axis=1)[:, [subset - 1]]
        best, place = np.full((len(nodes), d), -np.inf), np.zeros((len(nodes), d), np.int64)
        for j in range(d):
            of = np.flatnonzero(taken[:, j])  # the nodes where this column is tried
            if not len(of):
                continue
            o = rows[j, :m].astype(np.intp)
            c, ws, ys = code[j].take(o), np.cumsum(w.take(o)), np.cumsum(wy.take(o))
            before, before_w = ys[starts] - wy[o[starts]], ws[starts] - w[o[starts]]
            ends_here = c[1:] != c[:-1]
            ends_here[starts[1:] - 1] = False
            if len(of) < len(nodes):
                ends_here &= np.repeat(taken[:, j], counts)[1:]
            p = np.flatnonzero(ends_here)  # a cut may lie after these
            k = node.take(p)
            left_w, left = ws.take(p) - before_w.take(k), ys.take(p) - before.take(k)
            score = left * left / left_w + (total.take(k) - left) ** 2 / (total_w.take(k) - left_w)
            first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            top = np.maximum.reduceat(score, first)
            hit = np.flatnonzero(score == np.repeat(top, np.diff(np.r_[first, len(k)])))
            hit = hit[np.r_[True, k[hit[1:]] != k[hit[:-1]]]]
            best[of, j], place[of, j] = top, p[hit]
        f = best.argmax(axis=1)
        gain = best[np.arange(len(nodes)), f]
        split = np.flatnonzero(np.isfinite(gain))
        if not len(split):
            break
        f, p = f[split], place[split, f[split]]
        importance += np.bincount(f, np.maximum(gain[split] - total[split] ** 2 / total_w[split], 0), d)
        last = rows[f, p]
        low, high = x[last, f], x[rows[f, p + 1], f]
        middle = low + (high - low) / 2
        ids = nodes[split]
        feature[ids], cut[ids], child[ids] = f, np.where(middle < high, middle, low), n_nodes + 2 * np.arange(len(split))
        # The rows of nodes that split, by child: each column keeps its order on both sides.
        splits = np.zeros(len(nodes), bool)
        splits[split] = True
        side[r] = 0
        r = r[np.repeat(splits, counts)]
        k = np.repeat(np.arange(len(split)), counts[split])
        right[r] = code[f[k], r] > code[f, last][k]
        goes = right[r]
        n_right = np.bincount(k[goes], minlength=len(split))
        sizes = np.stack([counts[split] - n_right, n_right], axis=1).ravel()
        kid = np.repeat(np.arange(len(sizes)), sizes)
        by_kid = np.empty(len(r), np.intp)
        by_kid[kid & 1 == 0], by_kid[kid & 1 == 1] = r[~goes], r[goes]
        at, r = np.cumsum(sizes) - sizes, by_kid
        of_rows = y[r]
        least, largest = np.minimum.reduceat(of_rows, at), np.maximum.reduceat(of_rows, at)
        kids = n_nodes + np.arange(len(sizes))
        answer[kids] = np.where(least == largest, least, mean + np.add.reduceat(wy[r], at) / np.add.reduceat(w[r], at))
        n_nodes, level = n_nodes + len(sizes), level + 1
        still = least < largest
        nodes, counts = kids[still], sizes[still]
        if level < depth and len(nodes):  # rows of children that stay open: 1 left, 2 right
            stays = still[kid]
            side[r] = np.where(stays, 1 + (kid & 1), 0)
            kid = kid[stays]
            lefts, rights = np.flatnonzero(kid & 1 == 0), np.flatnonzero(kid & 1)
            moved[0, :len(kid)] = r[stays]
            for j in range(1, d):
                o = rows[j, :m]
                goes = side.take(o)
                moved[j][lefts], moved[j][rights] = o[goes == 1], o[goes == 2]
            rows, moved = moved, rows
        where = descend(where, held, feature, cut, child) if held is not None else where
        if level in depths:
            seen[level] = answer[where]
    leaf = feature[:n_nodes] < 0
    value = np.where(leaf, answer[:n_nodes], cut[:n_nodes])
    return feature[:n_nodes], value, child[:n_nodes], importance, [seen.get(k, answer[where]) for k in depths]


def descend(node: np.ndarray, x: np.ndarray, feature: np.ndarray, cut: np.ndarray, child: np.ndarray) -> np.ndarray:
    """One step down for the rows whose node has children."""
    i = np.flatnonzero(feature[node] >= 0)
    n = node[i]
    node[i] = child[n] + (x[i, feature[n]] > cut[n])
    return node


def answers(x: np.ndarray, feature: np.ndarray, value: np.ndarray, child: np.ndarray) -> np.ndarray:
    node, i = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(i := i[feature[node[i]] >= 0]):
        n = node[i]
        node[i] = child[n] + (x[i, feature[n]] > value[n])
    return value[node]


# ---- blocks of trees --------------------------------------------------------------------

@dataclass(frozen=True)
class Block:
    """Trees ``start`` to ``stop`` of the deepest forest of a grid; they answer for each of ``depths``."""

    head: tuple  # transformers that make the feature vector
    forest: Forest
    start: int
    stop: int
    depths: tuple[int, ...]

    @property
    def name(self) -> str:
        return f"trees={self.start}-{self.stop},maxDepth={','.join(map(str, self.depths))},seed={self.forest.getSeed()}"

    def _rows(self, rows: DataFrame, id_col: str, *more: str) -> DataFrame:
        ship_package(rows.sparkSession)
        for stage in self.head:
            rows = stage.transform(rows)
        label = F.col(self.forest.getLabelCol()).cast("double").alias(Y)
        return rows.select(id_col, label, *more, vector_to_array(self.forest.getFeaturesCol()).alias(X)).coalesce(1)

    def votes(self, rows: DataFrame, fold: int, id_col: str) -> DataFrame:
        """(id, label, trees, depth_<k>...) of the rows of ``fold``: sums of the answers of trees grown on the others."""
        seed, subset, depths, filed = self.forest.getSeed(), self.forest.subset, list(self.depths), self.forest.filed
        trees, out = range(self.start, self.stop), [f"depth_{k}" for k in self.depths]

        def run(batches):
            store = Store(filed)
            x, got = gathered(batches, store)
            by_id = np.asarray(pc.sort_indices(got[id_col]))  # bootstraps draw from rows in id order
            y, test = got[Y].to_numpy(), got["fold"].to_numpy(zero_copy_only=False) == fold
            grown, kept = by_id[~test[by_id]], by_id[test[by_id]]
            held = x[kept]
            x = store.columns(x, grown)
            sums = np.zeros((len(depths), len(kept)))
            for tree in bootstrapped(x, y[grown], depths[-1], subset(x.shape[1]), seed, trees, held, depths, store):
                sums += tree[-1]
            told = [got[id_col].take(pa.array(kept)), pa.array(y[kept]), pa.array(np.full(len(kept), len(trees), np.int32)), *map(pa.array, sums)]
            yield pa.record_batch(told, [id_col, "label", "trees", *out])

        schema = f"{id_col} long, label double, trees int, {', '.join(f'{c} double' for c in out)}"
        return self._rows(rows, id_col, "fold").mapInArrow(run, schema)

    def trees(self, rows: DataFrame, id_col: str) -> DataFrame:
        """(tree, feature, cut, child, importance) of each tree, grown on all ``rows``."""
        seed, subset, depth, trees = self.forest.getSeed(), self.forest.subset, self.depths[-1], range(self.start, self.stop)
        filed = self.forest.filed

        def run(batches):
            store = Store(filed)
            x, got = gathered(batches, store)
            by_id = np.asarray(pc.sort_indices(got[id_col]))
            x, y = store.columns(x, by_id), got[Y].to_numpy()[by_id]
            for t, (f, v, c, imp, _) in zip(trees, bootstrapped(x, y, depth, subset(x.shape[1]), seed, trees, store=store)):
                told = [pa.array([t], pa.int32()), *(pa.array([part.tobytes()], pa.binary()) for part in (f, v, c)),
                        pa.array([imp / (imp.sum() or 1)], pa.list_(pa.float64()))]
                yield pa.record_batch(told, ["tree", "feature", "cut", "child", "importance"])

        return self._rows(rows, id_col).mapInArrow(run, TREES)


def gathered(batches, store: Store) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """(features, other columns) of a task's rows; the features go to the store as they come."""
    others = []

    def features():
        for b in batches:
            if b.num_rows:
                others.append(b.drop_columns([X]))
                yield b.column(X).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)

    x, got = store.stacked(features()), pa.Table.from_batches(others)
    return x, {c: pa.concat_arrays(got[c].chunks) for c in got.column_names}


def bootstrapped(x, y, depth: int, subset: int, seed: int, trees, held=None, depths=(), store: Store = Store()):
    """The trees of these numbers; each draws from its number and the seed alone, so from row order (by id), not partitions."""
    presort = presorted(x, store)
    for t in trees:
        rng = np.random.default_rng([seed, t])
        weight = np.bincount(rng.integers(0, len(y), len(y)), minlength=len(y))
        yield grow(x, y, presort, weight, depth, subset, rng, held, depths, store)


def has_blocks(pipeline) -> bool:
    """Whether the pipeline ends in a forest of this module."""
    return isinstance(pipeline, Pipeline) and isinstance(pipeline.getStages()[-1], Forest)


def is_grown(pipeline) -> bool:
    """Whether its forest is one that is grown in memory."""
    return isinstance(pipeline, Pipeline) and isinstance(pipeline.getStages()[-1], GrownForest)


def blocks(pipeline: Pipeline, grid: list | None = None) -> list[Block]:
    """The blocks of a pipeline's forest, or of all forests of its grid."""
    forests = [pipeline.copy(pm).getStages()[-1] for pm in grid or [{}]]
    ends = {f.getNumTrees() for f in forests}
    ends = sorted(ends | set(range(BLOCK, max(ends), BLOCK)))
    depths = tuple(sorted({f.getMaxDepth() for f in forests}))
    return [Block(tuple(pipeline.getStages()[:-1]), forests[0], a, b, depths) for a, b in zip([0, *ends], ends)]


def block_votes(votes: DataFrame, forest: Forest, id_col: str) -> DataFrame:
    """(id, label, votes) of what :meth:`Block.votes` left, for one depth, as in :mod:`.forest`."""
    of = F.col(f"depth_{forest.getMaxDepth()}")
    return votes.select(id_col, "label", (F.array(F.col("trees") - of, of) if forest.getClasses() else F.array(of)).alias("votes"))


# ---- estimator and model ------------------------------------------------------------------

class _ForestParams(HasFeaturesCol, HasLabelCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels below the root", TypeConverters.toInt)
    classes = Param(Params._dummy(), "classes", "2 (labels 0 and 1), or 0 in regression", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "row key, orders the rows a bootstrap draws from", TypeConverters.toString)

    def getNumTrees(self) -> int:
        return self.getOrDefault(self.numTrees)

    def getMaxDepth(self) -> int:
        return self.getOrDefault(self.maxDepth)

    def getClasses(self) -> int:
        return self.getOrDefault(self.classes)


class Forest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Random forest; all columns a split in regression, a square root of them in classification."""

    filed = False

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", seed=0, numTrees=100, maxDepth=30, classes=0, idCol="id"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol="features", labelCol="label", seed=0, numTrees=100, maxDepth=30, classes=0, idCol="id")

    @property
    def subset(self):
        all_of_them = not self.getClasses()
        return lambda d: d if all_of_them else int(np.ceil(np.sqrt(d)))

    def model(self, paths: list[str]) -> GrownForestModel:
        """The model of the trees in these folders."""
        return GrownForestModel(paths)._set(featuresCol=self.getFeaturesCol(), classes=self.getClasses())

    def _fit(self, dataset: DataFrame) -> GrownForestModel:
        path, id_col = scratch_path(dataset.sparkSession, "forest"), self.getOrDefault(self.idCol)
        parts = [b.trees(dataset, id_col) for b in blocks(Pipeline(stages=[self]))]
        reduce(DataFrame.unionByName, parts).write.parquet(path)
        return self.model([path])


class GrownForest(Forest):
    """Keeps the rows in a task's memory: for at most ``LOCAL_ROWS``."""


class FiledForest(Forest):
    """The same trees, bit for bit; a task keeps the columns in files, and in memory some numbers a row."""

    filed = True


class _TreesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table().write.parquet(f"{path}/trees")


class _TreesReader(DefaultParamsReader):
    def load(self, path: str) -> GrownForestModel:
        found = super().load(path)
        found.paths = [f"{path}/trees"]
        return found


class GrownForestModel(Model, _ForestParams, MLReadable, MLWritable):
    """Mean of the trees' answers; the trees (14 bytes a node) are read and broadcast when the model is first used."""

    def __init__(self, paths: list[str] | None = None):
        super().__init__()
        self.paths, self._trees = paths or [], None
        self._setDefault(featuresCol="features", classes=0)

    def write(self) -> DefaultParamsWriter:
        return _TreesWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _TreesReader(cls)

    def table(self) -> DataFrame:
        return SparkSession.active().read.schema(TREES).parquet(*self.paths)

    @property
    def featureImportances(self) -> DenseVector:
        """Mean over the trees that split, adding up to 1."""
        each = np.array([r["importance"] for r in self.table().select("importance").collect()])
        each = each[each.sum(axis=1) > 0]
        return DenseVector(each.mean(axis=0) / each.mean(axis=0).sum() if len(each) else np.zeros(0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        ship_package(spark)
        if self._trees is None:
            rows = self.table().select("feature", "cut", "child").collect()
            self._trees = spark.sparkContext.broadcast([tuple(map(bytes, r)) for r in rows])
        trees = self._trees

        @F.pandas_udf("double")
        def mean(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=float)
            x, total = np.stack(vectors.to_numpy()), np.zeros(len(vectors))
            for f, v, c in trees.value:
                total += answers(x, np.frombuffer(f, np.int16), np.frombuffer(v), np.frombuffer(c, np.int32))
            return pd.Series(total / len(trees.value))

        got = dataset.withColumn("prediction", mean(vector_to_array(self.getFeaturesCol())))
        if not self.getClasses():
            return got
        p = F.col("prediction")
        return (got.withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (p > 1 - p).cast("double")))


def joined(head: tuple, forest: Forest, paths: list[str]) -> PipelineModel:
    return PipelineModel([*head, forest.model(paths)])

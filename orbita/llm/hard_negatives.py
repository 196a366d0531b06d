"""Hard negatives of anchors by a vertical scan of the vectors (BOND).

Vectors are quantised to integers.  An anchor's positives are its nearest rows of the same label; its
hard negatives, for each positive, are the nearest rows of other labels whose score lies in a window
relative to the positive's score.  Scores are integer inner products; ties go to the smaller id.

Rows and anchors are dealt to the cells of a grid (row groups by anchor groups).  A cell keeps its rows
dimension by dimension.  For each anchor, dimensions are read in descending magnitude of the anchor's
components, a few at a time.  The least and largest value of each unread dimension bound what it may still
contribute, so that every candidate has a lower and an upper score bound; candidates that can no longer be
among the best, or inside a window, leave the candidate bitmap.  What is left when all dimensions are read
has its exact score.  A cell's best rows are merged by a window over (anchor) or (anchor, positive).

The grid compares the anchors (a stated query set) with all rows: work is rows x anchors whatever the layout.
Cells are bounded by parameters; anchor groups are taken ``ROUND_GROUPS`` at a time, each round's result is written,
so shuffled copies of the rows are bounded too.  Nothing is collected or broadcast.

Defined cases: rows with a null id, label, vector or component, or a component that is not finite, take no
part; of rows that share an id only that of the least (label, quantised vector) does; shorter vectors count as padded with
zeros; an anchor without positives, or a positive without negatives, gives no rows; scores beyond 64 bits raise an error;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bound_batches, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score between which a negative's score must lie.
LOW, HIGH = 50, 95
EVERY = 50
#: Rows and anchors of one cell of the grid, anchor groups of one round, and dimensions read between two prunings.
ROWS, ANCHORS, ROUND_GROUPS, STEP = 16_384, 8_192, 32, 8


def quantised(rows: DataFrame, label: Column) -> DataFrame:
    """``vec_id, label, v``: one row per id, components as integers."""
    value = F.col("embedding")
    usable = F.forall(value, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))  # NaN is above infinity
    return (rows.where(F.col("vec_id").isNotNull() & label.isNotNull() & value.isNotNull() & usable)
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.transform(value, lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))
            .groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.label", "row.v"))


def vertical(column: pa.ChunkedArray, dims: int, dtype) -> np.ndarray:
    """Matrix dimensions x rows of a list column."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy()
    out = np.zeros((len(lists), dims), dtype=dtype)
    if len(flat):
        begin = np.cumsum(lengths) - lengths
        out[np.repeat(np.arange(len(lists)), lengths), np.arange(len(flat)) - np.repeat(begin, lengths)] = flat
    return np.ascontiguousarray(out.T)


def bond_scan(x: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, candidates: np.ndarray, keep) -> tuple:
    """Exact scores of the candidates that ``keep(lower, upper)`` leaves, and their positions.

    ``x`` is dimensions x rows, ``low`` and ``high`` its extremes per dimension."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order]
    ends = np.stack([a * low[order], a * high[order]])
    rest = np.zeros((2, len(a) + 1), dtype=x.dtype)  # what dimensions from k on may still contribute
    rest[0, :-1] = ends.min(axis=0)[::-1].cumsum()[::-1]
    rest[1, :-1] = ends.max(axis=0)[::-1].cumsum()[::-1]
    score = np.zeros(len(candidates), dtype=x.dtype)
    for k in range(0, len(a), STEP):
        if not len(candidates):
            break
        read = order[k:k + STEP]
        score = score + a[k:k + STEP] @ x[np.ix_(read, candidates)]
        done = min(k + STEP, len(a))
        left = keep(score + rest[0, done], score + rest[1, done])
        if not left.all():
            candidates, score = candidates[left], score[left]
    return candidates, score


def kth_largest(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k]


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by smaller id."""
    if len(score) > 4 * k:
        near = np.flatnonzero(score >= kth_largest(score, k))
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


def nearest(x, ids, labels, low, high, anchor, anchor_id, anchor_label, k: int = POSITIVES):
    """Ids and scores of the k best other rows of the anchor's label."""

    def keep(lower, upper):
        return upper >= kth_largest(lower, k) if len(lower) > k else np.ones(len(lower), dtype=bool)

    found, score = bond_scan(x, low, high, anchor, np.flatnonzero((labels == anchor_label) & (ids != anchor_id)), keep)
    top = best(score, ids[found], k)
    return ids[found[top]], score[top]


def window_of(score: int) -> tuple[int, int]:
    """Least and largest integer score s with ``LOW * score <= 100 s <= HIGH * score``."""
    return -(-LOW * score // 100), HIGH * score // 100


def in_windows(x, ids, labels, low, high, anchor, anchor_label, windows: np.ndarray, k: int = NEGATIVES):
    """For each window (inclusive score bounds): ids and scores of its k best rows of other labels."""

    def keep(lower, upper):
        left = np.zeros(len(lower), dtype=bool)
        for first, last in windows:
            sure = lower[(lower >= first) & (upper <= last)]  # certainly inside: k of them raise the least score that counts
            left |= (upper >= (kth_largest(sure, k) if len(sure) >= k else first)) & (lower <= last)
        return left

    found, score = bond_scan(x, low, high, anchor, np.flatnonzero(labels != anchor_label), keep)
    for first, last in windows:
        inside = np.flatnonzero((score >= first) & (score <= last))
        top = inside[best(score[inside], ids[found[inside]], k)]
        yield ids[found[top]], score[top]


class Cell:
    """One cell's rows in vertical layout and its anchors."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, dims: int, exact: bool):
        dtype = np.float64 if exact else np.int64  # whole numbers below 2^53 stay exact as doubles
        self.ids, self.labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        self.x = vertical(rows.column("v"), dims, dtype)
        self.low, self.high = self.x.min(axis=1), self.x.max(axis=1)
        self.anchors = np.ascontiguousarray(vertical(anchors.column("a_v"), dims, dtype).T)
        self.anchor_ids, self.anchor_labels = anchors.column("a_vec_id").to_numpy(), anchors.column("a_label").to_numpy()

    def parts(self):
        return self.x, self.ids, self.labels, self.low, self.high


def _columns(names, found) -> pa.Table:
    return pa.table({n: pa.array(np.array(c, dtype=np.int64)) for n, c in zip(names, found)})


def mine(rows: DataFrame, label: Column | None = None, every: int = EVERY) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id``, ``embedding`` and the ``label`` (a column of that name unless one is given); anchors are the
    rows whose id is divisible by ``every``."""
    spark = rows.sparkSession
    bound_batches(spark, ROWS)
    table = written(quantised(rows, F.col("label") if label is None else label), "vectors")
    total = table.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.count_if(F.col("vec_id") % every == 0).alias("anchors"),
                      F.max(F.array_max("v")).alias("most"), F.min(F.array_min("v")).alias("least")).first()
    dims = total.dims or 0
    reach = dims * max(total.most or 0, -(total.least or 0)) ** 2  # no score is beyond
    if reach >= 1 << 63:
        raise ValueError("inner products of these vectors do not fit 64 bits")
    exact = reach < 1 << 53
    row_groups = max(1, math.ceil(total.n / ROWS), min(3 * spark.sparkContext.defaultParallelism, math.ceil(total.n / 512)))
    anchor_groups = max(1, math.ceil(total.anchors / ANCHORS))
    dealt = table.withColumn("r", F.pmod(F.xxhash64("vec_id"), F.lit(row_groups)).cast("int"))

    def scan(anchors: DataFrame, work, schema: str, name: str) -> DataFrame:
        """``work(cell, anchor table)`` for every cell of the grid, in rounds of anchor groups."""
        out = None
        # Renamed for the shuffle: both sides come from one table, and the grid's join must tell their columns apart.
        anchors = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns]).withColumn("h", F.pmod(F.xxhash64("a_vec_id", F.lit(1)), F.lit(anchor_groups)).cast("int"))
        for begin in range(0, anchor_groups, ROUND_GROUPS):
            groups = list(range(begin, min(begin + ROUND_GROUPS, anchor_groups)))
            cells = row_groups * len(groups)
            left = dealt.withColumn("g", F.explode(F.array(*map(F.lit, groups)))).repartition(cells, "r", "g")
            right = (anchors.where(F.col("h").between(groups[0], groups[-1]))
                     .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(row_groups - 1)))).repartition(cells, "s", "h"))

            def run(a: pa.Table, b: pa.Table) -> pa.Table:
                return work(Cell(a, b, dims, exact), b) if len(a) and len(b) else work(None, b)

            found = written(left.groupBy("r", "g").cogroup(right.groupBy("s", "h")).applyInArrow(run, schema), name)
            out = found if out is None else out.unionByName(found)
        return out

    def positives_in(cell, _):
        names = ["anchor_id", "positive_id", "positive_score", "anchor_label"]
        found = [[], [], [], []]
        for k in range(len(cell.anchor_ids) if cell else 0):
            ids, score = nearest(*cell.parts(), cell.anchors[k], cell.anchor_ids[k], cell.anchor_labels[k])
            for column, values in zip(found, ([cell.anchor_ids[k]] * len(ids), ids, score, [cell.anchor_labels[k]] * len(ids))):
                column.extend(values)
        return _columns(names, found)

    anchors = table.where(F.col("vec_id") % every == 0)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = (scan(anchors, positives_in, "anchor_id long, positive_id long, positive_score long, anchor_label long", "positives")
                 .withColumn("place", F.row_number().over(order)).where(F.col("place") <= POSITIVES)
                 .groupBy(F.col("anchor_id").alias("vec_id"))  # at most POSITIVES rows
                 .agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("positives")))

    def negatives_in(cell, b):
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        found = [[], [], [], [], []]
        for k, pairs in enumerate(b.column("a_positives").to_pylist() if cell else []):
            windows = [(p, *window_of(p["positive_score"])) for p in pairs]
            windows = [w for w in windows if w[1] <= w[2]]
            spans = [w[1:] for w in windows]
            if not spans:
                continue
            results = in_windows(*cell.parts(), cell.anchors[k], cell.anchor_labels[k], spans)
            for (pair, _, _), (ids, score) in zip(windows, results):
                n = len(ids)
                for column, values in zip(found, ([cell.anchor_ids[k]] * n, [pair["positive_id"]] * n,
                                                  [pair["positive_score"]] * n, ids, score)):
                    column.extend(values)
        return _columns(names, found)

    near = scan(anchors.join(positives, "vec_id"), negatives_in,
                "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", "negatives")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (near.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= NEGATIVES)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


ORACLE = f"""
WITH u AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score,
       score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
     AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= {NEGATIVES}"""

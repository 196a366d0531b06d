"""Customer segmentation: scaling, k sweep, elbow choice, KMeans, PCA, centroids.

Every fit runs on executors; the driver only sees the k table (at most 9
rows), the centres of the restarts and the PCA loadings - all bounded by
parameters, not by the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..contracts import ID, K_MAX, K_MIN, KMEANS_FEATURES, KMEANS_RESTARTS, MIN_KMEANS_ROWS, RANDOM_STATE
from ..errors import ModelInputRefused
from ..functions.kneedle import elbow_convex_decreasing
from ..session import ship_package

VEC = "features_vec"


def kmeans_input(clean: DataFrame, features: list[str] = KMEANS_FEATURES, id_col: str = ID,
                 check: bool = True) -> DataFrame:
    """id + features, after the contract checks (one aggregate action when ``check``)."""
    missing = sorted(set(features + [id_col]) - set(clean.columns))
    if missing:
        raise ModelInputRefused(f"missing KMeans columns: {missing}")
    out = clean.select(id_col, *[F.col(c).cast("double").alias(c) for c in features])
    if check:
        bad = sum((F.count_if(F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))) for c in features),
                  F.lit(0))
        r = out.agg(F.count(F.lit(1)).alias("n"), (F.count(id_col) - F.count_distinct(id_col)).alias("dup"),
                    bad.alias("bad")).first()
        if r["dup"]:
            raise ModelInputRefused("duplicated ids in KMeans input")
        if r["bad"]:
            raise ModelInputRefused("null or infinite values in KMeans input")
        if r["n"] < MIN_KMEANS_ROWS:
            raise ModelInputRefused(f"KMeans needs at least {MIN_KMEANS_ROWS} rows")
    return out


def scaler_stats(df: DataFrame, features: list[str] = KMEANS_FEATURES) -> DataFrame:
    """(column_name, mean, std): population std; a constant column scales by 1."""
    wide = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
                  *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(features)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"m_{i}").alias("mean"),
                 F.when(F.col(f"s_{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{i}")).alias("std"))
        for i, c in enumerate(features)])).alias("r")).select("r.*")


def scale(df: DataFrame, stats: DataFrame | list, features: list[str] = KMEANS_FEATURES, keep: list[str] = (ID,),
          vector: bool = True) -> DataFrame:
    """z = (x - mean) / std for every feature; optionally assembles the ML vector.

    ``stats`` may be the stats DataFrame (applied as one map-valued scalar
    subquery) or already-collected rows (bounded by the feature list).
    """
    if isinstance(stats, DataFrame):
        m = stats.select(F.map_from_entries(F.collect_list(F.struct("column_name", "mean")))).scalar()
        s = stats.select(F.map_from_entries(F.collect_list(F.struct("column_name", "std")))).scalar()
        cols = [((F.col(c) - F.element_at(m, F.lit(c))) / F.element_at(s, F.lit(c))).alias(c) for c in features]
    else:
        lut = {r["column_name"]: (r["mean"], r["std"]) for r in stats}
        cols = [((F.col(c) - F.lit(lut[c][0])) / F.lit(lut[c][1])).alias(c) for c in features]
    out = df.select(*[k for k in keep if k in df.columns], *cols)
    if vector:
        out = VectorAssembler(inputCols=features, outputCol=VEC).transform(out)
    return out


@dataclass
class Sweep:
    table: DataFrame  # k, inertia, silhouette_sq
    centres: dict  # k -> (k x features) array of the best restart, scaled units


# Convergence (the usual KMeans convention): a restart stops when the *sum* of
# squared centre shifts is <= 1e-4 x mean feature variance, or after 300 passes.
CENTRE_SHIFT_TOL = 1e-4
MAX_ITER = 300


def _mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on uint64 arrays (wrapping arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _uniform(ids: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Uniform (0, 1) draw per id, a pure function of (id, seed, step): the same
    under any partitioning and on task re-execution."""
    stream = _mix64(np.array([(seed * 1_000_003 + step) & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))[0]
    with np.errstate(over="ignore"):
        h = _mix64(ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ stream)
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _sq_dist(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    d = (X * X).sum(1)[:, None] - 2.0 * (X @ C.T) + (C * C).sum(1)[None, :]
    return np.maximum(d, 0.0, out=d)


#: Rows of one packed block, and of one tile of it whose distances are held at once.
BLOCK, TILE = 8192, 512
PACKED = "n int, ids binary, x binary"


def _pack(batches):
    """Rows of id and features as blocks of bytes: every pass reads few large cells instead of 16 columns."""
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK):
            part = batch.slice(a, BLOCK)
            ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = np.column_stack([part.column(j).to_numpy(zero_copy_only=False) for j in range(1, part.num_columns)]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                                              pa.array([x.tobytes()], pa.binary())], names=["n", "ids", "x"])


def _blocks(batches):
    """(ids, rows) of every packed block."""
    for batch in batches:
        for n, ids, x in zip(*[batch.column(j) for j in range(3)]):
            n = n.as_py()
            yield np.frombuffer(ids.as_buffer(), dtype=np.int64), np.frombuffer(x.as_buffer(), dtype=np.float64).reshape(n, -1)


def _seed_step(features: list[str], id_col: str, todo: list, chosen: dict, step: int):
    """One k-means++ step for every restart in ``todo`` [(cfg, seed)]: per
    partition, the point minimising -ln(u)/D(x)^2 (an exponential race, i.e. a
    D^2-weighted draw); Spark keeps the global minimum per restart."""
    def run(batches):
        best = {}
        for ids, X in _blocks(batches):
            draws = {seed: -np.log(_uniform(ids, seed, step)) for seed in {s for _, s in todo}}
            for cfg, seed in todo:
                with np.errstate(divide="ignore"):
                    key = draws[seed] / _sq_dist(X, chosen[cfg]).min(1) if step else draws[seed]
                least = np.flatnonzero(key == key.min())
                i = int(least[np.argmin(ids[least])])
                if cfg not in best or (key[i], ids[i]) < best[cfg][:2]:
                    best[cfg] = (float(key[i]), int(ids[i]), X[i].copy())
        if best:
            frame = pd.DataFrame([(c, k, i, *x) for c, (k, i, x) in best.items()], columns=["cfg", "key", id_col, *features])
            yield pa.RecordBatch.from_pandas(frame.astype({"cfg": np.int32}), preserve_index=False)
    return run


def _nearest(D: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Global index of the nearest centre of every restart (row x restart)."""
    return np.stack([offsets[i] + D[:, offsets[i]:offsets[i + 1]].argmin(1) for i in range(len(offsets) - 1)],
                    axis=1)


def _label_step(features: list[str], centres: list):
    """Nearest-centre label for each given centre set (one output column per set)."""
    offsets = np.cumsum([0] + [len(c) for c in centres])
    C = np.vstack(centres)

    def run(batches):
        for pdf in batches:
            X = pdf[features].to_numpy(dtype=np.float64)
            G = _nearest(_sq_dist(X, C), offsets) - offsets[:-1][None, :] if len(X) else np.zeros((0, len(centres)))
            for j in range(len(centres)):
                pdf[f"_c{j}"] = G[:, j].astype(np.int32)
            yield pdf
    return run


def _lloyd_step(C: np.ndarray, ks: list[int]):
    """Per-partition partial sums for every centre of every active restart (``ks``: their numbers of centres, ascending):
    (g, n, cost, s_0..s_d) with g the global centre index; a restart's cost stands at its first centre."""
    m, d = C.shape
    # |x - c|^2 as one product: (-2c, |c|^2, 1) by (x, 1, |x|^2)
    folded = np.column_stack([-2.0 * C, (C * C).sum(1), np.ones(m)])
    groups, at = [], 0  # restarts of equal k: (first centre, restarts, k)
    for k in sorted(set(ks)):
        groups.append((at, ks.count(k), k))
        at += ks.count(k) * k

    def run(batches):
        sums, cost = np.zeros((m, d + 1)), np.zeros(m)
        for _, rows in _blocks(batches):
            for t in range(0, len(rows), TILE):
                X = rows[t:t + TILE]
                wide = np.column_stack([X, np.ones(len(X)), (X * X).sum(1)])
                for a, r, k in groups:
                    b = a + r * k
                    D = (folded[a:b] @ wide.T).reshape(r, k, len(X))
                    best = D.min(axis=1)
                    cost[a:b:k] += np.maximum(best, 0.0).sum(1)
                    taken = np.zeros(best.shape, dtype=bool)
                    for j in range(k):  # D becomes the 0/1 table of the assignments, the first centre on ties
                        hit = np.greater(D[:, j] == best, taken)
                        taken |= hit
                        D[:, j] = hit
                    sums[a:b] += D.reshape(r * k, len(X)) @ wide[:, :d + 1]
        columns = [np.arange(m, dtype=np.int32), np.rint(sums[:, d]).astype(np.int64), cost, *sums[:, :d].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["g", "n", "cost", *[f"s{f}" for f in range(d)]])
    return run


def _lloyd_pass(points: DataFrame, features: list[str], centres: dict) -> tuple[dict, dict, dict]:
    """One distributed assignment pass of packed ``points`` over all restarts in ``centres``.
    Returns (new centres, inertia of the given centres, counts) per restart."""
    cfgs = sorted(centres, key=lambda c: (len(centres[c]), c))
    offsets = np.cumsum([0] + [len(centres[c]) for c in cfgs])
    C = np.vstack([centres[c] for c in cfgs])
    d = len(features)
    schema = "g int, n long, cost double, " + ", ".join(f"s{f} double" for f in range(d))
    rows = points.mapInArrow(_lloyd_step(C, [len(centres[c]) for c in cfgs]), schema).groupBy("g").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(f"s{f}").alias(f"s{f}") for f in range(d)]
    ).collect()  # at most (restarts x sum of k) rows: bounded by parameters
    newC, cost, cnt = C.copy(), np.zeros(len(C)), np.zeros(len(C))
    for r in rows:
        g = r["g"]
        cnt[g], cost[g] = r["n"], r["cost"]
        if r["n"]:  # empty clusters keep their centre
            newC[g] = np.array([r[f"s{f}"] for f in range(d)]) / r["n"]
    out_c, out_cost, out_n = {}, {}, {}
    for i, c in enumerate(cfgs):
        a, b = offsets[i], offsets[i + 1]
        out_c[c], out_cost[c], out_n[c] = newC[a:b], float(cost[a:b].sum()), cnt[a:b]
    return out_c, out_cost, out_n


#: A table of at most so many rows goes whole to every task (15 features: 24 MB), which then runs whole restarts.
LOCAL_ROWS = 200_000


def _restart(X: np.ndarray, ids: np.ndarray, k: int, seed: int, shift_tol: float, max_iter: int) -> tuple[np.ndarray, float]:
    """One restart on rows that are all here: the same draws and steps as the distributed passes."""
    C = np.zeros((0, X.shape[1]))
    for step in range(k):
        w = _sq_dist(X, C).min(1) if step else np.ones(len(X))
        with np.errstate(divide="ignore"):
            key = -np.log(_uniform(ids, seed, step)) / w
        C = np.vstack([C, X[np.lexsort((ids, key))[0]]])
    for _ in range(max_iter):
        G = _sq_dist(X, C).argmin(1)
        n = np.bincount(G, minlength=k)
        sums = np.stack([np.bincount(G, weights=X[:, f], minlength=k) for f in range(X.shape[1])], axis=1)
        new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], C)  # empty clusters keep their centre
        shift = float(((new - C) ** 2).sum())
        C = new
        if shift <= shift_tol:
            break
    return C, float(_sq_dist(X, C).min(1).sum())


def _restarts_by_task(pts: DataFrame, features: list[str], configs: list, id_col: str, max_iter: int, shift_tol: float) -> dict:
    """Restarts dealt to tasks, the table (bounded by ``LOCAL_ROWS``) broadcast: one job instead of one per pass."""
    spark = pts.sparkSession
    rows = pts.toPandas()
    table = spark.sparkContext.broadcast((rows[features].to_numpy(dtype=np.float64), rows[id_col].to_numpy()))

    def run(batches):
        X, ids = table.value
        for batch in batches:
            found = [(c, *_restart(X, ids, k, s, shift_tol, max_iter)) for c, k, s in zip(batch["cfg"], batch["k"], batch["seed"])]
            yield pd.DataFrame({"cfg": [c for c, _, _ in found], "inertia": [i for _, _, i in found],
                                "centres": [C.ravel().tolist() for _, C, _ in found]})

    # The largest k take longest: dealt out first, one restart a task.
    order = sorted(((c, k, s) for c, (k, s) in enumerate(configs)), key=lambda r: -r[1])
    todo = spark.createDataFrame(spark.sparkContext.parallelize(order, len(order)), "cfg int, k int, seed long")
    out = todo.mapInPandas(run, "cfg int, inertia double, centres array<double>").collect()  # one row per restart
    table.destroy()
    return {r["cfg"]: (np.array(r["centres"]).reshape(-1, len(features)), r["inertia"]) for r in out}


def kmeans_restarts(points: DataFrame, features: list[str], configs: list, id_col: str = ID,
                    max_iter: int = MAX_ITER, tol: float = CENTRE_SHIFT_TOL, local_rows: int = LOCAL_ROWS) -> dict:
    """k-means++ seeding + Lloyd iterations for many (k, seed) restarts at once.

    Every pass is one Spark job over the whole table for *all* restarts still
    running (per-partition partial sums, reduced by a groupBy), instead of one
    job per restart per iteration; only centres (bounded by the parameters)
    reach the driver.  A table of at most ``local_rows`` rows is broadcast, and each task runs
    whole restarts on it: the same steps in one job.  Returns cfg -> (centres, inertia).
    """
    ship_package(points.sparkSession)
    pts = points.select(F.col(id_col).cast("long").alias(id_col), *[F.col(f).cast("double").alias(f) for f in features])
    var = pts.agg(F.count(F.lit(1)).alias("_n"), *[F.var_pop(f).alias(f) for f in features]).first()
    shift_tol = tol * float(np.mean([var[f] or 0.0 for f in features]))
    if var["_n"] <= local_rows:
        return _restarts_by_task(pts, features, configs, id_col, max_iter, shift_tol)
    pts = pts.repartition(partitions(pts.sparkSession, var["_n"])).mapInArrow(_pack, PACKED).persist()
    try:
        return _restarts_by_pass(pts, features, configs, id_col, max_iter, shift_tol)
    finally:
        pts.unpersist()


def partitions(spark, rows: int, rows_per_partition: int = 200_000) -> int:
    """Partitions for passes over a cached table: one for every so many rows, in whole waves of the cores."""
    cores = max(1, spark.sparkContext.defaultParallelism)
    return cores * -(-max(rows, 1) // (cores * rows_per_partition))


def _restarts_by_pass(pts: DataFrame, features: list[str], configs: list, id_col: str, max_iter: int, shift_tol: float) -> dict:
    """Every restart one step further in each pass over the packed table."""
    d = len(features)
    ks = dict(enumerate(k for k, _ in configs))
    seeds = dict(enumerate(s for _, s in configs))
    # A draw depends on the seed, the step and the centres so far: restarts of one seed share their first centres.
    longest = {s: max(k for c, k in ks.items() if seeds[c] == s) for s in set(seeds.values())}
    drawn = {s: np.zeros((0, d)) for s in longest}
    for step in range(max(ks.values())):
        todo = [(i, s) for i, s in enumerate(sorted(drawn)) if longest[s] > step]
        schema = "cfg int, key double, " + f"{id_col} long, " + ", ".join(f"{f} double" for f in features)
        picks = pts.mapInArrow(_seed_step(features, id_col, todo, {i: drawn[s] for i, s in todo}, step), schema).groupBy("cfg").agg(
            F.min(F.struct("key", id_col, *features)).alias("p")).collect()  # one row per seed
        for r in picks:
            s = dict(todo)[r["cfg"]]
            drawn[s] = np.vstack([drawn[s], [r["p"][f] for f in features]])
    chosen = {c: drawn[seeds[c]][:ks[c]] for c in ks}
    centres, active = chosen, set(ks)
    for _ in range(max_iter):
        if not active:
            break
        new, _, _ = _lloyd_pass(pts, features, {c: centres[c] for c in active})
        for c, nc in new.items():
            if float(((nc - centres[c]) ** 2).sum()) <= shift_tol:
                active.discard(c)
            centres[c] = nc
    _, inertia, _ = _lloyd_pass(pts, features, centres)  # final assignment with the final centres
    return {c: (centres[c], inertia[c]) for c in ks}


def scaled_columns(stats_rows: list) -> dict[str, Column]:
    """The scaled value of each feature as an expression over the raw columns."""
    return {r["column_name"]: (F.col(r["column_name"]) - F.lit(r["mean"])) / F.lit(r["std"]) for r in stats_rows}


def assign_expr(C: np.ndarray, features: list[str], values: dict[str, Column] | None = None) -> Column:
    """Nearest centre (first on ties) as a JVM expression over the feature columns, or over their ``values``."""
    values = values or {f: F.col(f) for f in features}
    dists = [sum(((values[f] - F.lit(float(C[j, i]))) * (values[f] - F.lit(float(C[j, i])))
                  for i, f in enumerate(features)), F.lit(0.0)) for j in range(len(C))]
    arr = F.array(*dists)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def k_sweep(scaled: DataFrame, n_rows: int, seed: int = RANDOM_STATE, k_min: int = K_MIN, k_max: int = K_MAX,
            restarts: int = KMEANS_RESTARTS, max_iter: int = MAX_ITER, features: list[str] = KMEANS_FEATURES,
            id_col: str = ID) -> Sweep:
    """Inertia and silhouette for k = k_min..min(k_max, n-1); best of ``restarts`` seeds per k.

    All k x restarts fits advance together (``kmeans_restarts``); the
    silhouette of each k's best fit is Spark's linear-time squared-Euclidean one.
    """
    top = min(k_max, n_rows - 1)
    if top < k_min:
        raise ModelInputRefused("not enough rows to evaluate clusters")
    ks = list(range(k_min, top + 1))
    configs = [(k, seed + i) for k in ks for i in range(restarts)]
    fits = kmeans_restarts(scaled, features, configs, id_col, max_iter)
    best = {}
    for c, (k, _) in enumerate(configs):  # lowest inertia wins; first seed on ties
        if k not in best or fits[c][1] < best[k][1]:
            best[k] = fits[c]
    schema = ", ".join(f"{f} double" for f in features) + ", " + ", ".join(f"_c{j} int" for j in range(len(ks)))
    labelled = VectorAssembler(inputCols=features, outputCol=VEC).transform(
        scaled.select(*features).mapInPandas(_label_step(features, [best[k][0] for k in ks]), schema)
    ).select(VEC, *[F.col(f"_c{j}").alias(f"c{k}") for j, k in enumerate(ks)]).persist()
    rows = []
    for k in ks:
        ev = ClusteringEvaluator(featuresCol=VEC, predictionCol=f"c{k}", distanceMeasure="squaredEuclidean")
        rows.append((k, float(best[k][1]), float(ev.evaluate(labelled))))
    labelled.unpersist()
    table = scaled.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_sq double")
    return Sweep(table, {k: best[k][0] for k in ks})


#: Segments that per-segment statistics are held for.
MAX_SEGMENTS = 256


def check_segments(df: DataFrame, label: str, most: int = MAX_SEGMENTS) -> None:
    """Refuse a label column of more than ``most`` values before anything is collected or broadcast per label."""
    if df.select(label).distinct().limit(most + 1).count() > most:
        raise ModelInputRefused(f"{label} has more than {most} segments")


def silhouette_sample(scaled: DataFrame, label: str, features: list[str] = KMEANS_FEATURES, id_col: str = ID,
                      per_segment: int = 200, tile: int = 4096) -> DataFrame:
    """Exact Euclidean silhouettes of a hash-stratified row sample: per segment the mean, and a 95 % bound on its error.

    Of each segment the ``per_segment`` rows of least ``md5(id)`` are taken (all, if fewer).  Their distances to *every* row are
    summed tile against tile in the tasks that hold the rows: a task emits one sum per sampled row and segment it met, never
    a pair.  The sample is bounded by segments x ``per_segment`` and goes to every task.  The bound is the normal one with the
    finite-population correction, 0 where the sample is the whole segment.  A segment of one row scores 0.
    """
    check_segments(scaled, label)
    spark = scaled.sparkSession
    ship_package(spark)
    # Row numbers within a segment, of the few least hashes only: the limit is pushed below the shuffle.
    order = Window.partitionBy(label).orderBy(F.md5(F.col(id_col).cast("string")), id_col)
    chosen = (scaled.select(id_col, label, *features).withColumn("_place", F.row_number().over(order))
              .where(F.col("_place") <= per_segment).drop("_place").orderBy(label, id_col).toPandas())
    points = chosen[features].to_numpy(float)

    def sums(batches):
        total: dict = {}
        for batch in batches:
            for key, part in batch.groupby("_label", dropna=False):
                x = part[features].to_numpy(float)
                entry = total.setdefault(None if pd.isna(key) else key, [0, np.zeros(len(points))])
                entry[0] += len(x)
                for a in range(0, len(x), tile):
                    t = x[a:a + tile]
                    square = (points ** 2).sum(1)[:, None] + (t ** 2).sum(1)[None, :] - 2 * points @ t.T
                    near = square < 1e-6 * (1 + (points ** 2).sum(1))[:, None]  # cancellation: by differences instead
                    i, j = np.nonzero(near)
                    square[i, j] = ((points[i] - t[j]) ** 2).sum(1)
                    entry[1] += np.sqrt(np.maximum(square, 0)).sum(1)
        for key, (n, distance) in total.items():
            yield pd.DataFrame({"_segment": [key] * len(points), "_row": np.arange(len(points)), "_n": n, "_d": distance})

    kind = scaled.schema[label].dataType.simpleString()
    met = (scaled.select(F.col(label).alias("_label"), *features)
           .mapInPandas(sums, f"_segment {kind}, _row long, _n long, _d double")
           .groupBy("_segment", "_row").agg(F.sum("_n").alias("_n"), F.sum("_d").alias("_d")))
    chosen["_row"] = np.arange(len(chosen))
    own = spark.createDataFrame([(int(r), None if pd.isna(v) else v) for r, v in zip(chosen["_row"], chosen[label].tolist())],
                                f"_row long, {label} {kind}")
    mine = F.col("_segment").eqNullSafe(F.col(label))
    per_row = (met.join(F.broadcast(own), "_row").groupBy("_row", label)
               .agg(F.max(F.when(mine, F.col("_n"))).alias("_size"), F.max(F.when(mine, F.col("_d") / F.greatest(F.col("_n") - 1, F.lit(1)))).alias("_a"),
                    F.min(F.when(~mine, F.col("_d") / F.col("_n"))).alias("_b")))
    s = F.when((F.col("_size") == 1) | F.col("_b").isNull() | (F.greatest("_a", "_b") == 0), 0.0).otherwise(
        (F.col("_b") - F.col("_a")) / F.greatest("_a", "_b"))
    m = F.count(F.lit(1))
    size = F.max("_size")
    spread = F.coalesce(F.stddev_samp("_s"), F.lit(0.0)) / F.sqrt(m) * F.sqrt((size - m) / F.greatest(size - 1, F.lit(1)))
    return per_row.select(label, "_size", s.alias("_s")).groupBy(label).agg(
        size.alias("usuarios"), m.alias("muestra"), F.avg("_s").alias("silhouette"), (F.lit(1.96) * spread).alias("margen"))


def silhouette_given(scaled: DataFrame, label: str, features: list[str] = KMEANS_FEATURES) -> DataFrame:
    """Mean squared-Euclidean silhouette of each segment, for labels that are given.

    Mean squared distances to a segment follow from its size, its vector sum and its sum of
    squared norms, so no pair is formed: one aggregate over the rows (segments x
    features numbers on the driver, at most ``MAX_SEGMENTS``), then one expression per row.  A segment of
    one row scores 0.
    """
    check_segments(scaled, label)
    norm = sum((F.col(f) * F.col(f) for f in features[1:]), F.col(features[0]) * F.col(features[0]))
    sums = scaled.groupBy(label).agg(F.count("*").alias("n"), F.sum(norm).alias("q"),
                                     *[F.sum(f).alias(f) for f in features]).collect()

    def total(r):  # squared distances from the row to all rows of the segment
        dot = sum((F.col(f) * F.lit(r[f]) for f in features[1:]), F.col(features[0]) * F.lit(r[features[0]]))
        return F.lit(r["n"]) * norm + F.lit(r["q"]) - F.lit(2.0) * dot

    def is_own(r):
        return F.col(label).eqNullSafe(F.lit(r[label]))

    own = F.coalesce(*[F.when(is_own(r), total(r) / F.lit(max(r["n"] - 1, 1))) for r in sums])
    single = F.coalesce(*[F.when(is_own(r), F.lit(r["n"] == 1)) for r in sums])
    others = [F.when(~is_own(r), total(r) / F.lit(r["n"])) for r in sums]
    near = F.least(*others) if len(others) > 1 else F.lit(None).cast("double")
    s = F.when(single | near.isNull(), 0.0).otherwise((near - own) / F.greatest(near, own))
    return scaled.select(label, s.alias("_silhouette")).groupBy(label).agg(
        F.count("*").alias("usuarios"), F.avg("_silhouette").alias("silhouette_sq"))


def choose_k(rows: list) -> tuple[int, str]:
    """Elbow of inertia vs k, else the k with the largest silhouette."""
    rows = sorted(rows, key=lambda r: r[0])
    ks, inertia = [r[0] for r in rows], [r[1] for r in rows]
    e = elbow_convex_decreasing(ks, inertia)
    if e in ks:
        return int(e), "metodo_codo"
    best = max(rows, key=lambda r: r[2])
    return int(best[0]), "silhouette_fallback"


def relabel_by_spend(assigned: DataFrame, original: DataFrame, id_col: str = ID,
                     spend: str = "gasto_mensual") -> DataFrame:
    """Renumber clusters by ascending mean spend so ids are stable across runs.

    The per-cluster means table has k rows (k <= 10); its ranking is a window
    over those k rows and the mapping is broadcast back.
    """
    means = assigned.select(id_col, "cluster").join(original.select(id_col, spend), id_col) \
        .groupBy("cluster").agg(F.avg(spend).alias("_m"))
    mapping = means.select("cluster", (F.row_number().over(Window.orderBy("_m", "cluster")) - 1)
                           .cast("int").alias("_new"))
    return assigned.join(F.broadcast(mapping), "cluster").drop("cluster").withColumnRenamed("_new", "cluster")


def pca_2d(scaled: DataFrame, id_col: str = ID):
    """Two principal components (sign fixed: largest |loading| positive) and explained variance."""
    model = PCA(k=2, inputCol=VEC, outputCol="_pc").fit(scaled)
    pcs = model.pc.toArray()  # features x 2, bounded by the feature list
    signs = []
    for j in range(2):
        col = pcs[:, j]
        idx = int(abs(col).argmax())
        signs.append(1.0 if col[idx] >= 0 else -1.0)
    arr = vector_to_array(F.col("_pc"))
    out = model.transform(scaled).select(id_col, (arr[0] * signs[0]).alias("pc1"), (arr[1] * signs[1]).alias("pc2"))
    return out, float(sum(model.explainedVariance.toArray()))


def centroids(assigned: DataFrame, original: DataFrame, features: list[str] = KMEANS_FEATURES,
              id_col: str = ID) -> DataFrame:
    """Per-cluster means in original units (the KMeans centres at convergence)."""
    j = assigned.select(id_col, "cluster").join(original.select(id_col, *features), id_col)
    return j.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in features])

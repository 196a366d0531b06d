"""Quality classifier: Bradley-Terry ranking of documents, thresholded at a score quantile.

A labelled document of quality 1 is preferred to one of quality 0.  The model
gives each text a score linear in its features; weights come from logistic loss on
the feature differences of such pairs.  The threshold is the training scores'
quantile at the share of quality-0 documents, and scores are mapped to 0..1 so that the
threshold falls on ``CUT``.

Every labelled row is fitted on, but those held out (``crc32(doc_id) mod 5 = 0``; their labels are never read). Equal rows of
features and label go as one with a weight. Rows are dealt by hash into groups of about ``GROUP``, in each of which every
preferred document meets every other one, so that pairs grow with the rows; rows of a rare class stand in several groups, so that
none goes without. A Newton step is one job that sums over the groups; the threshold is an exact order statistic of all scores.

Defined cases: a null text is empty, and empty texts get a score; null labels and labels
without a document are ignored; without both classes every score is ``CUT`` (all predicted 1);
null doc_ids are scored, never trained on, and not held out; repeated rows get equal scores;
an empty table gives no rows; other columns are kept, also where their names clash with ours.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import features
from .common import bound_batches, discard, fresh, scratch_path, written

#: Rows of a group, rows of the rarer class in it (on average, at least), and values that are looked through on the driver.
GROUP, RARE, FEW = 500, 20, 20_000
CUT = 0.3
RIDGE = 1e-3


def ratios(c: dict[str, np.ndarray]) -> np.ndarray:
    """Feature matrix (texts by features) from the counts of :func:`features.count`."""
    n = np.maximum(c["n_words"], 1).astype(float)
    letters, chars = np.maximum(c["letters"], 1), np.maximum(c["word_chars"], 1)
    mean = c["word_chars"] / n
    spread = np.sqrt(np.maximum(c["word_len_sq"] / n - mean ** 2, 0))
    short = np.minimum(c["n_words"], 20) / 20  # full-length texts are alike
    return np.column_stack([
        np.log1p(c["n_words"]), short, mean, np.abs(mean - 5.2), spread, c["symbol_words"] / n,
        np.minimum(1, 10 * c["n_symbols"] / chars), c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / n,
        c["uppers"] / letters, np.minimum(1, 4 * c["uppers"] / letters), c["short_words"] / n, c["long_words"] / n,
        c["plain_words"] / n, np.minimum(1, 5 * c["same_next"] / n), c["distinct_words"] / n,
        c["stops"] / n, np.minimum(1, c["exclaims"] / n), c["digits"] / chars, c["puncts"] / n])


def pair_sums(z: np.ndarray, y: np.ndarray, c: np.ndarray, w: np.ndarray, tile: int = 1024) -> np.ndarray:
    """Pairs, gradient and Hessian (flat) of the logistic loss ``log(1 + exp(-w . (good - bad)))`` over all pairs of rows ``z``
    of weights ``c``.  No pair's features are formed: a pair weighs on its two rows."""
    d = z.shape[1]
    count, gradient, hessian = 0.0, np.zeros(d), np.zeros((d, d))
    goods, bads = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    for i in (goods[a:a + tile] for a in range(0, len(goods), tile)):
        for j in (bads[a:a + tile] for a in range(0, len(bads), tile)):
            g, b, weight = z[i], z[j], c[i][:, None] * c[j][None, :]
            p = 1 / (1 + np.exp(np.clip((g @ w)[:, None] - (b @ w)[None, :], -30, 30)))  # probability of the wrong order
            wrong, spread = weight * p, weight * p * (1 - p)
            cross = g.T @ spread @ b
            count += weight.sum()
            gradient += wrong.sum(axis=0) @ b - wrong.sum(axis=1) @ g
            hessian += (g * spread.sum(axis=1)[:, None]).T @ g + (b * spread.sum(axis=0)[:, None]).T @ b - cross - cross.T
    return np.concatenate([[count], gradient, hessian.ravel()])


def fit_pairs(sums, d: int, ridge: float = RIDGE, steps: int = 40) -> np.ndarray:
    """Weights of least mean logistic loss with a ridge (Newton steps); ``sums(w)`` as of :func:`pair_sums`."""
    w = np.zeros(d)
    for _ in range(steps):
        total = sums(w)
        gradient, hessian = total[1:d + 1] / total[0] + ridge * w, total[d + 1:].reshape(d, d) / total[0] + ridge * np.eye(d)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return np.round(w, 9)  # sums differ in their last digits with the order of their parts


def fit_slope(sums) -> float:
    """Slope of a logistic fit of the labels through (threshold, ``CUT``); ``sums(slope)`` gives the means of
    ``(y - p) d`` and ``p (1 - p) d^2``."""
    slope = 1.0
    for _ in range(50):
        before, (first, second) = slope, sums(slope)
        slope = min(max(slope + first / max(1e-9, second + 1e-3), 0.05), 20.0)
        if abs(slope - before) < 1e-6:
            break
    return round(slope, 9)


OFFSET = float(np.log(CUT / (1 - CUT)))


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Model from features and labels 0/1 that are all here, as one group: standardisation, weights, threshold, slope."""
    model = {"mean": x.mean(axis=0) if len(x) else 0.0, "scale": 1.0, "w": None, "cut": 0.0, "slope": 0.0}
    if not (y == 1).any() or not (y == 0).any():
        return model
    model["scale"] = np.maximum(x.std(axis=0), 1e-6)
    z = (x - model["mean"]) / model["scale"]
    model["w"] = fit_pairs(lambda w: pair_sums(z, y, np.ones(len(y)), w), z.shape[1])
    s = z @ model["w"]
    model["cut"] = float(np.quantile(s, (y == 0).mean()))
    d = s - model["cut"]

    def sums(slope):
        p = 1 / (1 + np.exp(-np.clip(slope * d + OFFSET, -30, 30)))
        return float(((y - p) * d).mean()), float((p * (1 - p) * d * d).mean())
    model["slope"] = fit_slope(sums)
    return model


def total_of(df: DataFrame, of, size: int) -> np.ndarray:
    """Sum over all Arrow batches of ``of(batch)``, an array of ``size`` numbers."""
    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            total += of(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["i", "v"])

    out = np.zeros(size)
    for r in df.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v
    return out


def order_statistic(values: DataFrame, rank: int, few: int = FEW) -> float:
    """The ``rank``-th least ``s`` (from 0) of rows ``s, c`` (``c`` times each): bins of the range that holds it until few rows are left."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    while low < high:
        inside = values.where(F.col("s").between(low, high))
        if inside.limit(few + 1).count() <= few:
            rows = sorted((r.s, r.c) for r in inside.select("s", "c").collect())
            ends = np.cumsum([c for _, c in rows])
            return rows[int(np.searchsorted(ends, rank, side="right"))][0]
        bins = (inside.groupBy(F.floor((F.col("s") - low) / (high - low) * 1000).alias("bin"))
                .agg(F.min("s").alias("low"), F.max("s").alias("high"), F.sum("c").alias("c")).orderBy("bin").collect())  # at most 1,001
        for r in bins:
            if rank < r.c:
                low, high = r.low, r.high
                break
            rank -= int(r.c)
    return low


def dealt(rows: DataFrame, n: int, rare: int, rare_class: int) -> DataFrame:
    """``rows`` (y, x, c) in groups of about ``GROUP``, one row a group: lists of equal length."""
    groups = -(-n // GROUP)
    copies = F.when(F.col("y") == rare_class, -(-RARE * groups // rare) if groups > 1 else 1).otherwise(1)
    spread = rows.withColumn("t", F.explode(F.sequence(F.lit(1), copies)))
    return (spread.groupBy(F.pmod(F.xxhash64("y", "x", "t"), F.lit(groups)).alias("g"))
            .agg(F.sort_array(F.collect_list(F.struct("y", "x", "c"))).alias("rows")).select("rows"))


def fit_rows(rows: DataFrame) -> dict:
    """:func:`fit` of rows ``y, x, c`` (label, features, how often) that are spread over the cluster."""
    d = ratios(features.count([""])).shape[1]
    model = {"mean": 0.0, "scale": 1.0, "w": None, "cut": 0.0, "slope": 0.0}
    found = {r.y: (r.n, r.c) for r in rows.groupBy("y").agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()}
    if len(found) < 2:
        return model
    total = found[0][1] + found[1][1]

    def arrays(batch):  # features and weights of a batch
        return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d), batch.column("c").to_numpy(zero_copy_only=False)

    def moments(of):
        def one(batch):
            x, c = arrays(batch)
            return c @ of(x)
        return np.round(total_of(rows.select("x", "c"), one, d) / total, 12)
    mean = model["mean"] = moments(lambda x: x)
    scale = model["scale"] = np.maximum(np.sqrt(moments(lambda x: (x - mean) ** 2)), 1e-6)
    rare = min(found, key=lambda y: found[y][0])
    paths = [scratch_path(rows.sparkSession, f"quality-{n}") for n in ("groups", "scores")]
    groups = written(dealt(rows, found[0][0] + found[1][0], found[rare][0], rare), "groups", paths[0])

    def sums(w):
        def one(batch):
            out = np.zeros(1 + d + d * d)
            for group in batch.column(0):
                v = group.values
                x = v.field("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                out += pair_sums((x - mean) / scale, v.field("y").to_numpy(zero_copy_only=False), v.field("c").to_numpy(zero_copy_only=False), w)
            return out
        return total_of(groups, one, 1 + d + d * d)
    w = model["w"] = fit_pairs(sums, d)

    def scored(batches):
        for batch in batches:
            x, _ = arrays(batch)
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("c"), pa.array((x - mean) / scale @ w)], names=["y", "c", "s"])
    scores = written(rows.select("y", "x", "c").mapInArrow(scored, "y int, c double, s double"), "scores", paths[1])
    place = (total - 1) * found[0][1] / total  # linear between the two ranks, as np.quantile
    low = order_statistic(scores, int(place))
    high = order_statistic(scores, min(int(place) + 1, int(total) - 1)) if place > int(place) else low
    model["cut"] = float(np.floor((low + (place - int(place)) * (high - low)) * 1e12) / 1e12)  # a row on the threshold stays above
    dist = F.col("s") - F.lit(model["cut"])

    def slope_sums(slope):
        p = 1 / (1 + F.exp(-F.greatest(F.least(F.lit(slope) * dist + F.lit(OFFSET), F.lit(30.0)), F.lit(-30.0))))
        first, second = scores.agg(F.sum(F.col("c") * (F.col("y") - p) * dist), F.sum(F.col("c") * p * (1 - p) * dist * dist)).first()
        return first / total, second / total
    model["slope"] = fit_slope(slope_sums)
    for path in paths:
        discard(rows.sparkSession, path)
    return model


def score(model: dict, x: np.ndarray) -> np.ndarray:
    if model["w"] is None:
        return np.full(len(x), CUT)
    s = (x - model["mean"]) / model["scale"] @ model["w"] - model["cut"]
    out = 1 / (1 + np.exp(-np.clip(model["slope"] * s + OFFSET, -30, 30)))
    return np.where(s >= 0, np.maximum(out, CUT), out)  # the threshold itself is kept


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def with_features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and features ``x`` of each whole text: 20 numbers, so that a join with labels moves no text."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def featured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(ratios(features.count(texts.fillna("").tolist()))))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), featured(F.col("text").cast("string")).alias("x"))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int | None = None, featured: DataFrame | None = None) -> dict:
    """Fit on every labelled row that is not held out (with ``max_labelled``: on so many of least hash).
    ``featured`` is :func:`with_features` of ``docs``, where it is at hand."""
    usable = (labels.where(~is_held_out() & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")))
    if max_labelled is not None:
        usable = usable.orderBy(F.xxhash64("doc_id", "y"), "doc_id", "y").limit(max_labelled)
    featured = with_features(docs.where(F.col("doc_id").isNotNull())) if featured is None else featured
    path = scratch_path(docs.sparkSession, "quality-rows")
    rows = written(featured.join(usable, "doc_id").groupBy("y", "x").agg(F.count("*").cast("double").alias("c")), "rows", path)
    model = fit_rows(rows)
    discard(docs.sparkSession, path)
    return model


def with_score(docs: DataFrame, model: dict, name: str) -> DataFrame:
    """``docs`` with the score of each whole text in column ``name``."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(score(model, ratios(features.count(texts.fillna("").tolist()))))

    return docs.withColumn(name, scored(F.col("text").cast("string")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that the classifier rejects."""
    name = fresh(docs, "_score")
    return with_score(docs, train(docs, labels), name).where(F.col(name) >= CUT).drop(name)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    found = written(with_features(docs), "quality-features")
    model = train(docs, labels, featured=found)

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        return pd.Series(score(model, np.stack(x.to_list())) if len(x) else [], dtype=float)

    return found.select("doc_id", is_held_out().alias("held_out"), scored("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))

"""Fits that carry their proof: each comes with what must vanish at the optimum, worked out from all rows.

Rows are only ever aggregated (one pass, features x features numbers); the small dense
algebra on those numbers runs on the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import ModelInputRefused


def moments(df: DataFrame, columns: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, means and (population) covariance matrix of the columns: two aggregates.

    Products are taken of centred values, so that large means cost no digits."""
    first = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    if not first["n"]:
        raise ModelInputRefused("no rows to fit on")
    mean = [first[f"m{i}"] for i in range(len(columns))]
    centred = [F.col(c) - F.lit(m) for c, m in zip(columns, mean)]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    second = df.agg(*[F.avg(centred[i] * centred[j]).alias(f"s{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = second[f"s{i}_{j}"]
    return first["n"], np.array(mean), cov


def ols(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """(variable, coeficiente, coeficiente_estandar, residuo): least squares on all features, one row per feature.

    From the Gram matrix of all rows.  ``coeficiente_estandar`` is in standard deviations of feature and target;
    ``residuo`` is the correlation of the feature with the fit's residual, computed from the rows: 0 at the optimum.  A feature that is a
    combination of others makes the fit ambiguous and is refused.
    """
    _, mean, cov = moments(df, [*features, target])
    scale = np.sqrt(np.diag(cov))
    if (scale <= 1e-12 * np.maximum(1, np.abs(mean))).any():
        raise ModelInputRefused("a constant column has no coefficient")
    corr = cov / np.outer(scale, scale)
    if np.linalg.cond(corr[:-1, :-1]) > 1e12:
        raise ModelInputRefused("features are linearly dependent")
    standard = np.linalg.solve(corr[:-1, :-1], corr[:-1, -1])
    raw = standard * scale[-1] / scale[:-1]
    residual = F.col(target) - F.lit(float(mean[-1]))
    for f, w, m in zip(features, raw, mean):
        residual = residual - F.lit(float(w)) * (F.col(f) - F.lit(float(m)))
    check = df.agg(*[F.avg((F.col(f) - F.lit(float(m))) * residual / F.lit(float(s * scale[-1]))).alias(f"r{i}")
                     for i, (f, m, s) in enumerate(zip(features, mean, scale))]).first()
    rows = [(f, float(raw[i]), float(standard[i]), float(check[f"r{i}"])) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "variable string, coeficiente double, coeficiente_estandar double, residuo double")


def logistic(df: DataFrame, features: list[str], target: str, strength: float = 1.0, tol: float = 1e-12) -> DataFrame:
    """(variable, peso, momento, gradiente): L2 logistic regression on scaled features, one row per feature and one,
    ``(intercepto)``, for the free intercept.

    ``momento`` is the mean of feature x label over all rows; ``gradiente`` is the derivative of the mean penalised log loss with
    respect to the weight, one aggregate over all rows at the fitted weights: 0 at the optimum.
    """
    n, mean, cov = moments(df, features)
    scale = np.sqrt(np.diag(cov))
    scale[scale == 0] = 1.0
    z = {f: (F.col(f) - F.lit(float(m))) / F.lit(float(s)) for f, m, s in zip(features, mean, scale)}
    label = F.col(target).cast("double")
    rows = df.select(label.alias("label"), *[z[f].alias(f) for f in features]).persist()
    try:
        reg = 1.0 / (strength * n)
        model = LogisticRegression(featuresCol="z", labelCol="label", regParam=reg, elasticNetParam=0.0, maxIter=2000, tol=tol,
                                   standardization=False).fit(VectorAssembler(inputCols=features, outputCol="z").transform(rows))
        weights, bias = model.coefficients.toArray(), float(model.intercept)
        margin = F.lit(bias)
        for f, w in zip(features, weights):
            margin = margin + F.lit(float(w)) * F.col(f)
        miss = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col("label")
        found = rows.agg(F.avg(miss).alias("g"), F.avg("label").alias("m"),
                         *[F.avg(F.col(f) * miss).alias(f"g{i}") for i, f in enumerate(features)],
                         *[F.avg(F.col(f) * F.col("label")).alias(f"m{i}") for i, f in enumerate(features)]).first()
    finally:
        rows.unpersist()
    out = [("(intercepto)", bias, float(found["m"]), float(found["g"]))]
    out += [(f, float(weights[i]), float(found[f"m{i}"]), float(found[f"g{i}"] + reg * weights[i])) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(out, "variable string, peso double, momento double, gradiente double")


def principal(df: DataFrame, features: list[str], k: int = 2) -> tuple[list[float], np.ndarray, np.ndarray, dict]:
    """Variances of the first ``k`` principal components of the scaled features, their loadings (features x k, the largest in
    magnitude positive), the correlation matrix, and the scaled features as expressions."""
    _, mean, cov = moments(df, features)
    scale = np.sqrt(np.diag(cov))
    scale[scale == 0] = 1.0
    corr = cov / np.outer(scale, scale)
    values, vectors = np.linalg.eigh(corr)
    order = np.argsort(-values)[:k]
    loadings = vectors[:, order]
    loadings = loadings * np.where(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    z = {f: (F.col(f) - F.lit(float(m))) / F.lit(float(s)) for f, m, s in zip(features, mean, scale)}
    return [float(v) for v in values[order]], loadings, corr, z


def pca_scores(df: DataFrame, features: list[str], id_col: str, k: int = 2) -> DataFrame:
    """(id, pc1 .. pck): scores of every row, one expression per component."""
    _, loadings, _, z = principal(df, features, k)
    return df.select(id_col, *[sum((z[f] * F.lit(float(loadings[i, j])) for i, f in enumerate(features)), F.lit(0.0)).alias(f"pc{j + 1}")
                               for j in range(k)])


def pca_certificate(df: DataFrame, features: list[str], k: int = 2) -> DataFrame:
    """(componente, varianza, proporcion, residuo, varianza_filas): per component its eigenvalue and share of the total
    variance, the largest entry of ``C v - lambda v``, and the variance of the rows' scores, which must equal the eigenvalue."""
    values, loadings, corr, z = principal(df, features, k)
    scores = [sum((z[f] * F.lit(float(loadings[i, j])) for i, f in enumerate(features)), F.lit(0.0)) for j in range(k)]
    seen = df.agg(*[F.var_pop(s).alias(f"v{j}") for j, s in enumerate(scores)]).first()
    rows = []
    for j in range(k):
        residual = float(np.abs(corr @ loadings[:, j] - values[j] * loadings[:, j]).max())
        rows.append((j + 1, values[j], values[j] / float(np.trace(corr)), residual, float(seen[f"v{j}"])))
    return df.sparkSession.createDataFrame(
        rows, "componente int, varianza double, proporcion double, residuo double, varianza_filas double")

"""Registered queries: fits with their certificates, exact silhouettes, elbows of curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import (CLASSIFICATION_FEATURES, CLASSIFICATION_TARGET, ID, KMEANS_FEATURES, REGRESSION_FEATURES,
                         REGRESSION_TARGET)
from ..functions.numeric import round_half_even
from ..operators import certificates as CE
from ..operators import elbow as EL
from ..operators import screening as SCR
from ..operators import segment as SG
from ..operators import supervised as SV
from ..sources import tpch
from . import oracle as O
from .registry import analytic, clean_base, labelled, register


def _z(c: str) -> str:
    sd = f"stddev_pop(CAST({c} AS DOUBLE)) OVER ()"
    return f"((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / CASE WHEN {sd} = 0 THEN {O.d(1)} ELSE {sd} END)"


def _ols_sql(features: list[str], target: str, table: str) -> str:
    """Least squares by successive elimination: each step takes the slope on one feature out of all later columns.

    Slopes of step k form row k of a triangular system, solved backwards in the last SELECT."""
    names = [*[f"x{i}" for i in range(len(features))], "y"]
    ctes = [f"e0 AS (SELECT {', '.join(f'{_z(c)} AS {n}' for c, n in zip([*features, target], names))} FROM {table})"]
    for k in range(len(features)):
        later = names[k + 1:]
        slopes = ", ".join(f"sum({n} * x{k}) / sum(x{k} * x{k}) AS s{k}_{n}" for n in later)
        ctes.append(f"t{k} AS MATERIALIZED (SELECT {slopes} FROM e{k})")
        ctes.append(f"e{k + 1} AS MATERIALIZED (SELECT {', '.join(f'{n} - s{k}_{n} * x{k} AS {n}' for n in later)} FROM e{k}, t{k})")
    solved = "SELECT * FROM " + ", ".join(f"t{k}" for k in range(len(features)))
    for k in reversed(range(len(features))):
        known = "".join(f" - s{k}_x{j} * b{j}" for j in range(k + 1, len(features)))
        solved = f"SELECT *, s{k}_y{known} AS b{k} FROM ({solved})"
    out = " UNION ALL ".join(f"SELECT '{f}' AS variable, {O.rnd(f'b{i}', 6)} AS coeficiente_estandar, {O.d(0)} AS residuo FROM solved"
                             for i, f in enumerate(features))
    return O.with_ctes([*ctes, f"solved AS MATERIALIZED ({solved})"], out)


@register("ols_full", _ols_sql(REGRESSION_FEATURES, REGRESSION_TARGET, "labelled"))
def q_ols_full(spark, sf):
    """Least squares of spend on all regression features; the residual's correlation with each feature must round to 0."""
    fit = CE.ols(labelled(spark, sf), REGRESSION_FEATURES, REGRESSION_TARGET)
    return fit.select("variable", round_half_even("coeficiente_estandar", 6).alias("coeficiente_estandar"),
                      F.abs(round_half_even("residuo", 6)).alias("residuo"))


def _logit_sql(features: list[str], target: str) -> str:
    parts = [f"SELECT '(intercepto)' AS variable, {O.rnd(f'avg({target})', 6)} AS momento, {O.d(0)} AS gradiente FROM zs"]
    parts += [f"SELECT '{f}', {O.rnd(f'avg({f} * {target})', 6)}, {O.d(0)} FROM zs" for f in features]
    zs = f"zs AS (SELECT CAST({target} AS DOUBLE) AS {target}, {', '.join(f'{_z(f)} AS {f}' for f in features)} FROM labelled)"
    return O.with_ctes([zs], " UNION ALL ".join(parts))


@register("logit_gradient", _logit_sql(CLASSIFICATION_FEATURES, CLASSIFICATION_TARGET))
def q_logit_gradient(spark, sf):
    """L2 logistic regression of the risk label; the gradient at its weights, over all rows, must round to 0."""
    fit = CE.logistic(labelled(spark, sf), CLASSIFICATION_FEATURES, CLASSIFICATION_TARGET)
    return fit.select("variable", round_half_even("momento", 6).alias("momento"),
                      F.abs(round_half_even("gradiente", 6)).alias("gradiente"))


def _pca_ctes(features: list[str], table: str, rounds: int = 4000) -> list[str]:
    """First two eigenvectors of the correlation matrix by power iteration, the second after deflation."""
    def cov(a, b):
        return f"avg({a} * {b})"
    names = [f"z{i}" for i in range(len(features))]
    zs = f"zs AS MATERIALIZED (SELECT id_cliente, {', '.join(f'{_z(f)} AS {n}' for f, n in zip(features, names))} FROM {table})"
    matrix = ", ".join("[" + ", ".join(cov(a, b) for b in names) + "]" for a in names)

    def power(c, v):
        start = ", ".join(f"{O.d(1 + 0.01 * i)}" for i in range(len(features)))
        unit = "list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))"
        return (f"{v} AS MATERIALIZED (WITH RECURSIVE it(k, v) AS (SELECT 0, [{start}] UNION ALL SELECT k + 1, {unit} FROM "
                f"(SELECT k, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM it, {c} WHERE k < {rounds})) "
                f"SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS lambda_ FROM it, {c} WHERE k = {rounds})")

    n = len(features)
    deflated = (f"c2 AS MATERIALIZED (SELECT list_transform(range(1, {n + 1}), lambda i: list_transform(range(1, {n + 1}), "
                f"lambda j: m[i][j] - lambda_ * v[i] * v[j])) AS m FROM c1, v1)")
    return [zs, f"c1 AS MATERIALIZED (SELECT [{matrix}] AS m FROM zs)", power("c1", "v1"), deflated, power("c2", "v2")]


_PCA = _pca_ctes(KMEANS_FEATURES, "clean")


@register("pca_residual", O.with_ctes(_PCA, " UNION ALL ".join(
    f"SELECT CAST({j} AS INTEGER) AS componente, {O.rnd('lambda_', 6)} AS varianza, {O.rnd(f'lambda_ / {len(KMEANS_FEATURES)}', 6)} AS proporcion, "
    f"{O.d(0)} AS residuo, {O.rnd('lambda_', 6)} AS varianza_filas FROM v{j}" for j in (1, 2))))
def q_pca_residual(spark, sf):
    """Two principal components of the scaled segmentation features, with the residual of the eigen equation."""
    rows = CE.pca_certificate(SG.kmeans_input(clean_base(spark, sf), check=False), KMEANS_FEATURES)
    return rows.select("componente", *[F.abs(round_half_even(c, 6)).alias(c) for c in ("varianza", "proporcion", "residuo", "varianza_filas")])


def _signed(j: int) -> str:
    big = f"(SELECT v[list_position(list_transform(v, lambda x: abs(x)), list_max(list_transform(v, lambda x: abs(x))))] FROM v{j})"
    dot = " + ".join(f"z{i} * (SELECT v[{i + 1}] FROM v{j})" for i in range(len(KMEANS_FEATURES)))
    return O.rnd(f"({dot}) * sign({big})", 4) + " + 0.0"


@register("pca_2d", O.with_ctes(_PCA, f"SELECT id_cliente, {_signed(1)} AS pc1, {_signed(2)} AS pc2 FROM zs"))
def q_pca_2d(spark, sf):
    """Scores of every customer on the two components (4 decimals)."""
    scores = CE.pca_scores(SG.kmeans_input(clean_base(spark, sf), check=False), KMEANS_FEATURES, ID)
    return scores.select(ID, *[(round_half_even(c, 4) + F.lit(0.0)).alias(c) for c in ("pc1", "pc2")])


def _silhouette_sample_sql(per: int) -> str:
    z = ", ".join(f"{_z(c)} AS {c}" for c in KMEANS_FEATURES)
    dist = "sqrt(" + " + ".join(f"(s.{c} - a.{c}) * (s.{c} - a.{c})" for c in KMEANS_FEATURES) + ")"
    return O.with_ctes([
        f"zs AS MATERIALIZED (SELECT id_cliente, valor_cliente, {z} FROM analytic)",
        f"s AS (SELECT * FROM zs QUALIFY row_number() OVER (PARTITION BY valor_cliente ORDER BY md5(CAST(id_cliente AS VARCHAR)), id_cliente) <= {per})",
        f"m AS (SELECT s.id_cliente, s.valor_cliente, a.valor_cliente AS other, sum({dist}) AS d, count(*) AS n FROM s, zs a GROUP BY ALL)",
        f"r AS (SELECT id_cliente, valor_cliente, max(CASE WHEN other = valor_cliente THEN n END) AS size, "
        f"max(CASE WHEN other = valor_cliente THEN d / greatest(n - 1, 1) END) AS a, min(CASE WHEN other <> valor_cliente THEN d / n END) AS b "
        f"FROM m GROUP BY ALL)",
        f"v AS (SELECT valor_cliente, size, CASE WHEN size = 1 OR b IS NULL THEN {O.d(0)} ELSE (b - a) / greatest(a, b) END AS s FROM r)"],
        f"""SELECT valor_cliente, max(size) AS usuarios, count(*) AS muestra, {O.rnd('avg(s)', 6)} AS silhouette,
       {O.rnd(f'{O.d(1.96)} * coalesce(stddev_samp(s), 0) / sqrt(count(*)) * sqrt((max(size) - count(*)) / CAST(greatest(max(size) - 1, 1) AS DOUBLE))', 6)} AS margen
FROM v GROUP BY valor_cliente""")


@register("silhouette_sample", _silhouette_sample_sql(200))
def q_silhouette_sample(spark, sf):
    """Exact Euclidean silhouettes of 200 customers of each value tier against all customers, with their error bound."""
    data = analytic(spark, sf)
    scaled = SG.scale(data, SG.scaler_stats(data).collect(), keep=[ID, "valor_cliente"], vector=False)
    out = SG.silhouette_sample(scaled, "valor_cliente")
    return out.select("valor_cliente", "usuarios", "muestra", round_half_even("silhouette", 6).alias("silhouette"),
                      round_half_even("margen", 6).alias("margen"))


_CURVES = """
SELECT c_nationkey AS curva, k, count_if(n >= k) AS restantes
FROM (SELECT c_nationkey, o_custkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
     (SELECT unnest(range(1, 31)) AS k) GROUP BY ALL"""


@register("elbow_k", f"""
WITH p AS ({_CURVES}),
n AS (SELECT curva, k, CAST(k - 1 AS DOUBLE) / 29 AS x,
             CASE WHEN max(restantes) OVER w > min(restantes) OVER w
                  THEN CAST(restantes - min(restantes) OVER w AS DOUBLE) / (max(restantes) OVER w - min(restantes) OVER w) ELSE {O.d(0)} END AS y
      FROM p WINDOW w AS (PARTITION BY curva)),
d AS (SELECT curva, k, max(y) OVER (PARTITION BY curva) - y - x AS d FROM n),
b AS (SELECT *, coalesce(lag(d) OVER w, d) AS l, coalesce(lead(d) OVER w, d) AS r, lead(d) OVER w AS nx FROM d WINDOW w AS (PARTITION BY curva ORDER BY k)),
mx AS (SELECT curva, min(k) AS first FROM b WHERE d >= l AND d >= r GROUP BY curva),
ev AS (SELECT b.curva, b.k, d, nx, CASE WHEN d <= l AND d <= r THEN {O.d(0)} ELSE d - {O.d(1)} / 29 END AS t, d >= l AND d >= r AS top
       FROM b JOIN mx ON b.curva = mx.curva AND b.k >= first WHERE nx IS NOT NULL AND ((d >= l AND d >= r) OR (d <= l AND d <= r))),
h AS (SELECT b.curva, b.k FROM b JOIN ev ON b.curva = ev.curva AND ev.k = (SELECT max(k) FROM ev e WHERE e.curva = b.curva AND e.k <= b.k)
      WHERE b.nx < ev.t),
f AS (SELECT curva, min(k) AS k FROM h GROUP BY curva)
SELECT c.curva, (SELECT max(k) FROM ev WHERE ev.curva = c.curva AND ev.top AND ev.k <= f.k) AS elbow
FROM (SELECT DISTINCT curva FROM p) c LEFT JOIN f ON c.curva = f.curva""")
def q_elbow_k(spark, sf):
    """Per nation, the elbow of the curve "customers with k orders or more", k = 1..30."""
    orders, customer = tpch.read_table(spark, sf, "orders"), tpch.read_table(spark, sf, "customer")
    per = (orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
           .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")))
    counts = per.groupBy("c_nationkey").agg(*[F.count_if(F.col("n") >= k).alias(str(k)) for k in range(1, 31)])
    points = counts.select(F.col("c_nationkey").alias("curva"), F.explode(F.array(*[
        F.struct(F.lit(k).cast("long").alias("k"), F.col(str(k)).alias("restantes")) for k in range(1, 31)])).alias("p")).select("curva", "p.*")
    return EL.elbow_k(points, "curva", "k", "restantes")


def _screening_ctes() -> list[str]:
    """Per feature and fold, DuckDB's own line on the other folds and its R² on the fold, row by row."""
    rows = " UNION ALL ".join(f"SELECT '{f}' AS modelo, fold, CAST({f} AS DOUBLE) AS x, CAST({REGRESSION_TARGET} AS DOUBLE) AS y FROM fr" for f in REGRESSION_FEATURES)
    return [f"fr AS (SELECT *, CAST({O.hash_sql('id_cliente', '29:fold', 13)} % 5 AS INTEGER) AS fold FROM labelled WHERE is_test = 0)",
            f"lr AS MATERIALIZED ({rows})",
            "ln AS (SELECT a.modelo, k.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM lr a, (SELECT DISTINCT fold FROM lr) k "
            "WHERE a.fold <> k.fold GROUP BY a.modelo, k.fold)",
            "sc AS (SELECT r.modelo, r.fold, 1 - sum((y - a - b * x) * (y - a - b * x)) / (var_pop(y) * count(*)) AS score "
            "FROM lr r JOIN ln ON r.modelo = ln.modelo AND r.fold = ln.fold GROUP BY r.modelo, r.fold)",
            "cv AS (SELECT modelo, avg(score) AS cv_mean, stddev_pop(score) AS cv_std FROM sc GROUP BY modelo)"]


def _screened(spark, sf):
    train = SV.folds(labelled(spark, sf).filter(F.col("is_test") == 0))
    return SCR.cv_single_features(train, REGRESSION_FEATURES, REGRESSION_TARGET)


@register("cv_single_feature", O.with_ctes(_screening_ctes(), f"SELECT modelo, {O.rnd('cv_mean', 6)} AS cv_mean, {O.rnd('cv_std', 6)} AS cv_std FROM cv"))
def q_cv_single_feature(spark, sf):
    """Cross-validated R² of the line on each regression feature alone."""
    return _screened(spark, sf).select("modelo", *[round_half_even(c, 6).alias(c) for c in ("cv_mean", "cv_std")])


@register("best_single_feature", O.with_ctes(_screening_ctes(), f"SELECT max_by(modelo, cv_mean) AS modelo, {O.rnd('max(cv_mean)', 6)} AS cv_mean FROM cv"))
def q_best_single_feature(spark, sf):
    """The winner by mean CV score among the single features: the rule that picks a model from any CV table."""
    return SV.best_model(_screened(spark, sf)).withColumn("cv_mean", round_half_even("cv_mean", 6))

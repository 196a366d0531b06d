"""Registered model, scoring and sink queries.

Model-backed queries have no SQL oracle (iterative fits); the driver records
a rows-only check for them.  Sink queries write to the shared checkpoint
folder and read back, and are compared with SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import (CLASSIFICATION_FEATURES, CLASSIFICATION_TARGET, ID, KMEANS_FEATURES, PROFILE_COLUMNS,
                         REGRESSION_FEATURES, REGRESSION_TARGET)
from ..operators import analyst as AN
from ..operators import kpis as K
from ..operators import models as M
from ..operators import scoring as SC
from ..operators import segment as SG
from ..operators import supervised as SV
from ..operators.ledger import FitLedger
from ..sources import files, tpch
from . import oracle as O
from . import stages as S
from .registry import analytic, base, clean_base, kpis, labelled, register


# ---- segmentation ---------------------------------------------------------------------

def segmentation(spark, sf) -> dict:
    def build():
        clean = clean_base(spark, sf)
        data = SG.kmeans_input(clean)
        stats_rows = SG.scaler_stats(data).collect()  # one row per feature
        scaled = S.materialize(SG.scale(data, stats_rows))
        n = scaled.count()
        # Larger tables are passed over often: whole waves of the cores.
        scaled = (S.sized(scaled, n) if n <= SG.LOCAL_ROWS else scaled.repartition(SG.partitions(spark, n))).persist()
        sweep = SG.k_sweep(scaled, n)
        rows = [tuple(r) for r in sweep.table.collect()]  # at most 9 rows
        k, method = SG.choose_k(rows)
        centres = sweep.centres[k]  # k x features, scaled units
        raw = scaled.select(ID, SG.assign_expr(centres, KMEANS_FEATURES).alias("cluster"))
        means = raw.join(clean.select(ID, "gasto_mensual"), ID).groupBy("cluster") \
            .agg(F.avg("gasto_mensual").alias("m")).collect()  # k rows
        order = {r["cluster"]: i for i, r in enumerate(sorted(means, key=lambda r: (r["m"], r["cluster"])))}
        relabel = F.create_map(*[x for kv in order.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        pcs, variance = SG.pca_2d(scaled)
        users = raw.select(ID, F.element_at(relabel, F.col("cluster")).alias("cluster")) \
            .join(data, ID).join(pcs, ID).select(ID, *KMEANS_FEATURES, "cluster", "pc1", "pc2")
        users = S.materialize(users)
        sweep_table = spark.createDataFrame(
            [(kk, inertia, sil, k, method) for kk, inertia, sil in rows],
            "k int, inertia double, silhouette_sq double, k_elegido int, metodo string")
        centres_table = spark.createDataFrame(
            [(order[j], *map(float, centres[j])) for j in range(k)],
            "cluster int, " + ", ".join(f"{c} double" for c in KMEANS_FEATURES))
        return {"scaled": scaled, "stats": stats_rows, "centres": centres, "centres_table": centres_table,
                "relabel": relabel, "k": k,
                "method": method, "users": users, "sweep": sweep_table, "pca_variance": variance}
    return S.memo(spark, sf, "segmentation", build)


@register("k_sweep")
def q_k_sweep(spark, sf):
    return segmentation(spark, sf)["sweep"]


@register("segment_users")
def q_segment_users(spark, sf):
    return segmentation(spark, sf)["users"]


@register("cluster_centroids")
def q_cluster_centroids(spark, sf):
    users = segmentation(spark, sf)["users"]
    return users.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in KMEANS_FEATURES])


@register("segment_metrics")
def q_segment_metrics(spark, sf):
    seg = segmentation(spark, sf)
    sweep = seg["sweep"].filter(F.col("k") == F.col("k_elegido"))
    return sweep.select("k_elegido", "metodo", "inertia", "silhouette_sq",
                        F.lit(seg["pca_variance"]).alias("varianza_pca"),
                        F.lit(seg["users"].count()).alias("n_usuarios"))


@register("pca_centroids")
def q_pca_centroids(spark, sf):
    users = segmentation(spark, sf)["users"]
    return users.groupBy("cluster").agg(F.avg("pc1").alias("pc1"), F.avg("pc2").alias("pc2"))


@register("cluster_profile")
def q_cluster_profile(spark, sf):
    """Dashboard profile per KMeans cluster (same operator as the value-tier profile)."""
    return AN.segment_profile(segmentation(spark, sf)["users"], "cluster")


@register("cluster_share")
def q_cluster_share(spark, sf):
    return AN.segment_share(segmentation(spark, sf)["users"], "cluster")


@register("cluster_relative_profile")
def q_cluster_relative_profile(spark, sf):
    return AN.relative_profile(segmentation(spark, sf)["users"], "cluster")


# ---- supervised models -----------------------------------------------------------------

def model_rows(spark, sf) -> DataFrame:
    """Labelled rows that passed the model input gates of both tasks."""
    def build():
        lab = labelled(spark, sf)
        SV.check_supervised_input(lab, REGRESSION_FEATURES, REGRESSION_TARGET)
        SV.check_supervised_input(lab, CLASSIFICATION_FEATURES, CLASSIFICATION_TARGET)
        return lab
    return S.memo(spark, sf, "model_rows", build)


def regression(spark, sf) -> M.Selection:
    def build():
        lab = model_rows(spark, sf)
        train = lab.filter(F.col("is_test") == 0)
        # Not cached: cached rows of one partition would draw every fit to the executor that holds them.
        n = lab.count()
        rows, everything = S.sized(S.materialize(SV.folds(train)), train.count()), S.sized(lab, n)
        return M.select(rows, everything, M.regression_candidates(REGRESSION_FEATURES, REGRESSION_TARGET, rows=n),
                        M.r2_evaluator(REGRESSION_TARGET), 5, FitLedger(spark, "regression", rows, lab))
    return S.memo(spark, sf, "regression", build)


def classification(spark, sf) -> M.Selection:
    def build():
        lab = model_rows(spark, sf)
        n_folds = SV.check_classes(lab)
        train = lab.filter(F.col("is_test") == 0)
        n, n_all = train.count(), lab.count()
        rows, everything = S.sized(S.materialize(SV.folds(train, k=n_folds, label=CLASSIFICATION_TARGET)), n), S.sized(lab, n_all)
        found = M.classification_candidates(CLASSIFICATION_FEATURES, CLASSIFICATION_TARGET, n, rows=n_all)
        return M.select(rows, everything, found, M.f1_evaluator(CLASSIFICATION_TARGET), n_folds, FitLedger(spark, "classification", rows, lab))
    return S.memo(spark, sf, "classification", build)


@register("cv_regression")
def q_cv_regression(spark, sf):
    return regression(spark, sf).cv_table


@register("cv_classification")
def q_cv_classification(spark, sf):
    return classification(spark, sf).cv_table


@register("best_model")
def q_best_model(spark, sf):
    a = SV.best_model(regression(spark, sf).cv_table.withColumn("modelo", F.concat_ws(":", "modelo", "parametros")))
    b = SV.best_model(classification(spark, sf).cv_table.withColumn("modelo", F.concat_ws(":", "modelo", "parametros")))
    return a.withColumn("tarea", F.lit("regresion")).unionByName(b.withColumn("tarea", F.lit("clasificacion")))


def _holdout_reg(spark, sf) -> DataFrame:
    test = model_rows(spark, sf).filter(F.col("is_test") == 1)
    p = regression(spark, sf).holdout_model.transform(test)
    return p.select(ID, F.col(REGRESSION_TARGET).alias("valor_real"), F.col("prediction").alias("valor_predicho"),
                    (F.col(REGRESSION_TARGET) - F.col("prediction")).alias("residuo"))


def _holdout_clf(spark, sf) -> DataFrame:
    test = model_rows(spark, sf).filter(F.col("is_test") == 1)
    p = classification(spark, sf).holdout_model.transform(test)
    return p.select(ID, F.col(CLASSIFICATION_TARGET).alias("valor_real"),
                    F.col("prediction").cast("int").alias("valor_predicho"),
                    M.positive_probability().alias("probabilidad_riesgo"))


@register("holdout_reg_model")
def q_holdout_reg_model(spark, sf):
    return _holdout_reg(spark, sf)


@register("holdout_clf_model")
def q_holdout_clf_model(spark, sf):
    return _holdout_clf(spark, sf)


@register("model_regression_metrics")
def q_model_regression_metrics(spark, sf):
    return SV.regression_metrics(_holdout_reg(spark, sf))


@register("model_classification_metrics")
def q_model_classification_metrics(spark, sf):
    h = _holdout_clf(spark, sf)
    return SV.classification_metrics(h).withColumn("roc_auc", SV.roc_auc(h).select("roc_auc").scalar())


@register("feature_importance")
def q_feature_importance(spark, sf):
    a = M.feature_importance(regression(spark, sf).production_model, REGRESSION_FEATURES).withColumn("tarea", F.lit("regresion"))
    b = M.feature_importance(classification(spark, sf).production_model, CLASSIFICATION_FEATURES) \
        .withColumn("tarea", F.lit("clasificacion"))
    return a.unionByName(b)


@register("model_compare")
def q_model_compare(spark, sf):
    """Candidate comparison table (dashboard): every candidate's CV mean and std, both tasks."""
    return regression(spark, sf).cv_table.withColumn("tarea", F.lit("regresion")).unionByName(
        classification(spark, sf).cv_table.withColumn("tarea", F.lit("clasificacion")))


# ---- batch scoring -------------------------------------------------------------------------

def accepted_requests(spark, sf) -> DataFrame:
    """The raw integrated rows as requests; rows failing the input contract are left out."""
    raw = base(spark, sf)
    return SC.accepted(raw, KMEANS_FEATURES, known=raw.columns)


def with_cluster(seg: dict, req: DataFrame) -> DataFrame:
    """``req`` with its ``cluster``, worked out in the row."""
    z = SG.scaled_columns(seg["stats"])
    return req.withColumn("cluster", F.element_at(seg["relabel"], SG.assign_expr(seg["centres"], KMEANS_FEATURES, z)))


def with_spend(model, req: DataFrame) -> DataFrame:
    """``req`` with its ``gasto_predicho``."""
    return model.transform(req).withColumn("gasto_predicho", SC.clamp_spend(F.col("prediction"))).select(*req.columns, "gasto_predicho")


def with_risk(model, req: DataFrame) -> DataFrame:
    """``req`` with ``riesgo_predicho`` and ``probabilidad_riesgo``."""
    return model.transform(req).select(*req.columns, F.col("prediction").cast("int").alias("riesgo_predicho"),
                                       SC.clamp_probability(M.positive_probability()).alias("probabilidad_riesgo"))


@register("assign_cluster")
def q_assign_cluster(spark, sf):
    return with_cluster(segmentation(spark, sf), accepted_requests(spark, sf)).select(ID, "cluster")


@register("score_spend")
def q_score_spend(spark, sf):
    return with_spend(regression(spark, sf).production_model, accepted_requests(spark, sf)).select(ID, "gasto_predicho")


@register("score_risk")
def q_score_risk(spark, sf):
    scored = with_risk(classification(spark, sf).production_model, accepted_requests(spark, sf))
    return scored.select(ID, "riesgo_predicho", "probabilidad_riesgo")


@register("score_chain")
def q_score_chain(spark, sf):
    """Predicted spend replaces the observed one, then segment and risk are scored: one pass over the requests."""
    spend = with_spend(regression(spark, sf).production_model, accepted_requests(spark, sf))
    told = with_cluster(segmentation(spark, sf), spend.withColumn("gasto_mensual", F.col("gasto_predicho")))
    scored = with_risk(classification(spark, sf).production_model, told)
    return scored.select(ID, "gasto_predicho", "cluster", "riesgo_predicho", "probabilidad_riesgo")


# ---- sources and sinks ---------------------------------------------------------------------

_B_NUM = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" if c != ID else f"CAST({c} AS BIGINT) AS {c}"
                   for c in tpch.BEHAVIOUR_COLUMNS)


@register("scan_csv", O.with_chain(f"SELECT {_B_NUM} FROM behaviour_src"))
def q_scan_csv(spark, sf):
    """Behaviour source round trip through CSV (header, every cell read as text)."""
    path = files.scratch(spark, "behaviour-csv")
    files.write_csv(tpch.behaviour_source(spark, sf), path)
    raw = files.read_csv_text(spark, path, tpch.BEHAVIOUR_COLUMNS)
    return raw.select(*[F.col(c).try_cast("double").alias(c) if c != ID else F.col(c).cast("long").alias(c)
                        for c in tpch.BEHAVIOUR_COLUMNS])


@register("load_profile", O.with_chain(f"SELECT {', '.join(PROFILE_COLUMNS)} FROM profile_src"))
def q_load_profile(spark, sf):
    """Profile table bulk-loaded with the declared schema (the relational source)."""
    path = files.scratch(spark, "profile-table")
    return files.load_table(spark, tpch.profile_source(spark, sf), path)


@register("reload_stage", O.with_chain("SELECT * FROM clean"))
def q_reload_stage(spark, sf):
    path = files.scratch(spark, "stage-clean")
    clean_base(spark, sf).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("read_json_doc", O.with_chain("""
SELECT CAST(coalesce(sum(CASE WHEN valor_cliente = 'alto_valor' THEN usuarios END), 0) AS BIGINT) AS usuarios_alto_valor,
       CAST(coalesce(sum(CASE WHEN valor_cliente = 'valor_en_riesgo' THEN usuarios END), 0) AS BIGINT)
         AS usuarios_valor_en_riesgo
FROM kpis"""))
def q_read_json_doc(spark, sf):
    path = files.scratch(spark, "kpi-summary-json")
    files.write_json_doc(K.kpi_summary(kpis(spark, sf)), path)
    return files.read_json_doc(spark, path)


@register("stage_counts", O.with_chain("""
SELECT 'integrado' AS stage, count(*) AS filas, count(DISTINCT id_cliente) AS ids FROM base_raw
UNION ALL SELECT 'limpio', count(*), count(DISTINCT id_cliente) FROM clean
UNION ALL SELECT 'analitico', count(*), count(DISTINCT id_cliente) FROM analytic"""))
def q_stage_counts(spark, sf):
    parts = [base(spark, sf).agg(F.lit("integrado").alias("stage"), F.count(F.lit(1)).alias("filas"),
                                 F.count_distinct(ID).alias("ids")),
             clean_base(spark, sf).agg(F.lit("limpio").alias("stage"), F.count(F.lit(1)).alias("filas"),
                                       F.count_distinct(ID).alias("ids")),
             analytic(spark, sf).agg(F.lit("analitico").alias("stage"), F.count(F.lit(1)).alias("filas"),
                                     F.count_distinct(ID).alias("ids"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- model inputs (relational, oracle-checked) -------------------------------------------

_KF = ", ".join(KMEANS_FEATURES)


@register("kmeans_input", O.with_chain(f"SELECT id_cliente, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in KMEANS_FEATURES)} FROM clean"))
def q_kmeans_input(spark, sf):
    return SG.kmeans_input(clean_base(spark, sf))


def _z_sql(c: str) -> str:
    sd = f"stddev_pop(CAST({c} AS DOUBLE)) OVER ()"
    return O.rnd(f"(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / CASE WHEN {sd} = 0 THEN {O.d(1)} ELSE {sd} END", 6)


@register("scale_features", O.with_chain(
    f"SELECT id_cliente, {', '.join(f'{_z_sql(c)} AS {c}' for c in KMEANS_FEATURES)} FROM clean"))
def q_scale_features(spark, sf):
    """Population-std z-scores of the 15 segmentation features (6 decimals)."""
    from ..functions.numeric import round_half_even
    data = SG.kmeans_input(clean_base(spark, sf), check=False)
    z = SG.scale(data, SG.scaler_stats(data).collect(), vector=False)
    return z.select(ID, *[round_half_even(c, 6).alias(c) for c in KMEANS_FEATURES])


@register("centroids", O.with_chain(
    f"SELECT valor_cliente, {', '.join(O.rnd(f'avg({c})', 6) + f' AS {c}' for c in KMEANS_FEATURES)} "
    "FROM analytic GROUP BY valor_cliente"))
def q_centroids(spark, sf):
    """Centroids in original units, for given labels (the value tiers)."""
    from ..functions.numeric import round_half_even
    means = analytic(spark, sf).groupBy("valor_cliente").agg(*[F.avg(c).alias(c) for c in KMEANS_FEATURES])
    return means.select("valor_cliente", *[round_half_even(c, 6).alias(c) for c in KMEANS_FEATURES])


def _silhouette_sql() -> str:
    f = KMEANS_FEATURES
    z = ", ".join(f"{_z_raw(c)} AS {c}" for c in f)
    norm = " + ".join(f"{c} * {c}" for c in f)
    dot = " + ".join(f"p.{c} * s.{c}" for c in f)
    return f"""
SELECT valor_cliente, count(*) AS usuarios, {O.rnd('avg(s)', 6)} AS silhouette_sq FROM (
  SELECT id_cliente, valor_cliente, CASE WHEN max(n_own) = 1 THEN {O.d(0)}
         ELSE (min(other) - max(own)) / greatest(min(other), max(own)) END AS s
  FROM (SELECT p.id_cliente, p.valor_cliente, CASE WHEN s.t = p.valor_cliente THEN s.n END AS n_own,
               CASE WHEN s.t = p.valor_cliente THEN (s.n * p.q + s.q - 2 * ({dot})) / greatest(s.n - 1, 1) END AS own,
               CASE WHEN s.t <> p.valor_cliente THEN (s.n * p.q + s.q - 2 * ({dot})) / s.n END AS other
        FROM (SELECT *, {norm} AS q FROM (SELECT id_cliente, valor_cliente, {z} FROM analytic)) p,
             (SELECT valor_cliente AS t, count(*) AS n, sum({norm}) AS q, {', '.join(f'sum({c}) AS {c}' for c in f)}
              FROM (SELECT valor_cliente, {z} FROM analytic) GROUP BY valor_cliente) s)
  GROUP BY id_cliente, valor_cliente) GROUP BY valor_cliente"""


def _z_raw(c: str) -> str:
    sd = f"stddev_pop(CAST({c} AS DOUBLE)) OVER ()"
    return f"((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / CASE WHEN {sd} = 0 THEN {O.d(1)} ELSE {sd} END)"


@register("silhouette_tiers", O.with_chain(_silhouette_sql()))
def q_silhouette_tiers(spark, sf):
    """Squared-Euclidean silhouette of the value tiers on the scaled segmentation features."""
    from ..functions.numeric import round_half_even
    data = analytic(spark, sf)
    scaled = SG.scale(data, SG.scaler_stats(data).collect(), keep=[ID, "valor_cliente"], vector=False)
    out = SG.silhouette_given(scaled, "valor_cliente")
    return out.withColumn("silhouette_sq", round_half_even("silhouette_sq", 6))


@register("supervised_input", O.with_chain(
    f"SELECT id_cliente, is_test, gasto_mensual, riesgo_bajo_compromiso, "
    f"{', '.join(c for c in REGRESSION_FEATURES)} FROM labelled"))
def q_supervised_input(spark, sf):
    """Model input after the leakage and contract gates: features, both targets, split flag."""
    lab = labelled(spark, sf)
    SV.check_supervised_input(lab, REGRESSION_FEATURES, REGRESSION_TARGET)
    SV.check_supervised_input(lab, CLASSIFICATION_FEATURES, CLASSIFICATION_TARGET)
    return lab.select(ID, "is_test", REGRESSION_TARGET, CLASSIFICATION_TARGET, *REGRESSION_FEATURES)


@register("distinct_ids", O.with_chain("SELECT DISTINCT id_cliente FROM analytic ORDER BY id_cliente"))
def q_distinct_ids(spark, sf):
    """Sorted option list of customer ids (range-partitioned global sort)."""
    return AN.distinct_sorted(analytic(spark, sf), ID)

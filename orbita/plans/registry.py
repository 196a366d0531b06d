"""Registered queries: one DataFrame-returning callable per operator.

Each callable takes (spark, sf_dir) and builds its plan from the driver
tables, so its work grows with them.  The matching DuckDB statements live in
``oracle_sql()`` below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import BASE_COLUMNS, BASE_CONTRACT
from ..operators import clean as C
from ..operators import features as FE
from ..operators import integrate as I
from ..operators import kpis as K
from ..sources import tpch
from . import oracle as O
from . import stages as S

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared lineage ---------------------------------------------------------

def sources(spark, sf):
    """Extracted sources, materialized once (validation, compat and join all read them)."""
    b = S.stage(spark, sf, "behaviour_src", lambda: tpch.behaviour_source(spark, sf))
    p = S.stage(spark, sf, "profile_src", lambda: tpch.profile_source(spark, sf))
    return b, tpch.profile_for(p, b)


def base(spark, sf) -> DataFrame:
    def build():
        b, p = sources(spark, sf)
        return I.join_one_to_one(b, p).base
    return S.stage(spark, sf, "base", build)


def clean_base(spark, sf) -> DataFrame:
    # Ids are unique on both sides (proven by validation), so exact duplicates
    # cannot exist after the one-to-one join and the dedup shuffle is skipped.
    return S.stage(spark, sf, "clean", lambda: C.clean(base(spark, sf), BASE_CONTRACT, ids_unique=True,
                                                       border=S.materialize))


def analytic(spark, sf) -> DataFrame:
    return S.stage(spark, sf, "analytic", lambda: FE.derive(clean_base(spark, sf), border=S.materialize))


def kpis(spark, sf) -> DataFrame:
    return K.kpis_grid(analytic(spark, sf))


# ---- registry -----------------------------------------------------------------

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


register("kpis_grid", O.with_chain("SELECT * FROM kpis"))(kpis)

# ---- sources and validation ---------------------------------------------------------

from ..contracts import BEHAVIOUR_COLUMNS, PROFILE_COLUMNS, ID  # noqa: E402
from ..operators import validate as V  # noqa: E402

_B_TEXT, _B_FLOAT = {"tiempo_promedio_sesion_min"}, {"horas_consumo_mensual", "gasto_mensual",
                                                       "porcentaje_finalizacion", "porcentaje_uso_promociones"}
_P_FLOAT = {"porcentaje_uso_app_movil", "distancia_promedio_red_km"}
_P_ACTUAL = PROFILE_COLUMNS + ["segmento_mercado"]


@register("validate_source", O.with_chain(O.source_issues_sql(
    "behaviour_src", BEHAVIOUR_COLUMNS, BEHAVIOUR_COLUMNS, V.BEHAVIOUR_SOURCE, _B_TEXT, _B_FLOAT)))
def q_validate_source(spark, sf):
    return V.validate_source(sources(spark, sf)[0], BEHAVIOUR_COLUMNS, V.BEHAVIOUR_SOURCE)


@register("validate_profile", O.with_chain(O.source_issues_sql(
    "profile_src", PROFILE_COLUMNS, _P_ACTUAL, V.PROFILE_SOURCE, set(), _P_FLOAT)))
def q_validate_profile(spark, sf):
    return V.validate_source(tpch.profile_source(spark, sf), PROFILE_COLUMNS, V.PROFILE_SOURCE)


_COLUMN_CODES = ("NULL_VALUES", "NON_NUMERIC_VALUES", "CONVERTIBLE_NUMERIC_TYPE", "INFINITE_VALUES")


@register("validate_columns", O.with_chain("SELECT * FROM (" + O.source_issues_sql(
    "behaviour_src", BEHAVIOUR_COLUMNS, BEHAVIOUR_COLUMNS, V.BEHAVIOUR_SOURCE, _B_TEXT, _B_FLOAT)
    + f") WHERE code IN {_COLUMN_CODES}"))
def q_validate_columns(spark, sf):
    """The checks of single columns (nulls, text, type, infinities) on the behaviour source."""
    issues = V.validate_source(sources(spark, sf)[0], BEHAVIOUR_COLUMNS, V.BEHAVIOUR_SOURCE)
    return issues.where(F.col("code").isin(*_COLUMN_CODES))


_B_NO_SPEND = [c for c in BEHAVIOUR_COLUMNS if c != "gasto_mensual"]


@register("validate_schema", O.with_chain(O.source_issues_sql(
    "(SELECT * EXCLUDE (gasto_mensual) FROM behaviour_src)", BEHAVIOUR_COLUMNS, _B_NO_SPEND, V.BEHAVIOUR_SOURCE,
    _B_TEXT, _B_FLOAT - {"gasto_mensual"})))
def q_validate_schema(spark, sf):
    """Mutation test on real rows: the behaviour source without its spend column."""
    return V.validate_source(tpch.behaviour_source(spark, sf).drop("gasto_mensual"), BEHAVIOUR_COLUMNS,
                             V.BEHAVIOUR_SOURCE)


@register("validate_ids", O.with_chain(
    O.source_issues_sql("events_src", [ID], [ID, "eventos", "valor_total"], "eventos", set(), set())
    + "\nUNION ALL\n"
    + O.source_issues_sql("lineitem_keyed", [ID], [ID, "horas_consumo_mensual"], "lineitem", set(), set())))
def q_validate_ids(spark, sf):
    """Id checks on sources with real id problems: events (id 0) and lineitem keyed by order (duplicates)."""
    a = V.validate_source(tpch.events_source(spark, sf), [ID], "eventos")
    b = V.validate_source(tpch.lineitem_keyed(spark, sf), [ID], "lineitem")
    return a.unionByName(b)


@register("id_compat", O.with_chain("""
SELECT count(l.id) AS ids_izquierda, count(r.id) AS ids_derecha,
       count_if(l.id IS NOT NULL AND r.id IS NOT NULL) AS ids_compartidos,
       count_if(r.id IS NULL) AS ids_solo_izquierda, count_if(l.id IS NULL) AS ids_solo_derecha
FROM (SELECT DISTINCT CAST(id_cliente AS DOUBLE) AS id FROM events_src) l
FULL OUTER JOIN (SELECT DISTINCT CAST(id_cliente AS DOUBLE) AS id FROM profile_src) r ON l.id = r.id"""))
def q_id_compat(spark, sf):
    return V.id_compat(tpch.events_source(spark, sf), tpch.profile_source(spark, sf))


@register("ids_only_left", O.with_chain("""
SELECT DISTINCT CAST(id_cliente AS DOUBLE) AS id_cliente FROM profile_src
WHERE CAST(id_cliente AS DOUBLE) NOT IN (SELECT CAST(id_cliente AS DOUBLE) FROM events_src)
ORDER BY id_cliente LIMIT 10"""))
def q_ids_only_left(spark, sf):
    """Top-10 sample of profile ids without events (the sample is the feature)."""
    return V.ids_only_left(tpch.profile_source(spark, sf), tpch.events_source(spark, sf))


def _compat_sql(left: str, right: str) -> str:
    return f"""
SELECT 'compatibilidad_ids' AS stage, 'CUSTOMER_ID_MISMATCH' AS code, 'error' AS severity,
       CAST('id_cliente' AS VARCHAR) AS column_name, CAST(count_if(l.id IS NULL) + count_if(r.id IS NULL) AS BIGINT) AS n
FROM (SELECT DISTINCT TRY_CAST(id_cliente AS DOUBLE) AS id FROM {left} WHERE TRY_CAST(id_cliente AS DOUBLE) IS NOT NULL) l
FULL OUTER JOIN (SELECT DISTINCT TRY_CAST(id_cliente AS DOUBLE) AS id FROM {right}
                 WHERE TRY_CAST(id_cliente AS DOUBLE) IS NOT NULL) r ON l.id = r.id
HAVING count_if(l.id IS NULL) + count_if(r.id IS NULL) > 0"""


_SRC_ISSUES = ("(" + O.source_issues_sql("behaviour_src", BEHAVIOUR_COLUMNS, BEHAVIOUR_COLUMNS, V.BEHAVIOUR_SOURCE,
                                         _B_TEXT, _B_FLOAT)
               + "\nUNION ALL\n" + O.source_issues_sql("profile_src", PROFILE_COLUMNS, _P_ACTUAL, V.PROFILE_SOURCE,
                                                       set(), _P_FLOAT) + ")")


@register("validate_sources", O.with_chain(f"""
SELECT * FROM {_SRC_ISSUES} s
UNION ALL
SELECT * FROM ({_compat_sql('behaviour_src', 'profile_src')}) c
WHERE (SELECT count(*) FROM {_SRC_ISSUES} x WHERE x.severity = 'error' AND x.code IN
       ('INVALID_CUSTOMER_ID', 'NON_POSITIVE_CUSTOMER_ID', 'DUPLICATED_CUSTOMER_ID', 'MISSING_STREAMING_ID',
        'MISSING_PROFILE_ID')) = 0"""))
def q_validate_sources(spark, sf):
    """Consolidated report on the unrestricted pair (at sf0.1 one customer has no orders)."""
    b, _ = sources(spark, sf)
    return V.validate_sources(b, S.stage(spark, sf, "profile_src", lambda: tpch.profile_source(spark, sf)))


# ---- integration ---------------------------------------------------------------------

@register("integrate", O.with_chain("SELECT * FROM base_raw"))
def q_integrate(spark, sf):
    return base(spark, sf)


@register("integration_meta", O.with_chain("""
SELECT (SELECT count(*) FROM behaviour_src) AS filas_streaming,
       (SELECT count(DISTINCT id_cliente) FROM behaviour_src) AS ids_streaming,
       (SELECT count(*) FROM profile_bound) AS filas_perfil,
       (SELECT count(DISTINCT id_cliente) FROM profile_bound) AS ids_perfil,
       (SELECT count(*) FROM base_raw) AS filas_integradas,
       'segmento_mercado' AS columnas_descartadas, 'inner' AS tipo_join, 'one_to_one' AS cardinalidad"""))
def q_integration_meta(spark, sf):
    b, p = sources(spark, sf)
    res = I.join_one_to_one(b, p)
    return I.integration_meta(b, p, res.base, res.discarded_columns)


# ---- cleaning -------------------------------------------------------------------------



@register("dedup_exact", O.with_chain(
    "SELECT DISTINCT user_id + 1 AS id_cliente, event_type, value FROM events"))
def q_dedup_exact(spark, sf):
    """Exact-duplicate removal on events (user, type, value) - natural duplicates."""
    from ..contracts import Contract
    ev = tpch.read_table(spark, sf, "events").select((F.col("user_id") + 1).alias(ID), "event_type", "value")
    return C.dedup_exact(ev, Contract(columns=(ID, "event_type", "value")))


@register("id_gate", O.with_chain("""
SELECT count_if(TRY_CAST(id_cliente AS DOUBLE) IS NULL) AS ids_invalidos,
       count_if(fmod(TRY_CAST(id_cliente AS DOUBLE), 1) <> 0) AS ids_no_enteros,
       count_if(TRY_CAST(id_cliente AS DOUBLE) <= 0) AS ids_no_positivos,
       count(id_cliente) - count(DISTINCT id_cliente) AS ids_duplicados
FROM events_src"""))
def q_id_gate(spark, sf):
    return C.id_gate_counts(tpch.events_source(spark, sf))


@register("coerce_numeric", O.with_chain("SELECT * FROM coerced"))
def q_coerce(spark, sf):
    return C.coerce_numeric(base(spark, sf))


@register("mask_domain", O.with_chain("SELECT * FROM masked"))
def q_mask(spark, sf):
    return C.mask_domain(C.coerce_numeric(base(spark, sf)))


@register("column_medians", O.with_chain(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value FROM medians" for c in O.VALUE_COLUMNS)))
def q_medians(spark, sf):
    return C.column_medians(C.mask_domain(C.coerce_numeric(base(spark, sf))), BASE_CONTRACT.value_columns)


@register("impute_median", O.with_chain("SELECT * FROM clean"))
def q_clean(spark, sf):
    return clean_base(spark, sf)


def _stage_counts_sql() -> str:
    parts = []
    for c in O.VALUE_COLUMNS:
        ood = O._out_of_domain(c)
        parts.append(f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS nulos_antes, "
                     f"count_if(coalesce({ood}, FALSE)) AS valores_fuera_rango, "
                     f"count_if({c} IS NULL OR coalesce({ood}, FALSE)) AS valores_imputados FROM coerced")
    return " UNION ALL ".join(parts)


def _outliers_sql(table: str) -> str:
    parts = []
    for c in O.VALUE_COLUMNS:
        q1, q3 = O.quantile_sql(c, table, 0.25), O.quantile_sql(c, table, 0.75)
        parts.append(f"SELECT '{c}' AS column_name, (SELECT CASE WHEN q3 - q1 = 0 THEN 0 ELSE "
                     f"count_if({c} < q1 - {O.d(1.5)} * (q3 - q1) OR {c} > q3 + {O.d(1.5)} * (q3 - q1)) END "
                     f"FROM {table}, (SELECT {q1} AS q1, {q3} AS q3) qq GROUP BY q1, q3) AS outliers_iqr")
    return " UNION ALL ".join(parts)


@register("outliers_iqr", O.with_chain(_outliers_sql("clean")))
def q_outliers(spark, sf):
    return C.outliers_iqr(clean_base(spark, sf), BASE_CONTRACT.value_columns)


@register("cleaning_report", O.with_chain(
    f"SELECT s.*, o.outliers_iqr FROM ({_stage_counts_sql()}) s JOIN ({_outliers_sql('clean')}) o USING (column_name)"))
def q_cleaning_report(spark, sf):
    counts = C.stage_counts(C.coerce_numeric(base(spark, sf)))
    return C.report_with_outliers(counts, clean_base(spark, sf))


@register("cleaning_summary", O.with_chain("""
SELECT (SELECT count(*) FROM base_raw) AS filas_iniciales,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM base_raw)) AS filas_limpias,
       (SELECT count(*) FROM base_raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM base_raw)) AS duplicados_exactos"""))
def q_cleaning_summary(spark, sf):
    return C.cleaning_summary(base(spark, sf))


@register("validate_clean", O.with_chain(O.clean_issues_sql("coerced")))
def q_validate_clean(spark, sf):
    """Post-clean checks run on the coerced (not yet masked/imputed) table: real hits."""
    return V.validate_clean(C.coerce_numeric(base(spark, sf)))


@register("validate_clean_final", O.with_chain(O.clean_issues_sql("clean")))
def q_validate_clean_final(spark, sf):
    return V.validate_clean(clean_base(spark, sf))


# ---- features ---------------------------------------------------------------------

@register("ratios", O.with_chain("SELECT id_cliente, contenidos_por_sesion, gasto_por_hora, minutos_totales_estimados, "
                                 "soporte_por_dispositivo, generos_por_contenido FROM analytic"))
def q_ratios(spark, sf):
    return FE.ratios(clean_base(spark, sf)).select(
        ID, "contenidos_por_sesion", "gasto_por_hora", "minutos_totales_estimados", "soporte_por_dispositivo",
        "generos_por_contenido")


@register("engagement", O.with_chain("SELECT id_cliente, engagement_score FROM scored"))
def q_engagement(spark, sf):
    return FE.engagement_scores(clean_base(spark, sf))


@register("engagement_level", O.with_chain("SELECT id_cliente, engagement_score, nivel_engagement FROM analytic"))
def q_engagement_level(spark, sf):
    return analytic(spark, sf).select(ID, "engagement_score", FE.engagement_level("engagement_score")
                                      .alias("nivel_engagement"))


@register("flags", O.with_chain("SELECT id_cliente, cliente_antiguo, uso_promociones_alto FROM analytic"))
def q_flags(spark, sf):
    return FE.flags(clean_base(spark, sf)).select(ID, "cliente_antiguo", "uso_promociones_alto")


@register("tier_cuts", O.with_chain(" UNION ALL ".join(
    f"SELECT '{t}' AS tag, {t} AS value FROM cuts" for t in ("gasto_alto", "gasto_bajo", "engagement_alto",
                                                             "engagement_bajo"))))
def q_tier_cuts(spark, sf):
    return FE.tier_cuts(analytic(spark, sf))


@register("value_tier", O.with_chain("SELECT id_cliente, valor_cliente FROM analytic"))
def q_value_tier(spark, sf):
    scored = analytic(spark, sf).select(*BASE_CONTRACT.columns, "engagement_score")
    return FE.value_tier(scored).select(ID, "valor_cliente")


@register("analytic", O.with_chain("SELECT * FROM analytic"))
def q_analytic(spark, sf):
    return analytic(spark, sf)


# ---- KPIs and reports ---------------------------------------------------------------

@register("kpi_summary", O.with_chain("""
SELECT CAST(coalesce(sum(CASE WHEN valor_cliente = 'alto_valor' THEN usuarios END), 0) AS BIGINT) AS usuarios_alto_valor,
       CAST(coalesce(sum(CASE WHEN valor_cliente = 'valor_en_riesgo' THEN usuarios END), 0) AS BIGINT)
         AS usuarios_valor_en_riesgo
FROM kpis"""))
def q_kpi_summary(spark, sf):
    return K.kpi_summary(kpis(spark, sf))


@register("kpi_matrix", O.with_chain("""
SELECT nivel_engagement,
       sum(CASE WHEN valor_cliente = 'alto_valor' THEN usuarios END) AS alto_valor,
       sum(CASE WHEN valor_cliente = 'valor_en_riesgo' THEN usuarios END) AS valor_en_riesgo,
       sum(CASE WHEN valor_cliente = 'valor_medio' THEN usuarios END) AS valor_medio
FROM kpis GROUP BY nivel_engagement"""))
def q_kpi_matrix(spark, sf):
    return K.kpi_matrix(kpis(spark, sf))


def _quality_sql() -> str:
    def one(name, table, cols):
        nulls = " + ".join(f"count_if({c} IS NULL)" for c in cols)
        return (f"SELECT '{name}' AS stage, count(*) AS filas, CAST({len(cols)} AS BIGINT) AS columnas, "
                f"CAST({nulls} AS BIGINT) AS nulos_totales FROM {table}")
    from ..contracts import DERIVED_COLUMNS
    return " UNION ALL ".join([one("integrado", "base_raw", BASE_COLUMNS), one("limpio", "clean", BASE_COLUMNS),
                               one("analitico", "analytic", BASE_COLUMNS + DERIVED_COLUMNS)])


@register("quality_report", O.with_chain(_quality_sql()))
def q_quality_report(spark, sf):
    return K.quality_report([("integrado", base(spark, sf)), ("limpio", clean_base(spark, sf)),
                             ("analitico", analytic(spark, sf))])


@register("null_counts", O.with_chain(" UNION ALL ".join(
    f"SELECT 'integrado' AS stage, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM base_raw"
    for c in BASE_COLUMNS)))
def q_null_counts(spark, sf):
    return K.null_counts(base(spark, sf), "integrado")


# ---- supervised: relational parts ------------------------------------------------------

from ..contracts import CLASSIFICATION_TARGET  # noqa: E402
from ..operators import supervised as SV  # noqa: E402


def labelled(spark, sf) -> DataFrame:
    def build():
        split = SV.train_test_split(clean_base(spark, sf))
        return SV.risk_label(split)
    return S.stage(spark, sf, "labelled", build)


@register("train_test_split", O.with_chain("SELECT id_cliente, is_test FROM split"))
def q_split(spark, sf):
    return SV.train_test_split(clean_base(spark, sf)).select(ID, "is_test")


@register("risk_thresholds", O.with_chain(
    "SELECT 'porcentaje_finalizacion' AS column_name, fin AS value FROM risk_th "
    "UNION ALL SELECT 'sesiones_semana', ses FROM risk_th"))
def q_risk_thresholds(spark, sf):
    return SV.risk_thresholds(SV.train_test_split(clean_base(spark, sf)))


@register("risk_label", O.with_chain("SELECT id_cliente, is_test, riesgo_bajo_compromiso FROM labelled"))
def q_risk_label(spark, sf):
    return labelled(spark, sf).select(ID, "is_test", CLASSIFICATION_TARGET)


@register("class_balance", O.with_chain(
    "SELECT is_test, riesgo_bajo_compromiso, count(*) AS n FROM labelled GROUP BY ALL"))
def q_class_balance(spark, sf):
    return SV.class_balance(labelled(spark, sf))


@register("folds", O.with_chain(f"""
SELECT id_cliente, riesgo_bajo_compromiso,
       CAST((row_number() OVER (PARTITION BY riesgo_bajo_compromiso
                                ORDER BY {O.hash_sql('id_cliente', '29:fold', 13)}) - 1) % 5 AS INTEGER) AS fold
FROM labelled WHERE is_test = 0"""))
def q_folds(spark, sf):
    """Stratified 5-fold assignment of the training rows."""
    train = labelled(spark, sf).filter(F.col("is_test") == 0)
    return SV.folds(train, label=CLASSIFICATION_TARGET).select(ID, CLASSIFICATION_TARGET, "fold")


@register("folds_plain", O.with_chain(
    f"SELECT id_cliente, CAST({O.hash_sql('id_cliente', '29:fold', 13)} % 5 AS INTEGER) AS fold "
    "FROM labelled WHERE is_test = 0"))
def q_folds_plain(spark, sf):
    train = labelled(spark, sf).filter(F.col("is_test") == 0)
    return SV.folds(train).select(ID, "fold")


_OLS = ("(SELECT regr_slope(gasto_mensual, horas_consumo_mensual) AS b, "
        "regr_intercept(gasto_mensual, horas_consumo_mensual) AS a FROM split WHERE is_test = 0)")


@register("ols_simple", O.with_chain(f"""
SELECT {O.rnd('regr_slope(gasto_mensual, horas_consumo_mensual)', 6)} AS pendiente,
       {O.rnd('regr_intercept(gasto_mensual, horas_consumo_mensual)', 6)} AS intercepto,
       regr_count(gasto_mensual, horas_consumo_mensual) AS n
FROM split WHERE is_test = 0"""))
def q_ols(spark, sf):
    train = SV.train_test_split(clean_base(spark, sf)).filter(F.col("is_test") == 0)
    return SV.ols_simple(train, "horas_consumo_mensual", "gasto_mensual")


def ols_holdout(spark, sf) -> DataFrame:
    """Holdout predictions of the single-feature spend model (rounded coefficients)."""
    split = SV.train_test_split(clean_base(spark, sf))
    coef = SV.ols_simple(split.filter(F.col("is_test") == 0), "horas_consumo_mensual", "gasto_mensual")
    b, a = coef.select("pendiente").scalar(), coef.select("intercepto").scalar()
    test = split.filter(F.col("is_test") == 1)
    return test.select(ID, F.col("gasto_mensual").alias("valor_real"),
                       (a + b * F.col("horas_consumo_mensual")).alias("valor_predicho"))


_OLS_PRED = (f"(SELECT id_cliente, gasto_mensual AS valor_real, c.a + c.b * horas_consumo_mensual AS valor_predicho "
             f"FROM split, (SELECT {O.rnd('regr_slope(gasto_mensual, horas_consumo_mensual)', 6)} AS b, "
             f"{O.rnd('regr_intercept(gasto_mensual, horas_consumo_mensual)', 6)} AS a FROM split WHERE is_test = 0) c "
             f"WHERE is_test = 1)")


@register("holdout_reg", O.with_chain(
    f"SELECT id_cliente, valor_real, valor_predicho, valor_real - valor_predicho AS residuo FROM {_OLS_PRED}"))
def q_holdout_reg(spark, sf):
    p = ols_holdout(spark, sf)
    return p.withColumn("residuo", F.col("valor_real") - F.col("valor_predicho"))


@register("regression_metrics", O.with_chain(f"""
SELECT {O.rnd('1 - sum((valor_real - valor_predicho) * (valor_real - valor_predicho)) / (var_pop(valor_real) * count(*))', 6)} AS r2,
       {O.rnd('avg(abs(valor_real - valor_predicho))', 6)} AS mae,
       {O.rnd('sqrt(avg((valor_real - valor_predicho) * (valor_real - valor_predicho)))', 6)} AS rmse,
       count(*) AS n
FROM {_OLS_PRED}"""))
def q_regression_metrics(spark, sf):
    return SV.regression_metrics(ols_holdout(spark, sf))


def baseline_risk(spark, sf) -> DataFrame:
    """Holdout of the engagement baseline: P(risk) = 1 - engagement score."""
    lab = labelled(spark, sf).filter(F.col("is_test") == 1).select(ID, CLASSIFICATION_TARGET)
    sc = analytic(spark, sf).select(ID, (F.lit(1.0) - F.col("engagement_score")).alias("probabilidad_riesgo"))
    j = lab.join(sc, ID)
    return j.select(ID, F.col(CLASSIFICATION_TARGET).alias("valor_real"),
                    (F.col("probabilidad_riesgo") >= 0.5).cast("int").alias("valor_predicho"), "probabilidad_riesgo")


_BASE_PRED = ("(SELECT l.id_cliente, l.riesgo_bajo_compromiso AS valor_real, "
              f"CAST({O.d(1)} - a.engagement_score >= 0.5 AS INTEGER) AS valor_predicho, "
              f"{O.d(1)} - a.engagement_score AS probabilidad_riesgo "
              "FROM labelled l JOIN analytic a USING (id_cliente) WHERE l.is_test = 1)")


@register("holdout_clf", O.with_chain(f"SELECT * FROM {_BASE_PRED}"))
def q_holdout_clf(spark, sf):
    return baseline_risk(spark, sf)


@register("confusion_matrix", O.with_chain(f"""
SELECT r.real, p.predicho, count_if(valor_real = r.real AND valor_predicho = p.predicho) AS n
FROM {_BASE_PRED} x, (VALUES (0), (1)) r(real), (VALUES (0), (1)) p(predicho) GROUP BY r.real, p.predicho"""))
def q_confusion(spark, sf):
    return SV.confusion_matrix(baseline_risk(spark, sf))


@register("classification_metrics", O.with_chain(f"""
SELECT {O.rnd('count_if(valor_real = valor_predicho) / count(*)', 6)} AS accuracy,
       {O.rnd(f'coalesce(count_if(valor_real = 1 AND valor_predicho = 1) / nullif(count_if(valor_predicho = 1), 0), {O.d(0)})', 6)} AS precision,
       {O.rnd(f'coalesce(count_if(valor_real = 1 AND valor_predicho = 1) / nullif(count_if(valor_real = 1), 0), {O.d(0)})', 6)} AS recall,
       {O.rnd(f'coalesce(2.0 * count_if(valor_real = 1 AND valor_predicho = 1) / nullif(2.0 * count_if(valor_real = 1 AND valor_predicho = 1) + count_if(valor_real = 0 AND valor_predicho = 1) + count_if(valor_real = 1 AND valor_predicho = 0), 0), {O.d(0)})', 6)} AS f1
FROM {_BASE_PRED}"""))
def q_classification_metrics(spark, sf):
    return SV.classification_metrics(baseline_risk(spark, sf))


@register("roc_auc", O.with_chain(f"""
SELECT {O.rnd(f'(sum(CASE WHEN valor_real = 1 THEN rk END) - count_if(valor_real = 1) * (count_if(valor_real = 1) + 1) / {O.d(2)}) / (count_if(valor_real = 1) * count_if(valor_real = 0))', 6)} AS roc_auc
FROM (SELECT *, (rank() OVER (ORDER BY probabilidad_riesgo) - 1) + (count(*) OVER (PARTITION BY probabilidad_riesgo) + 1) / {O.d(2)} AS rk
      FROM {_BASE_PRED})"""))
def q_roc_auc(spark, sf):
    return SV.roc_auc(baseline_risk(spark, sf))


# ---- analyst queries (segment = value tier) ----------------------------------------------

from ..contracts import KMEANS_FEATURES  # noqa: E402
from ..operators import analyst as AN  # noqa: E402
from ..operators import scoring as SC  # noqa: E402

SEG = "valor_cliente"
_PV = AN.PROFILE_VARIABLES


@register("segment_filter", O.with_chain(
    f"SELECT id_cliente, valor_cliente, {', '.join(_PV)} FROM analytic WHERE valor_cliente IN ('alto_valor', 'valor_medio')"))
def q_segment_filter(spark, sf):
    return AN.segment_filter(analytic(spark, sf), SEG, ["alto_valor", "valor_medio"]).select(ID, SEG, *_PV)


@register("segment_share", O.with_chain(f"""
SELECT valor_cliente, count(*) AS usuarios,
       {O.rnd(f'count(*) / (SELECT count(*) FROM analytic) * {O.d(100)}', 2)} AS porcentaje
FROM analytic GROUP BY valor_cliente"""))
def q_segment_share(spark, sf):
    return AN.segment_share(analytic(spark, sf), SEG)


def _profile_sql():
    cols = []
    for v in _PV:
        x = f"avg({v}) * {O.d(100)}" if v == "porcentaje_uso_promociones" else f"avg({v})"
        cols.append(f"{O.rnd(x, 1)} AS {v}")
    return f"SELECT valor_cliente, {', '.join(cols)} FROM analytic GROUP BY valor_cliente"


@register("segment_profile", O.with_chain(_profile_sql()))
def q_segment_profile(spark, sf):
    return AN.segment_profile(analytic(spark, sf), SEG)


@register("profile_unpivot", O.with_chain(
    f"SELECT valor_cliente, variable, valor FROM ({_profile_sql()}) UNPIVOT (valor FOR variable IN ({', '.join(_PV)}))"))
def q_profile_unpivot(spark, sf):
    return AN.profile_unpivot(AN.segment_profile(analytic(spark, sf), SEG), SEG)


@register("relative_profile", O.with_chain(f"""
SELECT valor_cliente, variable,
       {O.rnd('(media - min(media) OVER (PARTITION BY variable)) / nullif(max(media) OVER (PARTITION BY variable) - min(media) OVER (PARTITION BY variable), 0)', 6)} AS nivel_relativo
FROM (SELECT valor_cliente, {', '.join(f'avg({v}) AS {v}' for v in KMEANS_FEATURES)} FROM analytic GROUP BY valor_cliente)
UNPIVOT (media FOR variable IN ({', '.join(KMEANS_FEATURES)}))"""))
def q_relative_profile(spark, sf):
    return AN.relative_profile(analytic(spark, sf), SEG)


@register("user_vs_segment", O.with_chain(f"""
SELECT id_cliente, valor_cliente, variable, valor_usuario, {O.rnd('media_segmento', 6)} AS media_segmento,
       {O.rnd(f'(valor_usuario - media_segmento) / nullif(media_segmento, 0) * {O.d(100)}', 1)} AS diferencia_pct
FROM (SELECT a.id_cliente, a.valor_cliente, u.variable, CAST(u.valor_usuario AS DOUBLE) AS valor_usuario,
             CASE u.variable {' '.join(f"WHEN '{v}' THEN m.{v}" for v in _PV)} END AS media_segmento
      FROM analytic a
      JOIN (SELECT valor_cliente, {', '.join(f'avg({v}) AS {v}' for v in _PV)} FROM analytic GROUP BY valor_cliente) m
        USING (valor_cliente)
      JOIN (SELECT id_cliente, variable, valor_usuario FROM
              (SELECT id_cliente, {', '.join(f'CAST({v} AS DOUBLE) AS {v}' for v in _PV)} FROM analytic)
              UNPIVOT (valor_usuario FOR variable IN ({', '.join(_PV)}))) u USING (id_cliente))"""))
def q_user_vs_segment(spark, sf):
    return AN.user_vs_segment(analytic(spark, sf), SEG)


@register("distinct_segments", O.with_chain("SELECT DISTINCT valor_cliente FROM analytic ORDER BY valor_cliente"))
def q_distinct_segments(spark, sf):
    return AN.distinct_sorted(analytic(spark, sf), SEG)


@register("executive_summary", O.with_chain(f"""
SELECT count(*) AS usuarios, count(DISTINCT valor_cliente) AS segmentos, {O.rnd('avg(gasto_mensual)', 2)} AS gasto_promedio,
       count_if(valor_cliente = 'alto_valor') AS usuarios_alto_valor,
       count_if(valor_cliente = 'valor_en_riesgo') AS usuarios_en_riesgo FROM analytic"""))
def q_executive_summary(spark, sf):
    return AN.executive_summary(analytic(spark, sf), SEG)


@register("spend_by_segment", O.with_chain(
    f"SELECT valor_cliente, {O.rnd('avg(gasto_mensual)', 2)} AS gasto_promedio FROM analytic GROUP BY valor_cliente"))
def q_spend_by_segment(spark, sf):
    return AN.spend_by_segment(analytic(spark, sf), SEG)


def _reasons_sql(fields) -> str:
    from ..contracts import INTEGER_COLUMNS as INTS, RANGES as RG
    parts = []
    for c in fields:
        x = f"TRY_CAST({c} AS DOUBLE)"
        parts.append(f"CASE WHEN {x} IS NULL OR isnan({x}) THEN '{c}:missing' END")
        lo, hi = RG.get(c, (None, None))
        if lo is not None:
            parts.append(f"CASE WHEN {x} < {O.d(lo)} THEN '{c}:below_minimum' END")
        if hi is not None:
            parts.append(f"CASE WHEN {x} > {O.d(hi)} THEN '{c}:above_maximum' END")
        if c in INTS:
            parts.append(f"CASE WHEN fmod({x}, {O.d(1)}) <> 0 THEN '{c}:not_integer' END")
        parts.append(f"CASE WHEN isinf({x}) THEN '{c}:not_finite' END")
    return f"concat_ws(',', {', '.join(parts)})"


_REQUESTS_SQL = f"""(
  SELECT *, CASE WHEN id_cliente % 53 = 0 THEN 'x' END AS cupon FROM base_raw
  UNION ALL SELECT *, NULL FROM (SELECT * REPLACE (CAST(400 AS BIGINT) AS edad) FROM base_raw WHERE id_cliente % 41 = 0)
  UNION ALL SELECT *, NULL FROM (SELECT * REPLACE (CAST(NULL AS BIGINT) AS id_cliente) FROM base_raw WHERE id_cliente % 43 = 0))"""


def requests(spark, sf) -> DataFrame:
    """The raw integrated rows as a batch of requests; some come twice under one id (once with an impossible
    age), some without an id, some with a field that the contract does not know."""
    raw = base(spark, sf)
    told = raw.withColumn("cupon", F.when(F.col("id_cliente") % 53 == 0, "x"))
    again = raw.where(F.col("id_cliente") % 41 == 0).withColumn("edad", F.lit(400).cast("long"))
    nameless = raw.where(F.col("id_cliente") % 43 == 0).withColumn("id_cliente", F.lit(None).cast("long"))
    return told.unionByName(again, True).unionByName(nameless, True)


_REASONS = f"concat_ws(',', nullif({_reasons_sql(KMEANS_FEATURES)}, ''), CASE WHEN cupon IS NOT NULL THEN 'cupon:unknown_field' END)"


@register("score_input_split", O.with_chain(f"""
SELECT id_cliente, CAST({_REASONS} = '' AS INTEGER) AS aceptado, {_REASONS} AS motivos FROM {_REQUESTS_SQL}"""))
def q_score_input_split(spark, sf):
    """A batch of scoring requests: accepted or rejected with reasons, row by row."""
    return SC.score_input_split(requests(spark, sf), KMEANS_FEATURES)


# Model, scoring and sink queries register themselves on import.
from . import registry_certificates, registry_io, registry_ml  # noqa: E402,F401

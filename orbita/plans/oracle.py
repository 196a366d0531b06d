"""DuckDB oracle SQL for the registered queries.

The oracle is an independent, whole-table restatement of each operator in
plain SQL: window ranks instead of the distributed distribution, sorted lists
instead of bucketed running sums, CROSS JOIN for the dense grid.  Statements
are assembled from one CTE chain (sources -> integrated base -> clean ->
analytical -> KPIs) so every query reads the given tables.
"""

from __future__ import annotations

from ..contracts import (BASE_COLUMNS, ENGAGEMENT_BINS, ENGAGEMENT_WEIGHTS, HIGH_PROMO_SHARE, ID, INTEGER_COLUMNS,
                         LONG_TENURE_MONTHS, RANGES, SESSIONS_PER_MONTH, TIER_QUANTILES)
from ..sources.tpch import (INFINITE_HOURS_EVERY, NULL_SPEND_EVERY, PROMO_DISCOUNT, TENURE_REFERENCE,
                            TEXT_SESSION_TIME_EVERY)

VALUE_COLUMNS = [c for c in BASE_COLUMNS if c != ID]


def d(x: float) -> str:
    """A DOUBLE literal (DuckDB reads 0.3 as DECIMAL)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def rnd(expr: str, digits: int) -> str:
    """Half-even rounding identical to rint(x * 10^d) / 10^d."""
    s = d(10 ** digits)
    return f"(round_even(({expr}) * {s}, 0) / {s})"


def median_sql(col: str, table: str) -> str:
    """numpy median of the non-null values: mean of the two middle order statistics."""
    return (f"(SELECT (s[CAST(floor((len(s) - 1) / 2) AS BIGINT) + 1] + s[CAST(ceil((len(s) - 1) / 2) AS BIGINT) + 1])"
            f" / {d(2)} FROM (SELECT list_sort(list({col}) FILTER (WHERE {col} IS NOT NULL)) AS s FROM {table}))")


def quantile_sql(col: str, table: str, q: float) -> str:
    """numpy 'linear' quantile: lerp between order statistics floor(h) and floor(h)+1."""
    h = f"((len(s) - 1) * {d(q)})"
    a = f"s[CAST(floor({h}) AS BIGINT) + 1]"
    b = f"s[least(CAST(floor({h}) AS BIGINT) + 1, len(s) - 1) + 1]"
    t = f"({h} - floor({h}))"
    return (f"(SELECT CASE WHEN {t} >= 0.5 THEN {b} - ({b} - {a}) * ({d(1)} - {t}) ELSE {a} + ({b} - {a}) * {t} END"
            f" FROM (SELECT list_sort(list({col}) FILTER (WHERE {col} IS NOT NULL)) AS s FROM {table}))")


def _out_of_domain(c: str) -> str:
    lo, hi = RANGES.get(c, (None, None))
    parts = []
    if lo is not None:
        parts.append(f"{c} < {d(lo)}")
    if hi is not None:
        parts.append(f"{c} > {d(hi)}")
    return "(" + " OR ".join(parts) + ")" if parts else "FALSE"


ref_y, ref_m = TENURE_REFERENCE

CTES: list[tuple[str, str]] = []


def cte(name: str, sql: str) -> None:
    CTES.append((name, sql))


cte("per_order", f"""
SELECT l_orderkey, sum(l_quantity) AS qty, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spend,
       count(*) AS lines, count_if(l_linestatus = 'F') AS lines_f, count_if(l_discount >= {d(PROMO_DISCOUNT)}) AS lines_promo
FROM lineitem GROUP BY l_orderkey""")
cte("per_customer", """
SELECT o_custkey, sum(qty) AS qty, sum(spend) AS spend, sum(lines) AS lines, count(*) AS n_orders,
       sum(lines_f) AS lines_f, sum(lines_promo) AS lines_promo, min(o_orderdate) AS first_order
FROM orders JOIN per_order ON o_orderkey = l_orderkey GROUP BY o_custkey""")
cte("brands", """
SELECT o_custkey, count(DISTINCT p_brand) AS brands
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""")
cte("behaviour_clean", f"""
SELECT CAST(o_custkey + 1 AS BIGINT) AS id_cliente, CAST(qty AS DOUBLE) AS horas_consumo_mensual,
       CAST(spend AS DOUBLE) AS gasto_mensual, CAST(lines AS BIGINT) AS cantidad_contenidos_vistos,
       CAST(n_orders AS BIGINT) AS sesiones_semana, {d(100)} * lines_f / lines AS porcentaje_finalizacion,
       CAST(qty AS DOUBLE) / n_orders AS tiempo_promedio_sesion_min,
       CAST(coalesce(brands, 0) AS BIGINT) AS cantidad_generos_consumidos,
       CAST(lines_promo AS DOUBLE) / lines AS porcentaje_uso_promociones,
       CAST(({ref_y} - year(first_order)) * 12 + ({ref_m} - month(first_order)) AS BIGINT) AS antiguedad_cliente_meses
FROM per_customer LEFT JOIN brands USING (o_custkey)""")
cte("behaviour_src", f"""
SELECT id_cliente,
       CASE WHEN id_cliente % {INFINITE_HOURS_EVERY} = 0 THEN CAST('inf' AS DOUBLE) ELSE horas_consumo_mensual END
         AS horas_consumo_mensual,
       CASE WHEN id_cliente % {NULL_SPEND_EVERY} = 0 THEN NULL ELSE gasto_mensual END AS gasto_mensual,
       cantidad_contenidos_vistos, sesiones_semana, porcentaje_finalizacion,
       CASE WHEN id_cliente % {TEXT_SESSION_TIME_EVERY} = 0 THEN 'x' ELSE CAST(tiempo_promedio_sesion_min AS VARCHAR) END
         AS tiempo_promedio_sesion_min,
       cantidad_generos_consumidos, porcentaje_uso_promociones, antiguedad_cliente_meses
FROM behaviour_clean""")
cte("profile_src", f"""
SELECT CAST(c_custkey + 1 AS BIGINT) AS id_cliente, CAST(18 + c_custkey % 60 AS BIGINT) AS edad,
       CAST(1 + c_nationkey % 5 AS BIGINT) AS dispositivos_registrados,
       (c_custkey % 101) / {d(100)} AS porcentaje_uso_app_movil,
       CAST(1 + (c_custkey + c_nationkey) % 5 AS BIGINT) AS cantidad_perfiles_creados,
       CAST(c_custkey % 8 AS BIGINT) AS interacciones_mensuales_soporte,
       c_acctbal / {d(100)} AS distancia_promedio_red_km, c_mktsegment AS segmento_mercado
FROM customer""")
cte("profile_bound", "SELECT * FROM profile_src WHERE id_cliente IN (SELECT id_cliente FROM behaviour_src)")
cte("base_raw", f"SELECT {', '.join('b.' + c if c in ('id_cliente',) else c for c in BASE_COLUMNS)} "
                "FROM behaviour_src b JOIN profile_bound p ON b.id_cliente = p.id_cliente")


def _coerce(c: str) -> str:
    if c == ID:
        return f"CAST(TRY_CAST({c} AS DOUBLE) AS BIGINT) AS {c}"
    x = f"TRY_CAST({c} AS DOUBLE)"
    return f"CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE {x} END AS {c}"


cte("coerced", "SELECT " + ", ".join(_coerce(c) for c in BASE_COLUMNS) + " FROM base_raw")
cte("masked", "SELECT " + ", ".join(
    c if c == ID else f"CASE WHEN {_out_of_domain(c)} THEN NULL ELSE {c} END AS {c}" for c in BASE_COLUMNS)
    + " FROM coerced")
cte("medians", "SELECT " + ", ".join(f"{median_sql(c, 'masked')} AS {c}" for c in VALUE_COLUMNS))


def _fill(c: str) -> str:
    if c == ID:
        return f"m.{c}"
    x = f"coalesce(m.{c}, md.{c})"
    return f"CAST(round_even({x}, 0) AS BIGINT) AS {c}" if c in INTEGER_COLUMNS else f"{x} AS {c}"


cte("clean", "SELECT " + ", ".join(_fill(c) for c in BASE_COLUMNS) + " FROM masked m, medians md")


def _pct(c: str) -> str:
    return (f"((rank() OVER (ORDER BY {c}) - 1) + (count(*) OVER (PARTITION BY {c}) + 1) / {d(2)})"
            f" / count(*) OVER ()")


_score = " + ".join(f"p_{c} * {d(w)}" for c, w in ENGAGEMENT_WEIGHTS)
cte("ranked", "SELECT *, " + ", ".join(f"{_pct(c)} AS p_{c}" for c, _ in ENGAGEMENT_WEIGHTS) + " FROM clean")
cte("scored", f"SELECT {', '.join(BASE_COLUMNS)}, {rnd(_score, 4)} AS engagement_score FROM ranked")


def _ratio(num: str, den: str) -> str:
    return f"coalesce({rnd(f'{num} / nullif({den}, 0)', 3)}, {d(0)})"


_level = "CASE " + " ".join(
    f"WHEN engagement_score > {d(lo)} AND engagement_score <= {d(hi)} THEN '{label}'" for lo, hi, label in ENGAGEMENT_BINS
) + " END"
cte("cuts", f"""
SELECT {quantile_sql('gasto_mensual', 'scored', TIER_QUANTILES['gasto_alto'])} AS gasto_alto,
       {quantile_sql('gasto_mensual', 'scored', TIER_QUANTILES['gasto_bajo'])} AS gasto_bajo,
       {quantile_sql('engagement_score', 'scored', TIER_QUANTILES['engagement_alto'])} AS engagement_alto,
       {quantile_sql('engagement_score', 'scored', TIER_QUANTILES['engagement_bajo'])} AS engagement_bajo""")
cte("analytic", f"""
SELECT {', '.join(BASE_COLUMNS)},
       {_ratio('cantidad_contenidos_vistos', f'sesiones_semana * {d(SESSIONS_PER_MONTH)}')} AS contenidos_por_sesion,
       {_ratio('gasto_mensual', 'horas_consumo_mensual')} AS gasto_por_hora,
       {rnd(f'horas_consumo_mensual * {d(60)}', 2)} AS minutos_totales_estimados,
       {_ratio('interacciones_mensuales_soporte', 'dispositivos_registrados')} AS soporte_por_dispositivo,
       {_ratio('cantidad_generos_consumidos', 'cantidad_contenidos_vistos')} AS generos_por_contenido,
       engagement_score, {_level} AS nivel_engagement,
       CAST(antiguedad_cliente_meses >= {LONG_TENURE_MONTHS} AS INTEGER) AS cliente_antiguo,
       CAST(porcentaje_uso_promociones >= {d(HIGH_PROMO_SHARE)} AS INTEGER) AS uso_promociones_alto,
       CASE WHEN gasto_mensual >= c.gasto_alto AND engagement_score >= c.engagement_alto THEN 'alto_valor'
            WHEN gasto_mensual <= c.gasto_bajo OR engagement_score <= c.engagement_bajo THEN 'valor_en_riesgo'
            ELSE 'valor_medio' END AS valor_cliente
FROM scored, cuts c""")

_KPI_MEANS = [("gasto_promedio", "gasto_mensual"), ("consumo_promedio_horas", "horas_consumo_mensual"),
              ("finalizacion_promedio", "porcentaje_finalizacion"), ("promociones_promedio", "porcentaje_uso_promociones"),
              ("antiguedad_promedio", "antiguedad_cliente_meses")]
cte("kpis", f"""
SELECT g.nivel_engagement, t.valor_cliente, count(DISTINCT a.id_cliente) AS usuarios,
       {', '.join(f"{rnd(f'avg(a.{src})', 2)} AS {name}" for name, src in _KPI_MEANS)},
       {rnd(f'count(DISTINCT a.id_cliente) / (SELECT count(*) FROM analytic) * {d(100)}', 2)} AS porcentaje_usuarios
FROM (SELECT DISTINCT nivel_engagement FROM analytic WHERE nivel_engagement IS NOT NULL) g
     CROSS JOIN (SELECT DISTINCT valor_cliente FROM analytic) t
     LEFT JOIN analytic a ON a.nivel_engagement = g.nivel_engagement AND a.valor_cliente = t.valor_cliente
GROUP BY g.nivel_engagement, t.valor_cliente""")


def with_chain(final: str) -> str:
    """Prefix ``final`` with the whole CTE chain (unused CTEs are not evaluated)."""
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in CTES) + "\n" + final


def with_ctes(more: list[str], final: str) -> str:
    """The chain, then further CTEs (``name AS (...)``), then ``final``."""
    return "WITH " + ",\n".join([f"{n} AS ({s})" for n, s in CTES] + more) + "\n" + final


# ---- validation oracles -----------------------------------------------------------

def source_issues_sql(table: str, required: list[str], actual: list[str], source: str,
                      text_cols: set[str], float_cols: set[str]) -> str:
    """Issue rows of the pre-join source checks, one SELECT ... HAVING per check."""
    stage = f"estructura_{source}"
    parts = []

    def add(code, sev, col, n, cond):
        c = "NULL" if col is None else f"'{col}'"
        parts.append(f"SELECT '{stage}' AS stage, '{code}' AS code, '{sev}' AS severity, CAST({c} AS VARCHAR) AS column_name,"
                     f" CAST({n} AS BIGINT) AS n FROM {table} HAVING {cond}")

    add("EMPTY_SOURCE", "error", None, "count(*)", "count(*) = 0")
    missing = sorted(set(required) - set(actual))
    extra = sorted(set(actual) - set(required))
    if missing:
        add("MISSING_REQUIRED_COLUMNS", "error", ",".join(missing), len(missing), "count(*) > 0")
    if extra:
        add("UNEXPECTED_COLUMNS", "warning", ",".join(extra), len(extra), "count(*) > 0")
    if ID in actual:
        i = f"TRY_CAST({ID} AS DOUBLE)"
        inv = f"count_if({i} IS NULL OR isnan({i}))"
        add("INVALID_CUSTOMER_ID", "error", ID, inv, f"count(*) > 0 AND {inv} > 0")
        nonpos = f"count_if({i} <= 0)"
        add("NON_POSITIVE_CUSTOMER_ID", "error", ID, nonpos, f"count(*) > 0 AND {nonpos} > 0")
        dup = f"(count({i}) - count(DISTINCT {i}))"
        add("DUPLICATED_CUSTOMER_ID", "error", ID, dup, f"count(*) > 0 AND {dup} > 0")
        for c in sorted(set(required) & set(actual)):
            if c == ID:
                continue
            nulls = f"count_if({c} IS NULL)"
            add("NULL_VALUES", "warning", c, nulls, f"count(*) > 0 AND {nulls} > 0")
            if c in text_cols:
                bad = f"count_if({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL)"
                add("NON_NUMERIC_VALUES", "warning", c, bad, f"count(*) > 0 AND {bad} > 0")
                add("CONVERTIBLE_NUMERIC_TYPE", "warning", c, 0, f"count(*) > 0 AND {bad} = 0")
            if c in text_cols or c in float_cols:
                inf = f"count_if(isinf(TRY_CAST({c} AS DOUBLE)))"
                add("INFINITE_VALUES", "warning", c, inf, f"count(*) > 0 AND {inf} > 0")
    return "\nUNION ALL\n".join(parts)


def clean_issues_sql(table: str) -> str:
    """Issue rows of the post-clean checks (all columns present, official order)."""
    stage = "dataset_limpio"
    parts = []

    def add(code, col, n, cond):
        c = "NULL" if col is None else f"'{col}'"
        parts.append(f"SELECT '{stage}' AS stage, '{code}' AS code, 'error' AS severity, CAST({c} AS VARCHAR) AS column_name,"
                     f" CAST({n} AS BIGINT) AS n FROM {table} HAVING {cond}")

    add("EMPTY_CLEAN_DATASET", None, "count(*)", "count(*) = 0")
    i = f"TRY_CAST({ID} AS DOUBLE)"
    add("INVALID_CLEAN_CUSTOMER_ID", ID, f"count_if({i} IS NULL OR isnan({i}))", f"count(*) > 0 AND count_if({i} IS NULL OR isnan({i})) > 0")
    dup = f"(count({i}) - count(DISTINCT {i}))"
    add("DUPLICATED_CLEAN_CUSTOMER_ID", ID, dup, f"count(*) > 0 AND {dup} > 0")
    for c in BASE_COLUMNS:
        x = f"TRY_CAST({c} AS DOUBLE)"
        bad = f"count_if({x} IS NULL OR isnan({x}))"
        ok = f"count(*) > 0 AND {bad} = 0"
        add("NULL_OR_NON_NUMERIC_AFTER_CLEANING", c, bad, f"count(*) > 0 AND {bad} > 0")
        add("INFINITE_AFTER_CLEANING", c, f"count_if(isinf({x}))", f"{ok} AND count_if(isinf({x})) > 0")
        lo, hi = RANGES.get(c, (None, None))
        if lo is not None:
            add("VALUE_BELOW_MINIMUM", c, f"count_if({x} < {d(lo)})", f"{ok} AND count_if({x} < {d(lo)}) > 0")
        if hi is not None:
            add("VALUE_ABOVE_MAXIMUM", c, f"count_if({x} > {d(hi)})", f"{ok} AND count_if({x} > {d(hi)}) > 0")
        if c in INTEGER_COLUMNS:
            # fmod keeps the sign like Spark's %, and fmod(+-inf, 1) is NaN (counted, as in Spark)
            ni = f"count_if(NOT (fmod({x}, {d(1)}) = 0))"
            add("NON_INTEGER_VALUE", c, ni, f"{ok} AND {ni} > 0")
    return "\nUNION ALL\n".join(parts)


cte("events_src", "SELECT user_id AS id_cliente, count(*) AS eventos, sum(value) AS valor_total FROM events GROUP BY user_id")
cte("lineitem_keyed", "SELECT l_orderkey AS id_cliente, l_quantity AS horas_consumo_mensual FROM lineitem")


def hash_sql(id_expr: str, salt: str, hex_digits: int = 15) -> str:
    return f"CAST(('0x' || substr(md5(CAST({id_expr} AS VARCHAR) || ':{salt}'), 1, {hex_digits})) AS BIGINT)"


cte("split", f"SELECT *, CAST({hash_sql('id_cliente', '29')} % 100 < 20 AS INTEGER) AS is_test FROM clean")
cte("risk_th", f"""SELECT {median_sql('porcentaje_finalizacion', '(SELECT * FROM split WHERE is_test = 0)')} AS fin,
                         {median_sql('sesiones_semana', '(SELECT * FROM split WHERE is_test = 0)')} AS ses""")
cte("labelled", "SELECT s.*, CAST(porcentaje_finalizacion < t.fin AND sesiones_semana < t.ses AS INTEGER)"
                " AS riesgo_bajo_compromiso FROM split s, risk_th t")

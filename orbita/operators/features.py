"""Derived engagement and value features on the clean base table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import (DERIVED_COLUMNS, ENGAGEMENT_BINS, ENGAGEMENT_WEIGHTS, HIGH_PROMO_SHARE, ID, LONG_TENURE_MONTHS,
                         SESSIONS_PER_MONTH, TIER_QUANTILES)
from ..functions.numeric import round_half_even, safe_ratio
from ..session import materialize
from . import distribution as D


def ratios(df: DataFrame) -> DataFrame:
    """Five ratio features; a zero denominator gives 0 (never an error)."""
    return df.withColumns({
        "contenidos_por_sesion": safe_ratio("cantidad_contenidos_vistos",
                                            F.col("sesiones_semana") * F.lit(SESSIONS_PER_MONTH), 3),
        "gasto_por_hora": safe_ratio("gasto_mensual", "horas_consumo_mensual", 3),
        "minutos_totales_estimados": round_half_even(F.col("horas_consumo_mensual") * F.lit(60.0), 2),
        "soporte_por_dispositivo": safe_ratio("interacciones_mensuales_soporte", "dispositivos_registrados", 3),
        "generos_por_contenido": safe_ratio("cantidad_generos_consumidos", "cantidad_contenidos_vistos", 3),
    })


def engagement_scores(df: DataFrame, id_column: str = ID, weights=ENGAGEMENT_WEIGHTS) -> DataFrame:
    """(id, engagement_score): weighted average-tie percent ranks, 4 decimals.

    The ranked columns are unpivoted to narrow (id, column, value) rows; the
    percent rank of every distinct value comes from the distributed cumulative
    distribution and is joined back on (column, value); one groupBy(id) pivots
    the four ranks back and the weighted sum is taken in the fixed order.
    """
    cols = [c for c, _ in weights]
    long = D.to_long(df, cols, id_column)
    pct = D.percent_rank_avg(D.cumulative(long))
    ranked = long.join(pct, [D.K, D.V]).groupBy(id_column).agg(
        *[F.max(F.when(F.col(D.K) == c, F.col("pct"))).alias(c) for c in cols])
    score = None
    for c, w in weights:
        term = F.col(c) * F.lit(w)
        score = term if score is None else score + term
    return ranked.select(id_column, round_half_even(score, 4).alias("engagement_score"))


def with_engagement(df: DataFrame, id_column: str = ID) -> DataFrame:
    return df.join(engagement_scores(df, id_column), id_column)


def engagement_level(score) -> F.Column:
    """Right-closed bins; a score outside every bin is null."""
    s = F.col(score) if isinstance(score, str) else score
    expr = None
    for lo, hi, label in ENGAGEMENT_BINS:
        cond = (s > F.lit(lo)) & (s <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "cliente_antiguo": (F.col("antiguedad_cliente_meses") >= LONG_TENURE_MONTHS).cast("int"),
        "uso_promociones_alto": (F.col("porcentaje_uso_promociones") >= F.lit(HIGH_PROMO_SHARE)).cast("int"),
    })


def tier_cuts(df: DataFrame) -> DataFrame:
    """(tag, value): spend q75/q25 and engagement q60/q33, linear interpolation."""
    dist = D.distribution(df, ["gasto_mensual", "engagement_score"])
    wanted = [("gasto_mensual", "gasto_alto", TIER_QUANTILES["gasto_alto"]),
              ("gasto_mensual", "gasto_bajo", TIER_QUANTILES["gasto_bajo"]),
              ("engagement_score", "engagement_alto", TIER_QUANTILES["engagement_alto"]),
              ("engagement_score", "engagement_bajo", TIER_QUANTILES["engagement_bajo"])]
    return D.quantiles(dist, wanted).select("tag", D.V)


def value_tier(df: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """First matching rule wins: alto_valor, then valor_en_riesgo, else valor_medio."""
    cuts = tier_cuts(df) if cuts is None else cuts
    m = D.as_map_scalar(cuts, "tag", D.V)
    g, e = F.col("gasto_mensual"), F.col("engagement_score")
    tier = (F.when((g >= F.element_at(m, F.lit("gasto_alto"))) & (e >= F.element_at(m, F.lit("engagement_alto"))),
                   F.lit("alto_valor"))
            .when((g <= F.element_at(m, F.lit("gasto_bajo"))) | (e <= F.element_at(m, F.lit("engagement_bajo"))),
                  F.lit("valor_en_riesgo"))
            .otherwise(F.lit("valor_medio")))
    return df.withColumn("valor_cliente", tier)


def derive(clean: DataFrame, id_column: str = ID, border=materialize) -> DataFrame:
    """Base (16 columns) -> analytical table (26 columns).

    ``border`` materializes the scored table before the tier cuts read it
    (the cuts are a scalar subquery over the same rows).
    """
    out = ratios(border(with_engagement(clean, id_column)))
    out = out.withColumn("nivel_engagement", engagement_level("engagement_score"))
    out = flags(out)
    out = value_tier(out)
    return out.select(*[c for c in clean.columns], *DERIVED_COLUMNS)

"""Analyst queries behind the dashboard, as whole-table DataFrame queries.

``segment`` is any label column: the value tier (deterministic) or the KMeans
cluster.  Per-segment tables have one row per segment, so joining them back
to users is a broadcast of a table bounded by the number of segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..contracts import ID, KMEANS_FEATURES
from ..functions.numeric import round_half_even

# The six variables the segment profile shows.
PROFILE_VARIABLES = [
    "horas_consumo_mensual",
    "gasto_mensual",
    "cantidad_contenidos_vistos",
    "porcentaje_finalizacion",
    "porcentaje_uso_promociones",
    "antiguedad_cliente_meses",
]


def segment_filter(df: DataFrame, segment: str, keep: list) -> DataFrame:
    return df.filter(F.col(segment).isin(keep))


def segment_share(df: DataFrame, segment: str) -> DataFrame:
    """Users per segment and % of all (filtered) rows, 2 decimals."""
    total = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("usuarios")).select(
        segment, "usuarios", round_half_even(F.try_divide(F.col("usuarios"), total) * F.lit(100.0), 2).alias("porcentaje"))


def segment_means(df: DataFrame, segment: str, variables: list[str]) -> DataFrame:
    return df.groupBy(segment).agg(*[F.avg(v).alias(v) for v in variables])


def segment_profile(df: DataFrame, segment: str, variables: list[str] = PROFILE_VARIABLES) -> DataFrame:
    """Mean per segment, promotions shown x100, 1 decimal."""
    m = segment_means(df, segment, variables)
    cols = []
    for v in variables:
        x = F.col(v) * F.lit(100.0) if v == "porcentaje_uso_promociones" else F.col(v)
        cols.append(round_half_even(x, 1).alias(v))
    return m.select(segment, *cols)


def profile_unpivot(profile: DataFrame, segment: str) -> DataFrame:
    """Wide profile -> (segment, variable, value)."""
    values = [c for c in profile.columns if c != segment]
    return profile.unpivot([segment], values, "variable", "valor")


def relative_profile(df: DataFrame, segment: str, variables: list[str] = KMEANS_FEATURES, digits: int = 6) -> DataFrame:
    """Per variable, min-max scaling of the segment means across segments (0/0 stays null)."""
    m = segment_means(df, segment, variables)
    long = m.unpivot([segment], variables, "variable", "media")
    # One window partition per variable over <= #segments rows: bounded.
    w = Window.partitionBy("variable")
    rel = F.try_divide(F.col("media") - F.min("media").over(w), F.max("media").over(w) - F.min("media").over(w))
    return long.select(segment, "variable", round_half_even(rel, digits).alias("nivel_relativo"))


def user_vs_segment(df: DataFrame, segment: str, variables: list[str] = PROFILE_VARIABLES,
                    id_col: str = ID) -> DataFrame:
    """Every user's values against the mean of their segment: % difference, 1 decimal."""
    m = segment_means(df, segment, variables)
    m = m.select(segment, *[F.col(v).alias(f"_m_{v}") for v in variables])
    j = df.select(id_col, segment, *variables).join(m, segment)  # broadcast at run time if m is small
    long = j.select(id_col, segment, F.explode(F.array(*[
        F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("valor_usuario"),
                 F.col(f"_m_{v}").alias("media_segmento")) for v in variables])).alias("r")).select(id_col, segment, "r.*")
    diff = F.try_divide(F.col("valor_usuario") - F.col("media_segmento"), F.col("media_segmento")) * F.lit(100.0)
    return long.select(id_col, segment, "variable", "valor_usuario",
                       round_half_even(F.col("media_segmento"), 6).alias("media_segmento"),
                       round_half_even(diff, 1).alias("diferencia_pct"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def executive_summary(analytic: DataFrame, segment: str) -> DataFrame:
    """Users, segments, mean spend, high-value and at-risk users (one pass)."""
    return analytic.agg(
        F.count(F.lit(1)).alias("usuarios"), F.count_distinct(segment).alias("segmentos"),
        round_half_even(F.avg("gasto_mensual"), 2).alias("gasto_promedio"),
        F.count_if(F.col("valor_cliente") == "alto_valor").alias("usuarios_alto_valor"),
        F.count_if(F.col("valor_cliente") == "valor_en_riesgo").alias("usuarios_en_riesgo"))


def spend_by_segment(analytic: DataFrame, segment: str) -> DataFrame:
    return analytic.groupBy(segment).agg(round_half_even(F.avg("gasto_mensual"), 2).alias("gasto_promedio"))

"""Business KPIs and the data-quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ID, TIER_LABELS
from ..functions.numeric import round_half_even

KPI_MEANS = [
    ("gasto_promedio", "gasto_mensual"),
    ("consumo_promedio_horas", "horas_consumo_mensual"),
    ("finalizacion_promedio", "porcentaje_finalizacion"),
    ("promociones_promedio", "porcentaje_uso_promociones"),
    ("antiguedad_promedio", "antiguedad_cliente_meses"),
]
KPI_COLUMNS = ["nivel_engagement", "valor_cliente", "usuarios"] + [n for n, _ in KPI_MEANS] + ["porcentaje_usuarios"]


def kpis_grid(analytic: DataFrame, id_column: str = ID) -> DataFrame:
    """Dense (engagement level x value tier) grid.

    Every combination of the *observed* levels and tiers appears; an empty
    cell has 0 users and null means.  The grid is built without a cross
    join: the observed tiers (at most 3 labels) come back as one bounded
    array scalar and are exploded next to each observed level.
    """
    grouped = analytic.groupBy("nivel_engagement", "valor_cliente").agg(
        F.count_distinct(id_column).alias("usuarios"),
        *[F.avg(src).alias(name) for name, src in KPI_MEANS])
    total = analytic.select(F.count(F.lit(1))).scalar()
    tiers = analytic.select(F.array_sort(F.collect_set("valor_cliente"))).scalar()
    grid = analytic.select("nivel_engagement").distinct().filter(F.col("nivel_engagement").isNotNull()) \
        .select("nivel_engagement", F.explode(tiers).alias("valor_cliente"))
    # grid and grouped hold at most (levels x tiers) rows.
    out = grid.join(F.broadcast(grouped), ["nivel_engagement", "valor_cliente"], "left")
    return out.select(
        "nivel_engagement", "valor_cliente",
        F.coalesce(F.col("usuarios"), F.lit(0)).cast("long").alias("usuarios"),
        *[round_half_even(F.col(name), 2).alias(name) for name, _ in KPI_MEANS],
        round_half_even(F.coalesce(F.col("usuarios"), F.lit(0)) / total * F.lit(100.0), 2).alias("porcentaje_usuarios"),
    )


def kpi_summary(kpis: DataFrame) -> DataFrame:
    """Users in alto_valor and in valor_en_riesgo (null -> 0)."""
    return kpis.agg(
        F.coalesce(F.sum(F.when(F.col("valor_cliente") == "alto_valor", F.col("usuarios"))), F.lit(0))
        .cast("long").alias("usuarios_alto_valor"),
        F.coalesce(F.sum(F.when(F.col("valor_cliente") == "valor_en_riesgo", F.col("usuarios"))), F.lit(0))
        .cast("long").alias("usuarios_valor_en_riesgo"),
    )


def kpi_matrix(kpis: DataFrame) -> DataFrame:
    """Engagement x value matrix: one row per level, one column per tier."""
    return kpis.groupBy("nivel_engagement").pivot("valor_cliente", TIER_LABELS).agg(F.sum("usuarios"))


def null_counts(df: DataFrame, stage: str) -> DataFrame:
    """(stage, column_name, nulls) for every column, one aggregate pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(stage).alias("stage"), F.lit(c).alias("column_name"), F.col(c).cast("long").alias("nulls"))
        for c in df.columns])).alias("r")).select("r.*")


def quality_report(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """Per stage: rows, columns and total nulls (one pass per stage)."""
    parts = []
    for name, df in stages:
        parts.append(df.agg(
            F.lit(name).alias("stage"), F.count(F.lit(1)).alias("filas"), F.lit(len(df.columns)).cast("long").alias("columnas"),
            sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0)).cast("long").alias("nulos_totales")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

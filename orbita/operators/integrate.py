"""Strict one-to-one integration of the two sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import BASE_COLUMNS, ID
from ..errors import JoinRefused


@dataclass
class Integration:
    base: DataFrame
    discarded_columns: list[str]


def check_gate(issues: DataFrame | None) -> None:
    """Integration needs a validation report without errors (action on a tiny table)."""
    if issues is None:
        raise JoinRefused("integration requires a validation report")
    n = issues.filter(F.col("severity") == "error").limit(1).count()
    if n:
        raise JoinRefused("the validation report contains blocking errors")


def join_one_to_one(behaviour: DataFrame, profile: DataFrame, id_column: str = ID,
                    columns: list[str] = BASE_COLUMNS) -> Integration:
    """Inner equi-join on the id, then the base projection in official order.

    Uniqueness of the id on both sides is proven beforehand (validation), so
    the join cannot multiply rows; Spark/AQE choose broadcast or sort-merge from
    runtime sizes.  Shared non-key columns are an error (no silent suffixes).
    """
    shared = sorted((set(behaviour.columns) & set(profile.columns)) - {id_column})
    if shared:
        raise JoinRefused(f"both sources carry the same non-key columns: {shared}")
    joined = behaviour.join(profile, id_column, "inner")
    missing = sorted(set(columns) - set(joined.columns))
    if missing:
        raise JoinRefused(f"integrated table lacks required columns: {missing}")
    discarded = sorted(set(joined.columns) - set(columns))
    return Integration(joined.select(*columns), discarded)


def integration_meta(behaviour: DataFrame, profile: DataFrame, base: DataFrame, discarded: list[str],
                     id_column: str = ID) -> DataFrame:
    """One row: rows and distinct ids on each side and in the result."""
    spark = base.sparkSession
    b = behaviour.agg(F.count(F.lit(1)).alias("filas"), F.count_distinct(id_column).alias("ids"))
    p = profile.agg(F.count(F.lit(1)).alias("filas"), F.count_distinct(id_column).alias("ids"))
    r = base.agg(F.count(F.lit(1)).alias("filas"))
    return spark.range(1).select(
        b.select("filas").scalar().alias("filas_streaming"), b.select("ids").scalar().alias("ids_streaming"),
        p.select("filas").scalar().alias("filas_perfil"), p.select("ids").scalar().alias("ids_perfil"),
        r.select("filas").scalar().alias("filas_integradas"),
        F.lit(",".join(discarded)).alias("columnas_descartadas"),
        F.lit("inner").alias("tipo_join"), F.lit("one_to_one").alias("cardinalidad"))


def check_row_count(base: DataFrame, shared_ids: int) -> int:
    """Action: the join must produce exactly one row per shared id."""
    n = base.count()
    if n == 0:
        raise JoinRefused("the integration produced no rows")
    if n != shared_ids:
        raise JoinRefused(f"integrated rows ({n}) differ from shared ids ({shared_ids})")
    return n

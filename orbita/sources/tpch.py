"""Bind the driver's star-schema tables to the two keyed sources.

behaviour: one row per customer, aggregated from lineitem x orders (x part for
brands).  profile: one row per customer, deterministic expressions over the
customer table.  Both key on ``o_custkey + 1`` / ``c_custkey + 1`` because the
contract requires positive ids.

Plan shape (what matters at 100 TB):
* lineitem is pre-aggregated per order *before* it meets orders, so the big
  join reads one row per order instead of one per line;
* the brand count is a separate (customer, brand) distinct, partially aggregated
  map-side, so no multi-distinct Expand over lineitem is needed; orders hold few lines of
  a brand twice, so a distinct by order would only shuffle the lines once more;
* every aggregation is hash-partitioned with map-side combine, so a customer
  that owns a third of all orders only makes a larger partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import BEHAVIOUR_COLUMNS, PROFILE_COLUMNS
from ..session import table_path

# Fixed values of the binding (mirrored in the SQL oracle).
TENURE_REFERENCE = (2002, 1)  # tenure counted in whole months up to 2002-01
PROMO_DISCOUNT = 0.05  # a line "uses a promotion" when its discount >= 5 %
# Deterministic dirt so the cleaning policies see real work:
NULL_SPEND_EVERY = 97  # gasto_mensual null
TEXT_SESSION_TIME_EVERY = 89  # tiempo_promedio_sesion_min = 'x' (column is text)
INFINITE_HOURS_EVERY = 83  # horas_consumo_mensual = +inf


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def behaviour_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed behaviour source (10 contract columns, no injected dirt)."""
    li = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")

    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("spend"),
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("l_linestatus") == "F").alias("lines_f"),
        F.count_if(F.col("l_discount") >= PROMO_DISCOUNT).alias("lines_promo"),
    )
    per_customer = (
        orders.join(per_order, orders.o_orderkey == per_order.l_orderkey)
        .groupBy("o_custkey")
        .agg(
            F.sum("qty").alias("qty"),
            F.sum("spend").alias("spend"),
            F.sum("lines").alias("lines"),
            F.count(F.lit(1)).alias("n_orders"),
            F.sum("lines_f").alias("lines_f"),
            F.sum("lines_promo").alias("lines_promo"),
            F.min("o_orderdate").alias("first_order"),
        )
    )
    brands = (
        li.select("l_orderkey", "l_partkey")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "p_brand")
        .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_custkey", "p_brand")
        .distinct()
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("brands"))
    )
    ref_y, ref_m = TENURE_REFERENCE
    out = per_customer.join(brands, "o_custkey", "left").select(
        (F.col("o_custkey") + 1).alias("id_cliente"),
        F.col("qty").cast("double").alias("horas_consumo_mensual"),
        F.col("spend").cast("double").alias("gasto_mensual"),
        F.col("lines").cast("long").alias("cantidad_contenidos_vistos"),
        F.col("n_orders").cast("long").alias("sesiones_semana"),
        (F.lit(100.0) * F.col("lines_f") / F.col("lines")).alias("porcentaje_finalizacion"),
        (F.col("qty") / F.col("n_orders")).alias("tiempo_promedio_sesion_min"),
        F.coalesce(F.col("brands"), F.lit(0)).cast("long").alias("cantidad_generos_consumidos"),
        (F.col("lines_promo") / F.col("lines")).alias("porcentaje_uso_promociones"),
        ((F.lit(ref_y) - F.year("first_order")) * 12 + (F.lit(ref_m) - F.month("first_order")))
        .cast("long")
        .alias("antiguedad_cliente_meses"),
    )
    return out.select(*BEHAVIOUR_COLUMNS)


def behaviour_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour source as extracted: some nulls, one text column, some +inf."""
    b = behaviour_clean(spark, sf_dir)
    i = F.col("id_cliente")
    return b.select(
        "id_cliente",
        F.when(i % INFINITE_HOURS_EVERY == 0, F.lit(float("inf"))).otherwise(F.col("horas_consumo_mensual"))
        .alias("horas_consumo_mensual"),
        F.when(i % NULL_SPEND_EVERY == 0, F.lit(None).cast("double")).otherwise(F.col("gasto_mensual"))
        .alias("gasto_mensual"),
        "cantidad_contenidos_vistos",
        "sesiones_semana",
        "porcentaje_finalizacion",
        F.when(i % TEXT_SESSION_TIME_EVERY == 0, F.lit("x"))
        .otherwise(F.col("tiempo_promedio_sesion_min").cast("string"))
        .alias("tiempo_promedio_sesion_min"),
        "cantidad_generos_consumidos",
        "porcentaje_uso_promociones",
        "antiguedad_cliente_meses",
    )


def profile_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile source: the 7 contract columns plus one extra column."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        (k + 1).alias("id_cliente"),
        (F.lit(18) + k % 60).cast("long").alias("edad"),
        (F.lit(1) + F.col("c_nationkey") % 5).cast("long").alias("dispositivos_registrados"),
        ((k % 101) / F.lit(100.0)).alias("porcentaje_uso_app_movil"),
        (F.lit(1) + (k + F.col("c_nationkey")) % 5).cast("long").alias("cantidad_perfiles_creados"),
        (k % 8).cast("long").alias("interacciones_mensuales_soporte"),
        (F.col("c_acctbal") / F.lit(100.0)).alias("distancia_promedio_red_km"),
        F.col("c_mktsegment").alias("segmento_mercado"),
    )


def profile_for(profile: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Profiles of customers that have behaviour rows (left semi join).

    At sf0.1 one customer has no orders; the strict same-universe gate would
    reject the unrestricted pair, which stays available for validation.
    """
    return profile.join(behaviour.select("id_cliente"), "id_cliente", "left_semi")


def sources(spark: SparkSession, sf_dir: str, dirty: bool = True) -> tuple[DataFrame, DataFrame]:
    b = behaviour_source(spark, sf_dir) if dirty else behaviour_clean(spark, sf_dir)
    return b, profile_for(profile_source(spark, sf_dir), b)


def events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third keyed source: activity per events user, keyed by the raw user id.

    Its ids start at 0 and do not shift, so it exercises the id checks
    (non-positive ids, mismatch against the customer universe) on real data.
    """
    e = read_table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("id_cliente")).agg(
        F.count(F.lit(1)).alias("eventos"), F.sum("value").alias("valor_total"))


def lineitem_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem viewed as a source keyed by l_orderkey (natural duplicates)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("id_cliente"), F.col("l_quantity").alias("horas_consumo_mensual"))


__all__ = ["BEHAVIOUR_COLUMNS", "PROFILE_COLUMNS", "behaviour_clean", "behaviour_source", "profile_source",
           "profile_for", "sources", "events_source", "lineitem_keyed", "read_table"]

"""Policy-based cleaning of the base table.

Order of policies (counts are taken at exactly these points):
exact dedup -> id gate -> numeric coercion -> +-inf to null (``nulos_antes``)
-> out-of-domain to null (``valores_fuera_rango``) -> median imputation
(``valores_imputados``) -> half-even integer restore.

Every per-column count of one stage is a single multi-aggregate pass; medians
come from the distributed cumulative distribution (no single-task percentile).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import BASE_CONTRACT, Contract
from ..errors import CleaningRefused
from ..functions.numeric import finite_or_null, out_of_domain, to_double
from ..session import materialize
from . import distribution as D


def require_columns(df: DataFrame, contract: Contract = BASE_CONTRACT) -> None:
    missing = sorted(set(contract.columns) - set(df.columns))
    if missing:
        raise CleaningRefused(f"missing required columns for preparation: {missing}")


def dedup_exact(df: DataFrame, contract: Contract = BASE_CONTRACT) -> DataFrame:
    """Drop exact duplicates over the contract columns (one shuffle)."""
    require_columns(df, contract)
    return df.select(*contract.columns).dropDuplicates(list(contract.columns))


def id_gate_counts(df: DataFrame, contract: Contract = BASE_CONTRACT) -> DataFrame:
    """One-row table: invalid, non-integer, non-positive and duplicated ids."""
    i = to_double(F.col(contract.id_column))
    return df.agg(
        F.count_if(i.isNull()).alias("ids_invalidos"),
        F.count_if(i.isNotNull() & ((i % 1) != 0)).alias("ids_no_enteros"),
        F.count_if(i <= 0).alias("ids_no_positivos"),
        (F.count(i) - F.count_distinct(i)).alias("ids_duplicados"),
    )


def enforce_id_gate(df: DataFrame, contract: Contract = BASE_CONTRACT) -> None:
    """Action: raise CleaningRefused when any id is unusable (ids are never imputed)."""
    r = id_gate_counts(df, contract).first()
    if r["ids_invalidos"]:
        raise CleaningRefused(f"{r['ids_invalidos']} null or non-numeric ids")
    if r["ids_no_enteros"]:
        raise CleaningRefused("id column holds non-integer values")
    if r["ids_no_positivos"]:
        raise CleaningRefused("id column holds values <= 0")
    if r["ids_duplicados"]:
        raise CleaningRefused(f"duplicated ids with possibly conflicting data: {r['ids_duplicados']}")


def coerce_numeric(df: DataFrame, contract: Contract = BASE_CONTRACT) -> DataFrame:
    """Ids to long; value columns parsed to double with NaN/+-inf -> null."""
    cols = [to_double(F.col(contract.id_column)).cast("long").alias(contract.id_column)]
    cols += [finite_or_null(to_double(F.col(c))).alias(c) for c in contract.value_columns]
    return df.select(*cols)


def mask_domain(df: DataFrame, contract: Contract = BASE_CONTRACT) -> DataFrame:
    """Out-of-domain values become null (inclusive bounds, never clipped)."""
    out = []
    for c in contract.columns:
        if c == contract.id_column:
            out.append(F.col(c))
            continue
        lo, hi = contract.ranges.get(c, (None, None))
        out.append(F.when(out_of_domain(F.col(c), lo, hi), F.lit(None).cast("double")).otherwise(F.col(c)).alias(c))
    return df.select(*out)


def column_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value): exact median of the non-null values of each column."""
    return D.medians(D.distribution(df, columns))


def impute_median(masked: DataFrame, contract: Contract = BASE_CONTRACT) -> DataFrame:
    """Fill nulls with the column median, then restore integer columns (half-even)."""
    meds = D.as_map_scalar(column_medians(masked, contract.value_columns))
    out = []
    for c in contract.columns:
        if c == contract.id_column:
            out.append(F.col(c))
            continue
        filled = F.coalesce(F.col(c), F.element_at(meds, F.lit(c)))
        if c in contract.integer_columns:
            filled = F.rint(filled).cast("long")
        out.append(filled.alias(c))
    return masked.select(*out)


def check_imputable(masked: DataFrame, contract: Contract = BASE_CONTRACT) -> None:
    """Action: a column with no valid value cannot be imputed."""
    r = masked.agg(*[F.count(c).alias(c) for c in contract.value_columns]).first()
    empty = [c for c in contract.value_columns if r[c] == 0]
    if empty:
        raise CleaningRefused(f"cannot impute columns without valid values: {empty}")


def masked(df: DataFrame, contract: Contract = BASE_CONTRACT, ids_unique: bool = False) -> DataFrame:
    """dedup -> coercion -> +-inf to null -> out-of-domain to null."""
    require_columns(df, contract)
    base = df.select(*contract.columns) if ids_unique else dedup_exact(df, contract)
    return mask_domain(coerce_numeric(base, contract), contract)


def clean(df: DataFrame, contract: Contract = BASE_CONTRACT, ids_unique: bool = False,
          border=materialize) -> DataFrame:
    """Lazy composition of the cleaning policies (gates are separate actions).

    ``ids_unique``: the caller proved id uniqueness (validation + one-to-one
    join), so exact duplicates are impossible and the dedup shuffle is skipped.
    ``border`` materializes the masked table, which both the medians and the
    fill read.
    """
    return impute_median(border(masked(df, contract, ids_unique)), contract)


def stage_counts(coerced: DataFrame, contract: Contract = BASE_CONTRACT) -> DataFrame:
    """Per column: nulls after coercion, out-of-domain, values to impute.

    One aggregate pass over the coerced table, unpivoted to one row per column.
    """
    aggs = []
    for c in contract.value_columns:
        lo, hi = contract.ranges.get(c, (None, None))
        ood = out_of_domain(F.col(c), lo, hi)
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__n"),
                 F.count_if(ood).alias(f"{c}__o"),
                 F.count_if(F.col(c).isNull() | ood).alias(f"{c}__i")]
    wide = coerced.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("nulos_antes"),
                 F.col(f"{c}__o").alias("valores_fuera_rango"), F.col(f"{c}__i").alias("valores_imputados"))
        for c in contract.value_columns]))
    return wide.select(rows.alias("r")).select("r.*")


def outliers_iqr(df: DataFrame, columns: list[str]) -> DataFrame:
    """IQR outlier count per column (diagnostic only).

    Q1/Q3 are linear quantiles; a value is an outlier when strictly outside
    [Q1 - 1.5 IQR, Q3 + 1.5 IQR]; IQR = 0 or an empty column gives 0.
    """
    spark = df.sparkSession
    long = D.to_long(df, columns)
    dist = D.cumulative(long)
    q = D.quantiles(dist, [(c, t, v) for c in columns for t, v in (("q1", 0.25), ("q3", 0.75))])
    lim = q.groupBy(D.K).agg(F.max(F.when(F.col("tag") == "q1", F.col(D.V))).alias("q1"),
                             F.max(F.when(F.col("tag") == "q3", F.col(D.V))).alias("q3"))
    lim = lim.withColumn("iqr", F.col("q3") - F.col("q1")).filter(F.col("iqr") != 0).select(
        D.K, (F.col("q1") - F.lit(1.5) * F.col("iqr")).alias("lo"), (F.col("q3") + F.lit(1.5) * F.col("iqr")).alias("hi"))
    # lim has at most one row per column.  Counted on the distribution (one row
    # per distinct value with its multiplicity), not on the unpivoted rows.
    outside = (F.col(D.V) < F.col("lo")) | (F.col(D.V) > F.col("hi"))
    counts = dist.join(F.broadcast(lim), D.K).groupBy(D.K).agg(
        F.sum(F.when(outside, F.col("cnt")).otherwise(F.lit(0))).alias("outliers_iqr"))
    names = spark.createDataFrame([(c,) for c in columns], f"{D.K} string")
    return names.join(counts, D.K, "left").select(
        D.K, F.coalesce(F.col("outliers_iqr"), F.lit(0)).cast("long").alias("outliers_iqr"))


def cleaning_report(base: DataFrame, contract: Contract = BASE_CONTRACT, ids_unique: bool = False) -> DataFrame:
    """Per-column cleaning metadata: nulls, out-of-domain, imputed, IQR outliers."""
    deduped = base.select(*contract.columns) if ids_unique else dedup_exact(base, contract)
    counts = stage_counts(coerce_numeric(deduped, contract), contract)
    cleaned = clean(base, contract, ids_unique)
    return report_with_outliers(counts, cleaned, contract)


def report_with_outliers(counts: DataFrame, cleaned: DataFrame, contract: Contract = BASE_CONTRACT) -> DataFrame:
    return counts.join(outliers_iqr(cleaned, contract.value_columns), "column_name")


def cleaning_summary(base: DataFrame, contract: Contract = BASE_CONTRACT) -> DataFrame:
    """One row: rows in, rows out, exact duplicates removed."""
    n_in = base.select(F.count(F.lit(1))).scalar()
    n_out = dedup_exact(base, contract).select(F.count(F.lit(1))).scalar()
    return base.sparkSession.range(1).select(
        n_in.alias("filas_iniciales"), n_out.alias("filas_limpias"), (n_in - n_out).alias("duplicados_exactos"))

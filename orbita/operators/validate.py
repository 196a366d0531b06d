"""Validation operators producing issue rows.

Every check of one table is a conditional count inside *one* aggregate pass;
the single result row is unpivoted into issue rows
``(stage, code, severity, column_name, n)`` and only the hits are kept.
Schema-level checks (missing / unexpected columns) need no job at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import BASE_COLUMNS, BEHAVIOUR_COLUMNS, ID, INTEGER_COLUMNS, PROFILE_COLUMNS, RANGES
from ..errors import RulesViolated
from ..functions.numeric import is_infinite, to_double

ISSUE_COLUMNS = ["stage", "code", "severity", "column_name", "n"]
ID_ERROR_CODES = ["INVALID_CUSTOMER_ID", "NON_POSITIVE_CUSTOMER_ID", "DUPLICATED_CUSTOMER_ID",
                  "MISSING_STREAMING_ID", "MISSING_PROFILE_ID"]

BEHAVIOUR_SOURCE = "usuarios_streaming"
PROFILE_SOURCE = "perfil_usuarios_postgresql"


def _issue(stage: str, code: str, severity: str, column: str | None, n: Column, hit: Column) -> Column:
    return F.struct(F.lit(stage).alias("stage"), F.lit(code).alias("code"), F.lit(severity).alias("severity"),
                    F.lit(column).cast("string").alias("column_name"), n.cast("long").alias("n"), hit.alias("hit"))


def _explode(wide: DataFrame, issues: list[Column]) -> DataFrame:
    return wide.select(F.inline(F.array(*issues))).filter("hit").select(*ISSUE_COLUMNS)


def _numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def _type_issue(stage: str, code: str) -> DataFrame:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(stage, code, "error", None, 1)],
                                 "stage string, code string, severity string, column_name string, n long")


def validate_source(df: DataFrame, required: list[str], source: str, id_column: str = ID) -> DataFrame:
    """Pre-join checks of one source (type, empty, schema, ids, nulls, text, inf)."""
    stage = f"estructura_{source}"
    if not isinstance(df, DataFrame):
        return _type_issue(stage, "INVALID_SOURCE_TYPE")
    actual = set(df.columns)
    missing = sorted(set(required) - actual)
    extra = sorted(actual - set(required))
    rows = F.count(F.lit(1))
    aggs = [rows.alias("_rows")]
    issues: list[Column] = []
    not_empty = F.col("_rows") > 0
    issues.append(_issue(stage, "EMPTY_SOURCE", "error", None, F.col("_rows"), F.col("_rows") == 0))
    if missing:
        issues.append(_issue(stage, "MISSING_REQUIRED_COLUMNS", "error", ",".join(missing), F.lit(len(missing)), not_empty))
    if extra:
        issues.append(_issue(stage, "UNEXPECTED_COLUMNS", "warning", ",".join(extra), F.lit(len(extra)), not_empty))
    if id_column in actual:
        i = to_double(F.col(id_column))
        aggs += [F.count_if(i.isNull() | F.isnan(i)).alias("_inv"), F.count_if(i <= 0).alias("_nonpos"),
                 (F.count(i) - F.count_distinct(i)).alias("_dup")]
        issues += [
            _issue(stage, "INVALID_CUSTOMER_ID", "error", id_column, F.col("_inv"), not_empty & (F.col("_inv") > 0)),
            _issue(stage, "NON_POSITIVE_CUSTOMER_ID", "error", id_column, F.col("_nonpos"),
                   not_empty & (F.col("_nonpos") > 0)),
            _issue(stage, "DUPLICATED_CUSTOMER_ID", "error", id_column, F.col("_dup"), not_empty & (F.col("_dup") > 0)),
        ]
        types = dict(df.dtypes)
        schema = {f.name: f.dataType for f in df.schema.fields}
        for j, c in enumerate(sorted(set(required) & actual)):
            if c == id_column:
                continue
            x = F.col(c)
            aggs.append(F.count_if(x.isNull()).alias(f"_n{j}"))
            issues.append(_issue(stage, "NULL_VALUES", "warning", c, F.col(f"_n{j}"), not_empty & (F.col(f"_n{j}") > 0)))
            num = x
            if not _numeric_type(schema[c]):
                num = to_double(x)
                aggs.append(F.count_if(x.isNotNull() & num.isNull()).alias(f"_t{j}"))
                issues.append(_issue(stage, "NON_NUMERIC_VALUES", "warning", c, F.col(f"_t{j}"),
                                     not_empty & (F.col(f"_t{j}") > 0)))
                issues.append(_issue(stage, "CONVERTIBLE_NUMERIC_TYPE", "warning", c, F.lit(0),
                                     not_empty & (F.col(f"_t{j}") == 0)))
            if types[c] in ("double", "float") or not _numeric_type(schema[c]):
                aggs.append(F.count_if(is_infinite(num)).alias(f"_f{j}"))
                issues.append(_issue(stage, "INFINITE_VALUES", "warning", c, F.col(f"_f{j}"),
                                     not_empty & (F.col(f"_f{j}") > 0)))
    return _explode(df.agg(*aggs), issues)


def id_compat(left: DataFrame, right: DataFrame, id_column: str = ID) -> DataFrame:
    """Same-universe check: distinct numeric ids on each side, full outer join."""
    l = left.select(to_double(F.col(id_column)).alias("_id")).filter(F.col("_id").isNotNull()).distinct() \
        .withColumn("_l", F.lit(1))
    r = right.select(to_double(F.col(id_column)).alias("_id")).filter(F.col("_id").isNotNull()).distinct() \
        .withColumn("_r", F.lit(1))
    j = l.join(r, "_id", "full_outer")
    return j.agg(
        F.count("_l").alias("ids_izquierda"), F.count("_r").alias("ids_derecha"),
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("ids_compartidos"),
        F.count_if(F.col("_r").isNull()).alias("ids_solo_izquierda"),
        F.count_if(F.col("_l").isNull()).alias("ids_solo_derecha"))


def ids_only_left(left: DataFrame, right: DataFrame, id_column: str = ID, sample: int = 10) -> DataFrame:
    """The first ``sample`` sorted ids present only on the left (left anti join)."""
    l = left.select(to_double(F.col(id_column)).alias(id_column)).filter(F.col(id_column).isNotNull())
    r = right.select(to_double(F.col(id_column)).alias(id_column))
    return l.join(r, id_column, "left_anti").distinct().orderBy(id_column).limit(sample)


def compat_issues(left: DataFrame, right: DataFrame, id_column: str = ID) -> DataFrame:
    stage = "compatibilidad_ids"
    if id_column not in left.columns or id_column not in right.columns:
        code = "MISSING_STREAMING_ID" if id_column not in left.columns else "MISSING_PROFILE_ID"
        return left.sparkSession.createDataFrame([(stage, code, "error", None, 1)],
                                                 "stage string, code string, severity string, column_name string, n long")
    c = id_compat(left, right, id_column)
    n = F.col("ids_solo_izquierda") + F.col("ids_solo_derecha")
    return _explode(c, [_issue(stage, "CUSTOMER_ID_MISMATCH", "error", id_column, n, n > 0)])


def validate_sources(behaviour: DataFrame, profile: DataFrame, id_column: str = ID) -> DataFrame:
    """Both source reports plus the id comparison, which is skipped when any
    source already has an id error."""
    a = validate_source(behaviour, BEHAVIOUR_COLUMNS, BEHAVIOUR_SOURCE, id_column)
    b = validate_source(profile, PROFILE_COLUMNS, PROFILE_SOURCE, id_column)
    src = a.unionByName(b)
    id_errors = src.filter(F.col("code").isin(ID_ERROR_CODES) & (F.col("severity") == "error")) \
        .select(F.count(F.lit(1))).scalar()
    compat = compat_issues(behaviour, profile, id_column).filter(id_errors == 0)
    return src.unionByName(compat)


def validate_clean(df: DataFrame, columns: list[str] = BASE_COLUMNS, id_column: str = ID) -> DataFrame:
    """Post-clean checks: what was a warning before is blocking now."""
    stage = "dataset_limpio"
    if not isinstance(df, DataFrame):
        return _type_issue(stage, "INVALID_CLEAN_DATASET_TYPE")
    actual = set(df.columns)
    missing = sorted(set(columns) - actual)
    extra = sorted(actual - set(columns))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    not_empty = F.col("_rows") > 0
    issues = [_issue(stage, "EMPTY_CLEAN_DATASET", "error", None, F.col("_rows"), F.col("_rows") == 0)]
    if missing:
        issues.append(_issue(stage, "MISSING_CLEAN_COLUMNS", "error", ",".join(missing), F.lit(len(missing)), not_empty))
        return _explode(df.agg(*aggs), issues)
    if extra:
        issues.append(_issue(stage, "UNEXPECTED_CLEAN_COLUMNS", "warning", ",".join(extra), F.lit(len(extra)), not_empty))
    if [c for c in df.columns if c in columns] != list(columns):
        issues.append(_issue(stage, "NON_STANDARD_COLUMN_ORDER", "warning", None, F.lit(0), not_empty))
    i = to_double(F.col(id_column))
    aggs += [F.count_if(i.isNull() | F.isnan(i)).alias("_inv"), (F.count(i) - F.count_distinct(i)).alias("_dup")]
    issues += [_issue(stage, "INVALID_CLEAN_CUSTOMER_ID", "error", id_column, F.col("_inv"), not_empty & (F.col("_inv") > 0)),
               _issue(stage, "DUPLICATED_CLEAN_CUSTOMER_ID", "error", id_column, F.col("_dup"),
                      not_empty & (F.col("_dup") > 0))]
    for j, c in enumerate(columns):
        x = to_double(F.col(c))
        bad = x.isNull() | F.isnan(x)
        aggs.append(F.count_if(bad).alias(f"_b{j}"))
        ok = not_empty & (F.col(f"_b{j}") == 0)  # a column with invalid values skips its other checks
        issues.append(_issue(stage, "NULL_OR_NON_NUMERIC_AFTER_CLEANING", "error", c, F.col(f"_b{j}"),
                             not_empty & (F.col(f"_b{j}") > 0)))
        aggs.append(F.count_if(is_infinite(x)).alias(f"_f{j}"))
        issues.append(_issue(stage, "INFINITE_AFTER_CLEANING", "error", c, F.col(f"_f{j}"), ok & (F.col(f"_f{j}") > 0)))
        lo, hi = RANGES.get(c, (None, None))
        if lo is not None:
            aggs.append(F.count_if(x < F.lit(float(lo))).alias(f"_lo{j}"))
            issues.append(_issue(stage, "VALUE_BELOW_MINIMUM", "error", c, F.col(f"_lo{j}"), ok & (F.col(f"_lo{j}") > 0)))
        if hi is not None:
            aggs.append(F.count_if(x > F.lit(float(hi))).alias(f"_hi{j}"))
            issues.append(_issue(stage, "VALUE_ABOVE_MAXIMUM", "error", c, F.col(f"_hi{j}"), ok & (F.col(f"_hi{j}") > 0)))
        if c in INTEGER_COLUMNS:
            aggs.append(F.count_if((x % 1) != 0).alias(f"_i{j}"))
            issues.append(_issue(stage, "NON_INTEGER_VALUE", "error", c, F.col(f"_i{j}"), ok & (F.col(f"_i{j}") > 0)))
    return _explode(df.agg(*aggs), issues)


def raise_if_invalid(issues: DataFrame, stage: str, limit: int = 1000) -> list:
    """Action: raise RulesViolated joining every error as ``[CODE] column n``.

    Issue tables hold at most a few rows per contract column, so collecting
    them is bounded by the contract, not by the data.
    """
    errors = issues.filter(F.col("severity") == "error").limit(limit).collect()
    if errors:
        msgs = [f"[{r['code']}] {r['column_name'] or ''} n={r['n']}".strip() for r in errors]
        raise RulesViolated(f"validation failed at stage '{stage}': " + " | ".join(msgs))
    return errors

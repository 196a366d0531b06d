"""Relational side of supervised modelling: split, label, folds, metrics.

Splits and folds are functions of a portable hash of (id, seed) - they do
not depend on partitioning, so a re-executed task (lost executor) assigns the
same rows, and DuckDB can restate them exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import (CLASSIFICATION_FEATURES, CLASSIFICATION_TARGET, CV_FOLDS, ID, LABEL_SOURCE_COLUMNS,
                         MIN_SUPERVISED_ROWS, RANDOM_STATE, REGRESSION_FEATURES, REGRESSION_TARGET, TEST_SHARE_PERCENT)
from ..errors import ModelInputRefused
from ..functions.numeric import round_half_even
from . import distribution as D


def id_hash(id_col: str = ID, salt: str = str(RANDOM_STATE), hex_digits: int = 15) -> Column:
    """Portable hash of (id, salt): the first ``hex_digits`` hex digits of md5 as a long."""
    s = F.concat(F.col(id_col).cast("string"), F.lit(":" + salt))
    return F.conv(F.substring(F.md5(s), 1, hex_digits), 16, 10).cast("long")


def train_test_split(df: DataFrame, id_col: str = ID, seed: int = RANDOM_STATE,
                     test_percent: int = TEST_SHARE_PERCENT) -> DataFrame:
    """Adds ``is_test`` (deterministic, about ``test_percent`` % of rows)."""
    return df.withColumn("is_test", (F.pmod(id_hash(id_col, str(seed)), F.lit(100)) < test_percent).cast("int"))


def check_supervised_input(df: DataFrame, features: list[str], target: str, id_col: str = ID) -> None:
    """Leakage guard and contract checks (schema-level, plus one aggregate action)."""
    leaks = sorted(set(features) & set(LABEL_SOURCE_COLUMNS)) if target == CLASSIFICATION_TARGET else []
    if target in features:
        raise ModelInputRefused(f"target {target} is listed as a feature")
    if leaks:
        raise ModelInputRefused(f"label-source columns used as features: {leaks}")
    missing = sorted(set(features + [id_col]) - set(df.columns))
    if missing:
        raise ModelInputRefused(f"missing model columns: {missing}")
    cols = features + ([target] if target in df.columns else [])
    r = df.agg(F.count(F.lit(1)).alias("n"), (F.count(id_col) - F.count_distinct(id_col)).alias("dup"),
               sum((F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
                               | (F.abs(F.col(c).cast("double")) == float("inf"))) for c in cols),
                   F.lit(0)).alias("bad")).first()
    if r["dup"]:
        raise ModelInputRefused("duplicated ids in model input")
    if r["bad"]:
        raise ModelInputRefused("null or infinite values in model input")
    if r["n"] < MIN_SUPERVISED_ROWS:
        raise ModelInputRefused(f"at least {MIN_SUPERVISED_ROWS} rows are required")


def median_of(df: DataFrame, column: str) -> Column:
    """Exact median of one column as a scalar subquery (distributed)."""
    return D.medians(D.distribution(df, [column])).select(D.V).scalar()


def risk_thresholds(split: DataFrame) -> DataFrame:
    """(column_name, value): medians of the label-source columns on TRAIN rows only."""
    train = split.filter(F.col("is_test") == 0)
    return D.medians(D.distribution(train, LABEL_SOURCE_COLUMNS))


def risk_label(split: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """riesgo_bajo_compromiso = completion < median AND sessions < median (strict)."""
    th = D.as_map_scalar(risk_thresholds(split) if thresholds is None else thresholds)
    lab = ((F.col("porcentaje_finalizacion") < F.element_at(th, F.lit("porcentaje_finalizacion")))
           & (F.col("sesiones_semana") < F.element_at(th, F.lit("sesiones_semana")))).cast("int")
    return split.withColumn(CLASSIFICATION_TARGET, lab)


def class_balance(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("is_test", CLASSIFICATION_TARGET).agg(F.count(F.lit(1)).alias("n"))


def check_classes(labelled: DataFrame) -> int:
    """Both classes in train and test; returns the number of CV folds."""
    rows = class_balance(labelled).collect()  # at most 4 rows
    got = {(r["is_test"], r[CLASSIFICATION_TARGET]): r["n"] for r in rows}
    for part in (0, 1):
        for cls in (0, 1):
            if not got.get((part, cls)):
                raise ModelInputRefused("both classes must appear in train and test")
    folds = min(CV_FOLDS, got[(0, 0)], got[(0, 1)])
    if folds < 2:
        raise ModelInputRefused("not enough rows per class for cross-validation")
    return folds


def folds(train: DataFrame, k: int = CV_FOLDS, id_col: str = ID, label: str | None = None,
          seed: int = RANDOM_STATE) -> DataFrame:
    """Adds ``fold``.

    Plain K-fold: pmod(hash, k).  Stratified: rows of each class are ordered
    by hash and dealt round-robin, so every fold gets floor/ceil of each class.
    The per-class position comes from the distributed cumulative distribution
    (no per-class global window, which would put a whole class in one task).
    """
    # 13 hex digits = 52 bits: exact as a double, the distribution's value type.
    h = id_hash(id_col, f"{seed}:fold", 13)
    t = train.withColumn("_h", h)
    if label is None:
        return t.withColumn("fold", F.pmod(F.col("_h"), F.lit(k)).cast("int")).drop("_h")
    long = t.select(F.col(label).cast("string").alias(D.K), F.col("_h").cast("double").alias(D.V))
    pos = D.cumulative(long).select(F.col(D.K).alias("_k"), F.col(D.V).alias("_v"), "before")
    out = t.join(pos, (F.col(label).cast("string") == F.col("_k")) & (F.col("_h").cast("double") == F.col("_v")))
    return out.withColumn("fold", F.pmod(F.col("before"), F.lit(k)).cast("int")).drop("_h", "_k", "_v", "before")


# ---- metrics over prediction tables ------------------------------------------

def regression_metrics(pred: DataFrame, real: str = "valor_real", predicted: str = "valor_predicho",
                       digits: int = 6) -> DataFrame:
    """R^2, MAE, RMSE in one aggregate pass (rounded half-even)."""
    e = F.col(real) - F.col(predicted)
    m = pred.agg(F.sum(e * e).alias("sse"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                 F.var_pop(real).alias("var"), F.count(F.lit(1)).alias("n"))
    r2 = F.lit(1.0) - F.try_divide(F.col("sse"), F.col("var") * F.col("n"))  # constant target -> null
    return m.select(round_half_even(r2, digits).alias("r2"), round_half_even(F.col("mae"), digits).alias("mae"),
                    round_half_even(F.sqrt("mse"), digits).alias("rmse"), F.col("n").alias("n"))


def confusion_matrix(pred: DataFrame, real: str = "valor_real", predicted: str = "valor_predicho") -> DataFrame:
    """Counts for every (real, predicted) in {0,1}^2, zero cells included."""
    m = pred.agg(*[F.count_if((F.col(real) == a) & (F.col(predicted) == b)).alias(f"c{a}{b}")
                   for a in (0, 1) for b in (0, 1)])
    return m.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("real"), F.lit(b).alias("predicho"), F.col(f"c{a}{b}").alias("n"))
        for a in (0, 1) for b in (0, 1)])).alias("r")).select("r.*")


def classification_metrics(pred: DataFrame, real: str = "valor_real", predicted: str = "valor_predicho",
                           digits: int = 6) -> DataFrame:
    """accuracy, precision, recall, F1 for class 1; zero division gives 0."""
    r, p = F.col(real), F.col(predicted)
    m = pred.agg(F.count_if((r == 1) & (p == 1)).alias("tp"), F.count_if((r == 0) & (p == 1)).alias("fp"),
                 F.count_if((r == 1) & (p == 0)).alias("fn"), F.count_if(r == p).alias("ok"),
                 F.count(F.lit(1)).alias("n"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("tp"), F.lit(2.0) * F.col("tp") + F.col("fp") + F.col("fn")),
                    F.lit(0.0))
    return m.select(round_half_even(F.col("ok") / F.col("n"), digits).alias("accuracy"),
                    round_half_even(prec, digits).alias("precision"), round_half_even(rec, digits).alias("recall"),
                    round_half_even(f1, digits).alias("f1"))


def roc_auc(pred: DataFrame, real: str = "valor_real", score: str = "probabilidad_riesgo", digits: int = 6) -> DataFrame:
    """Tie-aware ROC-AUC (Mann-Whitney U with average ranks).

    Average ranks come from the distributed cumulative distribution of the
    scores, joined back on the score value.
    """
    long = pred.select(F.lit("s").alias(D.K), F.col(score).cast("double").alias(D.V), F.col(real).alias("_y"))
    ranks = D.cumulative(long.select(D.K, D.V)).select(
        D.K, D.V, (F.col("before") + (F.col("cnt") + 1) / F.lit(2.0)).alias("_rank"))
    j = long.join(ranks, [D.K, D.V])
    m = j.agg(F.sum(F.when(F.col("_y") == 1, F.col("_rank"))).alias("rs"), F.count_if(F.col("_y") == 1).alias("npos"),
              F.count_if(F.col("_y") == 0).alias("nneg"))
    auc = F.try_divide(F.col("rs") - F.col("npos") * (F.col("npos") + 1) / F.lit(2.0),
                       F.col("npos") * F.col("nneg"))  # one class absent -> null
    return m.select(round_half_even(auc, digits).alias("roc_auc"))


def ols_simple(train: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """Single-feature least squares: slope and intercept (regr_* aggregates)."""
    return train.agg(round_half_even(F.regr_slope(F.col(y), F.col(x)), digits).alias("pendiente"),
                     round_half_even(F.regr_intercept(F.col(y), F.col(x)), digits).alias("intercepto"),
                     F.regr_count(F.col(y), F.col(x)).alias("n"))


def best_model(cv: DataFrame, metric: str = "cv_mean") -> DataFrame:
    """Winner by mean CV score only (the test split is audit-only)."""
    return cv.agg(F.max_by("modelo", metric).alias("modelo"), F.max(metric).alias(metric))


__all__ = ["REGRESSION_FEATURES", "REGRESSION_TARGET", "CLASSIFICATION_FEATURES", "CLASSIFICATION_TARGET"]

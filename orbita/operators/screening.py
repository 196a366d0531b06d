"""Cross-validated screening of single features: how well each one alone predicts a target.

A least-squares line needs six sums.  They are added up per fold in one aggregate over all rows;
the line of a fold's training rows follows from the totals less the fold's own sums, and so does its R² on the
fold.  No fold is read twice and no row leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cv_single_features(df: DataFrame, features: list[str], target: str, fold: str = "fold") -> DataFrame:
    """(modelo, cv_mean, cv_std): R² over the folds of the line on each feature, fitted on the other folds.

    Sums are taken of values less the column means, so that large means cost no digits.  A fold whose target is
    constant, or a training part whose feature is, scores null and is left out of the mean.
    """
    means = df.agg(*[F.avg(c).alias(c) for c in [*features, target]]).first()
    y = F.col(target).cast("double") - F.lit(float(means[target]))
    long = df.select(fold, y.alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("modelo"), (F.col(c).cast("double") - F.lit(float(means[c]))).alias("_x")) for c in features])).alias("_f"))
    x, y = F.col("_f._x"), F.col("_y")
    sums = long.groupBy(F.col("_f.modelo").alias("modelo"), fold).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(x).alias("x"), F.sum(y).alias("y"), F.sum(x * x).alias("xx"), F.sum(x * y).alias("xy"),
        F.sum(y * y).alias("yy"))
    whole = Window.partitionBy("modelo")  # one row a fold
    for c in ("n", "x", "y", "xx", "xy"):
        sums = sums.withColumn(f"t_{c}", F.sum(c).over(whole) - F.col(c))
    spread = F.col("t_xx") - F.col("t_x") * F.col("t_x") / F.col("t_n")
    slope = F.try_divide(F.col("t_xy") - F.col("t_x") * F.col("t_y") / F.col("t_n"), spread)
    rows = sums.where(F.col("t_n") > 0).withColumn("b", slope).withColumn("a", (F.col("t_y") - F.col("b") * F.col("t_x")) / F.col("t_n"))
    a, b = F.col("a"), F.col("b")
    missed = (F.col("yy") - 2 * a * F.col("y") - 2 * b * F.col("xy") + F.col("n") * a * a + 2 * a * b * F.col("x") + b * b * F.col("xx"))
    total = F.col("yy") - F.col("y") * F.col("y") / F.col("n")
    scored = rows.withColumn("score", F.lit(1.0) - F.try_divide(missed, total))
    return scored.groupBy("modelo").agg(F.avg("score").alias("cv_mean"), F.stddev_pop("score").alias("cv_std"))

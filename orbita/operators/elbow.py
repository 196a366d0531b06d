"""Kneedle elbows of many curves at once (Satopaa, Albrecht, Irwin, Raghavan, 2011), with windows only.

The same rules as :mod:`orbita.functions.kneedle`, which serves the one k table of a segmentation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def elbow_k(points: DataFrame, curve: str, x: str, y: str, sensitivity: float = 1.0) -> DataFrame:
    """(curve, elbow): the elbow of each decreasing convex curve, null where it has none.

    ``points`` has one row per curve and x.  The difference of the normalised curve and the diagonal is searched for the first local
    maximum that it falls below, by the sensitivity's threshold, before a local minimum takes the threshold's place.
    A window partition is one curve.
    """
    whole = Window.partitionBy(curve)
    along = whole.orderBy(x)

    def normal(c):
        low, span = F.min(c).over(whole), F.max(c).over(whole) - F.min(c).over(whole)
        return F.when(span > 0, (F.col(c).cast("double") - low) / span).otherwise(0.0)

    rows = points.select(curve, x, normal(x).alias("_x"), normal(y).alias("_y"), F.count(F.lit(1)).over(whole).alias("_n"))
    rows = rows.select(curve, x, "_x", "_n", (F.max("_y").over(whole) - F.col("_y") - F.col("_x")).alias("_d"))
    d = F.col("_d")
    before, after = F.coalesce(F.lag("_d").over(along), d), F.coalesce(F.lead("_d").over(along), d)
    step = F.try_divide(F.max("_x").over(whole), F.col("_n") - 1)  # mean distance of neighbours on the unit interval
    rows = rows.select(curve, x, "_d", F.lead("_d").over(along).alias("_next"), step.alias("_step"),
                       ((d >= before) & (d >= after)).alias("_top"), ((d <= before) & (d <= after)).alias("_bottom"))
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("_next").isNull()  # the last point sets and tests nothing
    # A point that is maximum and minimum at once (a flat piece) leaves the threshold at zero.
    threshold = F.when(last, None).when(F.col("_bottom"), 0.0).when(F.col("_top"), d - F.lit(sensitivity) * F.col("_step"))
    started = F.max(F.col("_top").cast("int")).over(so_far) == 1  # minima before the first maximum don't count
    rows = (rows.withColumn("_started", started).withColumn("_set", F.when(F.col("_started"), threshold))
            .withColumn("_threshold", F.last("_set", True).over(so_far))
            .withColumn("_at", F.last(F.when(F.col("_top") & ~last, F.col(x)), True).over(so_far)))
    hit = F.when(F.col("_next") < F.col("_threshold"), F.struct(F.col(x).alias("x"), F.col("_at").alias("at")))
    return rows.groupBy(curve).agg(F.min(hit).alias("_hit"), F.count(F.lit(1)).alias("_n")).select(
        curve, F.when(F.col("_n") >= 2, F.col("_hit.at")).alias("elbow"))

"""Exact, distributed order statistics: percent rank, medians, linear quantiles.

Spark's exact ``percentile``/``median`` keeps a value->count map per group and
merges it in one task for a global aggregate, and a global ``rank()`` window
pulls every row into one task.  Neither survives a table with billions of
distinct values.  Here every statistic is derived from one *cumulative
distribution* table built with shuffles only:

1. ``groupBy(column, value).count()`` - partial aggregation map-side, so a hot
   value (a third of all rows) costs one counter, not one task;
2. ranges of about equal counts of distinct values per column: splitters are
   every m-th value of a hash sample of the distinct values (about
   ``OVERSAMPLE x buckets`` of a column, whatever its size), so neither a heavy
   tail nor one far outlier fills a bucket.  The sample is a function of the
   values, so a re-executed task cuts at the same places;
3. per-bucket running sums: a window partitioned by (column, bucket);
4. bucket offsets: a running sum over at most ``columns x buckets`` rows,
   broadcast back (its size is bounded by the bucket parameter, not the data).

The result has, for every distinct value, how many values are strictly
smaller (``before``), how many are equal (``cnt``) and the column size ``n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numeric import lerp
from ..session import shuffle_partitions

K, V = "column_name", "value"


def to_long(df: DataFrame, columns: list[str], id_column: str | None = None) -> DataFrame:
    """Unpivot ``columns`` into (id?, column_name, value double), nulls dropped."""
    ids = [id_column] if id_column else []
    long = df.select(*ids, F.explode(F.array(*[
        F.struct(F.lit(c).alias(K), F.col(c).cast("double").alias(V)) for c in columns
    ])).alias("_kv")).select(*ids, F.col(f"_kv.{K}").alias(K), F.col(f"_kv.{V}").alias(V))
    return long.filter(F.col(V).isNotNull())


#: Sampled distinct values per bucket: bucket sizes vary by about 1 / sqrt(OVERSAMPLE).
OVERSAMPLE = 32
_HASHES = float(1 << 63)


def splitters(counts: DataFrame, sizes: DataFrame, buckets: int) -> DataFrame:
    """(column_name, _splits): at most ``buckets - 1`` ascending values that part the column's distinct
    values into ranges of about equal counts."""
    chance = F.col("_distinct") * (F.shiftrightunsigned(F.xxhash64(K, V), 1) / F.lit(_HASHES))
    sample = (counts.select(K, V).join(F.broadcast(sizes.select(K, "_distinct")), K)
              .where(chance < F.lit(float(OVERSAMPLE * buckets))))
    place = F.row_number().over(Window.partitionBy(K).orderBy(V))  # about OVERSAMPLE x buckets rows a column
    total = F.count(F.lit(1)).over(Window.partitionBy(K))
    ranked = sample.select(K, V, place.alias("_place"), total.alias("_total"))
    share = lambda k: F.floor(k * F.lit(buckets) / (F.col("_total") + 1))
    cut = ranked.where(share(F.col("_place")) > share(F.col("_place") - 1))
    return cut.groupBy(K).agg(F.sort_array(F.collect_list(V)).alias("_splits"))


def with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """Adds ``_b``, the number of entries of ``_splits`` that are not above the value (an unrolled binary search)."""
    rows = rows.withColumn("_b", F.lit(0))
    step = 1 << max(0, buckets - 1).bit_length()
    while step:
        # Behind the array's end ``get`` is null, which counts as above every value.
        probe = F.get("_splits", F.col("_b") + F.lit(step - 1)) <= F.col(V)
        rows = rows.withColumn("_b", F.when(probe, F.col("_b") + F.lit(step)).otherwise(F.col("_b")))
        step //= 2
    return rows


def bucketed(long: DataFrame, buckets: int) -> DataFrame:
    """(column_name, value) rows -> (column_name, value, cnt, n, _b): distinct values dealt to ranges of about equal counts."""
    counts = long.groupBy(K, V).agg(F.count(F.lit(1)).alias("cnt"))
    sizes = counts.groupBy(K).agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("_distinct"))
    # One row per column name each, with at most ``buckets`` splitters: bounded by the column list.
    cuts = sizes.join(splitters(counts, sizes, buckets), K, "left")
    return with_bucket(counts.join(F.broadcast(cuts.select(K, "n", "_splits")), K), buckets).select(K, V, "cnt", "n", "_b")


def cumulative(long: DataFrame, buckets: int | None = None) -> DataFrame:
    """(column_name, value) rows -> (column_name, value, cnt, before, n)."""
    b = bucketed(long, buckets or max(8, shuffle_partitions(long.sparkSession)))
    w_in = Window.partitionBy(K, "_b").orderBy(V).rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("_before_in", F.coalesce(F.sum("cnt").over(w_in), F.lit(0)))
    totals = b.groupBy(K, "_b").agg(F.sum("cnt").alias("_bt"))
    w_off = Window.partitionBy(K).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_bt").over(w_off), F.lit(0))).select(K, "_b", "_off")
    # offsets holds at most (#columns x buckets) rows.
    return b.join(F.broadcast(offsets), [K, "_b"]).select(
        K, V, "cnt", (F.col("_off") + F.col("_before_in")).alias("before"), "n")


def distribution(df: DataFrame, columns: list[str], buckets: int | None = None) -> DataFrame:
    return cumulative(to_long(df, columns), buckets)


def percent_rank_avg(dist: DataFrame) -> DataFrame:
    """pandas ``rank(pct=True)`` with average ties: (before + (cnt+1)/2) / n."""
    return dist.select(K, V, ((F.col("before") + (F.col("cnt") + 1) / F.lit(2.0)) / F.col("n")).alias("pct"))


def _holds(pos: Column) -> Column:
    """This distinct value occupies 0-based sorted position ``pos``."""
    return (F.col("before") <= pos) & (pos < F.col("before") + F.col("cnt"))


def quantiles(dist: DataFrame, wanted: list[tuple[str, str, float]]) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas 'linear').

    ``wanted``: list of (column_name, tag, q).  Returns (column_name, tag, value).
    A request on a column without values yields no row.

    One pass over the distribution: every distinct value checks whether it
    holds the lower or upper order statistic of a request (the requests are a
    broadcast list bounded by the caller), then one small aggregate per request.
    """
    spark = dist.sparkSession
    req = spark.createDataFrame(wanted, f"{K} string, tag string, q double")
    h = (F.col("n") - 1) * F.col("q")
    lo = F.floor(h)
    hi = F.least(lo + 1, F.col("n") - 1)
    hits = dist.join(F.broadcast(req), K).select(
        K, "tag", V, (h - lo).alias("_frac"), _holds(lo).alias("_lo"), _holds(hi).alias("_hi")
    ).filter(F.col("_lo") | F.col("_hi"))
    agg = hits.groupBy(K, "tag").agg(F.max(F.when(F.col("_lo"), F.col(V))).alias("_a"),
                                     F.max(F.when(F.col("_hi"), F.col(V))).alias("_b"),
                                     F.max("_frac").alias("_frac"))
    return agg.select(K, "tag", lerp(F.col("_a"), F.col("_b"), F.col("_frac")).alias(V))


def medians(dist: DataFrame) -> DataFrame:
    """numpy median: mean of the two middle order statistics.  (column_name, value)."""
    lo = F.floor((F.col("n") - 1) / 2)
    hi = F.ceil((F.col("n") - 1) / 2)
    hits = dist.select(K, V, _holds(lo).alias("_lo"), _holds(hi).alias("_hi")).filter(F.col("_lo") | F.col("_hi"))
    return hits.groupBy(K).agg(
        ((F.max(F.when(F.col("_lo"), F.col(V))) + F.max(F.when(F.col("_hi"), F.col(V)))) / F.lit(2.0)).alias(V))


def as_map_scalar(small: DataFrame, key: str = K, value: str = V) -> Column:
    """A bounded (key, value) table as one map-valued scalar subquery.

    Used to bring per-column statistics (one row per contract column) into a
    row-level expression without a cross join; Spark runs the subquery once
    and inlines the result.
    """
    return small.select(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value))))).scalar()

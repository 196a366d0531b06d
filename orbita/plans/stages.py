"""Stage borders: materialize a DataFrame to the shared checkpoint folder.

A reliable ``checkpoint()`` writes the stage to ``spark.checkpoint.dir`` and
cuts the lineage, so (1) the expensive upstream (lineitem -> customer
aggregation, joins) runs once even when the stage feeds self-joins and scalar
subqueries, (2) a lost executor re-reads the stage instead of recomputing it,
and (3) later plans stay small.  Materialized stages are memoized per
application and input folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize  # noqa: F401  (re-exported)

_MEMO: dict[tuple, DataFrame] = {}


def sized(df: DataFrame, rows: int, rows_per_partition: int = 200_000) -> DataFrame:
    """Partitions proportional to the row count (iterative ML on a cached table:
    every iteration is a job, so empty-ish tasks are pure overhead)."""
    want = max(1, -(-rows // rows_per_partition))
    have = df.rdd.getNumPartitions()
    return df.coalesce(want) if want < have else df.repartition(want) if want > 2 * have else df


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MEMO:
        _MEMO[key] = materialize(build())
    return _MEMO[key]


def memo(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """Memoize a non-DataFrame result (fitted models, small driver-side tables)."""
    key = (spark.sparkContext.applicationId, sf_dir, "memo:" + name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def forget() -> None:
    _MEMO.clear()

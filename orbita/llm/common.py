"""Small helpers shared by the training-text operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: Rows and bytes of one Arrow batch on its way to a Python worker, well under Spark's
#: defaults of 10,000 rows and 64 MB: a worker holds one batch and what is made of it.
ARROW_ROWS, ARROW_BYTES = 512, "8m"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bound_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Before Python workers are used: keep Arrow batches small (a worker holds one), and ship this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives a lost executor, and rows that
    several later steps read are computed once.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (extra columns may clash with ours)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))

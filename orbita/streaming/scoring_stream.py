"""Batch scoring over arriving request files (Structured Streaming).

The per-request scoring endpoints of the original service become one
stateless streaming query: request files land in a folder, each micro-batch is
validated against the input contract and scored with the fitted pipeline
models, and accepted and rejected rows are appended to two sinks.  There is
no state, watermark or event time: each request is scored on its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..contracts import ID, KMEANS_FEATURES
from ..operators import scoring as SC


def request_schema(fields: list[str] = KMEANS_FEATURES) -> T.StructType:
    """Requests arrive as text so unparsable cells reach the input check."""
    return T.StructType([T.StructField(ID, T.LongType())] + [T.StructField(c, T.StringType()) for c in fields])


def score_batch(batch: DataFrame, score: Callable[[DataFrame], DataFrame], accepted_path: str, rejected_path: str,
                fields: list[str] = KMEANS_FEATURES, epoch: int = 0) -> None:
    """Score one micro-batch; output goes to ``epoch=<n>`` folders overwritten as a
    whole, so a re-executed batch (lost executor, restart) does not duplicate rows."""
    score(SC.accepted(batch, fields)).write.mode("overwrite").parquet(f"{accepted_path}/epoch={epoch}")
    SC.rejected(batch, fields).write.mode("overwrite").parquet(f"{rejected_path}/epoch={epoch}")


def start(spark: SparkSession, source_dir: str, score: Callable[[DataFrame], DataFrame], accepted_path: str,
          rejected_path: str, checkpoint: str, fields: list[str] = KMEANS_FEATURES, fmt: str = "json"):
    """Start the query; ``checkpoint`` must be a shared folder (exactly-once file sink bookkeeping)."""
    stream = spark.readStream.schema(request_schema(fields)).format(fmt).load(source_dir)
    return (stream.writeStream
            .foreachBatch(lambda df, epoch: score_batch(df, score, accepted_path, rejected_path, fields, epoch))
            .option("checkpointLocation", checkpoint)
            .start())

"""Training-text pipeline over ``documents``: each stage works on what its predecessor kept.

1. quality        -- documents that the Bradley-Terry classifier rejects go;
2. line_dedup     -- cross-site boilerplate lines go (each stays once), and documents that this leaves blank;
3. near_dedup     -- of each SimHash group the document of the smallest doc_id stays;
4. decontaminate  -- documents that hold a benchmark item go;
5. packing        -- the rest is packed into windows of token ids.

All but the last return the columns of ``documents``; every result is written as Parquet to
the shared folder and read again as the next stage's input.

Defined cases are those of the operators: null texts count as empty (the classifier scores them
like any text); extra columns are carried up to packing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orbita.llm import common, decontaminate, line_dedup, packing, quality, queries, simhash
from orbita.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean_documents(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, radius=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_dedup", simhash_stage),
          ("decontaminate", decontamination_stage), ("packing", packing_stage)]

#: SQL can't express the classifier, SimHash or packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``.  A stage's table goes when its successor's is written; packing writes
    its pieces before it returns."""
    docs, before = common.documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        docs = common.written(stage(spark, docs, sf_dir), name, path)
        if before:
            common.discard(spark, before)
        before = path
    packed = STAGES[-1][1](spark, docs, sf_dir)
    common.discard(spark, before)
    return packed

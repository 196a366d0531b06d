"""Ledger of model fits in a shared folder: a killed or timed-out model selection goes on where it stopped.

A selection is named by what decides its result: the task, a fingerprint of the input rows and the
versions involved.  Each cross-validation fit (candidate, parameters, fold) adds one
small JSON file when its score is known; files appear whole or not at all.  Fitted models are
saved to a folder of their own first and recorded afterwards, so a half-written
model is never loaded.  Two runs may work on one selection at once: equal fits have equal records, and
the first record stays.
"""

from __future__ import annotations

import hashlib
import json
from uuid import uuid4

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import shared

#: Part of every key: raise it when a change of the fitting code changes its results.
FIT_VERSION = 6
RECORD = "modelo string, parametros string, fold int, score double"


def fingerprint(df: DataFrame) -> str:
    """Content of a table, whatever its row order and partitioning: one aggregate over row hashes."""
    columns = sorted(df.columns)
    row = F.xxhash64(*columns)
    sums = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("total"), F.bit_xor(row).alias("xor"),
                  F.sum(F.xxhash64(*columns, F.lit(1)).cast("decimal(38,0)")).alias("again")).first()
    types = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in columns)
    return hashlib.md5(f"{types}|{tuple(sums)}".encode()).hexdigest()


class FitLedger:
    """Records of one selection."""

    def __init__(self, spark: SparkSession, task: str, *inputs: DataFrame, root: str | None = None):
        base = (root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/orbita-fits").rstrip("/")
        decides = "|".join([str(FIT_VERSION), pyspark.__version__, *map(fingerprint, inputs)])
        self.spark = spark
        self.folder = f"{base}/{task}-{hashlib.md5(decides.encode()).hexdigest()[:20]}"

    def _score_path(self, name: str, params: str, fold: int) -> str:
        return f"{self.folder}/scores/{hashlib.md5(f'{name}|{params}|{fold}'.encode()).hexdigest()}.json"

    def record(self, name: str, params: str, fold: int, score: float) -> None:
        line = json.dumps({"modelo": name, "parametros": params, "fold": fold, "score": score})
        shared.put(self.spark, self._score_path(name, params, fold), line)

    def table(self) -> DataFrame:
        """(modelo, parametros, fold, score) of every recorded fit."""
        if not shared.names(self.spark, f"{self.folder}/scores"):
            return self.spark.createDataFrame([], RECORD)
        return self.spark.read.schema(RECORD).option("pathGlobFilter", "*.json").json(f"{self.folder}/scores")

    def scores(self) -> dict[tuple[str, str, int], float]:
        """Recorded fits: at most candidates x grid x folds."""
        return {(r["modelo"], r["parametros"], r["fold"]): r["score"] for r in self.table().collect()}

    def votes(self, name: str, params: str, fold: int, make) -> str:
        """Where the recorded votes (in a refit: trees) of a forest's block are; ``make()``'s are written first and recorded then."""
        record = f"{self.folder}/votes/{hashlib.md5(f'{name}|{params}|{fold}'.encode()).hexdigest()}.json"
        if not shared.exists(self.spark, record):
            path = f"{self.folder}/votes/{uuid4().hex}"
            make().write.parquet(path)
            shared.put(self.spark, record, json.dumps({"path": path}))
        return json.loads(shared.read(self.spark, record))["path"]

    def model(self, which: str, fit) -> PipelineModel:
        """The recorded model of that name, or ``fit()``'s, saved and recorded."""
        record = f"{self.folder}/{which}.json"
        if not shared.exists(self.spark, record):
            fitted, path = fit(), f"{self.folder}/models/{which}-{uuid4().hex[:12]}"
            fitted.write().save(path)
            shared.put(self.spark, record, json.dumps({"path": path}))
        return PipelineModel.load(json.loads(shared.read(self.spark, record))["path"])

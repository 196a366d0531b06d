"""Cross-stage check as a result: one row per check, so that every failure is seen at once."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import ID
from ..errors import StagesDisagree

SCHEMA = "control string, objeto string, encontrado string, esperado string, correcto int"


def model_features(model: PipelineModel) -> list[str]:
    """Input columns of the pipeline's assembler."""
    return next(list(s.getInputCols()) for s in model.stages if hasattr(s, "getInputCols") and hasattr(s, "getOutputCol"))


def cross_check(spark: SparkSession, tables: dict[str, DataFrame], stages: list[str], features: dict[str, tuple[list[str], list[str]]],
                metrics: dict, id_col: str = ID) -> DataFrame:
    """(control, objeto, encontrado, esperado, correcto): equal row counts over the ``stages``, unique ids, features
    (found, contracted) of every model, finite metrics.  One aggregate per stage; a stage that is missing fails too."""
    rows, counts = [], {}
    for name in stages:
        if name not in tables:
            rows.append(("etapa_presente", name, "no", "si", 0))
            continue
        r = tables[name].agg(F.count(F.lit(1)).alias("n"), F.count_distinct(id_col).alias("ids")).first()
        counts[name] = r["n"]
        rows.append(("ids_unicos", name, str(r["ids"]), str(r["n"]), int(r["ids"] == r["n"])))
    first = next(iter(counts.values()), 0)
    rows += [("filas_iguales", name, str(n), str(first), int(n == first and n > 0)) for name, n in counts.items()]
    for name, (found, wanted) in features.items():
        rows.append(("variables", name, ",".join(found), ",".join(wanted), int(list(found) == list(wanted))))
    for name, value in metrics.items():
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            rows.append(("metrica_finita", name, "finita" if math.isfinite(value) else str(value), "finita", int(math.isfinite(value))))
    return spark.createDataFrame(rows, SCHEMA)


def raise_if_failed(checks: DataFrame) -> None:
    """Raise with every failed check."""
    bad = checks.where("correcto = 0").collect()  # at most one row per stage, model and metric
    if bad:
        raise StagesDisagree(" | ".join(f"{r['control']} {r['objeto']}: {r['encontrado']} instead of {r['esperado']}" for r in bad))

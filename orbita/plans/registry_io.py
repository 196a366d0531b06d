"""Registered queries: CSV by name with rejects, versioned publication and read-back, scoring from published models,
cross-stage check, records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import BEHAVIOUR_COLUMNS, CLASSIFICATION_FEATURES, ID, INTEGER_COLUMNS, KMEANS_FEATURES, REGRESSION_FEATURES
from ..operators import crosscheck as CC
from ..operators import scoring as SC
from ..operators import segment as SG
from ..sources import csv_scan, files, shared, tpch
from ..sources import publication as PB
from . import oracle as O
from .registry import analytic, base, clean_base, kpis, register

_NUMBERS = ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c == ID else f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in BEHAVIOUR_COLUMNS)


@register("scan_csv_reordered", O.with_chain(f"SELECT {_NUMBERS}, CASE WHEN id_cliente % 2 = 1 THEN 'n' || id_cliente END AS nota FROM behaviour_src"))
def q_scan_csv_reordered(spark, sf):
    """Behaviour source in two files, one with its columns backwards and nulls written as NA, read by name."""
    path, source = files.scratch(spark, "behaviour-files"), tpch.behaviour_source(spark, sf)
    odd = F.col(ID) % 2 == 1
    told = source.withColumn("nota", F.when(odd, F.concat(F.lit("n"), F.col(ID).cast("string"))))
    text = told.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) for c in told.columns])
    files.write_csv(text.where(odd).select(*reversed(text.columns)), path)
    told.where(~odd).write.mode("append").option("header", True).csv(path)
    rows = csv_scan.scan(spark, path).rows
    return rows.select(*[F.col(c).cast("long").alias(c) if c == ID else F.col(c).try_cast("double").alias(c) for c in BEHAVIOUR_COLUMNS], "nota")


_RAGGED = ["id_cliente", "cantidad_contenidos_vistos", "sesiones_semana", "antiguedad_cliente_meses"]


@register("csv_rejects", O.with_chain(f"""
SELECT CAST(id_cliente AS VARCHAR) AS inicio,
       CASE WHEN id_cliente % 10 = 3 THEN concat_ws(',', {', '.join(_RAGGED[:3])}) ELSE concat_ws(',', {', '.join(_RAGGED)}) || ',' || id_cliente % 7 END AS linea,
       CASE WHEN id_cliente % 10 = 3 THEN 'too_few_fields' ELSE 'too_many_fields' END AS motivo
FROM behaviour_src WHERE id_cliente % 10 IN (3, 7)"""))
def q_csv_rejects(spark, sf):
    """A file in which some lines lack a field and some have one more: the reject table of its scan."""
    path, source = files.scratch(spark, "ragged-file"), tpch.behaviour_source(spark, sf)
    cells = [F.col(c).cast("string") for c in _RAGGED]
    line = F.when(F.col(ID) % 10 == 3, F.concat_ws(",", *cells[:3])).when(
        F.col(ID) % 10 == 7, F.concat_ws(",", *cells, (F.col(ID) % 7).cast("string"))).otherwise(F.concat_ws(",", *cells))
    # One text column under the header's name; a separator that no cell holds keeps the commas bare.
    source.select(line.alias(",".join(_RAGGED))).write.option("header", True).option("sep", "\u0001").csv(path)
    return csv_scan.scan(spark, path).rejects.drop("archivo")


def _tables(spark, sf) -> dict:
    return {"base": base(spark, sf), "clean": clean_base(spark, sf), "analytic": analytic(spark, sf), "kpis": kpis(spark, sf)}


@register("published_tables", O.with_chain("""
SELECT 'analytic' AS tabla, count(*) AS filas FROM analytic
UNION ALL SELECT 'base', count(*) FROM base_raw
UNION ALL SELECT 'clean', count(*) FROM clean
UNION ALL SELECT 'kpis', count(*) FROM kpis"""))
def q_published_tables(spark, sf):
    """Tables first, log entry last; rows read back through the latest version."""
    folder = files.scratch(spark, "published")
    PB.publish(spark, folder, _tables(spark, sf), {})
    manifest = PB.latest(spark, folder)
    parts = [PB.table(spark, manifest, name).agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("filas"))
             for name in sorted(manifest["tables"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("stage_bytes")
def q_stage_bytes(spark, sf):
    """Rows and bytes of every published table (the storage that takes the place of the report's memory figures)."""
    folder = files.scratch(spark, "stage-bytes")
    PB.publish(spark, folder, _tables(spark, sf), {})
    m = PB.latest(spark, folder)
    rows = [(name, PB.table(spark, m, name).count(), shared.size(spark, path)) for name, path in sorted(m["tables"].items())]
    return spark.createDataFrame(rows, "tabla string, filas long, bytes long")


@register("published_views", O.with_chain("""
SELECT a.nivel_engagement, a.valor_cliente, count(*) AS usuarios, max(k.usuarios) AS usuarios_kpi, sum(c.edad) AS edad_total,
       CAST(2 AS BIGINT) AS version
FROM analytic a JOIN clean c ON a.id_cliente = c.id_cliente JOIN kpis k
  ON a.nivel_engagement = k.nivel_engagement AND a.valor_cliente = k.valor_cliente GROUP BY ALL"""))
def q_published_views(spark, sf):
    """Two versions are published, the first without half of the customers; views over the latest one's tables answer a SQL question."""
    folder, tables = files.scratch(spark, "published-views"), _tables(spark, sf)
    half = {name: df.where(F.col(ID) % 2 == 0) for name, df in tables.items() if ID in df.columns}
    PB.publish(spark, folder, {**tables, **half}, {})
    PB.publish(spark, folder, tables, {})
    manifest = PB.latest(spark, folder)
    PB.views(spark, manifest, "orbita_")
    return spark.sql("""
SELECT a.nivel_engagement, a.valor_cliente, count(*) AS usuarios, max(k.usuarios) AS usuarios_kpi, sum(c.edad) AS edad_total
FROM orbita_analytic a JOIN orbita_clean c ON a.id_cliente = c.id_cliente JOIN orbita_kpis k
  ON a.nivel_engagement = k.nivel_engagement AND a.valor_cliente = k.valor_cliente
GROUP BY a.nivel_engagement, a.valor_cliente""").withColumn("version", F.lit(manifest["version"]).cast("long"))


@register("manifest", O.with_chain("""
SELECT (SELECT count(*) FROM base_raw) AS filas_base, (SELECT count(*) FROM clean) AS filas_clean,
       (SELECT count(*) FROM analytic) AS filas_analytic, (SELECT count(*) FROM kpis) AS filas_kpis,
       'deferred_until_all_stages_pass' AS estrategia, '_log' AS marcador, 'completed' AS estado"""))
def q_manifest(spark, sf):
    """Run manifest (deterministic part): a full gated run without models is published to the
    shared folder, and its log entry is read back."""
    from . import pipeline as P
    folder = files.scratch(spark, "run")
    P.run(spark, sf, folder, train_models=False)
    m = PB.latest(spark, folder)
    row = (*[m["rows"][n] for n in ("base", "clean", "analytic", "kpis")], m["publication"]["strategy"],
           m["publication"]["completion_marker"], m["status"])
    return spark.createDataFrame([row], "filas_base long, filas_clean long, filas_analytic long, filas_kpis long, estrategia string, "
                                        "marcador string, estado string")


def published_models(spark, sf) -> dict:
    """Manifest of a version that holds the models, the scaler and the centres."""
    from . import pipeline as P
    folder = files.scratch(spark, "published-models")
    tables, models, _, metrics = P.model_tables(spark, sf)
    PB.publish(spark, folder, tables, {"metrics": metrics}, models)
    return PB.latest(spark, folder)


@register("score_published")
def q_score_published(spark, sf):
    """The raw rows as requests, scored by models, scaler and centres loaded from the latest published version alone."""
    from . import registry_ml as RM
    m = published_models(spark, sf)
    centres = PB.table(spark, m, "kmeans_centres").orderBy("cluster").collect()  # k rows
    seg = {"stats": PB.table(spark, m, "kmeans_scaler").collect(),  # one row per feature
           "centres": SG.np.array([[r[c] for c in KMEANS_FEATURES] for r in centres]),
           "relabel": F.create_map(*[F.lit(v) for i, r in enumerate(centres) for v in (i, r["cluster"])])}
    req = SC.accepted(base(spark, sf), KMEANS_FEATURES)
    scored = RM.with_risk(PB.model(m, "classification"), RM.with_cluster(seg, RM.with_spend(PB.model(m, "regression"), req)))
    return scored.select(ID, "gasto_predicho", "cluster", "riesgo_predicho", "probabilidad_riesgo")


_CHECKED = [("base", "base_raw"), ("clean", "clean"), ("analytic", "analytic")]


def _cross_check_sql() -> str:
    parts = []
    for run, cond in (("bueno", "TRUE"), ("roto", "id_cliente % 10 <> 0")):
        for name, table in _CHECKED:
            kept = cond if name == "clean" else "TRUE"
            copies = f"{table} WHERE {kept}" + (f" UNION ALL SELECT id_cliente FROM {table} WHERE id_cliente % 50 = 1" if run == "roto" and name == "analytic" else "")
            parts.append(f"SELECT '{run}' AS corrida, '{name}' AS objeto, count(*) AS n, count(DISTINCT id_cliente) AS ids FROM (SELECT id_cliente FROM {copies})")
    n = O.with_ctes([f"n AS ({' UNION ALL '.join(parts)})", "b AS (SELECT corrida, n FROM n WHERE objeto = 'base')"], "")
    fixed = []
    for run in ("bueno", "roto"):
        cut = CLASSIFICATION_FEATURES[1:] if run == "roto" else CLASSIFICATION_FEATURES
        ok = int(run == "bueno")
        fixed.append(f"SELECT '{run}', 'variables', 'classification', '{','.join(cut)}', '{','.join(CLASSIFICATION_FEATURES)}', {ok}")
        fixed.append(f"SELECT '{run}', 'variables', 'regression', '{','.join(REGRESSION_FEATURES)}', '{','.join(REGRESSION_FEATURES)}', 1")
        value = "avg(gasto_mensual)" if run == "bueno" else "avg(CASE WHEN gasto_mensual > 0 THEN CAST('inf' AS DOUBLE) END)"
        fixed.append(f"SELECT '{run}', 'metrica_finita', 'gasto_promedio', CASE WHEN isfinite({value}) THEN 'finita' ELSE CAST({value} AS VARCHAR) END, "
                     f"'finita', CAST(isfinite({value}) AS INTEGER) FROM clean")
    return n + f"""
SELECT n.corrida, 'ids_unicos' AS control, objeto, CAST(ids AS VARCHAR) AS encontrado, CAST(n AS VARCHAR) AS esperado, CAST(ids = n AS INTEGER) AS correcto FROM n
UNION ALL SELECT n.corrida, 'filas_iguales', objeto, CAST(n.n AS VARCHAR), CAST(b.n AS VARCHAR), CAST(n.n = b.n AS INTEGER) FROM n JOIN b ON n.corrida = b.corrida
UNION ALL {' UNION ALL '.join(fixed)}"""


@register("cross_check", _cross_check_sql())
def q_cross_check(spark, sf):
    """All checks over two published runs read back: a good one, and one with lost rows, repeated ids, a model of
    other features and a metric that is not finite."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    tables = {n: df for n, df in _tables(spark, sf).items() if n != "kpis"}
    broken = {**tables, "clean": tables["clean"].where(F.col(ID) % 10 != 0),
              "analytic": tables["analytic"].unionByName(tables["analytic"].where(F.col(ID) % 50 == 1))}
    cut = {"regression": REGRESSION_FEATURES, "classification": CLASSIFICATION_FEATURES[1:]}
    contracted = {"regression": REGRESSION_FEATURES, "classification": CLASSIFICATION_FEATURES}
    out = None
    for run, used, columns in (("bueno", tables, contracted), ("roto", broken, cut)):
        # The check reads a model's inputs; their assemblers stand for models that take long to fit.
        fitted = {n: Pipeline(stages=[VectorAssembler(inputCols=c, outputCol="v")]).fit(used["base"].select(*c).limit(0).select(
            *[F.col(x).try_cast("double").alias(x) for x in c])) for n, c in columns.items()}
        folder = files.scratch(spark, f"checked-{run}")
        PB.publish(spark, folder, used, {}, fitted)
        m = PB.latest(spark, folder)
        spend = F.col("gasto_mensual") if run == "bueno" else F.when(F.col("gasto_mensual") > 0, F.lit(float("inf")))
        found = CC.cross_check(spark, {n: PB.table(spark, m, n) for n in m["tables"]}, [n for n, _ in _CHECKED],
                               {n: (CC.model_features(PB.model(m, n)), contracted[n]) for n in sorted(m["models"])},
                               {"gasto_promedio": tables["clean"].agg(F.avg(spend)).first()[0]})
        found = found.withColumn("corrida", F.lit(run))
        out = found if out is None else out.unionByName(found)
    return out


_INTS = [c for c in INTEGER_COLUMNS]


@register("records_json", O.with_chain(f"""
SELECT id_cliente, '{{' || concat_ws(',', {', '.join(f"'{chr(34)}{c}{chr(34)}:' || coalesce(CAST({c} AS VARCHAR), 'null')" for c in _INTS)},
  {', '.join(f"'{chr(34)}{c}{chr(34)}:' || coalesce('{chr(34)}' || {c} || '{chr(34)}', 'null')" for c in ('nivel_engagement', 'valor_cliente'))},
  '"gasto_centavos":' || CASE WHEN id_cliente % 5 = 0 THEN 'null' ELSE CAST(CAST(round_even(gasto_mensual * 100, 0) AS BIGINT) AS VARCHAR) END) || '}}' AS registro
FROM analytic"""))
def q_records_json(spark, sf):
    """Null-safe JSON records of the analytical table's integer and text columns, spend in cents (NaN -> null, nulls kept).

    Every fifth record's spend is turned into NaN first."""
    cents = F.when(F.col(ID) % 5 == 0, F.lit(float("nan"))).otherwise(F.col("gasto_mensual") * 100)
    table = analytic(spark, sf).select(*_INTS, "nivel_engagement", "valor_cliente", cents.alias("gasto_centavos"))
    return files.records_json(table, integral=["gasto_centavos"])



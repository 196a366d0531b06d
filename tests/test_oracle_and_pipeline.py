import json
import os
import tempfile

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF
from orbita.plans import pipeline as P
from orbita.sources import publication as PB

TABLES = "region nation customer supplier part orders lineitem events".split()
FAST = ["kpis_grid", "validate_sources", "validate_ids", "id_compat", "integrate", "impute_median", "cleaning_report",
        "analytic", "tier_cuts", "kpi_matrix", "folds", "roc_auc", "user_vs_segment", "score_input_split",
        "published_tables", "published_views", "cross_check", "csv_rejects", "elbow_k", "manifest", "column_medians"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "porcentaje_usuarios" in df.columns


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_pipeline_gates_and_deferred_publication(spark):
    out = tempfile.mkdtemp(prefix="orbita-pub-")
    res = P.run(spark, SF, out, train_models=False)
    m = PB.latest(spark, out)
    assert m == json.loads(json.dumps(res.manifest)) and m["version"] == 1
    assert m["status"] == "completed" and {m["rows"][n] for n in ("base", "clean", "analytic")} == {150} and m["rows"]["kpis"] < 150
    assert all(os.path.exists(p) for p in m["tables"].values())
    assert PB.table(spark, m, "analytic").count() == 150

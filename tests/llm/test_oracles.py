import duckdb
import pytest

from orbita.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLE[name]).df()
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns and len(got) > 0
    rows = lambda df: sorted(map(tuple, df[columns].astype(str).values.tolist()))
    assert rows(got) == rows(want)

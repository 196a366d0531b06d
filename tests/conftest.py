import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orbita.contracts import BASE_COLUMNS, BEHAVIOUR_SCHEMA, PROFILE_SCHEMA  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from orbita.session import get_session
    s = get_session("local[4]", app="orbita-tests", shuffle_partitions=4,
                    extra={"spark.driver.memory": "6g", "spark.sql.adaptive.enabled": "true"})
    yield s


def behaviour_rows(n=12):
    """A small behaviour table built in code (ids 1001..)."""
    rows = []
    for i in range(n):
        rows.append((1001 + i, float(15 + 4 * i), float(30 + 37 * i), 1 + 5 * i, i % 6, float(10 + 7 * i),
                     float(5 + 20 * i), 1 + i % 14, (i % 9) / 10.0, 1 + 8 * i))
    return rows


def profile_rows(n=12):
    return [(1001 + i, 18 + 4 * i, 1 + i % 5, ((i * 7) % 10 + 1) / 10.0, 1 + i % 5, i % 8, 1.4 + 6.5 * i)
            for i in range(n)]


@pytest.fixture(scope="session")
def behaviour(spark):
    return _typed(spark, behaviour_rows(), BEHAVIOUR_SCHEMA).cache()


@pytest.fixture(scope="session")
def profile(spark):
    return _typed(spark, profile_rows(), PROFILE_SCHEMA).cache()


def _typed(spark, rows, schema):
    conv = [float if f.dataType.typeName() == "double" else int for f in schema.fields]
    return spark.createDataFrame([tuple(c(x) for c, x in zip(conv, r)) for r in rows], schema)


__all__ = ["BASE_COLUMNS", "SF"]

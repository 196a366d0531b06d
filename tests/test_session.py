import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from orbita.session import ship_package


def test_threads_that_ask_at_once_ship_the_package_once():
    shipped = []

    def add(path):
        time.sleep(0.1)
        shipped.append(path)

    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app-of-this-test", addPyFile=add))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda _: ship_package(spark), range(8)))
        assert len(shipped) == 1  # and nobody went on before it was there

"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import getpass
import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

from .errors import SharedFolderMissing

# Conf applied when this package builds the session.  On a cluster the
# deployment's own settings win: getOrCreate() keeps an existing session.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture for error messages costs several driver round trips per
    # Column function; the contract-wide checks build thousands of expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "orbita", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode: the driver JVM is the only executor.
            builder = builder.config("spark.driver.memory", os.environ.get("ORBITA_DRIVER_MEMORY", "16g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (reliable) folder there and we only read it; one that
    names none is an error.  In local mode (tests), where all tasks share the machine, an unset
    folder becomes one per user, so that a later session finds what a killed one recorded.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise SharedFolderMissing("spark.checkpoint.dir must name a folder that driver and executors share")
        current = os.path.join(tempfile.gettempdir(), f"orbita-{getpass.getuser()}")
        os.makedirs(current, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application.

    Functions in ``mapInPandas`` and the like are found by module name, which a
    worker can only import where the package is installed or shipped.  Fits ask from many threads at once, and
    Spark refuses a second file of the same name: the others wait for the first.
    """
    with _SHIPPING:
        if spark.sparkContext.applicationId not in _SHIPPED:
            _ship(spark)


def _ship(spark: SparkSession) -> None:
    sc = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="orbita-package-"), "orbita.zip")  # on the driver; Spark serves it
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for name in sorted(f for f in files if f.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("orbita", os.path.relpath(full, package)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df):
    """Reliable checkpoint of ``df`` to the shared folder (cuts lineage).

    The frame is persisted while the checkpoint is written so the plan is not
    computed twice (once for the eager count, once for the write).
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()

"""Small files in a shared folder (Hadoop file system API): exclusive creation, listing, whole-file reads.

Everything goes through the session's Hadoop configuration, so the folder may be on any store that Spark reaches.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _path(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    at, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False if there is one already (exactly one of several writers succeeds)."""
    at, fs = _path(spark, path)
    try:
        if fs.getUri().getScheme() == "file":
            # Here Hadoop looks first and creates then; the system call does both at once.
            fs.mkdirs(at.getParent())
            nio, attributes = spark._jvm.java.nio.file, spark._jvm.java.nio.file.attribute.FileAttribute
            nio.Files.createFile(nio.Paths.get(at.toUri().getPath(), spark.sparkContext._gateway.new_array(spark._jvm.String, 0)),
                                 spark.sparkContext._gateway.new_array(attributes, 0))
            out = fs.create(at, True)
        else:
            out = fs.create(at, False)
    except Exception as e:
        if fs.exists(at):
            return False
        raise e
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that appears whole or not at all: written beside, then renamed.  An existing one stays."""
    from uuid import uuid4
    at, fs = _path(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{uuid4().hex}.part")
    create(spark, beside.toString(), text)
    if fs.exists(at) or not fs.rename(beside, at):
        fs.delete(beside, False)


def read(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    at, fs = _path(spark, path)
    size = int(fs.getFileStatus(at).getLen())
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode("utf-8") if size else ""
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file."""
    at, fs = _path(spark, path)
    stream = fs.open(at)
    try:
        jvm = spark._jvm
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    at, fs = _path(spark, path)
    return int(fs.getContentSummary(at).getLength())

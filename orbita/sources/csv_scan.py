"""CSV scan by column name, with a table of rejected lines.

A source may be several files, each with its own header.  Headers are read first (the first line of each
file, by a few driver threads); files of one header are read together and their columns taken by
name, so a file with columns in another order is read right.  Every cell stays text, so
that unparsable ones survive to be counted by validation.  Cells of ``NULL_TOKENS`` are null.

Lines with more or fewer fields than their header are not guessed at: they go to the reject table with
file, first field, line text and reason.
"""

from __future__ import annotations

import csv
import io
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SourceUnreadable
from . import shared

# Texts that the usual CSV readers of data frames take for a missing value.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
               "NULL", "NaN", "None", "n/a", "nan", "null"]

_LINE = "_orbita_line"
READERS = 16


@dataclass
class Scan:
    rows: DataFrame  # the columns of the source, as text
    rejects: DataFrame  # archivo, inicio (the line's first field), linea, motivo


def _files(spark: SparkSession, path: str) -> list[str]:
    """Data files of a path (a file, or a folder), without hidden and empty ones."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        raise SourceUnreadable(f"cannot read CSV source {path}: no such file")
    found = [(s.getPath().toString(), s.getPath().getName(), s.isFile(), s.getLen()) for s in fs.listStatus(at)]
    return sorted(p for p, name, is_file, size in found if is_file and size and name[0] not in "._")


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    line = shared.first_line(spark, path).lstrip("﻿").rstrip("\r")
    return tuple(name.strip() for name in next(csv.reader(io.StringIO(line)), []))


def scan(spark: SparkSession, path: str) -> Scan:
    """Rows and rejects of a CSV source.

    Missing, unreadable and empty sources, a name twice in one header, and files whose headers differ in more than
    their order raise :class:`SourceUnreadable`.  Columns are in the order of the first file.
    """
    paths = _files(spark, path)
    if not paths:
        raise SourceUnreadable(f"CSV source {path} has no data")
    with ThreadPoolExecutor(READERS) as pool:
        headers = list(pool.map(lambda p: _header(spark, p), paths))
    columns = list(headers[0])
    for file, header in zip(paths, headers):
        if len(set(header)) < len(header):
            raise SourceUnreadable(f"{file}: a column name stands twice in {list(header)}")
        if set(header) != set(columns):
            raise SourceUnreadable(f"{file}: columns {sorted(header)} differ from {sorted(columns)} of {paths[0]}")
    rows = rejects = None
    for header in sorted(set(headers)):
        part = _read(spark, [p for p, h in zip(paths, headers) if h == header], header)
        good = part.where(F.col(_LINE).isNull()).select(*[_null_safe(c).alias(c) for c in columns])
        bad = part.where(F.col(_LINE).isNotNull()).select(
            F.col("_file").alias("archivo"), F.col(f"`{header[0]}`").alias("inicio"), F.col(_LINE).alias("linea"),
            _reason(len(header)).alias("motivo"))
        rows = good if rows is None else rows.unionByName(good)
        rejects = bad if rejects is None else rejects.unionByName(bad)
    if rows.isEmpty():
        raise SourceUnreadable(f"CSV source {path} has no rows")
    return Scan(rows, rejects)


def _read(spark: SparkSession, paths: list[str], header: tuple[str, ...]) -> DataFrame:
    """Files of one header: Spark fills the line column where the number of fields is not the header's."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, _LINE)])
    try:
        # Without column pruning: a line's fields are only counted when all of them are parsed.
        rows = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnPruning", False)
                .option("columnNameOfCorruptRecord", _LINE).csv(paths).withColumn("_file", F.col("_metadata.file_name")))
        # Spark refuses to read the line column alone (a bare count would): this always true test needs a second one.
        return rows.where(F.length(F.concat_ws("", F.col(f"`{header[0]}`"))) >= 0)
    except Exception as e:
        raise SourceUnreadable(f"cannot read CSV source {paths[0]}: {e}") from e


def _null_safe(name: str) -> Column:
    return F.when(~F.col(f"`{name}`").isin(NULL_TOKENS), F.col(f"`{name}`"))


def _reason(fields: int) -> Column:
    """Why a line was rejected: with a mark as one more field at its end, does the mark fall within the header's?"""
    mark = "\u0002"
    names = [f"c{k}" for k in range(fields)]
    parsed = F.from_csv(F.concat(F.col(_LINE), F.lit("," + mark)), ", ".join(f"{n} string" for n in names))
    return F.when(F.array_contains(F.array(*[F.coalesce(parsed[n], F.lit("")) for n in names]), mark), "too_few_fields").otherwise(
        "too_many_fields")

"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. Rows are dealt by hash into cells (logical partitions, independent of tasks and retries).
2. The driver draws how many rows each cell sends to each shard: row sums are the cells'
   counts, column sums the shards' exact sizes (at most one apart).  The matrix has
   at most ``MAX_CELLS`` rows, whatever the input.
3. Inside a cell rows are ranked by a hash (the local permutation) and dealt by the counts.
4. Inside a shard rows are ranked by a second hash (the second permutation), bucket by
   bucket, so that no task holds a whole shard.

Only narrow rows are moved; DataFrame functions do all of it (the matrix alone is
drawn on the driver).

Defined cases: a null text has size 1 and the CRC of an empty text; null doc_ids
and repeated rows are rows like others (each gets its own slot); fewer rows than shards
leave shards empty; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, text_or_empty, written

SHARDS = 16
ROWS_PER_CELL = 1000
MAX_CELLS = 1 << 16


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` without replacement, by inversion over the support within 12
    standard deviations of the mean (all of it where it is short); populations of any size."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mean = draws * good / total
    spread = 12 * math.sqrt(mean * (bad / total) * (total - draws) / max(1, total - 1)) + 12
    low, high = max(low, math.floor(mean - spread)), min(high, math.ceil(mean + spread))
    k = np.arange(low, high, dtype=float)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(cells: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows from each cell to each shard: uniform among all matrices of these margins' draws."""
    rng = np.random.default_rng(seed)
    left = list(sizes)
    out = np.zeros((len(cells), len(sizes)), dtype=np.int64)
    for i, count in enumerate(cells):
        rest = sum(left)
        for s, room in enumerate(left):
            rest -= room
            out[i, s] = take = hypergeometric(rng, room, rest, count)
            count -= take
        left = [room - int(take) for room, take in zip(left, out[i])]
    return out


def shard_rows(rows: DataFrame, shards: int = SHARDS, seed: int = 20, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    spark = rows.sparkSession
    key, cell, second, bounds, rank, bucket, first, n = (
        fresh(rows, c) for c in ("_key", "_cell", "_second", "_bounds", "_rank", "_bucket", "_first", "_n"))
    # The row's position makes equal rows differ; the table fixes it before anything depends on it.
    given = [F.col(f"`{c}`") for c in rows.columns]
    keyed = written(rows.select(*given, F.xxhash64(F.lit(seed), *given, F.monotonically_increasing_id()).alias(key)),
                    "shard-rows")
    total = keyed.count()
    cells = min(MAX_CELLS, max(1, total // rows_per_cell))
    keyed = keyed.withColumn(cell, F.pmod(F.xxhash64(F.lit("cell"), key), F.lit(cells)).cast("int"))
    counts = [(r[0], r[1]) for r in sorted(keyed.groupBy(cell).count().collect())]  # at most MAX_CELLS rows
    matrix = communication_matrix([c for _, c in counts], [total // shards + (s < total % shards) for s in range(shards)],
                                  seed)
    ends = spark.createDataFrame([(c, row) for (c, _), row in zip(counts, np.cumsum(matrix, axis=1).tolist())],
                                 f"`{cell}` int, `{bounds}` array<long>")
    in_cell = W.partitionBy(cell).orderBy(F.xxhash64(F.lit("local"), key), key)
    buckets = min(MAX_CELLS // shards, max(1, total // (shards * rows_per_cell)))
    dealt = (keyed.join(ends, cell)
             .withColumn(rank, (F.row_number().over(in_cell) - 1).cast("long"))
             .withColumn("shard", F.size(F.filter(bounds, lambda b: b <= F.col(rank))).cast("int"))
             .withColumn(second, F.xxhash64(F.lit("second"), key)))
    # Buckets are ranges of the second key, so bucket order and order in it make one permutation of the shard.
    width = 2.0 ** 64 / buckets
    dealt = written(dealt.withColumn(bucket, F.least(F.lit(buckets - 1), F.floor(
        (F.col(second).cast("double") + 2.0 ** 63) / F.lit(width))).cast("int"))
        .select(*given, "shard", bucket, second, key), "shard-dealt")
    offsets = (dealt.groupBy("shard", bucket).agg(F.count("*").alias(n))  # at most MAX_CELLS rows
               .withColumn(first, F.coalesce(F.sum(n).over(
                   W.partitionBy("shard").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))))
    in_bucket = W.partitionBy("shard", bucket).orderBy(second, key)
    return (dealt.join(offsets, ["shard", bucket])
            .select(*given, "shard", (F.col(first) + F.row_number().over(in_bucket) - 1).alias("slot")))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes plus 1) and ``text_crc32`` of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
                       F.crc32(text_or_empty()).cast("long").alias("text_crc32"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 20) -> DataFrame:
    """One row per document under the law ``rows``."""
    return shard_rows(digests(docs), shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 20) -> None:
    """Write whole rows as ``shard=N`` folders: texts move once, to their shard's bucket of slots.

    Rows meet their slot by doc_id and digest; of several equal ones each takes one slot.
    """
    row = fresh(docs, "_row")
    keyed = written(docs.withColumn(row, F.monotonically_increasing_id()), "shard-input")
    placed = shard_rows(keyed.select(row), shards, seed)
    (keyed.join(placed, row).drop(row).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))

"""SimHash near-dedup by tiled exact comparison.

Fingerprints: 64-bit majority of the XXH64 hashes of all word shingles.  Distinct
fingerprints are laid out in tiles by the population counts of their segments (four of
16 bits, or eight of 8 bits for very many fingerprints); two fingerprints within
``radius`` bits have counts that differ by ``radius`` in sum at most, so only tile pairs
that near are compared (numpy exclusive-or and bit counts), all others are skipped.  A
tile holds ``TILE`` fingerprints; full cells are split into several tiles.  Each tile pair reports a
spanning forest of its links, never all pairs, and components are found over those.

Defined cases: a null text is empty; texts without words have fingerprint zero and
link like others; null doc_ids are kept, and a component's id is its smallest
non-null doc_id (null if it has none); repeated rows share a fingerprint; an empty
table gives no rows; other columns are kept, also where their names clash with ours.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, fresh, written
from .components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
TILE = 2048
#: Bytes of a text that are cut into words at once: bounds memory for very long texts.
STEP = 1 << 19
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_runs(raw: bytes, step: int):
    """Words of a text in lists of about ``step`` bytes."""
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + step)
        end = cut.start() if cut else len(raw)
        yield raw[at:end].split()  # bytes: ASCII white space only
        at = end


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text as an unsigned 64-bit number."""
    import xxhash
    join, digest = b" ".join, xxhash.xxh64_intdigest
    ones, n, last = np.zeros(64, dtype=np.int64), 0, []

    def add(hashes: list[int]) -> None:
        nonlocal n
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[:] += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)

    for run in _word_runs((text or "").encode("utf-8", "surrogatepass").lower(), STEP):  # bytes: A-Z only
        words = last + run
        if len(words) >= shingle:
            add([digest(join(t), SEED) for t in zip(*(words[k:] for k in range(shingle)))])
        last = words[len(words) - shingle + 1:] if len(words) >= shingle else words
    if not n and last:
        add([digest(join(last), SEED)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint (as a signed long) in column ``name``."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(name, simhash(F.col(text).cast("string")))


def _near_cells(radius: int, segments: int) -> list[tuple[int, ...]]:
    """Differences of segment counts that sum to ``radius`` at most, one of each opposite two."""
    near = [()]
    for _ in range(segments):
        near = [d + (x,) for d in near for x in range(-radius, radius + 1) if sum(map(abs, d)) + abs(x) <= radius]
    return [d for d in near if d > (0,) * segments]


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[list[int], list[int]]:
    """Links between two tiles (or inside one) that connect what all their links connect."""
    nodes = a if b is None else np.concatenate([a, b])
    other = nodes if b is None else b
    shift = 0 if b is None else len(a)
    label = np.arange(len(nodes))
    left, right = [], []
    rows = max(1, (1 << 20) // max(1, len(other)))
    for at in range(0, len(a), rows):
        near = np.bitwise_count(a[at:at + rows, None] ^ other[None, :]) <= radius
        if b is None:  # each pair once
            near &= np.arange(len(other))[None, :] > np.arange(at, at + len(near))[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            at_i = at + int(i)
            js = np.flatnonzero(near[i]) + shift
            labels, where = np.unique(label[js], return_index=True)
            new = labels != label[at_i]
            if not new.any():
                continue
            left += [int(nodes[at_i])] * int(new.sum())
            right += nodes[js[where[new]]].tolist()
            merged = np.append(labels, label[at_i])
            label[np.isin(label, merged)] = merged.min()
    return left, right


def segments_for(distinct: int) -> int:
    """Segments whose bit counts name a cell: more of them cut the compared pairs (about 1 in 70 with 4, 1 in 4,000
    with 8), for more copies of each tile (21 and 73).  Links are the same."""
    return 4 if distinct < 1 << 24 else 8


def links(fingerprints: DataFrame, name: str, radius: int = RADIUS, tile: int = TILE, segments: int = 4) -> DataFrame:
    """``a, b``: links among distinct fingerprints (column ``name``) that give all components."""
    width = 64 // segments
    counts = [F.bit_count(F.shiftrightunsigned(name, width * q).bitwiseAND((1 << width) - 1 if width < 64 else -1)) for q in range(segments)]
    cell = sum((c.cast("long") * 128 ** q for q, c in enumerate(counts)), F.lit(0).cast("long"))
    distinct = fingerprints.select(F.col(name).alias("fp"), cell.alias("cell"))
    sizes = distinct.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    if segments <= 4:  # 17^4 cells at most
        sizes = F.broadcast(sizes)
    tiles = written(distinct.join(sizes, "cell")
                    .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
                    .groupBy("cell", "tile").agg(F.collect_list("fp").alias("fps")), "tiles")
    # Sums reach from -radius to width + radius; seven bits a segment leave room, and cells out of range match nothing.
    steps = [sum(d * 128 ** q for q, d in enumerate(n)) for n in _near_cells(radius, segments)]
    across = (tiles.select("fps", "cell", "tile", F.explode(F.array([F.lit(s).cast("long") for s in steps])).alias("step"))
              .select("fps", F.col("tile").alias("ta"), (F.col("cell") + F.col("step")).alias("to"), F.col("cell").alias("from"))
              .join(tiles.select(F.col("fps").alias("other"), F.col("tile").alias("tb"), F.col("cell").alias("to")), "to"))
    inside = (tiles.select("fps", F.col("tile").alias("ta"), F.col("cell").alias("to"), F.col("cell").alias("from"))
              .join(tiles.select(F.col("fps").alias("other"), F.col("tile").alias("tb"), F.col("cell").alias("to")), "to")
              .where(F.col("ta") <= F.col("tb")))
    pairs = across.unionByName(inside).select("from", "ta", "to", "tb", "fps", "other").repartition("from", "ta", "to", "tb")

    def compare(batches):
        for batch in batches:
            left, right = [], []
            same = [f == t and x == y for f, t, x, y in zip(*(batch.column(k).to_pylist() for k in (0, 2, 1, 3)))]
            fps, other = batch.column(4), batch.column(5)
            for k, inner in enumerate(same):
                a = fps[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                b = None if inner else other[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                x, y = forest(a, b, radius)
                left += x
                right += y
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in (left, right)],
                                             names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def grouped(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, root, first`` of every distinct fingerprint of ``rows(fp, doc_id, row)``.

    ``root`` names the component; ``first`` is the least (no id, doc_id, row) of the fingerprint.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    found = written(rows.groupBy("fp").agg(first), "fingerprints")
    roots = components(links(found, "fp", radius, segments=segments_for(found.count())), "a", "b").withColumnRenamed("node", "fp")
    return found.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    name = fresh(docs, "_fp")
    rows = written(with_fingerprint(docs.select("doc_id", "text"), name, shingle).select(
        F.col(name).alias("fp"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).alias("row")), "simhash")
    groups = written(grouped(rows, radius), "groups")
    ids = groups.groupBy("root").agg(F.min("first").alias("least")).select("root", F.col("least.doc_id").alias("component_id"))
    component = groups.join(ids, "root").select("fp", "component_id")
    return rows.join(component, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (rows without one
    come last), of several texts with that id the one of the least hash, of equal rows one.

    Texts move once, to be matched with the hashes of the rows that stay; equal rows are
    merged before they move.
    """
    fp, row, key = (fresh(docs, c) for c in ("_fp", "_row", "_key"))
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text")).withColumn(
        key, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    rows = written(with_fingerprint(keyed.select("doc_id", "text", row), fp, shingle).select(
        F.col(fp).alias("fp"), F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row")), "simhash")
    stay = grouped(rows, radius).groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.row").alias(row), F.coalesce("first.doc_id", F.lit(-(1 << 63))).alias(key))
    return keyed.dropDuplicates([row, key]).join(stay, [row, key], "left_semi").drop(row, key)

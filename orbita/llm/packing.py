"""Sum-of-squares online packing of token ids into windows of fixed length.

Each document (its ids and an end id) is cut into whole windows and a rest.  The
rest goes to the fill level that keeps the sum over levels of squared counts of
partly filled windows smallest; counts live in one level array.  Where a
partition's documents end, its open windows are merged (the emptiest ones are
cut into the gaps of the fullest), so that at most one window of a partition
has padding.  A partition of the input packs alone: no shuffle, and memory is one
Arrow batch plus the open windows.

Defined cases: a null text is empty and has only the end id; null doc_ids and
repeated rows are packed like others; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, text_or_empty, written
from .token_store import END_ID, encoder_for

WINDOW = 1024


class SumOfSquares:
    """Level array and open windows of one partition.

    ``add`` places one piece ``(key, start, ids)`` and returns a window that it
    filled, or None; ``close`` returns what is left.  A window is a list of pieces.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)  # open windows at each fill level
        self.open: dict[int, list[list]] = {}

    def level(self, size: int) -> int:
        """The fill level (0: a new window) whose choice makes the sum of squares least; ties: the fullest."""
        n, c = self.counts, self.capacity
        top = c - size
        # Twice these numbers is the change of the sum of squares, less a constant of 2.
        change = (n[size:c + 1] - n[:top + 1]).astype(float)
        change[n[:top + 1] == 0] = np.inf
        change[0] = n[size] - 0.5
        if size == c:
            change[0] = -1.0
        elif change[top] != np.inf and top > 0:
            change[top] = -n[top] - 0.5  # completes the window: no new level to count
        return top - int(np.argmin(change[::-1]))

    def add(self, piece: tuple) -> list | None:
        size = len(piece[2])
        level = self.level(size)
        window = []
        if level:
            self.counts[level] -= 1
            window = self.open[level].pop()
        window.append(piece)
        if level + size == self.capacity:
            return window
        self.counts[level + size] += 1
        self.open.setdefault(level + size, []).append(window)
        return None

    def close(self) -> list[list]:
        """Merge the open windows: pieces of the emptiest fill the gaps of the fullest, cut where needed."""
        left = [[level, w] for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.open, self.counts[:] = {}, 0
        i, j = 0, len(left) - 1
        while i < j:
            gap = self.capacity - left[i][0]
            if not gap:
                i += 1
                continue
            key, start, ids = left[j][1].pop()
            moved = min(gap, len(ids))
            if moved < len(ids):  # the head stays, the tail moves
                left[j][1].append((key, start, ids[:-moved]))
                start, ids = start + len(ids) - moved, ids[-moved:]
            left[i][1].append((key, start, ids))
            left[i][0] += moved
            left[j][0] -= moved
            if not left[j][0]:
                j -= 1
        return [w for fill, w in left if fill]


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of every document: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``sequence_id`` numbers windows gaplessly: those of a partition in order, and
    before them all of earlier partitions (one count per partition on the driver).
    """
    spark = docs.sparkSession
    bound_batches(spark)

    def pieces(batches):
        from pyspark import TaskContext
        enc, part, packer, n = encoder_for(tokenizer_path), TaskContext.get().partitionId(), SumOfSquares(window), 0

        def rows(windows):
            nonlocal n
            out = []
            for w in windows:
                offset = 0
                for (doc_id, total), start, ids in w:
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, n, offset, part))
                    offset += len(ids)
                n += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)

        for batch in batches:
            full = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                key, whole = (doc_id, len(ids)), len(ids) - len(ids) % window
                full += [[(key, at, ids[at:at + window])] for at in range(0, whole, window)]
                if whole < len(ids):
                    # a copy: the window must not keep the whole document alive
                    done = packer.add((key, whole, ids[whole:].copy()))
                    if done:
                        full.append(done)
            if full:
                yield rows(full)
        last = packer.close()
        if last:
            yield rows(last)

    placed = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
                     .mapInArrow(pieces, _SCHEMA), "pack")
    counts = {r.part: r.n for r in placed.groupBy("part").agg((F.max("local") + 1).alias("n")).collect()}
    bases, before = [], 0
    for part in sorted(counts):
        bases.append((part, before))
        before += counts[part]
    base = spark.createDataFrame(bases, "part int, base long")
    return (placed.join(F.broadcast(base), "part")  # one row per input partition
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("base") + F.col("local")).alias("sequence_id"), "offset"))


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "local", "offset", "part"]
_TYPES = [pa.int64()] * 7 + [pa.int32()]
_SCHEMA = ", ".join(f"{n} long" for n in _NAMES[:-1]) + ", part int"

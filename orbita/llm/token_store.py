"""Token-id store: a shared zstandard dictionary, one compressed frame per document.

Layout under ``path`` (written and read by Spark only, so any file system works):

* ``dictionary/`` -- one row: ``dict_hash`` (SHA-256 of the dictionary), ``content``, ``id_bytes``.
* ``segments/``   -- rows of about ``SEGMENT_BYTES``: ``part`` and ``seg`` (ascending
  doc_id order), ``dict_hash``, ``first_id``/``last_id`` (Parquet statistics prune on
  them), ``start`` (ids before the segment in its part), ``n_tokens``, and the offset
  index ``doc_ids``, ``ends`` (where each frame ends in ``payload``), ``lengths`` (ids
  of each document) beside the ``payload`` of concatenated frames.

Each frame is decompressed alone, so a short document costs one slice.

Defined cases: a null text is empty (only the end id); null doc_ids sort first and
stay null; repeated rows are each stored; an empty table gives an empty store; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .common import bound_batches, text_or_empty

#: The dictionary, which only affects compression, is trained on so many whole documents of at most so many characters: those of
#: least hash in the whole table, whatever their file or source.  It serves short documents; long ones compress by themselves.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 1000, 8000
DICTIONARY_BYTES = 64 * 1024
SEGMENT_BYTES = 1 << 20
SEGMENT_DOCUMENTS = 4096
LEVEL = 3
END_ID = 0

_SEGMENTS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("seg", T.IntegerType()),
    T.StructField("dict_hash", T.StringType()), T.StructField("first_id", T.LongType()),
    T.StructField("last_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("payload", T.BinaryType()),
])
_DICTIONARY = "dict_hash string, content binary, id_bytes int"


def _codec(content: bytes):
    import zstandard as zstd
    return zstd.ZstdCompressionDict(content) if content else None


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from serialized id arrays; too few of them serve as raw content."""
    import zstandard as zstd
    samples = [s for s in samples if s]
    try:
        return zstd.train_dictionary(size, samples).as_bytes() if samples else b""
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


def dictionary_rows(docs: DataFrame, rows: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS) -> list[str]:
    """The training texts: at most ``rows`` of at most ``chars`` characters."""
    text = text_or_empty()
    marked = (docs.select(F.xxhash64(F.col("doc_id").cast("string"), text).alias("h"), text.alias("t"))
              .where((F.col("t") != "") & (F.char_length("t") <= chars)))
    # Only hashes compete for the least ones; texts are read once these are known.
    least = [r.h for r in marked.select("h").orderBy("h").limit(rows).collect()]
    found = marked.where(F.col("h") <= least[-1]).limit(rows).collect() if least else []
    return [t for _, t in sorted((r.h, r.t) for r in found)]


def _train(docs: DataFrame, encoder: bpe.Encoder, dtype: str) -> bytes:
    return train_dictionary([i.astype(dtype).tobytes() for i in encoder.encode_all(dictionary_rows(docs))])


_ENCODERS: dict[str, bpe.Encoder] = {}


def encoder_for(path: str) -> bpe.Encoder:
    """One encoder and its word cache per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = bpe.Encoder(path)
    return _ENCODERS[path]


def write_store(docs: DataFrame, path: str, tokenizer_path: str, partitions: int) -> None:
    """Encode ``docs(doc_id, text)`` and write the store in ascending doc_id order.

    The range exchange is keyed by doc_id and the row's position, so that a
    repeated id does not land in one task.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    encoder = encoder_for(tokenizer_path)
    dtype = "<u2" if encoder.size <= 1 << 16 else "<u4"
    content = _train(docs, encoder, dtype)
    dict_hash = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(content), int(dtype[-1]))], _DICTIONARY).coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/dictionary")

    def segments(batches):
        import zstandard as zstd
        enc, dictionary = encoder_for(tokenizer_path), _codec(content)
        if dictionary:
            dictionary.precompute_compress(level=LEVEL)
        press = zstd.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        end = np.array([END_ID], dtype)
        part, seg, start = 0, 0, 0
        ids, ends, lengths, frames, size = [], [], [], [], 0

        def flush():
            nonlocal seg, start, ids, ends, lengths, frames, size
            total = sum(lengths)
            row = pa.RecordBatch.from_pylist([{
                "part": part, "seg": seg, "dict_hash": dict_hash, "first_id": ids[0], "last_id": ids[-1],
                "start": start, "n_tokens": total, "doc_ids": ids, "ends": ends, "lengths": lengths,
                "payload": b"".join(frames)}], schema=_ARROW)
            seg, start = seg + 1, start + total
            ids, ends, lengths, frames, size = [], [], [], [], 0
            return row

        for batch in batches:
            if batch.num_rows:
                part = batch.column(2)[0].as_py()
            for doc_id, ids_of in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1).to_pylist())):
                values = np.concatenate([ids_of.astype(dtype), end])
                frame = press.compress(values.tobytes())
                size += len(frame)
                ids.append(doc_id)
                ends.append(size)
                lengths.append(len(values))
                frames.append(frame)
                if size >= SEGMENT_BYTES or len(ids) >= SEGMENT_DOCUMENTS:
                    yield flush()
        if ids:
            yield flush()

    tie = F.monotonically_increasing_id().alias("_tie")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), tie)
     .repartitionByRange(partitions, F.col("doc_id").asc_nulls_first(), "_tie")
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie")
     .select("doc_id", "text", F.spark_partition_id().alias("part"))
     .mapInArrow(segments, _SEGMENTS).write.mode("overwrite").option("compression", "none")
     .parquet(f"{path}/segments"))


_ARROW = pa.schema([
    ("part", pa.int32()), ("seg", pa.int32()), ("dict_hash", pa.string()), ("first_id", pa.int64()),
    ("last_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("ends", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])


class _Frames:
    """Documents of a segment, each from its own frame; the segment must name our dictionary."""

    def __init__(self, dict_hash: str, content: bytes, id_bytes: int):
        import zstandard as zstd
        self.hash, self.dtype = dict_hash, f"<u{id_bytes}"
        self._open = zstd.ZstdDecompressor(dict_data=_codec(content))

    def ids(self, segment: dict, k: int) -> np.ndarray:
        if segment["dict_hash"] != self.hash:
            raise ValueError(f"segment was written with dictionary {segment['dict_hash']}, not {self.hash}")
        at = segment["ends"][k - 1] if k else 0
        raw = self._open.decompress(segment["payload"][at:segment["ends"][k]])
        return np.frombuffer(raw, self.dtype).astype("<u4")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, int]:
    row = spark.read.schema(_DICTIONARY).parquet(f"{path}/dictionary").first()
    if hashlib.sha256(bytes(row.content)).hexdigest() != row.dict_hash:
        raise ValueError("the dictionary does not match its hash")
    return row.dict_hash, bytes(row.content), row.id_bytes


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")


def read_store(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every stored document: ``doc_id, start, n_tokens, ids_crc32`` and, if asked, its ``ids``.

    ``start`` counts all ids before the document: a segment knows those of its
    part, and the totals of the parts (one row per part) are added up here.
    """
    bound_batches(spark, 16)  # a row is a segment here
    key = _dictionary(spark, path)
    totals = {r.part: r.n for r in _segments(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    bases, before = {}, 0
    for part in sorted(totals):
        bases[part], before = before, before + totals[part]

    def documents(batches):
        frames = _Frames(*key)
        for batch in batches:
            for s in batch.to_pylist():
                at = bases[s["part"]] + s["start"]
                rows = {"doc_id": s["doc_ids"], "start": [], "n_tokens": s["lengths"], "ids_crc32": []}
                if with_ids:
                    rows["ids"] = []
                for k, n in enumerate(s["lengths"]):
                    values = frames.ids(s, k)
                    if len(values) != n:
                        raise ValueError("the offset index does not match a frame")
                    rows["start"].append(at)
                    rows["ids_crc32"].append(zlib.crc32(values.tobytes()))
                    if with_ids:
                        rows["ids"].append(values.astype("int64"))
                    at += n
                yield pa.RecordBatch.from_pydict(rows)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return _segments(spark, path).mapInArrow(documents, schema)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this id: Parquet statistics pick the segments, the index the frame."""
    frames = _Frames(*_dictionary(spark, path))
    hits = _segments(spark, path).where((F.coalesce("first_id", F.lit(doc_id)) <= doc_id) & (F.col("last_id") >= doc_id))
    hits = hits.where(F.array_contains("doc_ids", doc_id))
    return [frames.ids(s, k).tolist() for s in (r.asDict() for r in hits.toLocalIterator())
            for k, d in enumerate(s["doc_ids"]) if d == doc_id]

"""Token ids in fixed-width bit-packed files.

A file set is a folder of Parquet files; each row is one segment, a run of whole documents in
ascending ``doc_id`` order. Its payload holds the ids of all its documents, ``width`` bits each:
64 ids make ``width`` little-endian 64-bit words, lowest bits first, so a block of ids starts at a
whole word. ``block_offsets`` gives each block's place in the payload, and an id's place follows
from its number alone, so any document is unpacked from the blocks that hold it.

Columns of a segment: ``shard`` and ``segment`` (ascending in document order), ``shard_start`` (ids
before it in its shard), ``n_ids``, ``width``, ``doc_ids``, ``doc_lengths``, ``block_offsets``,
``payload``.

Null or empty texts hold the end id only. Null ``doc_id``s come first; rows that repeat are kept,
in the order of their texts. An empty table makes an empty file set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .cached_encoder import encoder
from .common import filled, slices

# Ids of a block, and ids after which a segment ends with the document it is in.
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 20

SEGMENT_SCHEMA = (
    "shard int, segment long, shard_start long, n_ids long, width int, doc_ids array<long>, "
    "doc_lengths array<long>, block_offsets array<long>, payload binary"
)
_ARROW = pa.schema([
    ("shard", pa.int32()), ("segment", pa.int64()), ("shard_start", pa.int64()),
    ("n_ids", pa.int64()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_lengths", pa.list_(pa.int64())), ("block_offsets", pa.list_(pa.int64())),
    ("payload", pa.binary()),
])


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids below ``2 ** width`` in ``width`` bits each, filled up to a multiple of 64 ids."""
    rows = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    rows.ravel()[:len(ids)] = ids
    words = np.zeros((len(rows), width), "<u8")
    for place in range(64):
        word, shift = divmod(place * width, 64)
        words[:, word] |= rows[:, place] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= rows[:, place] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(payload: bytes, width: int, count: int, first: int = 0) -> np.ndarray:
    """``count`` ids from number ``first`` on, reading only the words they lie in."""
    head = first // 64
    rows = -(-(first + count) // 64) - head
    words = np.frombuffer(payload, "<u8", rows * width, head * width * 8).reshape(rows, width)
    ids = np.empty((rows, 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for place in range(64):
        word, shift = divmod(place * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        ids[:, place] = value & mask
    return ids.ravel()[first - head * 64:first - head * 64 + count]


class _Segments:
    """Collects documents and hands out full segments."""

    def __init__(self, width: int):
        self.width, self.shard = width, TaskContext.get().partitionId()
        self.number = self.start = 0
        self._clear()

    def _clear(self) -> None:
        self.doc_ids, self.lengths, self.ids, self.held = [], [], [], 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.ids.append(ids)
        self.held += len(ids)

    def close(self) -> pa.RecordBatch:
        blocks = -(-self.held // BLOCK_IDS)
        row = {
            "shard": self.shard, "segment": self.number, "shard_start": self.start,
            "n_ids": self.held, "width": self.width, "doc_ids": self.doc_ids,
            "doc_lengths": self.lengths,
            "block_offsets": [b * BLOCK_IDS * self.width // 8 for b in range(blocks)],
            "payload": pack(np.concatenate(self.ids), self.width),
        }
        self.number += 1
        self.start += self.held
        self._clear()
        return pa.RecordBatch.from_pylist([row], schema=_ARROW)


def encode_segments(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Segments of all documents, ordered by ``doc_id`` within and across shards."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = encoder(tokenizer)
        out = _Segments(max(source.vocabulary - 1, end_id, 1).bit_length())
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch):
                ids, offsets = source.encode(filled(part.column("text")))
                for row, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    out.add(doc_id, np.concatenate([ids[offsets[row]:offsets[row + 1]], end]))
                    if out.held >= SEGMENT_IDS:
                        yield out.close()
        if out.doc_ids:
            yield out.close()

    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Repeated ids are told apart by a hash of the text, so that even a common id is divided.
    ordered = ordered.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text")
    return ordered.mapInArrow(encode, SEGMENT_SCHEMA)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    encode_segments(docs, tokenizer, end_id).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)


def with_start(segments: DataFrame) -> DataFrame:
    """Segments with ``start``, the ids of all segments before them.

    A shard has its own running count, so only shard totals, one row a shard, are added up.
    """
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shards_before"))
    return segments.join(totals, "shard").withColumn(
        "start", F.col("shards_before") + F.col("shard_start"))


def documents(segments: DataFrame) -> DataFrame:
    """One row per document with its ids, unpacked; also ``start``."""
    schema = "doc_id long, start long, ids array<int>"
    return _per_document(segments, schema, lambda ids: ids.astype(np.int32).tolist(), "ids", pa.list_(pa.int32()))


def digests(segments: DataFrame) -> DataFrame:
    """One row per document: ``start``, ``n_tokens`` and the crc32 of its ids as 32-bit integers."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return _per_document(
        segments, schema, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "ids_crc32", pa.int64())


def _per_document(segments: DataFrame, schema: str, value, name: str, kind: pa.DataType) -> DataFrame:
    with_count = "n_tokens" in schema

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["width"], row["n_ids"])
                lengths = np.asarray(row["doc_lengths"], np.int64)
                ends = np.cumsum(lengths)
                columns = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(row["start"] + ends - lengths, pa.int64()),
                }
                if with_count:
                    columns["n_tokens"] = pa.array(lengths, pa.int64())
                columns[name] = pa.array(
                    [value(ids[e - n:e]) for e, n in zip(ends, lengths)], kind)
                yield pa.RecordBatch.from_pydict(columns)

    needed = with_start(segments).select(
        "start", "n_ids", "width", "doc_ids", "doc_lengths", "payload")
    return needed.mapInArrow(expand, schema)


def tokens_of(segments: DataFrame, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (once per row that had the id), from the blocks that hold them."""
    found = []
    hits = segments.where(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))
    for row in hits.toLocalIterator():
        start = 0
        for other, length in zip(row.doc_ids, row.doc_lengths):
            if other == doc_id:
                block = start // BLOCK_IDS
                payload = memoryview(row.payload)[row.block_offsets[block]:]
                found.append(unpack(payload, row.width, length, start - block * BLOCK_IDS))
            start += length
    return found

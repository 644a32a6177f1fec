"""Helpers the operators share: staged tables, text batches, hashes of byte spans."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_dir

# A worker handles at most this many bytes of text at once; one longer text is a batch of its own.
SLICE_BYTES = 8 << 20
# The same where numbers are kept for each byte.
HASHED_BYTES = 2 << 20


# Folders that are removed when the work that needs them is done; one list for each scratch().
_SCRATCH: list[list[str]] = []


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it again.

    The lineage is cut there: a lost executor costs the tasks it ran, not what came before.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside at the end, whether it went well or not.

    The result of the work must have been written by then; a frame over a staged table is not.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for folder in _SCRATCH.pop():
            discard(spark, folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder, wherever the cluster keeps it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keep_rows(docs: DataFrame, fate: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``fate`` turns away, with all their columns.

    ``fate`` has one row at most for an id and text (``_id``, ``_sha``): ``once`` false drops its rows,
    true keeps one of them, whichever. Whole rows move once, for one join that is planned alike at
    every size; only rows that repeat in id and text are added up in a second one, if there are any.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
        F.sha2(text, 256).alias("_sha"))
    match = F.col("r._id").eqNullSafe(F.col("f._id")) & (F.col("r._sha") == F.col("f._sha"))
    fate = staged(fate.select("_id", "_sha", "once"), "fate")
    kept = rows.alias("r").join(fate.hint("merge").alias("f"), match, "left_anti").select("_row.*")
    once = fate.where("once")
    if not once.take(1):
        return kept
    several = rows.alias("r").join(once.hint("merge").alias("f"), match, "left_semi")
    firsts = several.groupBy("_id", "_sha").agg(F.first("_row").alias("_row"))
    return kept.unionByName(firsts.select("_row.*"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def filled(texts: pa.Array) -> pa.Array:
    """Texts as one array of large strings, null as empty."""
    return pc.fill_null(texts.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold at most ``limit`` bytes, or one longer text."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(first, last - first)
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts and the last one ends."""
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if buffers[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the spans [start, start + length), one span after the other."""
    ends = np.cumsum(lengths)
    if len(ends) == 0 or ends[-1] == 0:
        return np.zeros(0, np.int64)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])


def mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_POWERS = {}


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), equal for equal bytes wherever they lie.

    Bytes are weighted by the powers of an odd number counted from the start of their span.
    """
    lengths = ends - starts
    longest = int(lengths.max(initial=0))
    size = 1 << max(6, longest.bit_length())
    if size not in _POWERS:
        with np.errstate(over="ignore"):
            _POWERS[size] = np.cumprod(np.full(size, 0x9E3779B97F4A7C15, np.uint64))
    out = np.zeros(len(starts), np.uint64)
    used = np.flatnonzero(lengths)
    if len(used):
        kept = lengths[used]
        at = gather(starts[used], kept)
        place = gather(np.zeros(len(used), np.int64), kept)
        with np.errstate(over="ignore"):
            terms = (data[at].astype(np.uint64) + np.uint64(1)) * _POWERS[size][place]
            sums = np.add.reduceat(terms, np.cumsum(kept) - kept)
            out[used] = mix(sums + kept.astype(np.uint64))
    return out

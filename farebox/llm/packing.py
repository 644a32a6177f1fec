"""Documents packed into sequences of bounded length by best fit decreasing.

A document longer than a sequence is cut into full pieces; what is left over is its first piece.
Full pieces are sequences by themselves. The others are placed one after the other, long ones first.

The method this departs from is the sum-of-squares rule: a piece goes where the sum of squares of
N(g), the number of open sequences with g free places, becomes smallest. That keeps gaps of all
sizes in supply for pieces to come, which pays when they come in any order; here all are known. The
rule decides only while the pieces to come could fill the gaps twice. From then on a piece goes to
the tightest gap by the same table of counts, which needs fewer sequences. Where many pieces are
longer than half a sequence, as in the test tables, none fits a gap before that, and all pieces that
go into a gap go there by best fit.

Null or empty texts are one piece that holds the end id. Rows that repeat are packed as rows of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .cached_encoder import encoder
from .common import filled, slices, staged

# Pieces placed by one task. Groups differ in size by chance only: they are drawn by a hash.
GROUP_PIECES = 40_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
    ("length", pa.int64()), ("ids_crc32", pa.int64()),
])


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first may be shorter than a sequence."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return [(s, first if s == 0 else capacity) for s in starts]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Every document's pieces with the crc32 of their ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, end = encoder(tokenizer), np.array([end_id], "<u4")
        for batch in batches:
            for part in slices(batch):
                ids, offsets = source.encode(filled(part.column("text")))
                rows = []
                for row, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    own = np.concatenate([ids[offsets[row]:offsets[row + 1]].astype("<u4"), end])
                    rows += [
                        (doc_id, number, start, length, zlib.crc32(own[start:start + length].tobytes()))
                        for number, (start, length) in enumerate(cut(len(own), capacity))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    needed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return needed.mapInArrow(encode, PIECE_SCHEMA)


def sum_of_squares(
    lengths: np.ndarray, capacity: int, tight: bool = True, decreasing: bool = True,
) -> tuple[np.ndarray, np.ndarray]:
    """A sequence and an offset for each piece; lengths are from 1 to ``capacity``.

    Without ``tight`` the sum-of-squares rule places every piece, without ``decreasing`` pieces are
    placed in the order given. Both are for comparison: they need more sequences. Placing a piece of length s in a gap g changes the sum of squares by
    2 (N(g - s) - N(g) + 1), by 1 - 2 N(s) if it fills the gap, and by 2 N(capacity - s) + 1 if it
    opens a sequence.
    """
    order = np.argsort(-lengths, kind="stable") if decreasing else np.arange(len(lengths))
    counts = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    remaining = np.cumsum(lengths[order][::-1])[::-1]
    free = opened = 0
    for number, at in enumerate(order):
        size = int(lengths[at])
        gaps = counts[size:capacity]
        change = 2 * (counts[:capacity - size] - gaps + 1)
        if size < capacity:
            change[0] = 1 - 2 * gaps[0]
        change = np.where(gaps > 0, change, np.iinfo(np.int64).max)
        best = int(np.argmin(change)) if size < capacity else 0
        usable = size < capacity and gaps[best] > 0
        # Gaps are kept in supply only while what is to come could fill them twice.
        spare = not tight or remaining[number] >= 2 * free
        if usable and (change[best] <= 2 * counts[capacity - size] + 1 or not spare):
            gap = size + (best if spare else int(np.flatnonzero(gaps)[0]))
            target = open_at[gap].pop()
            counts[gap] -= 1
        else:
            gap, target, opened = capacity, opened, opened + 1
            free += capacity
        sequence[at], offset[at] = target, capacity - gap
        free -= size
        left = gap - size
        if left:
            open_at[left].append(target)
            counts[left] += 1
    return sequence, offset


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.

    Texts are encoded where they are read; only the short rows of pieces move, to groups of a
    bounded number of pieces that are packed independently.
    """
    all_pieces = staged(pieces(docs, tokenizer, end_id, capacity), "pieces")
    full = F.col("length") == capacity
    whole = all_pieces.where(full).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    groups = max(1, math.ceil(all_pieces.where(~full).count() / GROUP_PIECES))

    def place(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        sequence, offset = sum_of_squares(table["length"].to_numpy(), capacity)
        ids = (key[0].as_py() << 40) + sequence
        return table.drop_columns(["group"]).append_column(
            "sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    drawn = F.pmod(F.xxhash64("doc_id", "length", "ids_crc32"), F.lit(groups))
    # Rows that repeat have one hash; the random part keeps many of them from one group.
    spread = F.pmod(drawn + F.monotonically_increasing_id() % groups, F.lit(groups))
    packed = all_pieces.where(~full).withColumn("group", spread).groupBy("group").applyInArrow(
        place, f"{PIECE_SCHEMA}, sequence_id long, offset long")
    return whole.unionByName(packed)

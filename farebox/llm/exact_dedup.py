"""Exact duplicates by counting quotient filters and byte comparison.

A 64-bit fingerprint of each text is split into a quotient (its upper bits) and a remainder. A
counting quotient filter keeps the remainders of one quotient as a sorted run; two bit vectors,
``occupieds`` (one bit a quotient) and ``runends`` (one bit a slot), say which run is whose, and a
repeated remainder is followed by its count in place of copies. As fingerprints come out of a filter
in ascending order, filters built for parts of the corpus merge without loss: equal fingerprints
meet and their counts are added.

Each task builds filters of the rows it reads, one per block of the fingerprint space; blocks are
merged by one task each, which sees a fingerprint once per part however many rows had it. A
fingerprint counted once belongs to a text that occurs once. Rows of the others are compared byte
by byte: they are grouped by the text itself, pre-aggregated where they are read.

Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the largest
``doc_id`` stays (null is smaller than any id); of rows that also share that id, one stays, whichever.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import keep_rows, staged

# Fingerprints that one merged block holds on average.
BLOCK_FINGERPRINTS = 1 << 20
# Repeated fingerprints are broadcast up to this many rows of 8 bytes, joined by shuffle beyond.
BROADCAST_ROWS = 200_000

_FILTER_SCHEMA = "block long, quotient_bits int, occupieds binary, runends binary, slots binary"
_FILTER_ARROW = pa.schema([
    ("block", pa.int64()), ("quotient_bits", pa.int32()), ("occupieds", pa.binary()),
    ("runends", pa.binary()), ("slots", pa.binary()),
])


def build_filter(fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> dict:
    """A filter of ascending distinct ``fingerprints`` of ``bits`` bits with their counts.

    A remainder counted once takes one slot. One counted more often takes three: twice itself, which
    is how a reader tells it has a count, then the count.
    """
    quotient_bits = min(bits, max(1, int(len(fingerprints)).bit_length()))
    shift = np.uint64(bits - quotient_bits)
    quotients = (fingerprints >> shift).astype(np.int64)
    remainders = fingerprints & ((np.uint64(1) << shift) - np.uint64(1))
    sizes = np.where(counts > 1, 3, 1)
    ends = np.cumsum(sizes)
    slots = np.zeros(int(ends[-1]) if len(ends) else 0, "<u8")
    slots[ends - sizes] = remainders
    many = np.flatnonzero(counts > 1)
    slots[ends[many] - 2] = remainders[many]
    slots[ends[many] - 1] = counts[many]
    occupieds = np.zeros(1 << quotient_bits, bool)
    occupieds[quotients] = True
    runends = np.zeros(len(slots), bool)
    runends[ends[np.flatnonzero(np.append(np.diff(quotients) != 0, True))] - 1 if len(ends) else []] = True
    return {
        "quotient_bits": quotient_bits, "occupieds": np.packbits(occupieds).tobytes(),
        "runends": np.packbits(runends).tobytes(), "slots": slots.tobytes(),
    }


def read_filter(stored: dict, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The ascending fingerprints of a filter, and their counts."""
    slots = np.frombuffer(stored["slots"], "<u8")
    if len(slots) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    runends = np.unpackbits(np.frombuffer(stored["runends"], np.uint8))[:len(slots)].astype(bool)
    run = np.concatenate([[0], np.cumsum(runends)[:-1]])
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(stored["occupieds"], np.uint8)))
    # Remainders of a run ascend, so a slot equal to the one before it, in the same run, begins a
    # count; the count itself is skipped, whatever its value.
    same = np.zeros(len(slots), bool)
    same[1:] = (slots[1:] == slots[:-1]) & (run[1:] == run[:-1])
    heads, at = [], 0
    doubled = np.flatnonzero(same)
    place = 0
    counted = []
    while place < len(doubled):
        second = int(doubled[place])
        heads.append(np.arange(at, second))
        counted.append(second - 1)
        at = second + 2
        place = int(np.searchsorted(doubled, at + 1))
    heads.append(np.arange(at, len(slots)))
    first = np.concatenate(heads)
    counts = np.ones(len(first), np.int64)
    if counted:
        counted = np.asarray(counted)
        counts[np.searchsorted(first, counted)] = slots[counted + 2].astype(np.int64)
    quotients = occupied[run[first]].astype(np.uint64)
    return (quotients << np.uint64(bits - stored["quotient_bits"])) | slots[first], counts


def merge_filters(filters: list[dict], bits: int) -> dict:
    """One filter with the summed counts of several."""
    parts = [read_filter(f, bits) for f in filters]
    fingerprints, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(fingerprints), np.int64)
    np.add.at(counts, inverse, np.concatenate([p[1] for p in parts]))
    return build_filter(fingerprints, counts, bits)


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """Values of the column ``fingerprint`` that occur more than once."""
    block_bits = max(4, min(16, math.ceil(math.log2(max(1, rows / BLOCK_FINGERPRINTS)))))
    bits = 64 - block_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            new = batch.column(0).to_numpy().view(np.uint64)
            values, inverse = np.unique(np.concatenate([values, new]), return_inverse=True)
            total = np.zeros(len(values), np.int64)
            np.add.at(total, inverse, np.concatenate([counts, np.ones(len(new), np.int64)]))
            counts = total
        blocks = (values >> np.uint64(bits)).astype(np.int64)
        within = values & np.uint64((1 << bits) - 1)
        edges = np.flatnonzero(np.append(True, np.diff(blocks) != 0)) if len(blocks) else []
        rows = [
            {"block": int(blocks[a]), **build_filter(within[a:b], counts[a:b], bits)}
            for a, b in zip(edges, [*edges[1:], len(blocks)])]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_FILTER_ARROW)

    def merge(key: tuple[pa.Scalar], parts: pa.Table) -> pa.Table:
        merged = merge_filters(parts.to_pylist(), bits)
        values, counts = read_filter(merged, bits)
        above = np.uint64(key[0].as_py()) << np.uint64(bits)
        return pa.table({"fingerprint": pa.array((values[counts > 1] | above).view(np.int64))})

    filters = fingerprints.select("fingerprint").mapInArrow(build, _FILTER_SCHEMA)
    return filters.groupBy("block").applyInArrow(merge, "fingerprint long")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``keep_id``, ``group_size``, ``kept`` and the text's SHA-256."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("fingerprint"))
    repeated = staged(repeated_fingerprints(base, docs.count()), "repeated")
    small = repeated.count() <= BROADCAST_ROWS
    hit = (F.broadcast(repeated) if small else repeated).withColumn("repeats", F.lit(True))
    # The byte comparison: one group per text, partial groups where the texts are read.
    suspects = base.join(hit.drop("repeats"), "fingerprint", "left_semi")
    groups = suspects.groupBy("fingerprint", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("fingerprint", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    rows = base.select("doc_id", "fingerprint", F.sha2("text", 256).alias("text_sha256"))
    marked = rows.join(hit, "fingerprint", "left")
    single = marked.where(F.col("repeats").isNull()).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    joined = marked.where("repeats").drop("repeats").join(groups, ["fingerprint", "text_sha256"])
    # Rows that share the id that stays: the first of them is kept.
    own = Window.partitionBy("text_sha256", "doc_id").orderBy(F.lit(0))
    several = joined.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(own) == 1)).alias("kept"),
        "text_sha256")
    return single.unionByName(several)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    out = exact_groups(docs).where(~F.col("kept"))
    # A row not kept that has the id that stays repeats the row that does.
    once = F.bool_or(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return keep_rows(docs, out.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(
        once.alias("once")))

"""Product codes of vectors, with the nearest codebook entry found by slices and bit masks.

A vector is cut into equal parts and each part is replaced by the number of the nearest of 64 entries.
Along one dimension the entries' coordinates are sorted, and a mask of 64 bits is kept for every
prefix of that order. An entry that is at most r away lies within r in every dimension; the entries
that do so in one dimension are a slice of its order, whose mask is the difference of two prefix
masks. The masks of all dimensions are ANDed, and exact distances are worked out only for the bits
that are left. The radius r is the distance to some entry, here the one nearest in the part's
widest dimension, so the nearest entry and all that tie with it are among the candidates.

Components are whole numbers floor(256 * x). Rows whose vector is null, or holds a null or a number
that is not finite, are left out. Shorter vectors count as padded with zeros, to the next multiple of
the number of parts that the longest one needs. Null ids come after all others; rows with equal ids
are ordered by their vectors, so repeated rows get the same code. With fewer than 64 vectors a
codebook has fewer entries, which may be equal; the lower index wins then. An empty table gives no
rows. Columns beyond ``vec_id``, ``embedding`` and ``label`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import staged

PARTS = 16
ENTRIES = 64  # as many as a mask has bits
ROUNDS = 2
SCALE = 256

_SUMS = "part int, entry int, n long, sums array<long>"
_CODED = "vec_id long, label int, code string, error long"


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and the integer components ``x`` of the rows that are kept."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = lambda x: F.floor(x.cast("double") * SCALE)
    kept = vectors.where(F.col("embedding").isNotNull() & F.forall("embedding", finite))
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
        F.transform("embedding", whole).alias("x"))


class Codebooks:
    """Entries of all parts: an integer array of parts x entries x dimensions of a part."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        order = np.argsort(entries, axis=1, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=1)
        bits = np.left_shift(np.uint64(1), order.astype(np.uint64))
        # prefix[p, k, d]: the entries of part p that come first k times in dimension d.
        self.prefix = np.zeros((entries.shape[0], entries.shape[1] + 1, entries.shape[2]), np.uint64)
        self.prefix[:, 1:] = np.bitwise_or.accumulate(bits, axis=1)
        self.widest = (self.sorted[:, -1] - self.sorted[:, 0]).argmax(1)

    def candidates(self, part: int, x: np.ndarray) -> np.ndarray:
        """For each row of ``x`` the mask of the entries no farther than the radius in any dimension."""
        entries, d = self.entries[part], int(self.widest[part])
        line = self.sorted[part, :, d]
        place = np.clip(np.searchsorted(line, x[:, d]), 1, max(1, len(line) - 1))
        left, right = line[place - 1], line[np.minimum(place, len(line) - 1)]
        place = np.where(x[:, d] - left <= right - x[:, d], place - 1, np.minimum(place, len(line) - 1))
        start = np.argsort(entries[:, d], kind="stable")[place]
        squared = ((x - entries[start]) ** 2).sum(1)
        radius = np.floor(np.sqrt(squared.astype(np.float64))).astype(np.int64) + 1
        mask = np.full(len(x), np.uint64(0xFFFFFFFFFFFFFFFF))
        for k in range(x.shape[1]):
            low = np.searchsorted(self.sorted[part, :, k], x[:, k] - radius, side="left")
            high = np.searchsorted(self.sorted[part, :, k], x[:, k] + radius, side="right")
            mask &= self.prefix[part, high, k] ^ self.prefix[part, low, k]
        return mask

    def nearest(self, part: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row, the lowest of those that tie, and its squared distance."""
        mask = self.candidates(part, x)
        best = np.full(len(x), np.iinfo(np.int64).max)
        found = np.zeros(len(x), np.int64)
        for e, entry in enumerate(self.entries[part]):
            rows = np.flatnonzero(mask >> np.uint64(e) & np.uint64(1))
            squared = ((x[rows] - entry) ** 2).sum(1)
            closer = squared < best[rows]
            best[rows[closer]], found[rows[closer]] = squared[closer], e
        return found, best

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of integers as rows of ``dims`` numbers, padded with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _moved(vectors: DataFrame, books: Codebooks, dims: int) -> Codebooks:
    """Each entry replaced by the floored mean of the parts nearest to it.

    A task adds up its rows; what is shuffled and returned is one row per part and entry of each.
    """
    width = dims // PARTS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = books.entries.shape
        counts, sums = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for part in range(PARTS):
                own = x[:, part * width:(part + 1) * width]
                found, _ = books.nearest(part, own)
                counts[part] += np.bincount(found, minlength=shape[1])
                np.add.at(sums[part], found, own)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
             pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    per_task = vectors.select("x").mapInArrow(add, _SUMS)
    totals = per_task.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)])
    entries = books.entries.copy()
    for row in totals.collect():  # at most PARTS * ENTRIES rows
        entries[row.part, row.entry] = [row[f"s{k}"] // row.n for k in range(width)]
    return Codebooks(entries)


def train(vectors: DataFrame) -> tuple[Codebooks, int] | None:
    """Codebooks of kept vectors after all rounds, and the dimensions vectors are padded to."""
    longest = vectors.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return None
    dims = max(1, -(-longest // PARTS)) * PARTS
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).select("x").collect()
    start = np.array([row.x + [0] * (dims - len(row.x)) for row in first], np.int64)
    books = Codebooks(start.reshape(len(first), PARTS, dims // PARTS).swapaxes(0, 1).copy())
    for _ in range(ROUNDS):
        books = _moved(vectors, books, dims)
    return books, dims


def encode(vectors: DataFrame, books: Codebooks, dims: int) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error`` of kept vectors."""
    width = dims // PARTS

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), dims)
            codes, error = np.zeros((len(x), PARTS), np.uint8), np.zeros(len(x), np.int64)
            for part in range(PARTS):
                codes[:, part], squared = books.nearest(part, x[:, part * width:(part + 1) * width])
                error += squared
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(error)], ["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "x").mapInArrow(assign, _CODED)


def vector_codes(vectors: DataFrame) -> DataFrame:
    """Codes of all kept vectors, their errors alone and per label, and the codebooks' digest.

    Integer components are staged once and read in every round. Errors per label are added up before
    they are shuffled; joined to the rows, one row a label.
    """
    kept = staged(kept_vectors(vectors), "vectors")
    trained = train(kept)
    if trained is None:
        empty = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    books, dims = trained
    coded = staged(encode(kept, books, dims), "codes")
    # Null labels have a key of their own, as rows of null keys would all go to one task.
    keys = [F.coalesce("label", F.lit(0)).alias("k"), F.col("label").isNull().alias("k_null")]
    per_label = coded.groupBy(*keys).agg(F.sum("error").alias("label_error"))
    return coded.select("*", *keys).join(per_label, ["k", "k_null"]).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def codes_sql(rounds: int = ROUNDS) -> str:
    """The same in SQL, every part against every entry."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS (
            SELECT vec_id, part, first(v) AS v, arg_min(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d
            FROM (SELECT p.vec_id, p.part, p.v, b.entry,
                         list_sum(list_transform(list_zip(p.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
                  FROM parts p JOIN book{r} b USING (part))
            GROUP BY 1, 2)""")
        if r < rounds:
            steps.append(f"""means{r} AS (
                SELECT part, entry, list(floor(s / n)::BIGINT ORDER BY k) AS c FROM (
                    SELECT part, entry, k, sum(v[k]) AS s, count(*) AS n
                    FROM (SELECT part, entry, v, unnest(range(1, len(v) + 1)) AS k FROM near{r}) GROUP BY 1, 2, 3)
                GROUP BY 1, 2)""")
            steps.append(f"""book{r + 1} AS (
                SELECT part, entry, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN means{r} m USING (part, entry))""")
    return f"""
        WITH whole AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x)::BIGINT) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
        ), parts AS (
            SELECT vec_id, part, x[part * len(x) // {PARTS} + 1:(part + 1) * len(x) // {PARTS}] AS v
            FROM whole, (SELECT unnest(range({PARTS})) AS part)
        ), book0 AS (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS c
            FROM parts QUALIFY entry < {ENTRIES}
        ), {", ".join(steps)}, codes AS (
            SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
            FROM near{rounds} GROUP BY 1
        ), digest AS (
            SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
            FROM book{rounds}
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM codes JOIN whole USING (vec_id), digest
    """

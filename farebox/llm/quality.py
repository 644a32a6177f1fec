"""Quality classifier: naive Bayes features in a linear support vector machine.

A text's features are indicators of n-grams: of its words (one and two), and of its words' forms
(one to three): case, digits, what punctuation a word ends in, and how far back the same word stood.
Each is hashed to one of ``DIMENSIONS`` places. The log-count ratio of a place says how much more
often texts of label 1 have it than texts of label 0; these counts cover all labelled rows and are
added up by Spark. Indicators are scaled by the ratios and brought to unit length, and a linear
hinge-loss model is fitted to them by dual coordinate descent on a sample of at most ``FIT_ROWS``
labelled rows, drawn by a hash of the id. A logistic curve over its margins gives the score.

Null or empty texts have no n-gram and get the score of a zero margin. Null ids are never labelled.
Where a row has several labels, or the same text several rows, each counts. If no row is labelled 0,
nothing is held against any document and every score is 1; if none is labelled 1, every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import HASHED_BYTES, filled, mix, slices, span_hashes, text_bytes

DIMENSIONS_BITS = 18
DIMENSIONS = 1 << DIMENSIONS_BITS
FIT_ROWS = 12_000
EPOCHS = 12
PENALTY = 1.0
# A repeated word is one that stood at most so many words before.
REACH = 4

_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 lower, 4 digit, 8 beyond ASCII, 16 punctuation
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 2, 4, 8
_KIND[[b for b in range(33, 127) if not chr(b).isalnum()]] = 16


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and places of the n-grams each text has, each once, in ascending order."""
    data, offsets = text_bytes(texts)
    inside = data > 32
    change = np.diff(inside.astype(np.int8), prepend=0)
    begins = change == 1
    first_bytes = offsets[:-1][offsets[:-1] < len(data)]
    begins[first_bytes] = inside[first_bytes]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stops = np.flatnonzero(change == -1)
    ends = np.append(stops, len(data))[np.searchsorted(stops, starts, side="right")]
    ends = np.minimum(ends, np.append(starts[1:], len(data)))
    row = np.searchsorted(offsets, starts, side="right") - 1
    word = span_hashes(data, starts, ends)

    kinds = np.where(inside, _KIND[data], 0)
    shape = np.bitwise_or.reduceat(kinds, starts).astype(np.uint64)
    shape |= kinds[starts].astype(np.uint64) << np.uint64(5)
    for back in (1, 2, 3):
        at = np.maximum(ends - back, starts)
        last = np.where(kinds[at] == 16, data[at], 0).astype(np.uint64)
        shape |= last << np.uint64(2 + 8 * back)
    far = np.zeros(len(word), np.uint64)
    for back in range(REACH, 0, -1):
        far[back:][(word[back:] == word[:-back]) & (row[back:] == row[:-back])] = back
    with np.errstate(over="ignore"):
        form = mix(shape | (far << np.uint64(40)))
        grams = [(row, word), (row, form)]
        both = row[1:] == row[:-1]
        grams.append((row[1:][both], (mix(word[:-1]) + word[1:])[both]))
        grams.append((row[1:][both], (mix(form[:-1]) + form[1:])[both]))
        three = row[2:] == row[:-2]
        grams.append((row[2:][three], (mix(mix(form[:-2]) + form[1:-1]) + form[2:])[three]))
        keys = [
            (r.astype(np.uint64) << np.uint64(DIMENSIONS_BITS))
            | (mix(h + np.uint64(kind)) >> np.uint64(64 - DIMENSIONS_BITS))
            for kind, (r, h) in enumerate(grams)]
    keys = np.unique(np.concatenate(keys))
    return (keys >> np.uint64(DIMENSIONS_BITS)).astype(np.int64), (keys & np.uint64(DIMENSIONS - 1)).astype(np.int64)


@dataclass
class Model:
    """``ratio`` scales the indicators, ``weight`` is the fitted vector, the rest the curve."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float
    constant: float | None = None

    def margins(self, texts: pa.Array) -> np.ndarray:
        row, place = features(texts)
        ratio = self.ratio[place]
        dot = np.bincount(row, ratio * self.weight[place], len(texts))
        norm = np.sqrt(np.bincount(row, ratio * ratio, len(texts)))
        return dot / np.maximum(norm, 1e-12) + self.bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -500, 500)))


def descend(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int) -> np.ndarray:
    """The vector of a hinge-loss model by dual coordinate descent; ``rows`` are (places, values)."""
    weight, dual = np.zeros(size), np.zeros(len(rows))
    squares = np.array([float(v @ v) for _, v in rows])
    draw = np.random.default_rng(0)
    for _ in range(EPOCHS):
        worst = 0.0
        for k in draw.permutation(len(rows)):
            places, values = rows[k]
            slope = labels[k] * float(weight[places] @ values) - 1
            if (dual[k] == 0 and slope >= 0) or (dual[k] == PENALTY and slope <= 0):
                continue
            worst = max(worst, abs(slope))
            new = min(max(dual[k] - slope / squares[k], 0.0), PENALTY)
            weight[places] += (new - dual[k]) * labels[k] * values
            dual[k] = new
        if worst < 1e-3:
            break
    return weight


def curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve over the margins, by Newton's method."""
    positive, negative = (labels > 0).sum(), (labels < 0).sum()
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-6 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def held_out(doc_id):
    """Rows no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("long").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # One plan at every size: labels grow with the corpus, so they are never broadcast.
    rows = texts.join(known.hint("merge"), "doc_id").select("doc_id", "text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, DIMENSIONS), np.int64)
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                row, place = features(filled(part.column("text")))
                label = part.column("label").to_numpy()[row]
                for value in (0, 1):
                    totals[value] += np.bincount(place[label == value], minlength=DIMENSIONS)
        place = np.flatnonzero(totals.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(totals[0, place]), pa.array(totals[1, place])], ["place", "n0", "n1"])

    counts = rows.mapInArrow(count, "place long, n0 long, n1 long").groupBy("place").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()  # at most DIMENSIONS rows
    totals = np.ones((2, DIMENSIONS))
    totals[0, counts["place"]] += counts["n0"]
    totals[1, counts["place"]] += counts["n1"]
    if not counts["n0"].sum() or not counts["n1"].sum():
        zeros = np.zeros(DIMENSIONS, np.float32)
        return Model(zeros, zeros, 0, 0, 0, constant=float(not counts["n0"].sum()))
    log_ratio = np.log(totals[1] / totals[1].sum()) - np.log(totals[0] / totals[0].sum())
    log_ratio[totals.sum(0) < 5] = 0  # places hardly any text has
    ratio = log_ratio.astype(np.float32)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                row, place = features(filled(part.column("text")))
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                places = pa.ListArray.from_arrays(pa.array(bounds), pa.array(place.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("label"), places], ["label", "places"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        labels = table["label"].to_numpy() * 2.0 - 1
        rows = []
        for places in table["places"]:
            at = places.values.to_numpy()
            values = ratio[at].astype(np.float64)
            norm = max(float(np.sqrt(values @ values)), 1e-12)
            rows.append((np.append(at, DIMENSIONS), np.append(values / norm, 1.0)))
        weight = descend(rows, labels, DIMENSIONS + 1)
        slope, shift = curve(np.array([float(weight[p] @ v) for p, v in rows]), labels)
        yield pa.RecordBatch.from_pydict({"model": [np.append(weight, [slope, shift]).tobytes()]})

    # The ids of the sample are drawn first, so only its own texts move a second time.
    drawn = [F.xxhash64("doc_id"), "doc_id", "label"]
    chosen = known.distinct().join(texts.select("doc_id"), "doc_id", "left_semi").orderBy(*drawn).limit(FIT_ROWS)
    sample = texts.join(F.broadcast(chosen), "doc_id").orderBy(*drawn, F.xxhash64("text")).limit(FIT_ROWS).select(
        "doc_id", "text", "label")
    fitted = sample.mapInArrow(vectors, "label int, places array<int>").coalesce(1).mapInArrow(
        learn, "model binary").first()
    found = np.frombuffer(fitted["model"], np.float64)
    return Model(ratio, found[:DIMENSIONS].astype(np.float32), *map(float, found[DIMENSIONS:]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                scores = shared.value.scores(filled(part.column("text")))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), pa.array(scores),
                    pa.array((scores >= 0.7).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    needed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        held_out(F.col("doc_id")).alias("held_out"))
    return needed.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows that score at least ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                yield part.filter(pa.array(shared.value.scores(filled(part.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)

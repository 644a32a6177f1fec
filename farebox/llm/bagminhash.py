"""Weighted minwise signatures of shingle multisets by hierarchical Poisson processes.

The weight of a shingle is how often a text has it. Weights are divided into unit levels, and levels
into dyadic intervals [2**k, 2**(k+1)). Each shingle and interval has a Poisson process whose points,
drawn from hashes, come in ascending order at the rate of the interval's length; a point belongs to
one level of the interval and to one place of the signature. A text sees the points of the levels
its count reaches, and each place keeps the smallest. Two texts agree in a place with the
probability of their weighted Jaccard similarity, the sum of the smaller counts by the sum of the
larger ones. A process is followed only until it passes the largest value any place still holds, so
most shingles are given up after their first point.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import gather, mix, span_hashes, text_bytes

WORDS = 5


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, hash and count of every distinct shingle, ordered by row and hash.

    Words are what white space separates. A text of fewer words has one shingle, of all of them;
    a text without words has none.
    """
    data, offsets = text_bytes(texts)
    inside = data > 32
    change = np.diff(inside.astype(np.int8), prepend=0)
    begins = change == 1
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none, none.astype(np.uint64), none
    stops = np.flatnonzero(change == -1)
    ends = np.append(stops, len(data))[np.searchsorted(stops, starts, side="right")]
    ends = np.minimum(ends, np.append(starts[1:], len(data)))
    word = span_hashes(data, starts, ends)
    row = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    lengths = np.diff(first)
    numbers = np.where(lengths > 0, np.maximum(lengths - words + 1, 1), 0)
    at = gather(first[:-1], numbers)
    owner = np.repeat(np.arange(len(texts)), numbers)
    with np.errstate(over="ignore"):
        value = np.zeros(len(at), np.uint64)
        for k in range(words):
            place = at + k
            there = place < first[owner + 1]
            part = word[np.minimum(place, len(word) - 1)]
            value = np.where(there, mix(value * np.uint64(3) + part + np.uint64(k)), value)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))
    heads = np.flatnonzero(new)
    return owner[heads], value[heads], np.diff(np.append(heads, len(owner)))


def signatures(row: np.ndarray, value: np.ndarray, count: np.ndarray, rows: int, places: int) -> np.ndarray:
    """``rows`` x ``places`` smallest points; infinite throughout for a row without shingles."""
    signature = np.full(rows * places, np.inf)
    limit = np.full(rows, np.inf)
    top = np.frexp(count.astype(np.float64))[1]  # intervals 0 .. top - 1
    level = gather(np.zeros(len(count), np.int64), top)
    own = np.repeat(np.arange(len(count)), top)
    row, reach = row[own], count[own]
    with np.errstate(over="ignore"):
        key = mix(value[own] + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        rate = np.ldexp(1.0, level)
        base = np.left_shift(np.int64(1), level)
        point = np.zeros(len(key))
        number = np.uint64(0)
        while len(key):
            number += np.uint64(1)
            draw = mix(key + number * np.uint64(0xD1342543DE82EF95))
            uniform = ((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53
            point = point - np.log(uniform) / rate
            more = mix(draw)
            place = ((more >> np.uint64(32)) % np.uint64(places)).astype(np.int64)
            # The point's level within its interval; the count must reach it.
            seen = base + ((more & np.uint64(0xFFFFFFFF)).astype(np.int64) & (base - 1)) <= reach
            hit = np.flatnonzero(seen & (point < limit[row]))
            np.minimum.at(signature, row[hit] * places + place[hit], point[hit])
            touched = np.unique(row[hit]) if len(hit) < rows else np.arange(rows)
            limit[touched] = signature.reshape(rows, places)[touched].max(1)
            go = np.flatnonzero(point < limit[row])
            row, reach, key, rate, base, point = (a[go] for a in (row, reach, key, rate, base, point))
    return signature.reshape(rows, places)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of consecutive places; the same key in another band is another one."""
    rows, places = signature.shape
    bits = signature.view(np.uint64).reshape(rows, bands, places // bands)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (rows, bands)).copy()
        for k in range(places // bands):
            key = mix(key * np.uint64(5) + bits[:, :, k])
    return key.view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two multisets given as ascending hashes and counts."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][left], b[1][right]).sum())
    union = int(a[1].sum()) + int(b[1].sum()) - low
    return low / union if union else 0.0

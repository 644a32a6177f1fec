"""Document fingerprints by a homomorphic multiset hash, in SQL functions only.

A fingerprint is a vector of sums. Its first lanes add up, modulo 2**32, wide hash vectors of the
text's paragraphs (lines), so it does not depend on their order, and a paragraph is put in or taken
out by adding or subtracting its own vector. The further lanes do the same for the clauses of the
paragraphs, modulo 2**20, with vectors of zeros and ones: the number of clauses and, for each lane,
how many clauses have a one there. Seen as +1 and -1, the lanes of two texts have the scalar
product of their clause counts as expectation, which gives their likeness in [0, 1].

Clauses end at sentence marks and at words that end in certain letters, so an edit changes only the
clauses it touches. Null counts as empty; an empty text is one empty paragraph without clauses.
Texts without clauses are alike (1) if their fingerprints are equal and not at all otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

# 64-bit hashes of a paragraph (two lanes each), and of a clause (63 lanes each).
WIDE, SIGNS = 8, 2
CLAUSE_END = r"\n|(?<=[.!?。！？])\s?|(?<=[nt])\s"

_PER_LONG, _BITS, _SHIFTS = 3, 20, 21
_ONES = sum(1 << (_SHIFTS * k) for k in range(_PER_LONG))
_LANE = (1 << _BITS) - 1
_LANES = _LANE * _ONES
_WORD = (1 << 32) - 1

# Rows of documents per range of ids, and the most ranges.
RANGE_ROWS, MOST_RANGES = 4_000, 65_536


def _total(values: Column, lane, mask: int) -> Column:
    """Sum of one lane over an array of hashes; never overflows, as it is cut after each step."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda sum_, h: (sum_ + lane(h)).bitwiseAND(F.lit(mask)))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def vector(text: Column) -> Column:
    """The lanes of a text, as an array of longs."""
    def wide(paragraphs: Column, seed: int) -> Column:
        hashes = F.transform(paragraphs, lambda p: F.xxhash64(F.lit(seed), p))
        return _bound(hashes, lambda h: F.array(
            _total(h, lambda x: x.bitwiseAND(F.lit(_WORD)), _WORD),
            _total(h, lambda x: F.shiftrightunsigned(x, 32), _WORD)))

    def signs(clauses: Column, seed: int) -> Column:
        hashes = F.transform(clauses, lambda c: F.xxhash64(F.lit(seed), c))
        return _bound(hashes, lambda h: F.array(*[
            _total(h, lambda x, k=k: F.shiftrightunsigned(x, k).bitwiseAND(F.lit(_ONES)), _LANES)
            for k in range(_SHIFTS)]))

    first = _bound(F.split(text, "\n"), lambda p: F.concat(*[wide(p, s) for s in range(WIDE)]))
    second = _bound(F.filter(F.split(text, CLAUSE_END), lambda c: c != ""), lambda c: F.concat(
        F.array(F.size(c).cast("long").bitwiseAND(F.lit(_LANE))),
        *[signs(c, s) for s in range(WIDE, WIDE + SIGNS)]))
    return F.concat(first, second)


def _masks() -> Column:
    return F.array(*[F.lit(m).cast("long") for m in [_WORD] * (2 * WIDE) + [_LANE] + [_LANES] * (SIGNS * _SHIFTS)])


def added(a: Column, b: Column) -> Column:
    """The vector of all paragraphs of two texts."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b"), _masks().alias("m")),
                       lambda z: (z["a"] + z["b"]).bitwiseAND(z["m"]))


def removed(a: Column, b: Column) -> Column:
    """The vector of a text ``a`` without the paragraphs of ``b``.

    Each lane gets its modulus before the subtraction, so none borrows from its neighbour.
    """
    moduli = [_WORD + 1] * (2 * WIDE) + [_LANE + 1] + [(_LANE + 1) * _ONES] * (SIGNS * _SHIFTS)
    zipped = F.arrays_zip(
        a.alias("a"), b.alias("b"), _masks().alias("m"),
        F.array(*[F.lit(m).cast("long") for m in moduli]).alias("n"))
    return F.transform(zipped, lambda z: ((z["a"] + z["n"]) - z["b"]).bitwiseAND(z["m"]))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, from the vectors alone."""
    def signs(v: Column) -> Column:
        packed = F.slice(v, 2 * WIDE + 2, SIGNS * _SHIFTS)
        lanes = F.flatten(F.transform(packed, lambda x: F.array(*[
            F.shiftrightunsigned(x, _SHIFTS * k).bitwiseAND(F.lit(_LANE)) for k in range(_PER_LONG)])))
        count = F.element_at(v, 2 * WIDE + 1)
        return F.transform(lanes, lambda c: (2 * c - count).cast("double"))

    def product(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    near = _bound(F.struct(signs(a).alias("x"), signs(b).alias("y")), lambda s: _bound(
        product(s["x"], s["x"]) + product(s["y"], s["y"]),
        lambda length: F.when(length > 0, 2 * product(s["x"], s["y"]) / length).otherwise(F.lit(0.0))))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), near)))


def written(v: Column) -> Column:
    """A vector as a string of hexadecimal digits, equal for equal vectors."""
    wide = F.transform(F.slice(v, 1, 2 * WIDE), lambda x: F.lpad(F.hex(x), 8, "0"))
    rest = F.transform(F.slice(v, 2 * WIDE + 1, SIGNS * _SHIFTS + 1), lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.lower(F.concat(F.array_join(wide, ""), F.array_join(rest, "")))


def _longs(values: list[int]) -> Column:
    """Numbers as one constant: they travel as a text, which the optimizer folds into an array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _range_number(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``key``: first among every 256th of them, then among the next 256."""
    if not bounds:
        return F.lit(0)
    step = 256
    firsts = bounds[step::step]
    block = F.size(F.filter(_longs(firsts), lambda x: x <= key)) if firsts else F.lit(0)
    within = F.slice(_longs(bounds), block * step + 1, F.lit(step))
    return block * step + F.size(F.filter(within, lambda x: x <= key))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and the text of the next document, after the last that of the first.

    Ids are divided into ranges of about equal size, each sorted by one task. A range also gets the
    first document of the range after it, so no range has to look into another. Null ids come
    first; rows that share an id follow each other in the order of their texts.
    """
    lowest = -(1 << 63)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(lowest).cast("long"))
    count = rows.count()
    ranges = min(MOST_RANGES, max(1, math.ceil(count / RANGE_ROWS)))
    bounds = []
    if ranges > 1:
        shares = [k / ranges for k in range(1, ranges)]
        bounds = sorted(set(rows.select(key.alias("k")).agg(
            F.percentile_approx("k", F.array(*map(F.lit, shares)), 20 * ranges)).first()[0]))
    number = _range_number(F.col("key"), bounds)
    keyed = rows.withColumn("key", key).withColumn("range", number)
    firsts = {r["range"]: r["first"] for r in keyed.groupBy("range").agg(
        F.min("key").alias("first")).toLocalIterator()}  # one row a range
    order = sorted(firsts)
    # guest_of[n]: the range that also gets the first document of range n.
    guest_of = {n: order[k - 1] for k, n in enumerate(order)}
    size = len(bounds) + 1
    at = F.col("range") + 1
    first = F.element_at(_longs([firsts.get(n, 0) for n in range(size)]), at)
    host = F.element_at(_longs([guest_of.get(n, 0) for n in range(size)]), at)
    own = F.struct(F.col("range").cast("long").alias("r"), F.lit(False).alias("guest"))
    visit = F.struct(host.alias("r"), F.lit(True).alias("guest"))
    placed = keyed.withColumn(
        "place", F.explode(F.when(F.col("key") == first, F.array(own, visit)).otherwise(F.array(own))))
    along = Window.partitionBy("place.r").orderBy("place.guest", "key", F.xxhash64("text"), "text")
    return placed.select(
        "doc_id", "text", "place.guest", F.lead("text").over(along).alias("next")).where(~F.col("guest")).drop("guest")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of edited texts, and the likeness of neighbours.

    In an edited text the last half of the characters is replaced by as many from the next document.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.expr("substring(text, 1, int(n_chars - n_chars div 2))"), F.substring(F.col("next"), F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumns({
        "own": vector(F.col("text")), "changed": vector(F.col("edited")), "following": vector(F.col("next"))})
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"), written(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"))

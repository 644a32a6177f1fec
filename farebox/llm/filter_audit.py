"""How filters applied one after the other share their removals, for every order of them.

A document's failures are a mask of five bits. All documents are reduced to counts per part and mask,
and from these the removals v(S) of each of the 32 sets S of filters are tabulated: the documents that
fail any of them. Everything else is read off that table. A filter placed after the set P removes
v(P + f) - v(P), fails alone on v(all) - v(all - f), and its Shapley value is the solution of a least
squares problem: additive weights, one a filter, fitted to v over the sets that are neither empty nor
full, weighted by the Shapley kernel and constrained to add up to v(all). The normal equations are
the same for every part, so they are solved once, in rationals, for the columns of the table.

Null texts count as empty. ``E`` compares ids: of equal texts, rows with the smallest id pass; a null
id is neither smaller nor larger than another, so such rows pass and never make others fail. Rows that
repeat count each. Several labels of one document count as one that has what any of them has. An
empty table gives no part. Columns beyond ``doc_id``, ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
FULL = SETS - 1
# What the filters test.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 100, 80, 10
WORD_BREAKS = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = r"[#$%&*|]"

_MEASURES = ("n", "good", "toxic")
_AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long")
_AUDIT_ARROW = pa.schema(
    [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
    + [(c, pa.int64()) for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


def text_failures(text: Column) -> Column:
    """The mask of the filters A to D, which a text fails or passes by itself."""
    words = F.filter(F.split(text, WORD_BREAKS), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    tests = (
        n < MIN_WORDS,
        100 * distinct < MIN_DISTINCT_PERCENT * n,
        100 * capitals > MAX_CAPITAL_PERCENT * F.length(text),
        text.rlike(SYMBOLS),
    )
    return sum((F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per ``part`` and ``mask``: all (``n``), of good quality, toxic.

    Texts do not travel, their hashes do. Rows are added up before every shuffle, so a text, an id or
    a part that holds most rows is a few rows by then.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("sha"), text_failures(text).alias("own"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"))
    rows = base.groupBy("doc_id", "part", "sha", "own").agg(F.count(F.lit(1)).alias("n"))
    # Null ids have no label and would meet in one task of the join.
    marked = rows.where("doc_id is not null").join(marks, "doc_id", "left").select(
        *rows.columns, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("is_good", "is_toxic")])
    nameless = rows.where("doc_id is null").withColumns({"is_good": F.lit(False), "is_toxic": F.lit(False)})
    every = marked.unionByName(nameless)

    # Equal texts of one part with equal labels: their rows, and those with the smallest id.
    kinds = every.groupBy("sha", "part", "own", "is_good", "is_toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    # Only texts of several kinds need to know the smallest id among all of them, but every text has
    # few: at most four for each part it occurs in.
    first = kinds.groupBy("sha").agg(F.min("least.doc_id").alias("first"))
    kinds = kinds.join(first, "sha")
    passing = F.col("nameless") + F.when(
        F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    sides = F.array(*[
        F.struct((F.col("own") + extra).alias("mask"), count.alias("count"))
        for extra, count in ((0, passing), (16, F.col("n") - passing))])
    split = kinds.select("part", "is_good", "is_toxic", F.inline(sides)).where("count > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("count").alias("n"),
        F.coalesce(F.sum(F.when(F.col("is_good"), F.col("count"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("is_toxic"), F.col("count"))), F.lit(0)).alias("toxic"))


def removal_table(counts: DataFrame) -> DataFrame:
    """Of each part: ``n`` and the arrays ``v_n``, ``v_good``, ``v_toxic`` of removals per set."""
    sums = [F.sum("n").alias("n")]
    for name in _MEASURES:
        hits = [
            F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(name))), F.lit(0))
            for s in range(SETS)]
        sums.append(F.array(*hits).alias(f"v_{name}"))
    return counts.groupBy("part").agg(*sums)


def _solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X with matrix X = right, by elimination."""
    rows = [list(a) + list(b) for a, b in zip(matrix, right)]
    size = len(matrix)
    for k in range(size):
        pivot = next(r for r in range(k, size) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(size):
            if r != k and rows[r][k]:
                factor = rows[r][k]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[k])]
    return [row[size:] for row in rows]


def shapley_solution(players: int) -> list[list[Fraction]]:
    """Row i: by how much v of each set enters the Shapley value of player i.

    Minimised is the sum over sets S of w(S) * (sum of x_i in S - v(S))**2 with the kernel weight
    w(S) = (p - 1) / (C(p, s) * s * (p - s)), under the constraint that all x add up to v(all). With
    the multiplier of the constraint these are p + 1 linear equations, solved for every column of v.
    """
    full = (1 << players) - 1
    matrix = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    right = [[Fraction(0)] * (full + 1) for _ in range(players + 1)]
    for s in range(1, full):
        size = s.bit_count()
        weight = Fraction(players - 1, comb(players, size) * size * (players - size))
        inside = [i for i in range(players) if s >> i & 1]
        for i in inside:
            right[i][s] += weight
            for j in inside:
                matrix[i][j] += weight
    for i in range(players):
        matrix[i][players] = matrix[players][i] = Fraction(1)
    right[players][full] = Fraction(1)
    return _solve(matrix, right)[:players]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step in it.

    Counted are documents of the part: ``kept`` after the step, ``removed`` by it, ``redundant`` (fail
    its filter but were removed before), ``unique_fails`` (fail nothing else), ``good_lost`` and
    ``toxic_lost`` by label. ``shapley`` is what its filter removes, summed over all orders.
    """
    solution = shapley_solution(len(FILTERS))
    orders = ["".join(p) for p in permutations(FILTERS)]

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v, good, toxic = (row[f"v_{m}"] for m in _MEASURES)
                values = [
                    factorial(len(FILTERS)) * sum(c * x for c, x in zip(line, v)) for line in solution]
                out = []
                for order in orders:
                    before = 0
                    for step, letter in enumerate(order, 1):
                        k = FILTERS.index(letter)
                        after = before | 1 << k
                        removed = v[after] - v[before]
                        out.append((
                            row["part"], order, step, row["n"] - v[after], removed, v[1 << k] - removed,
                            v[FULL] - v[FULL ^ 1 << k], good[after] - good[before],
                            toxic[after] - toxic[before], int(values[k])))
                        before = after
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, field.type) for column, field in zip(zip(*out), _AUDIT_ARROW)],
                    schema=_AUDIT_ARROW)

    return removal_table(mask_counts(docs, labels)).mapInArrow(spell, _AUDIT)


# The contract's columns, from the removals of each order counted document by document's mask.
AUDIT_SQL = r"""
    WITH texts AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
    ), words AS (
        SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first
        FROM texts
    ), fails AS (
        SELECT doc_id, part,
               len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
               100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
               regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e
        FROM words
    ), marks AS (
        SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1
    ), counts AS (
        SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM fails LEFT JOIN marks USING (doc_id) GROUP BY ALL
    ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), orders AS (
        SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
        FROM letters p, letters q, letters r, letters s, letters t
        WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
    ), steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders
    ), failing AS (
        SELECT *, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [a, b, c, d, e][i]) AS failed FROM counts
    ), falls AS (
        SELECT *, filter_order[step] AS own,
               list_contains(failed, filter_order[step]) AS hit,
               coalesce(list_bool_or(list_transform(failed, lambda f: instr(filter_order, f) < step)), false) AS gone
        FROM failing, steps
    ), totals AS (
        SELECT part, filter_order, step, own,
               coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept,
               coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed,
               coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant,
               coalesce(sum(n) FILTER (hit AND len(failed) = 1), 0) AS unique_fails,
               coalesce(sum(good) FILTER (hit AND NOT gone), 0) AS good_lost,
               coalesce(sum(toxic) FILTER (hit AND NOT gone), 0) AS toxic_lost
        FROM falls GROUP BY ALL
    )
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
           redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
           good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
    FROM totals
"""

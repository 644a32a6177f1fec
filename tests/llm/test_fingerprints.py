"""Lanes, likeness and neighbours of fingerprints, counted again in plain Python."""

import hashlib
import re
import struct

import numpy as np
import xxhash
from pyspark.sql import functions as F

from farebox.llm import multiset_hash as M


def hashed(seed, text):
    """xxhash64 of a number and a text, as SQL chains them."""
    return xxhash.xxh64_intdigest(text.encode(), seed=xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=42))


def plain_vector(text):
    out = []
    for seed in range(M.WIDE):
        hashes = [hashed(seed, p) for p in text.split("\n")]
        out += [sum(h & 0xFFFFFFFF for h in hashes) % 2**32, sum(h >> 32 for h in hashes) % 2**32]
    clauses = [c for c in re.split(M.CLAUSE_END, text, flags=re.ASCII) if c]
    out.append(len(clauses) % 2**20)
    for seed in range(M.WIDE, M.WIDE + M.SIGNS):
        hashes = [hashed(seed, c) for c in clauses]
        for k in range(21):
            lanes = [sum(h >> (k + 21 * j) & 1 for h in hashes) % 2**20 for j in range(3)]
            out.append(sum(lane << (21 * j) for j, lane in enumerate(lanes)))
    return out


def plain_likeness(a, b):
    if a == b:
        return 1.0

    def signs(v):
        return np.array([2 * (x >> (21 * j) & 0xFFFFF) - v[2 * M.WIDE] for x in v[2 * M.WIDE + 1:] for j in range(3)], float)

    x, y = signs(a), signs(b)
    length = x @ x + y @ y
    return min(1.0, max(0.0, 2 * (x @ y) / length)) if length else 0.0


def test_lanes_and_likeness(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    texts = [r.text or "" for r in docs.collect()] + [r.text or "" for r in odd_docs.collect() if len(r.text or "") < 9_999]
    pairs = list(zip(texts, texts[1:] + texts[:1]))
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", M.vector(F.col("a")).alias("va"), M.vector(F.col("b")).alias("vb")).withColumn(
        "near", M.likeness(F.col("va"), F.col("vb"))).collect()
    for row in rows:
        assert row.va == plain_vector(row.a)
        assert abs(row.near - plain_likeness(row.va, row.vb)) < 1e-9


def test_edited_pairs_over_many_ranges(spark, monkeypatch):
    """Each row's neighbour, edited text and fingerprints, whatever the number of ranges."""
    rows = [(3 * k, f"text {k} is here. And more\nof {k % 7} it") for k in range(300)] + [(700_000, ""), (700_001, None)]
    texts = [t or "" for _, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for per_range in (1, 10, 4_000):
        monkeypatch.setattr(M, "RANGE_ROWS", per_range)
        found = sorted(M.edited_pairs(docs).collect())
        assert [r.doc_id for r in found] == [i for i, _ in rows]
        for k, row in enumerate(found):
            text, following = texts[k], texts[(k + 1) % len(texts)]
            half = len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            assert row.n_chars == len(text)
            assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            if k % 50 == 0 or k > 298:
                own, changed, after = map(plain_vector, (text, edited, following))
                assert abs(row.near_edited - plain_likeness(own, changed)) < 1e-9
                assert abs(row.near_next - plain_likeness(own, after)) < 1e-9


def test_bounds_are_one_constant(spark):
    """65,536 ranges are planned in no time: numbers do not become nodes of the plan."""
    import time

    bounds = list(range(0, 65_536 * 3, 3))
    started = time.monotonic()
    rows = spark.range(0, 200_000, 997).withColumn("n", M._range_number(F.col("id"), bounds)).collect()
    assert time.monotonic() - started < 30
    assert all(r.n == min(r.id // 3 + 1, 65_536) for r in rows)

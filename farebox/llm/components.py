"""Connected components of a graph given by its edges, by alternating star operations.

A large star hangs the larger neighbours of each node on the smallest node next to it, a small star
the smaller ones. Each is a minimum per node, pre-aggregated, and a join that adaptive execution
splits at nodes with many edges. The edges end as stars around the smallest node of each component.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import staged


class Sets:
    """Disjoint sets of hashable items, named by their smallest item."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, item):
        parent = self.parent
        root = item
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(item, item) != root:
            parent[item], item = root, parent[item]
        return root

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _local(edges: DataFrame) -> DataFrame:
    """The edges of each partition as stars, which connect the same nodes with fewer edges."""
    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, nodes = Sets(), set()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sets.join(a, b)
                nodes.update((a, b))
        stars = [(n, sets.find(n)) for n in nodes]
        stars = [(n, r) for n, r in stars if n != r]
        if stars:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in zip(*stars)], ["a", "b"])

    return edges.mapInArrow(contract, "a long, b long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, its component's smallest node, for all nodes but the roots.

    ``edges`` has two columns of longs; repeated edges and loops do no harm.
    """
    a, b = edges.columns
    plain = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")
    now = staged(_local(plain), "edges")
    state = None
    while True:
        now = staged(_small_star(_large_star(now)), "stars")
        # A star forest stays as it is; two sums tell whether anything moved.
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == tuple(row):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(row)

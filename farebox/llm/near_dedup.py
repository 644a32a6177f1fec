"""Near duplicates: banded BagMinHash signatures, then the multisets of shingles themselves.

Two texts are linked if the weighted Jaccard similarity of their five-word shingles is at least 0.8,
or if they are equal; classes are the connected components. Candidates are texts that share the key
of a band; with 50 bands of 8 places a pair at the threshold is missed once in 10,000.

A bucket may hold a large part of the corpus, so its pairs are not listed. First every member is
compared with the bucket's leader only. Most buckets are one class then and are done. In the others,
members that are not in the leader's class are compared exactly with all members of other classes,
in blocks of bounded size; a task reports only the links that join classes it had not joined. So
every candidate pair that could join two classes is verified, and none other.

Equal texts are one node. Null counts as empty; texts without words are linked to equal ones only.
Rows that repeat belong to one class. A class is named by its smallest ``doc_id``; as ids may be null
or repeat, it is known by the text of the row it keeps, which no other class has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bagminhash import band_keys, shingles, signatures, weighted_jaccard
from .common import HASHED_BYTES, filled, keep_rows, slices, staged
from .components import Sets, components

BANDS, BAND_PLACES = 50, 8
SIMILARITY = 0.8
# Members of a bucket in one block, and texts fetched by broadcast of their keys at most.
BLOCK = 1_000
BROADCAST_ROWS = 100_000

_SIGNED = "doc_id long, sha string, bands array<long>"


def _text():
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _signed(docs: DataFrame) -> DataFrame:
    """Band keys of all texts; a task works them out once for equal texts."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[str] = set()
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                shas = part.column("sha").to_pylist()
                new = [k for k, sha in enumerate(shas) if not (sha in met or met.add(sha))]
                texts = filled(part.column("text").take(pa.array(new, pa.int64())))
                found = signatures(*shingles(texts), len(new), BANDS * BAND_PLACES)
                keys = band_keys(found, BANDS)
                bands: list = [None] * len(shas)
                for row, k in enumerate(new):
                    bands[k] = keys[row] if np.isfinite(found[row, 0]) else keys[row, :0]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("sha"), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "sha", "bands"])

    needed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"))
    return needed.withColumn("sha", F.sha2("text", 256)).mapInArrow(sign, _SIGNED)


def _similar(pairs: DataFrame) -> DataFrame:
    """Of pairs of nodes with their texts, those whose multisets overlap enough."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in slices(batch, "text_a", HASHED_BYTES):
                for part in slices(half, "text_b", HASHED_BYTES):
                    sides = []
                    for name in ("text_a", "text_b"):
                        row, value, count = shingles(filled(part.column(name)))
                        cuts = np.searchsorted(row, np.arange(1, part.num_rows))
                        sides.append(list(zip(np.split(value, cuts), np.split(count, cuts))))
                    near = [weighted_jaccard(x, y) >= SIMILARITY for x, y in zip(*sides)]
                    yield part.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def _joins(key: tuple, table: pa.Table) -> pa.Table:
    """Links between classes in one block of a bucket: the first side against both.

    ``side`` 0 and 1 are compared with each other, 1 and 2 among themselves too. Exact overlaps of
    one text with all others come from one pass over the block's shingles.
    """
    nodes = table["node"].to_pylist()
    side, own = table["side"].to_numpy(), table["class"].to_pylist()
    owner, value, count = shingles(filled(table["text"].combine_chunks()))
    names, place = np.unique(value, return_inverse=True)
    sizes = np.bincount(owner, count, len(nodes))
    sets, found = Sets(), []
    for k in np.flatnonzero(side > 0):
        mine = owner == k
        counts = np.zeros(len(names), np.int64)
        counts[place[mine]] = count[mine]
        low = np.bincount(owner, np.minimum(counts[place], count), len(nodes))
        union = sizes + sizes[k] - low
        for other in np.flatnonzero((low >= SIMILARITY * union) & (low > 0)):
            if sets.join(own[k], own[other]):
                found.append((own[k], own[other]))
    columns = zip(*found) if found else ([], [])
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def near_classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_sha256``, ``class_id``, ``class_size`` and ``class_sha256`` of every row.

    ``class_sha256`` tells classes apart: the hash of the text of the row with the smallest id.
    """
    signed = staged(_signed(docs), "signed")
    # One node per text; bands are null where a task had met the text before.
    nodes = staged(signed.groupBy("sha").agg(
        F.min("doc_id").alias("doc_id"), F.first("bands", ignorenulls=True).alias("bands"),
    ).withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = nodes.select("node", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(
        F.min("node").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = staged(members.join(shared, "band"), "buckets")

    # Texts of the nodes that have a candidate, once each.
    wanted = staged(buckets.select("node").distinct().join(nodes.select("node", "doc_id", "sha"), "node"), "wanted")
    keys = wanted.select("node", "sha", F.col("doc_id").alias("first_id"))
    keys = F.broadcast(keys) if wanted.count() <= BROADCAST_ROWS else keys
    source = docs.select(F.col("doc_id").cast("long").alias("first_id"), _text().alias("text"))
    source = source.withColumn("sha", F.sha2("text", 256))
    match = (source["sha"] == keys["sha"]) & source["first_id"].eqNullSafe(keys["first_id"])
    texts = staged(source.join(keys, match).select("node", "text").dropDuplicates(["node"]), "texts")

    def texts_as(node: str, text: str) -> DataFrame:
        return texts.select(F.col("node").alias(node), F.col("text").alias(text))

    spokes = buckets.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = staged(_similar(spokes.join(texts_as("b", "text_b"), "b").join(texts_as("a", "text_a"), "a")), "links")
    classes = components(links)

    def class_of(node: str, name: str, frame: DataFrame) -> DataFrame:
        """``frame`` with the class of its column ``node``."""
        found = classes.select(F.col("node").alias(node), F.col("root").alias("_root"))
        return frame.join(found, node, "left").withColumn(name, F.coalesce("_root", node)).drop("_root")

    # A bucket of two is compared by now.
    parts = staged(class_of("leader", "main", class_of("node", "class", buckets.where("size > 2"))), "parts")
    other = F.col("class") != F.col("main")
    mixed = parts.groupBy("band").agg(
        F.ceil(F.count_if(~other) / BLOCK).alias("mains"), F.ceil(F.count_if(other) / BLOCK).alias("others"),
    ).where("others > 0")
    rows = parts.join(mixed, "band").withColumn("other", other)
    number = F.pmod(F.xxhash64("node"), F.when(F.col("other"), F.col("others")).otherwise(F.col("mains")))

    def cells(first, second, side):
        """Copies of a row for each number in ``first`` x ``second``."""
        return F.flatten(F.transform(first, lambda i: F.transform(
            second, lambda j: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side")))))

    def upto(n):
        return F.sequence(F.lit(0).cast("long"), n - 1)

    # Blocks of the leader's class meet blocks of the others (i >= 0), which also meet each other.
    main_cells = cells(F.array(number), upto(F.col("others")), 0)
    other_cells = F.concat(
        cells(upto(F.greatest(F.col("mains"), F.lit(1))), F.array(number), 1),
        F.transform(F.filter(upto(F.col("others")), lambda j: j != number), lambda j: F.struct(
            (-1 - F.least(number, j)).alias("i"), F.greatest(number, j).alias("j"), F.lit(2).alias("side"))))
    placed = rows.withColumn("cell", F.explode(F.when(F.col("other"), other_cells).otherwise(main_cells)))
    placed = placed.select("band", "cell.i", "cell.j", "cell.side", "node", "class").join(texts, "node")
    joined = placed.groupBy("band", "i", "j").applyInArrow(_joins, "a long, b long").distinct()
    merged = components(joined)

    # A node's class, then the class its class went into.
    roots = class_of("node", "class", nodes.select("node", "sha"))
    last = merged.select(F.col("node").alias("class"), F.col("root").alias("_last"))
    roots = roots.join(last, "class", "left").select("sha", F.coalesce("_last", "class").alias("root"))
    rows = signed.select("doc_id", "sha").join(roots, "sha")
    # Of the rows with the smallest id, the one with the smallest hash; null ids come last.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha"))
    sizes = rows.groupBy("root").agg(least.alias("least"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(sizes, "root").select(
        "doc_id", rows["sha"].alias("text_sha256"), F.col("least.doc_id").alias("class_id"), "class_size",
        F.col("least.sha").alias("class_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The row with the smallest ``doc_id`` of each class, with all its columns."""
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_sha256") == F.col("class_sha256"))
    rows = near_classes(docs).where("class_size > 1").withColumn("stays", stays)
    fate = rows.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(
        F.bool_or("stays").alias("once"), F.count(F.lit(1)).alias("n"))
    return keep_rows(docs, fate.where("not once or n > 1"))

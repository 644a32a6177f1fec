"""Jaccard join of shingle sets by parity sketches, a pigeonhole join of their segments, and a check.

Two texts are linked when their sets of five-word shingles have a similarity of 0.8 or more, that is
when 100 * common >= 80 * union; classes are the connected components.

Each shingle flips one bit of a sketch, so the Hamming distance of two sketches is never more than
the number of shingles that only one of the sets has. For linked sets of a and b shingles that number
is at most (a + b) // 9, and neither is more than 1.25 times the other.

* *Join.* A wide sketch is cut into segments, more of them than there may be differences, and a
  segment's odd bits make a key. Of linked sets, at most D = (a + b) // 9 keys of either are missing
  in the other, so under any order of the keys that both agree on, one of the first D + 1 keys is
  common. Rare keys come first: the order is by how many texts have a shingle, counted over the whole
  corpus in a table of fixed size, which any text's passages that many share stay behind. As D and
  the number of segments depend on the size, sketches of a *band* of sizes have equal segments, and
  the smallest sets of a band are also entered in the band below. Small sets have a segment for
  every shingle. A set with fewer odd segments than keys needed meets all sets of its band instead.
* *Buckets.* Sets with a common key are a bucket. Buckets are not listed pair by pair: each set
  is checked against the one leader it shares most keys with, and components are made. Buckets whose
  members are of one class are done. In the others, members of different classes are compared by
  narrow sketches, in blocks of bounded bytes. A block reports fewer pairs than it has members: of those
  whose distance is within D, the closest ones that connect its classes. They are checked. Where there
  were more and classes still differ, all members that have such a pair are compared again, by their
  shingles, in blocks that report only links.
* *Check.* The shingles of both texts are worked out again and compared.

Words are runs of bytes other than 0x20 and 0x09-0x0D, with A-Z as lower case. A text of fewer than
five words has one shingle, all its words. A null text counts as empty; a text without words has no
shingle and is linked with nothing, not even its copy. Texts with equal sets are one node. A component
is named by its smallest ``doc_id``; null ids are named by none, so a component of such rows only has a
null name. Rows that repeat belong to one component. Columns beyond ``doc_id`` and ``text`` are not read.
Shingles and sets are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import HASHED_BYTES, filled, gather, mix, slices, span_hashes, staged, text_bytes
from .components import Sets, components

WORDS = 5
# Sets of fewer shingles have a segment for each; bands above begin at SMALL * RATIO ** k and have
# SPREAD segments for each shingle of their smallest set.
SMALL, RATIO, SPREAD = 64, 4, 1.25
# Counters of the table that ranks shingles, 4 bytes each, and the blocks it travels in.
SLOTS, SLOT_BLOCKS = 1 << 20, 64
# Members of a bucket in one row.
LISTED = 1_000
# Texts checked against one leader in a group.
CHECKED = 256
# Members and bytes of sketches in one block of a bucket.
BLOCK, BLOCK_BYTES = 1_000, 8 << 20
# Nodes whose texts are fetched by broadcast (about 60 bytes each) up to this many, by shuffle beyond.
BROADCAST_ROWS = 200_000

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_ONE, _SALT = np.uint64(1), np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, ordered by row and hash."""
    data, offsets = text_bytes(texts)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    stops = np.append(np.flatnonzero(~inside), len(data))
    ends = np.minimum(stops[np.searchsorted(stops, starts)], np.append(starts[1:], len(data)))
    word = span_hashes(_LOWER[data], starts, ends)
    row = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    words = np.diff(first)
    many = np.where(words > 0, np.maximum(words - WORDS + 1, 1), 0)
    owner, at = np.repeat(np.arange(len(texts)), many), gather(first[:-1], many)
    last = first[owner + 1]
    value = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            there = np.flatnonzero(at + k < last)
            value[there] = mix(value[there] * np.uint64(5) + word[at[there] + k] + np.uint64(k + 1))
    bounds = np.concatenate([[0], np.cumsum(many)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        value[a:b].sort()
    new = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))
    return owner[new], value[new]


def _per_row(owner: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's shingles start, and the last one's end."""
    return np.searchsorted(owner, np.arange(rows + 1))


def set_ids(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each row's set; 0 for an empty one."""
    ids = np.zeros(len(starts) - 1, np.uint64)
    used = np.flatnonzero(np.diff(starts))
    if len(used):
        with np.errstate(over="ignore"):
            mixed = mix(value ^ _SALT)
            ids[used] = mix(np.add.reduceat(mixed, starts[used]) + np.diff(starts)[used].astype(np.uint64))
    return ids


def sketch_bits(size: np.ndarray) -> np.ndarray:
    """Bits of the narrow sketch of a set: a power of two, four to eight for each shingle."""
    return np.maximum(64, 1 << np.ceil(np.log2(np.maximum(4 * size, 1))).astype(np.int64))


def sketches(value: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """The narrow sketch of each row: the parity of its shingles' bits."""
    size = np.diff(starts)
    bits = sketch_bits(size)
    base = np.concatenate([[0], np.cumsum(bits)])
    place = np.repeat(base[:-1], size) + (value.astype(np.int64) & np.repeat(bits - 1, size))
    odd = np.bincount(place, minlength=base[-1]) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[a:b] for a, b in zip((base[:-1] // 8).tolist(), (base[1:] // 8).tolist())]


def bands_of(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, band and number of keys needed of every entry of sets that are not empty.

    Every set is entered in its own band; its partners have up to 1.25 times its size. A set of less
    than 1.25 times the smallest size of its band is entered below as well, where partners are smaller.
    """
    own = np.zeros(len(size), np.int64)
    floor = np.full(len(size), SMALL, np.int64)
    while (up := size >= floor).any():
        own[up] += 1
        floor[up] *= RATIO
    least = floor // RATIO
    rows = np.flatnonzero(size > 0)
    low = np.flatnonzero((own > 0) & (4 * size < 5 * least))
    return (
        np.concatenate([rows, low]), np.concatenate([own[rows], own[low] - 1]),
        np.concatenate([size[rows] // 4, (least[low] - 1 + size[low]) // 9]) + 1)


def segments(value: np.ndarray, starts: np.ndarray, spread: float):
    """Row, band and keys needed of every entry; entry, number and first shingle of its odd segments.

    ``at`` holds the shingles of all entries, one entry after the other.
    """
    row, band, needed = bands_of(np.diff(starts))
    size = np.diff(starts)[row]
    at = gather(starts[row], size)
    entry = np.repeat(np.arange(len(row)), size)
    count = np.where(band > 0, np.ceil(spread * SMALL * float(RATIO) ** (band - 1)), 0).astype(np.uint64)[entry]
    with np.errstate(over="ignore"):
        # Hashes of a set ascend, so the shingles of a segment follow one another.
        number = np.where(count > 0, (value[at] >> np.uint64(32)) * count >> np.uint64(32), value[at])
    new = np.ones(len(at), bool)
    new[1:] = (entry[1:] != entry[:-1]) | (number[1:] != number[:-1])
    heads = np.flatnonzero(new)
    return row, band, needed, at, entry[heads], number[heads], heads


def too_few(value: np.ndarray, starts: np.ndarray, spread: float) -> list[list[int]]:
    """Of every row the bands in which it has fewer segments than it needs keys; nearly always none."""
    row, band, needed, _, entry, _, _ = segments(value, starts, spread)
    short: list[list[int]] = [[] for _ in range(len(starts) - 1)]
    for k in np.flatnonzero(np.bincount(entry, minlength=len(row)) < needed):
        short[row[k]].append(int(band[k]))
    return short


def segment_keys(value: np.ndarray, starts: np.ndarray, ranks: np.ndarray, spread: float = SPREAD):
    """Row and key of the keys that sets are entered with, rare ones first."""
    row, band, needed, at, entry, number, heads = segments(value, starts, spread)
    if not len(at):
        return row[:0], value[:0]
    mine = value[at]
    with np.errstate(over="ignore"):
        odd = np.bitwise_xor.reduceat(mix(mine ^ _SALT), heads)
        key = mix(odd + mix(number + band[entry].astype(np.uint64) * _SALT))
    rank = np.minimum.reduceat(ranks[(mine & np.uint64(SLOTS - 1)).astype(np.int64)], heads)
    order = np.lexsort((key, rank, entry))
    entry, key = entry[order], key[order]
    first = np.searchsorted(entry, np.arange(len(row)))
    taken = np.arange(len(entry)) - first[entry] < needed[entry]
    return row[entry[taken]], key[taken]


def _unmet(met: set[int], nodes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which rows have a set that is not empty and was not met before."""
    return np.array([s > 0 and not (n in met or met.add(n)) for n, s in zip(nodes.tolist(), size.tolist())], bool)


def _text():
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


_SIGNED = (
    "doc_id long, print long, node long, size long, sketch binary, few array<int>, block int, counts binary")


def _signed(docs: DataFrame, spread: float) -> DataFrame:
    """Node, size and sketch of every text; besides, in rows of their own, how many texts hit a slot.

    A task works sketch and counts out once for equal sets, its other rows have a null sketch.
    """
    kinds = pa.schema([
        ("doc_id", pa.int64()), ("print", pa.int64()), ("node", pa.int64()), ("size", pa.int64()),
        ("sketch", pa.binary()), ("few", pa.list_(pa.int32())), ("block", pa.int32()), ("counts", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        counts = np.zeros(SLOTS, np.int32)
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                owner, value = shingle_sets(filled(part.column("text")))
                starts = _per_row(owner, part.num_rows)
                nodes = set_ids(value, starts).view(np.int64)
                size = np.diff(starts)
                new = _unmet(met, nodes, size)
                fresh = value[np.repeat(new, size)]
                counts += np.bincount((fresh & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS).astype(np.int32)
                bounds = np.concatenate([[0], np.cumsum(size[new])]).astype(np.int64)
                drawn: list = [None] * part.num_rows
                few: list = [None] * part.num_rows
                for row, sketch, bands in zip(
                        np.flatnonzero(new), sketches(fresh, bounds), too_few(fresh, bounds, spread)):
                    drawn[row], few[row] = sketch, bands or None
                nothing = pa.nulls(part.num_rows)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("print"), pa.array(nodes, mask=size == 0), pa.array(size),
                    pa.array(drawn, pa.binary()), pa.array(few, pa.list_(pa.int32())), nothing.cast(pa.int32()),
                    nothing.cast(pa.binary())], schema=kinds)
        parts = np.split(counts, SLOT_BLOCKS)
        used = [k for k, c in enumerate(parts) if c.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(used), f.type) for f in list(kinds)[:6]]
            + [pa.array(used, pa.int32()), pa.array([parts[k].tobytes() for k in used], pa.binary())], schema=kinds)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(_text()).alias("print"), _text().alias("text"))
    return rows.mapInArrow(sign, _SIGNED)


def slot_ranks(signed: DataFrame) -> np.ndarray:
    """For every slot, eight times the binary logarithm of the texts that hit it; 1 MB in all."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(raw, np.int32)
                sums[block] = sums.get(block, 0) + counts.astype(np.int64)
        ranks = [np.round(8 * np.log2(c + 1)).astype(np.uint8).tobytes() for c in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(ranks, pa.binary())], ["block", "ranks"])

    blocks = signed.where("block is not null").select("block", "counts").repartition("block")
    out = np.zeros(SLOTS, np.uint8)
    width = SLOTS // SLOT_BLOCKS
    for row in blocks.mapInArrow(total, "block int, ranks binary").collect():
        out[row.block * width:(row.block + 1) * width] = np.frombuffer(row.ranks, np.uint8)
    return out


def _entries(docs: DataFrame, ranks: np.ndarray, spread: float) -> DataFrame:
    """``key`` and ``node`` of all entries; a task enters equal sets once."""
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                owner, value = shingle_sets(filled(part.column("text")))
                starts = _per_row(owner, part.num_rows)
                nodes = set_ids(value, starts)
                size = np.diff(starts)
                new = _unmet(met, nodes, size)
                bounds = np.concatenate([[0], np.cumsum(size[new])]).astype(np.int64)
                row, key = segment_keys(value[np.repeat(new, size)], bounds, ranks, spread)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(nodes[new].view(np.int64)[row])], ["key", "node"])

    return docs.select(_text().alias("text")).mapInArrow(enter, "key long, node long")


_LISTS = "bucket long, head long, leader long, members array<long>"


def _buckets(entries: DataFrame) -> DataFrame:
    """Members of every key that several nodes have, in lists of at most LISTED, and the leader.

    Entries come ordered by key, so a key's nodes pass by in a row, however many they are; no more
    than one list of them is held. A key of several lists is its own bucket; a shorter one is known by
    its members, so that keys with the same members are one bucket.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, leader = None, np.zeros(0, np.int64), None
        for batch in batches:
            key, node = (batch.column(k).to_numpy() for k in range(2))
            if held_key is not None:
                key = np.concatenate([np.full(len(held), held_key), key])
                node = np.concatenate([held, node])
            if not len(key):
                continue
            new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
            key, node = key[new], node[new]
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            tails = np.append(heads[1:], len(key))
            out = []
            # A key's last nodes go out even if only one is left after earlier lists.
            ended = (tails - heads > 1) | ((heads == 0) & (leader is not None))
            ended[-1] = False
            for a, b in zip(heads[ended].tolist(), tails[ended].tolist()):
                out += _cut(key[a], node[a:b], leader if a == 0 else None)
            # The last key may go on in the next batch. Nodes ascend, so the last one is kept to tell
            # it from a repeated one, and what fills a list is given out.
            first = heads[-1]
            known = leader if first == 0 else None
            held_key, held = key[first], node[first:]
            while len(held) > LISTED:
                known = int(held[0]) if known is None else known
                out.append((int(held_key), int(held[0]), known, held[:LISTED]))
                held = held[LISTED:]
            leader = known
            if out:
                yield _as_lists(out)
        if held_key is not None and (leader is not None or len(held) > 1):
            yield _as_lists(_cut(held_key, held, leader))

    ordered = entries.repartition("key").sortWithinPartitions("key", "node")
    lists = ordered.mapInArrow(listed, _LISTS)
    return lists.groupBy("bucket", "head").agg(
        F.first("leader").alias("leader"), F.first("members").alias("members"), F.count(F.lit(1)).alias("weight"))


def _cut(key: int, nodes: np.ndarray, leader: int | None) -> list[tuple]:
    """A key's remaining nodes as lists; ``leader`` if some were given out before."""
    if leader is None and len(nodes) <= LISTED:
        with np.errstate(over="ignore"):
            name = mix(mix(nodes.view(np.uint64) ^ _SALT).sum(keepdims=True) + np.uint64(len(nodes)))
        return [(int(name.view(np.int64)[0]), int(nodes[0]), int(nodes[0]), nodes)]
    leader = int(nodes[0]) if leader is None else leader
    return [(int(key), int(nodes[k]), leader, nodes[k:k + LISTED]) for k in range(0, len(nodes), LISTED)]


def _as_lists(rows: list[tuple]) -> pa.RecordBatch:
    ends = np.cumsum([len(r[3]) for r in rows])
    members = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(np.concatenate([r[3] for r in rows])))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)] + [members],
        ["bucket", "head", "leader", "members"])


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` with their texts; nodes are fetched by broadcast if they are few."""
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"),
        F.xxhash64(_text()).alias("print"), _text().alias("text"))
    keys = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    return texts.join(keys, ["id", "no_id", "print"])


def _checked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs of nodes ``a`` and ``b``, those that are linked.

    The texts of up to about CHECKED nodes that are checked against one other come into one group with
    it, ordered so that it comes first; a task holds the shingles of one leader at a time.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHECKED).alias("groups"))
    placed = pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("groups")))
    leads = placed.select("a", "salt").distinct()
    seats = placed.select("a", "salt", F.col("b").alias("node"), F.lit(1).alias("turn")).unionByName(
        leads.select("a", "salt", F.col("a").alias("node"), F.lit(0).alias("turn")))
    wanted = staged(seats.join(nodes.select("node", "id", "no_id", "print"), "node"), "wanted")
    fetched = _texts(docs, wanted).select("a", "salt", "turn", "node", "text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, held = None, None
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                owner, value = shingle_sets(filled(part.column("text")))
                starts = _per_row(owner, part.num_rows)
                right = set_ids(value, starts).view(np.int64) == part.column("node").to_numpy()
                found = []
                for k, (a, turn, node) in enumerate(zip(*(
                        part.column(c).to_pylist() for c in ("a", "turn", "node")))):
                    if not right[k]:
                        continue
                    own = value[starts[k]:starts[k + 1]]
                    if turn == 0:
                        lead, held = a, own
                    elif lead == a:
                        both = len(np.intersect1d(held, own, assume_unique=True))
                        if 100 * both >= 80 * (len(held) + len(own) - both):
                            found.append((a, node))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    together = fetched.repartition("a", "salt").sortWithinPartitions("a", "salt", "turn")
    return together.mapInArrow(check, "a long, b long")


def close_pairs(left: np.ndarray, right: np.ndarray, words: list[np.ndarray], size: np.ndarray):
    """Numbers of the pairs of ``left`` and ``right`` whose sketches may be those of linked sets.

    ``words`` are the sketches as 64-bit words. A wider sketch is folded to the other's width; sizes
    that may be linked have widths that differ by a factor of two at most.
    """
    found = []
    widths = np.array([len(w) for w in words])
    for width in np.unique(widths[left]):
        rows = left[widths[left] == width]
        for other in (width, 2 * width, width // 2):
            others = right[widths[right] == other]
            if not len(others) or not other:
                continue
            wide, narrow = max(width, other), min(width, other)

            def fold(numbers):
                m = np.stack([words[n] for n in numbers])
                return m if m.shape[1] == narrow else m[:, :narrow] ^ m[:, narrow:]

            across = fold(others)
            for n, line in zip(rows, fold(rows)):
                total = size[n] + size[others]
                near = np.flatnonzero(
                    (5 * np.minimum(size[n], size[others]) >= 4 * np.maximum(size[n], size[others])))
                apart = np.bitwise_count(across[near] ^ line).sum(1, dtype=np.int64)
                hit = near[apart <= total[near] // 9]
                found.append((np.full(len(hit), n), others[hit], apart[apart <= total[near] // 9]))
            del wide
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def nearest_forest(low: np.ndarray, high: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Numbers of the pairs that connect all classes which pairs connect, closest ones first.

    There are fewer of them than classes, however many pairs there are.
    """
    names, ends = np.unique(np.concatenate([low, high]), return_inverse=True)
    order = np.argsort(apart, kind="stable")
    if len(names) <= 2:
        return order[:1]
    low, high = ends[:len(low)][order], ends[len(low):][order]
    left, taken, sets = np.arange(len(order)), [], Sets()
    label = np.arange(len(names))
    while True:
        left = left[label[low[left]] != label[high[left]]]
        if not len(left):
            return order[np.sort(np.array(taken, np.int64))]
        # Of every set of classes its closest pair: what is written last, stays.
        backwards = left[::-1]
        best = np.full((2, len(names)), len(order))
        best[0, label[low[backwards]]] = best[1, label[high[backwards]]] = backwards
        best = best.min(0)
        for pair in np.unique(best[best < len(order)]).tolist():
            if sets.join(int(low[pair]), int(high[pair])):
                taken.append(pair)
        label = np.array([sets.find(k) for k in range(len(names))])


def _mixed(lists: DataFrame, known: DataFrame) -> DataFrame:
    """Members of the buckets that have several classes; ``other`` if not of the leader's class."""
    rows = lists.select("bucket", "leader", F.explode("members").alias("node")).join(
        known.select("node", "size", "class"), "node")
    main = F.max(F.when(F.col("node") == F.col("leader"), F.col("class")))
    classes = rows.groupBy("bucket").agg(
        main.alias("main"), F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    return rows.join(classes.select("bucket", "main"), "bucket").select(
        "bucket", "node", "size", "class", (F.col("class") != F.col("main")).alias("other"))


def _cells(mixed: DataFrame, content: DataFrame, width: int) -> DataFrame:
    """Members of buckets in blocks, and pairs of blocks (``i``, ``j``) in which all pairs of classes meet.

    Cells with a negative ``i`` are of blocks -1 - ``i`` and ``j`` of the other classes, the rest of blocks
    ``i`` of the leader's class and ``j`` of others. ``content`` has ``width`` bytes for each shingle, or
    fewer, and eight at least.
    """
    def blocks(side):
        members, size = F.count_if(side), F.sum(F.when(side, F.greatest(width * F.col("size"), F.lit(8))))
        return F.greatest(F.ceil(members / BLOCK), F.ceil(F.coalesce(size, F.lit(0)) / BLOCK_BYTES))

    other_class = F.when(F.col("other"), F.col("class"))
    count = mixed.groupBy("bucket").agg(
        blocks(~F.col("other")).alias("mains"), blocks(F.col("other")).alias("others"),
        F.coalesce(F.min(other_class) < F.max(other_class), F.lit(False)).alias("several"))
    seated = mixed.join(count, "bucket").withColumn("own", F.pmod(
        F.xxhash64("node"), F.when(F.col("other"), F.col("others")).otherwise(F.col("mains"))))

    def upto(n):
        return F.sequence(F.lit(0).cast("long"), n - 1)

    def cell(i, j):
        return F.struct(i.alias("i"), j.alias("j"))

    own = F.col("own")
    with_main = F.transform(upto(F.col("mains")), lambda i: cell(i, own))
    among = F.transform(upto(F.col("others")), lambda k: cell(-1 - F.least(own, k), F.greatest(own, k)))
    # Other members of one class need not meet one another.
    places = F.when(~F.col("other"), F.transform(upto(F.col("others")), lambda j: cell(own, j))).when(
        F.col("mains") == 0, among).when(F.col("several"), F.concat(with_main, among)).otherwise(with_main)
    placed = seated.where("other or others > 0").select(
        "bucket", "node", "size", "class", "other", "own", F.explode(places).alias("cell"))
    return placed.join(content, "node").select(
        "bucket", "cell.*", "node", "size", "class", "other", "own", *[c for c in content.columns if c != "node"])


def _sides(key: tuple, group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The members of a cell whose pairs are compared."""
    i, j = key[1].as_py(), key[2].as_py()
    other, own = group["other"].to_numpy(zero_copy_only=False), group["own"].to_numpy()
    right = np.flatnonzero(other & (own == j))
    return np.flatnonzero(other & (own == -1 - i)) if i < 0 else np.flatnonzero(~other), right


def _near(key: tuple, group: pa.Table):
    """Pairs of a cell of different classes whose sketches allow a link, and their distances."""
    left, right = _sides(key, group)
    words = [np.frombuffer(s, "<u8") for s in group["sketch"].to_pylist()]
    own_class = group["class"].to_numpy()
    a, b, apart = close_pairs(left, right, words, group["size"].to_numpy())
    use = own_class[a] != own_class[b]
    if key[1].as_py() == -1 - key[2].as_py():
        # A block with itself has each pair twice.
        use &= a < b
    return a[use], b[use], apart[use]


_NEAR = "bucket long, a long, b long, cut boolean"


def _candidates(lists: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of different classes in one bucket whose sketches allow a link.

    A block reports the closest pairs that connect its classes, fewer than it has members, and says in
    ``cut`` if there are more, so a bucket without ``cut`` has no further pairs.
    """
    def compare(key: tuple, group: pa.Table) -> pa.Table:
        node, own_class = group["node"].to_numpy(), group["class"].to_numpy()
        a, b, apart = _near(key, group)
        kept = nearest_forest(own_class[a], own_class[b], apart)
        first, second = np.minimum(node[a[kept]], node[b[kept]]), np.maximum(node[a[kept]], node[b[kept]])
        return pa.table(
            [pa.array(c) for c in (
                np.full(len(kept), key[0].as_py(), np.int64), first, second, np.full(len(kept), len(kept) < len(a)))],
            ["bucket", "a", "b", "cut"])

    cells = _cells(_mixed(lists, known), known.select("node", "sketch"), 1)
    return cells.groupBy("bucket", "i", "j").applyInArrow(compare, _NEAR)


def _doubtful(lists: DataFrame, known: DataFrame) -> DataFrame:
    """Members of buckets with a pair of different classes whose sketches allow a link."""
    def compare(key: tuple, group: pa.Table) -> pa.Table:
        a, b, _ = _near(key, group)
        used = np.unique(np.concatenate([a, b]))
        return group.select(["bucket", "node", "size", "class", "other"]).take(pa.array(used, pa.int64()))

    cells = _cells(_mixed(lists, known), known.select("node", "sketch"), 1)
    return cells.groupBy("bucket", "i", "j").applyInArrow(
        compare, "bucket long, node long, size long, class long, other boolean").distinct()


def _shingles(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``shingles`` of nodes, 8 bytes each, worked out from the texts again."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=HASHED_BYTES):
                owner, value = shingle_sets(filled(part.column("text")))
                starts = _per_row(owner, part.num_rows)
                right = set_ids(value, starts).view(np.int64) == part.column("node").to_numpy()
                sets = [value[starts[k]:starts[k + 1]].tobytes() for k in np.flatnonzero(right)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").filter(pa.array(right)), pa.array(sets, pa.binary())], ["node", "shingles"])

    fetched = _texts(docs, nodes.select("node", "id", "no_id", "print")).select("node", "text")
    # Rows that repeat have one id and text.
    return fetched.mapInArrow(hashed, "node long, shingles binary").groupBy("node").agg(
        F.first("shingles").alias("shingles"))


def linked_pairs(left: np.ndarray, right: np.ndarray, sets: list[np.ndarray], classes: np.ndarray) -> list[tuple]:
    """Linked pairs of ``left`` and ``right`` that connect all classes which linked pairs connect."""
    size = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(size)])
    names, number = np.unique(np.concatenate(sets), return_inverse=True)
    at = number[gather(starts[right], size[right])]
    heads = np.cumsum(size[right]) - size[right]
    mine, joined, found = np.zeros(len(names), bool), Sets(), []
    for a in left.tolist():
        own = number[starts[a]:starts[a + 1]]
        mine[own] = True
        both = np.add.reduceat(mine[at], heads, dtype=np.int64)
        mine[own] = False
        hits = right[(100 * both >= 80 * (size[a] + size[right] - both)) & (classes[right] != classes[a])]
        found += [(a, b) for b in hits.tolist() if joined.join(int(classes[a]), int(classes[b]))]
    return found


def _links_within(mixed: DataFrame, shingles: DataFrame) -> DataFrame:
    """Links that connect all members of a bucket which links connect; every pair of classes is compared."""
    def compare(key: tuple, group: pa.Table) -> pa.Table:
        left, right = _sides(key, group)
        found: list = []
        if len(left) and len(right):
            sets = [np.frombuffer(s, "<u8") for s in group["shingles"].to_pylist()]
            found = linked_pairs(left, right, sets, group["class"].to_numpy())
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table([pa.array(group["node"].to_numpy()[pairs[:, k]]) for k in range(2)], ["a", "b"])

    return _cells(mixed, shingles, 8).groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")


def near_sets(docs: DataFrame, spread: float = SPREAD) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    signed = staged(_signed(docs, spread), "signed")
    rows = signed.where("block is null").drop("block", "counts")
    # One node per set, known by its row with the smallest id; null ids come last.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "print"))
    nodes = rows.where("size > 0").groupBy("node").agg(
        least.alias("least"), F.max("size").alias("size"), F.max("sketch").alias("sketch"))
    nodes = staged(nodes.select(
        "node", "size", "sketch", F.col("least.doc_id").alias("doc_id"), F.col("least.no_id").alias("no_id"),
        F.coalesce("least.doc_id", F.lit(0)).alias("id"), F.col("least.print").alias("print")), "nodes")
    lists = staged(_buckets(_entries(docs, slot_ranks(signed), spread)), "lists")

    # The leader that a node shares most keys with.
    spokes = lists.select("leader", "weight", F.explode("members").alias("node")).where("node != leader")
    shared = spokes.groupBy("leader", "node").agg(F.sum("weight").alias("weight"))
    best = shared.groupBy("node").agg(F.max(F.struct("weight", "leader")).alias("best"))
    links = staged(_checked(docs, nodes, best.select(F.col("best.leader").alias("a"), F.col("node").alias("b"))), "links")

    few = rows.where("few is not null").select(F.explode("few").alias("band"), F.col("node").alias("a")).distinct()
    if few.take(1):
        links = staged(links.unionByName(_checked(docs, nodes, _with_band(few, nodes))), "links")

    def known(classes):
        return nodes.join(classes, "node", "left").select(
            "node", "size", "sketch", F.coalesce("root", "node").alias("class"))

    classes = components(links)
    found = staged(_candidates(lists, known(classes)), "candidates")
    if found.take(1):
        more = _checked(docs, nodes, found.select("a", "b").distinct())
        stars = classes.select(F.col("node").alias("a"), F.col("root").alias("b"))
        classes = components(staged(stars.unionByName(more), "links"))
        # Only buckets with more pairs than were reported are looked at again.
        open_lists = lists.join(found.where("cut").select("bucket").distinct(), "bucket", "left_semi")
        doubtful = staged(_doubtful(open_lists, known(classes)), "doubtful")
        if doubtful.take(1):
            shingles = staged(_shingles(docs, nodes.join(doubtful.select("node").distinct(), "node")), "shingles")
            more = _links_within(doubtful, shingles)
            stars = classes.select(F.col("node").alias("a"), F.col("root").alias("b"))
            classes = components(staged(stars.unionByName(more), "links"))

    named = nodes.join(classes, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("class"))
    names = named.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    names = named.join(names, "class").select("node", "component_id")
    linked = rows.where("size > 0").join(names, "node").select(
        "doc_id", F.col("size").alias("n_shingles"), "component_id")
    alone = rows.where("size = 0").select(
        "doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def _with_band(few: DataFrame, nodes: DataFrame) -> DataFrame:
    """Sets with too few keys against all sets of their band that have a size they may be linked to."""
    # The smallest size of band k > 0 is SMALL * RATIO ** (k - 1).
    own = F.when(F.col("size") < SMALL, 0).otherwise(
        F.floor(F.round(F.log(F.col("size") / SMALL) / float(np.log(RATIO)), 9)) + 1).cast("int")
    least = F.lit(SMALL) * F.pow(F.lit(float(RATIO)), own - 1)
    entered = nodes.select("node", "size", F.explode(F.when(
        (own > 0) & (4 * F.col("size") < 5 * least), F.array(own, own - 1)).otherwise(F.array(own))).alias("band"))
    sized = few.join(nodes.select(F.col("node").alias("a"), F.col("size").alias("size_a")), "a")
    pairs = sized.join(entered, "band").where(
        (F.col("a") != F.col("node")) & (5 * F.least("size", "size_a") >= 4 * F.greatest("size", "size_a")))
    return pairs.select("a", F.col("node").alias("b")).distinct()


JOIN_SQL = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(
                   coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words
    ), fives AS (
        SELECT doc_id, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o
               || ' ' || lead(word, 4) OVER o AS one
        FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY place)
    ), shingles AS (
        SELECT DISTINCT doc_id, one FROM fives WHERE one IS NOT NULL
        UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 4
    ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
    ), sets AS (SELECT doc_id, n, one FROM shingles JOIN sizes USING (doc_id)
    ), links AS (
        SELECT a.doc_id AS x, b.doc_id AS y
        FROM sets a JOIN sets b ON a.one = b.one AND a.doc_id <> b.doc_id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ), reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
    )
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
    FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1) LEFT JOIN sizes USING (doc_id)
"""

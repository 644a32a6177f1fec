"""Token counts by a finite-state transducer compiled from a piece model.

The transducer reads characters and says with each how the number of tokens changes. What a state
has to know of the text read so far are the places from which a piece may still be under way: how
much of it has been read (a node in the tree of pieces), the last token before that place, and how
many tokens fewer there were. Reading a character moves every such piece on; the one that ends here
and is compatible with its left neighbour is the new last token. Between two characters that no
piece holds side by side nothing is under way, and the transducer is in its start state. States and
transitions are made when they are first met and kept for the worker's later texts.

Texts are read in chunks of fixed length, all chunks of a batch side by side. A chunk maps the state
it is entered in to the state it is left in and a count. From its first place of rest on, this map is
constant and computed for all chunks at once. What lies before depends on the chunk to the left:
maps are composed from left to right, all chunks whose left neighbour is known in one step, until
all are known. A chunk without a place of rest takes part in the next step. Counts of a document
are differences of running sums.

Null or empty texts have no token.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import filled, mix, slices
from .piece_model import SPACE, PieceModel, piece_model

CHUNK = 256
# Transitions kept between batches; more than these make the worker start anew.
REMEMBERED = 1 << 21

_ROOT, _NONE = 0, -1


class Transducer:
    def __init__(self, model: PieceModel):
        self.model = model
        missing = [c for c in model.joining if c not in model.ids]
        if missing:
            raise ValueError(f"characters of pieces that are no pieces: {missing[:5]}")
        chars = sorted(model.joining)
        self.classes = np.zeros(0x110000, np.int16)
        self.classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.classes[ord(" ")] = self.classes[ord(SPACE)]
        number = {c: k + 1 for k, c in enumerate(chars)}
        self.width = len(chars) + 1
        self.adjoin = np.zeros((self.width, self.width), bool)
        for a, b in model.pairs:
            self.adjoin[number[a], number[b]] = True
        # Characters that no longer piece holds: one token, or one for each byte.
        code = np.arange(0x110000)
        spelled = 1 + (code > 0x7F).astype(np.int8) + (code > 0x7FF) + (code > 0xFFFF) if model.bytes else 1
        self.alone = np.broadcast_to(np.asarray(spelled, np.int8), code.shape).copy()
        self.alone[[ord(c) for c in model.ids if len(c) == 1]] = 1
        # The tree of pieces.
        self.children: list[dict[int, int]] = [{}]
        self.piece = [_NONE]
        for piece, i in model.ids.items():
            if any(c not in number for c in piece):
                continue
            node = _ROOT
            for c in piece:
                step = number[c]
                if step not in self.children[node]:
                    self.children[node][step] = len(self.children)
                    self.children.append({})
                    self.piece.append(_NONE)
                node = self.children[node][step]
            self.piece[node] = i
        self.forget()

    def forget(self) -> None:
        self.states = [((_ROOT, _NONE, 0),)]
        self.number = {self.states[0]: 0}
        self._sized(1 << 16)

    def _sized(self, size: int) -> None:
        self.keys = np.full(size, -1, np.int64)
        self.next = np.zeros(size, np.int32)
        self.change = np.zeros(size, np.int8)
        self.held = 0

    def _place(self, key: int) -> int:
        mask = len(self.keys) - 1
        at = int(mix(np.array([key], np.uint64))[0]) & mask
        while self.keys[at] != -1 and self.keys[at] != key:
            at = (at + 1) & mask
        return at

    def _add(self, keys: np.ndarray) -> None:
        """Compile the transitions of the given keys."""
        if 2 * (self.held + len(keys)) > len(self.keys):
            old = self.keys >= 0
            kept = self.keys[old], self.next[old], self.change[old]
            self._sized(4 * len(self.keys))
            for key, following, change in zip(*(k.tolist() for k in kept)):
                at = self._place(key)
                self.keys[at], self.next[at], self.change[at] = key, following, change
            self.held = len(kept[0])
        for key in keys.tolist():
            at = self._place(key)
            following, change = self._advance(*divmod(key, self.width))
            self.keys[at], self.next[at], self.change[at] = key, following, change
            self.held += 1

    def _advance(self, state: int, step: int) -> tuple[int, int]:
        moved = []
        for node, before, behind in self.states[state]:
            child = self.children[node].get(step)
            if child is not None:
                moved.append((child, before, behind))
        if len(moved) == 1 and moved[0][2] == 0 and moved[0][0] in self._first(step):
            # Nothing reaches over this place: what stands before it no longer matters.
            moved = [(moved[0][0], _NONE, 0)]
        for child, before, behind in moved:
            piece = self.piece[child]
            if piece != _NONE and (before == _NONE or self.model.compatible(before, piece)):
                break
        change = behind + 1
        live = tuple(
            (child, before, behind - change) for child, before, behind in moved
            if self.children[child]) + ((_ROOT, piece, 0),)
        if live not in self.number:
            self.number[live] = len(self.states)
            self.states.append(live)
        return self.number[live], change

    def _first(self, step: int) -> tuple[int]:
        return (self.children[_ROOT][step],)

    def step(self, states: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states that follow, and the changes of the counts."""
        keys = states.astype(np.int64) * self.width + classes
        while True:
            mask = len(self.keys) - 1
            at = (mix(keys.astype(np.uint64)) & np.uint64(mask)).astype(np.int64)
            found = self.keys[at]
            off = np.flatnonzero((found != keys) & (found != -1))
            while len(off):
                at[off] = (at[off] + 1) & mask
                found[off] = self.keys[at[off]]
                off = off[(found[off] != keys[off]) & (found[off] != -1)]
            new = keys[found == -1]
            if not len(new):
                return self.next[at], self.change[at]
            self._add(np.unique(new))

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text."""
        strings = texts.to_pylist()
        lengths = np.array([len(t) + 1 if t else 0 for t in strings], np.int64)
        joined = "".join(" " + t for t in strings if t)
        ends = np.cumsum(lengths)
        if not len(joined):
            return np.zeros(len(strings), np.int64)
        if self.held > REMEMBERED:
            self.forget()
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = self.classes[codes]
        change = np.where(classes == 0, self.alone[codes], 0).astype(np.int8)
        rest = np.empty(len(codes), bool)
        rest[1:] = ~self.adjoin[classes[:-1], classes[1:]]
        rest[0] = True
        rest[(ends - lengths)[lengths > 0]] = True
        self._scan(classes, rest, change)
        running = np.concatenate([[0], np.cumsum(change, dtype=np.int64)])
        return running[ends] - running[ends - lengths]

    def _scan(self, classes: np.ndarray, rest: np.ndarray, change: np.ndarray) -> None:
        """Fill in the changes of all places."""
        size = len(classes)
        starts = np.arange(0, size, CHUNK)
        ends = np.minimum(starts + CHUNK, size)
        places = np.flatnonzero(rest)
        first = np.append(places, size)[np.searchsorted(places, starts)]
        first = np.minimum(first, ends)
        left_in = np.full(len(starts), -1, np.int64)
        constant = np.flatnonzero(first < ends)
        left_in[constant] = self._run(
            classes, rest, change, first[constant], ends[constant], np.zeros(len(constant), np.int64))
        waiting = np.flatnonzero(first > starts)
        while len(waiting):
            ready = left_in[waiting - 1] >= 0
            now, waiting = waiting[ready], waiting[~ready]
            state = self._run(classes, rest, change, starts[now], first[now], left_in[now - 1])
            through = first[now] == ends[now]
            left_in[now[through]] = state[through]

    def _run(self, classes, rest, change, at, ends, states) -> np.ndarray:
        """Read from ``at`` to ``ends`` in all lanes; the states at the ends."""
        at, states = at.copy(), states.copy()
        lanes = np.flatnonzero(at < ends)
        while len(lanes):
            place = at[lanes]
            state = np.where(rest[place], 0, states[lanes])
            reads = np.flatnonzero(classes[place])
            following = np.zeros(len(lanes), np.int64)
            if len(reads):
                following[reads], change[place[reads]] = self.step(state[reads], classes[place[reads]])
            states[lanes] = following
            at[lanes] += 1
            lanes = lanes[at[lanes] < ends[lanes]]
        return states


@functools.lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One transducer for each model file and worker."""
    return Transducer(piece_model(path))


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``n_bytes``, ``n_tokens`` and whether there are more than ``limit`` tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_path)
        for batch in batches:
            for part in slices(batch):
                texts = filled(part.column("text"))
                counts = machine.count(texts)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pc.binary_length(texts).cast(pa.int64()),
                    pa.array(counts, pa.int64()), pa.array(counts > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    needed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return needed.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

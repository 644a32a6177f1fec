"""Encoding and decoding with a piece model by a table of last pieces.

For every prefix of a text the last piece of its encoding is stored. An automaton over all pieces
finds those that end at a place; the one whose left neighbour, the last piece stored for the place
where it begins, is compatible with it is that prefix's last piece, and there is only one. The ids
of the whole text are then read from its end backwards. The work grows with the length of the text,
whatever it is made of.

Texts are taken apart before a space and between characters that no piece holds side by side, and
the table is made once for each distinct chunk. Null or empty texts are the begin and end ids.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .cached_encoder import ChunkCache
from .common import filled, slices
from .piece_model import SPACE, PieceModel, piece_model

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceCodec(ChunkCache):
    def __init__(self, model: PieceModel):
        import ahocorasick

        self.model = model
        self.automaton = ahocorasick.Automaton()
        for piece, i in model.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        pairs = {p.replace(SPACE, " ") for p in model.pairs}
        self.cut_between = np.zeros((256, 256), bool)
        for a in range(128):
            for b in range(128):
                self.cut_between[a, b] = chr(a) + chr(b) not in pairs
        # No piece has a space behind another character, so a space begins a chunk.
        if not any(SPACE in p.lstrip(SPACE) for p in model.ids):
            self.cut_between[128:, 32] = True
        self.forget()

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, None]:
        cut = np.empty(len(data), bool)
        cut[0] = True
        cut[1:] = self.cut_between[data[:-1], data[1:]]
        return cut, data, None

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        return [self.chunk(c.replace(" ", SPACE)) for c in chunks]

    def chunk(self, text: str) -> list[int]:
        """Ids of a text whose spaces are already marked."""
        last, begins = [-1] * (len(text) + 1), [0] * (len(text) + 1)
        done, compatible = 0, self.model.compatible
        for end, (piece, length) in self.automaton.iter(text):
            end += 1
            for k in range(done + 1, end):  # places where no piece ends
                begins[k] = k - 1
            done = end
            if last[end] >= 0:
                continue
            before = last[end - length]
            if before < 0 or compatible(before, piece):
                last[end], begins[end] = piece, end - length
        for k in range(done + 1, len(text) + 1):
            begins[k] = k - 1
        ids, at = [], len(text)
        while at:
            first = begins[at]
            if last[at] >= 0:
                ids.append(last[at])
            else:
                ids.extend(reversed(self.model.spelled(text[first:at])))
            at = first
        ids.reverse()
        return ids

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, without begin and end ids."""
        marked = pc.replace_substring(texts, SPACE, " ")
        led = pc.binary_join_element_wise(pa.scalar(" ", marked.type), marked, pa.scalar("", marked.type))
        return self.encode(pc.if_else(pc.equal(marked, ""), marked, led))


@functools.lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec for each model file and worker."""
    return PieceCodec(piece_model(path))


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """Documents with their ids, begin and end ids included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lists in _id_lists(batches, model_path):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([i.astype(np.int32) for i in lists], pa.list_(pa.int32()))],
                ["doc_id", "ids"])

    return _needed(docs).mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Digests of the ids of each document, and of the text that the library decodes them to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lists in _id_lists(batches, model_path):
            decode = codec(model_path).model.library.decode
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"),
                pa.array([len(i) for i in lists], pa.int64()),
                pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in lists]),
                pa.array([hashlib.sha256(decode(i.tolist()).encode()).hexdigest() for i in lists]),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _needed(docs).mapInArrow(run, SCHEMA)


def _needed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _id_lists(batches, model_path: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    source = codec(model_path)
    begin, end = ([i] for i in (source.model.library.bos_id(), source.model.library.eos_id()))
    for batch in batches:
        for part in slices(batch):
            ids, offsets = source.encode_texts(filled(part.column("text")))
            yield part, [
                np.concatenate([begin, ids[a:b], end]) for a, b in zip(offsets[:-1], offsets[1:])]

"""Ids of whole texts from a tokenizer of the tokenizers library, each distinct chunk encoded once.

Pre-tokenizers that split at white space and between letters and punctuation never join what lies
on both sides of such a cut, so a text is the concatenation of its chunks. Chunks repeat, texts do
not; the library sees only the chunks a worker has not met yet. Texts for which a cut may not be
safe (a special token's string, white space beyond ASCII) go to the library whole. The library gets
many new words in one text. Where white space leaves no trace, it makes no chunks, and a mark stands
behind each word; byte-level tokens tell by their lengths where a word behind white space ends.
"""

from __future__ import annotations

import functools
import itertools
import os

import numpy as np
import pyarrow as pa

from .common import gather, text_bytes

# Bytes of distinct chunks, their ids and what holds them that a worker remembers before it forgets
# all that are not in the texts at hand.
REMEMBERED_BYTES = 48 << 20
# What a remembered chunk takes besides its own bytes and four for each id.
CHUNK_BYTES = 150
# Longer chunks are encoded wherever they occur and not remembered.
LONGEST = 256
# The library gets so many bytes of chunks at once.
LEARNED_BYTES = 1 << 20
# What stands behind each word where many are one text without white space, and how many words are one text.
MARK, MARKED = "~", 1_000

_SPACE, _ALNUM, _PUNCT, _OTHER = 0, 1, 2, 3


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    for code in range(128):
        char = chr(code)
        if char in "\t\n\v\f\r ":
            kinds[code] = _SPACE
        elif char.isalnum():
            kinds[code] = _ALNUM
        elif char.isprintable() and char != "'":
            kinds[code] = _PUNCT
    return kinds


_KINDS = _byte_kinds()
# cut[a, b]: a chunk may end between a byte of kind a and one of kind b.
_CUT = np.zeros((4, 4), bool)
_CUT[[_ALNUM, _PUNCT, _OTHER], _SPACE] = True
_CUT[_ALNUM, _PUNCT] = _CUT[_PUNCT, _ALNUM] = True
_CUT_FOLDED = _CUT.copy()
_CUT_FOLDED[_SPACE] = [False, True, True, True]
# White space that is not ASCII, in UTF-8, and the bytes it begins with.
_WIDE_SPACE = [chr(c).encode() for c in (
    0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_WIDE_FIRST = np.isin(np.arange(256), [c[0] for c in _WIDE_SPACE])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class ChunkCache:
    """Ids of texts put together from the ids of their distinct chunks.

    A subclass says where a text may be cut and how chunks are encoded.
    """

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Where chunks begin, the bytes to encode, and which of them are not left out (None: all).

        Starts of texts are added by the caller.
        """
        raise NotImplementedError

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def ids_of(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has."""
        encoded = self.encode_chunks([c.decode("utf-8", "replace") for c in chunks])
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter(itertools.chain.from_iterable(encoded), np.uint32, int(lengths.sum())), lengths

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held_bytes = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.used = 0

    def _keep(self, chunks: list[bytes]) -> None:
        """Forget all chunks but these, which are known."""
        slots = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        lengths = self.lengths[slots]
        ids = self.flat[gather(self.starts[slots], lengths)]
        self.forget()
        self._store(ids, lengths, 0)
        self._name(chunks, 0)

    def _store(self, ids: np.ndarray, lengths: np.ndarray, first: int) -> None:
        """Ids of chunks in a row, in the slots from ``first`` on."""
        end = first + len(lengths)
        while end > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.starts[first:end] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:end] = lengths
        self.used += len(ids)

    def _append(self, chunks: list[bytes], first: int) -> None:
        """Ids of chunks, in the slots from ``first`` on; the library's own objects live for one part."""
        sizes = np.cumsum([len(c) for c in chunks])
        cuts = np.searchsorted(sizes, np.arange(LEARNED_BYTES, sizes[-1] + LEARNED_BYTES, LEARNED_BYTES)) + 1
        done = 0
        for end in np.unique(np.minimum(cuts, len(chunks))).tolist():
            self._store(*self.ids_of(chunks[done:end]), first + done)
            done = end

    def _learn(self, chunks: list[bytes]) -> None:
        first, used = len(self.known), self.used
        self._append(chunks, first)
        self._name(chunks, used)

    def _name(self, chunks: list[bytes], used: int) -> None:
        """Remember chunks whose ids are in the next slots and in the room from ``used`` on."""
        first = len(self.known)
        self.known.update(zip(chunks, range(first, first + len(chunks))))
        self.held_bytes += sum(map(len, chunks)) + CHUNK_BYTES * len(chunks) + 4 * (self.used - used)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids start and the last one's end."""
        data, offsets = text_bytes(texts)
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        cut, data, kept = self.cuts(data, offsets)
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        if kept is None:
            places = starts = np.flatnonzero(cut)
        else:
            starts, places, data = np.flatnonzero(cut & kept), np.flatnonzero(cut[kept]), data[kept]
        chunks = pa.Array.from_buffers(pa.large_binary(), len(places), [
            None, pa.py_buffer(np.append(places, len(data)).astype(np.int64)),
            pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        raw, at = text_bytes(chunks.dictionary)
        raw, at = raw.tobytes(), at.tolist()
        distinct = [raw[a:b] for a, b in zip(at, at[1:])]
        if self.held_bytes > REMEMBERED_BYTES:
            self._keep([c for c in distinct if c in self.known])
        slots = list(map(self.known.get, distinct))
        new = [k for k, slot in enumerate(slots) if slot is None]
        missing = [distinct[k] for k in new if len(distinct[k]) <= LONGEST]
        if missing:
            self._learn(missing)
        # Long chunks take the slots and the room after what is remembered, until the next call.
        kept_ids, long = self.used, [distinct[k] for k in new if len(distinct[k]) > LONGEST]
        if long:
            self._append(long, len(self.known))
        above = iter(range(len(self.known), len(self.known) + len(long)))
        for k in new:
            slots[k] = self.known[distinct[k]] if len(distinct[k]) <= LONGEST else next(above)
        slots = np.array(slots, np.int64)[chunks.indices.to_numpy(zero_copy_only=False)]
        lengths = self.lengths[slots]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[gather(self.starts[slots], lengths)]
        self.used = kept_ids
        if long and len(self.flat) > max(1 << 20, 4 * kept_ids):
            self.flat = self.flat[:max(1 << 16, kept_ids)].copy()
        return ids, before[np.searchsorted(starts, offsets)]


class CachedEncoder(ChunkCache):
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Where case and white space leave no trace, chunks that differ in them are one.
        plain = self.encode_chunks([chr(c) for c in range(97, 123)])
        self.folds = plain == self.encode_chunks([chr(c) for c in range(65, 91)]) == self.encode_chunks(
            [f" \n{chr(c)} " for c in range(97, 123)])
        # Marked words are told apart by the mark's id, which no word has; no special token is made of words and marks.
        mark, letters = self.encode_chunks([MARK])[0], "".join(chr(c) for c in range(97, 123))
        joined = self.encode_chunks(["".join(letter + MARK for letter in letters)])[0]
        self.mark = mark[0] if (
            self.folds and len(mark) == 1 and joined == [i for ids in plain for i in ids + mark]
            and all(t.replace(MARK.encode(), b"") and not t.replace(MARK.encode(), b"").isalnum() for t in self.special)
        ) else None
        # The bytes of each token, where a text's bytes are its tokens' and no special token is made of words.
        before, self.widths = self.tokenizer.pre_tokenizer, None
        if (self.tokenizer.normalizer is None and isinstance(self.tokenizer.model, models.BPE)
                and isinstance(before, pre_tokenizers.ByteLevel) and not before.add_prefix_space
                and all(t and not t.isalnum() for t in ("".join(s.decode().split()) for s in self.special))):
            tokens = self.tokenizer.get_vocab(with_added_tokens=True)
            self.widths = np.zeros(max(tokens.values()) + 1, np.int64)
            self.widths[list(tokens.values())] = list(map(len, tokens))
        self.forget()

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _words(self, chunks: list[bytes]) -> list[bool]:
        """Which chunks may be one text with others."""
        if self.mark is not None:
            return list(map(bytes.isalnum, chunks))
        if self.widths is None:
            return [False] * len(chunks)
        return [c[:1].isspace() and c[1:].decode("utf-8", "replace").isalnum() for c in chunks]

    def ids_of(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not all(self._words(chunks)):
            return super().ids_of(chunks)
        mark = "" if self.mark is None else MARK
        texts = [mark.join([c.decode() for c in chunks[k:k + MARKED]]) + mark for k in range(0, len(chunks), MARKED)]
        ids = np.concatenate([np.array(i, np.uint32) for i in self.encode_chunks(texts)])
        if mark:
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) == len(chunks):
                return np.delete(ids, marks), np.diff(marks, prepend=-1) - 1
        else:
            ends, chunk_ends = np.cumsum(self.widths[ids]), np.cumsum(list(map(len, chunks)))
            last = np.flatnonzero(np.isin(ends, chunk_ends, assume_unique=True))
            if len(last) == len(chunks) and last[-1] == len(ids) - 1:
                return ids, np.diff(last, prepend=-1)
        return super().ids_of(chunks)

    def _learn(self, chunks: list[bytes]) -> None:
        words = self._words(chunks)
        for kind in (True, False):
            if some := [c for c, word in zip(chunks, words) if word == kind]:
                super()._learn(some)

    def _unsafe(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts must not be cut."""
        bad = np.zeros(len(offsets) - 1, bool)
        wide = _WIDE_SPACE if _WIDE_FIRST[data].any() else []
        raw = data.tobytes()
        for needle in self.special + wide:
            at = raw.find(needle)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, side="right")) - 1
                bad[text] = True
                at = raw.find(needle, int(offsets[text + 1]))
        return bad

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        unsafe = np.flatnonzero(self._unsafe(data, offsets))
        kinds = _KINDS[data]
        cut = np.empty(len(data), bool)
        cut[0] = True
        cut[1:] = (_CUT_FOLDED if self.folds else _CUT).ravel()[(kinds[:-1] << 2) | kinds[1:]]
        folded = _LOWER[data] if self.folds else data
        kept = kinds != _SPACE if self.folds else None
        for text in unsafe:
            span = slice(offsets[text], offsets[text + 1])
            cut[span] = False
            if self.folds:
                folded[span], kept[span] = data[span], True
        return cut, folded, kept


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> CachedEncoder:
    """One encoder for each tokenizer file and worker."""
    return CachedEncoder(path)

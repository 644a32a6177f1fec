"""The vocabulary of a piece model with merges by score, and which pieces may be neighbours.

Encoding joins, again and again, the two neighbours that make the best piece (the leftmost of
equals). Two pieces are compatible if the text they make is encoded as just these two. A sequence
of pieces is the encoding of its text exactly if all its neighbours are compatible.
"""

from __future__ import annotations

import functools

SPACE = "▁"


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = self.library.get_piece_size()
        self.bytes = {}
        self.ids: dict[str, int] = {}
        for i in range(count):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i)):
                self.ids[piece] = i
        self.text = {i: piece for piece, i in self.ids.items()}
        self.score = {piece: self.library.get_score(i) for piece, i in self.ids.items()}
        # Characters and pairs of characters that occur within longer pieces. No piece reaches
        # over a pair that is not among them, so encoding can be cut there.
        self.joining = {c for piece in self.ids if len(piece) > 1 for c in piece}
        self.pairs = {piece[k:k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        self.unknown = self.library.unk_id()
        self._compatible: dict[tuple[int, int], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by its definition."""
        parts = list(text)
        while True:
            joined = [
                (-self.score[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in self.score]
            if not joined:
                return parts
            _, k = min(joined)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self._compatible.get(key)
        if known is None:
            a, b = self.text[left], self.text[right]
            known = a[-1] + b[0] not in self.pairs or self.merged(a + b) == [a, b]
            if len(self._compatible) > 2_000_000:
                self._compatible.clear()
            self._compatible[key] = known
        return known

    def spelled(self, char: str) -> list[int]:
        """Ids of a character that is no piece."""
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in char.encode()]


@functools.lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model for each file and worker."""
    return PieceModel(path)

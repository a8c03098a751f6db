"""Token ids of whole texts by a vocabulary that treats white-space separated pieces by themselves."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from matchweave.llm.words import Words, hash_ranges, split_words

#: Slots of the table of known pieces (a power of two), and token ids kept for them before it is emptied.
SLOTS = 1 << 22
POOL = 1 << 23
#: Pieces encoded at once.
ENCODED = 8_192

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER_OR_DIGIT = _LETTER.copy()
_LETTER_OR_DIGIT[48:58] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True


class PieceTokenizer:
    """Encodes each different piece once and keeps its ids in a direct-mapped table.

    The vocabulary drops white space and splits before it merges, so the ids of a text are those of its pieces one
    after another, where a piece is a word or the sentence mark after an ASCII letter or digit. ASCII capitals are
    lowered first, as the vocabulary does, unless special tokens might be near.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.between = self.encoder.encode("0", add_special_tokens=False).ids
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(SLOTS, dtype=np.uint64)
        self.begin = np.zeros(SLOTS, dtype=np.int32)
        self.size = np.zeros(SLOTS, dtype=np.int32)
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has; letters go through in one text, told apart by a digit between them."""
        letters = np.fromiter((p.isalpha() for p in pieces), dtype=bool, count=len(pieces))
        sizes, plain = np.zeros(len(pieces), dtype=np.int64), np.flatnonzero(letters)
        flat = np.empty(0, dtype=np.uint32)
        if len(plain):
            joined = b" 0 ".join([pieces[i] for i in plain.tolist()]).decode()
            flat = np.array(self.encoder.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=np.uint32)
            between = np.flatnonzero(flat == self.between[0])
            if len(between) == len(plain) - 1:
                sizes[plain] = np.diff(np.concatenate([[-1], between, [len(flat)]])) - 1
                flat = np.delete(flat, between)
            else:
                letters[:], plain, flat = False, plain[:0], flat[:0]
        rest = np.flatnonzero(~letters).tolist()
        encoded = [e.ids for e in self.encoder.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)]
        sizes[rest] = [len(e) for e in encoded]
        out = np.empty(int(sizes.sum()), dtype=np.uint32)
        of_letters = np.repeat(letters, sizes)
        out[of_letters] = flat
        out[~of_letters] = np.fromiter((i for e in encoded for i in e), dtype=np.uint32, count=len(out) - len(flat))
        return out, sizes

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, lower: bool) -> None:
        for i in range(0, len(starts), ENCODED):
            part = slice(i, i + ENCODED)
            self._learn_some(data, starts[part], ends[part], hashes[part], lower)

    def _learn_some(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, lower: bool) -> None:
        pieces = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        ids, sizes = self._encode([p.lower() for p in pieces] if lower else pieces)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        self.keys[slot] = hashes
        self.begin[slot] = self.used + np.cumsum(sizes) - sizes
        self.size[slot] = sizes
        self.used += len(ids)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, Words]:
        """Ids of all texts in a row, the number of ids of each word, and the words."""
        words = split_words(column, lower=False)
        data = words.data
        if not len(words.starts):
            return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64), words
        marked = _MARK[data[words.ends - 1]] & (words.ends - words.starts > 1)
        marked[marked] = _LETTER_OR_DIGIT[data[words.ends[marked] - 2]]
        # pieces: words without their mark, and the marks
        at = np.flatnonzero(marked) + 1
        ends = words.ends - marked
        starts = np.insert(words.starts, at, words.ends[marked] - 1)
        ends = np.insert(ends, at, words.ends[marked])
        lower = b"<|" not in data.tobytes()
        hashes = hash_ranges(data, starts, ends, lower=lower)
        hashes[hashes == 0] = 1

        if self.used > POOL:
            self._reset()
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        ids = None
        missing = np.flatnonzero(self.keys[slot] != hashes)
        begin, size = self.begin[slot].astype(np.int64), self.size[slot].astype(np.int64)
        while len(missing):
            # of pieces that share a slot one is learnt and read at a time
            _, first = np.unique(slot[missing], return_index=True)
            chosen = missing[first]
            self._learn(data, starts[chosen], ends[chosen], hashes[chosen], lower)
            known = self.keys[slot[missing]] == hashes[missing]
            found = missing[known]
            begin[found], size[found] = self.begin[slot[found]], self.size[slot[found]]
            missing = missing[~known]
        total = int(size.sum())
        stops = np.cumsum(size)
        source = np.repeat(begin - (stops - size), size) + np.arange(total)
        ids = self.pool[source]
        # back from pieces to words
        piece_word = np.arange(len(starts)) - np.searchsorted(at + np.arange(len(at)), np.arange(len(starts)), side="right")
        counts = np.bincount(piece_word, weights=size, minlength=len(words.starts)).astype(np.int64)
        return ids, counts, words


_LOADED: dict[str, PieceTokenizer] = {}


def load(path: str) -> PieceTokenizer:
    """The tokenizer of this Python process."""
    if path not in _LOADED:
        _LOADED[path] = PieceTokenizer(path)
    return _LOADED[path]

"""A compressed FM-index over word sequences: wavelet matrix, backward search and first occurrences of windows."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank over a sequence of small integers: one bit vector per bit of the alphabet, counted per 64-bit word."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        current = symbols.astype(np.int64)
        for level in range(self.levels):
            bits = ((current >> (self.levels - 1 - level)) & 1).astype(np.uint8)
            padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
            padded[: len(bits)] = bits
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]))
            self.zeros.append(len(bits) - int(bits.sum()))
            current = np.concatenate([current[bits == 0], current[bits == 1]])

    def descend(self, symbols: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Where the first ``positions`` entries of each symbol end after the last level."""
        for level in range(self.levels):
            one = (symbols >> (self.levels - 1 - level)) & 1
            block = positions >> 6
            low = (np.uint64(1) << (positions & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[level][block] + np.bitwise_count(self.words[level][block] & low)
            positions = np.where(one == 1, ones + self.zeros[level], positions - ones)
        return positions


def _pair_ranks(left: np.ndarray, shift: int) -> np.ndarray:
    """Ranks of (rank here, rank ``shift`` further on); what lies behind the end ranks lowest."""
    right = np.zeros_like(left)
    right[: len(left) - shift] = left[shift:] + 1
    key = left * (int(left.max()) + 2) + right
    order = np.argsort(key, kind="stable")
    steps = np.empty(len(key), dtype=np.int64)
    steps[0] = 0
    np.cumsum(key[order][1:] != key[order][:-1], out=steps[1:])
    ranks = np.empty(len(key), dtype=np.int64)
    ranks[order] = steps
    return ranks


class FMIndex:
    """Index of several word sequences for patterns of up to ``window`` words.

    Suffixes are ordered by their first ``window`` words, which is all that a backward search of that length reads.
    Between sequences stands symbol 0.
    """

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, window: int):
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        hashes = np.concatenate(sequences)
        _, symbols = np.unique(hashes, return_inverse=True)
        ends = np.cumsum(lengths + 1)
        text = np.zeros(int(ends[-1]), dtype=np.int64)
        inside = np.ones(len(text), dtype=bool)
        inside[ends - 1] = False
        text[inside] = symbols + 1
        self.window, self.text, self.lengths, self.ends = window, text, lengths, ends - 1

        ranks, size = text, 1
        while size * 2 <= window - 1:
            ranks, size = _pair_ranks(ranks, size), size * 2
        shorter = _pair_ranks(ranks, window - 1 - size) if window - 1 > size else ranks
        full = _pair_ranks(ranks, window - size)
        suffixes = np.argsort(full, kind="stable")
        self.matrix = WaveletMatrix(text[suffixes - 1], int(text.max()) + 1)
        counts = np.bincount(text, minlength=int(text.max()) + 1)
        alphabet = np.arange(len(counts))
        before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.shift = before - self.matrix.descend(alphabet, np.zeros(len(counts), dtype=np.int64))
        # rows whose first window - 1 words agree: begin and end of that group
        ordered = shorter[suffixes]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        spans = np.diff(np.concatenate([begins, [len(text)]]))
        self.group_begin, self.group_end = np.repeat(begins, spans), np.repeat(begins + spans, spans)
        # smallest owner of the rows whose first window words agree
        owner = np.repeat(owners, lengths + 1)[suffixes]
        ordered = full[suffixes]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        spans = np.diff(np.concatenate([begins, [len(text)]]))
        self.first_owner = np.repeat(np.minimum.reduceat(owner, begins), spans)

    def step(self, low: np.ndarray, high: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Extend matches by one word to the left."""
        both = self.matrix.descend(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        both += np.concatenate([self.shift[symbols], self.shift[symbols]])
        return both[: len(symbols)], both[len(symbols) :]

    def first_owners(self) -> list[np.ndarray]:
        """For every window of every sequence, the smallest owner of an equal window in the index.

        All sequences stream from right to left together. A match grows to ``window`` words; then its last word is
        let go (its rows widen to the group that shares the other words) before the next word comes in on the left.
        Every streamed sequence is in the index, so no extension fails.
        """
        order = np.argsort(-self.lengths, kind="stable")
        lengths, ends = self.lengths[order], self.ends[order]
        found = [np.empty(max(n - self.window + 1, 0), dtype=np.int64) for n in self.lengths]
        low = np.zeros(len(order), dtype=np.int64)
        high = np.full(len(order), len(self.text), dtype=np.int64)
        reports = []
        for depth in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -depth, side="left"))
            low, high = low[:live], high[:live]
            if depth >= self.window:
                low, high = self.group_begin[low], self.group_end[low]
            low, high = self.step(low, high, self.text[ends[:live] - 1 - depth])
            if depth >= self.window - 1:
                reports.append((live, depth, self.first_owner[low]))
        for live, depth, owner in reports:
            for lane, value in zip(order[:live], owner):
                found[lane][self.lengths[lane] - 1 - depth] = value
        return found

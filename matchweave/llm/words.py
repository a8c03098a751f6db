"""Words, hashes and n-grams of whole Arrow columns, computed with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a single longer text is handled alone.
SLICE_BYTES = 2 << 20
#: Bytes whose words are hashed at once.
HASH_BYTES = 1 << 20

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True

_RADIX = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_PLACES: list[np.ndarray] = []


def _places(n: int) -> np.ndarray:
    """A fixed odd random number for each of ``n`` places in a word; kept for the next call."""
    if not _PLACES or len(_PLACES[0]) < n:
        _PLACES[:] = [mix(np.arange(1, max(n, HASH_BYTES) + 1, dtype=np.uint64) * np.uint64(_RADIX)) | np.uint64(1)]
    return _PLACES[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (one to one)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each text begins (one entry more); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``, or one row if that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = column_bytes(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


@dataclass
class Words:
    """Words of several texts: byte ranges, hashes and the index of each text's first word (one entry more)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """Number of the text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(column: pa.Array, lower: bool = False, separator: np.ndarray = SEPARATOR) -> Words:
    r"""Words of every text, by default ``[^\x20\x09-\x0D]+``; ``lower`` hashes A-Z as a-z.

    ``separator`` marks the bytes that stand between words.
    """
    data, offsets = column_bytes(column)
    inside = ~separator[data]
    at_start = np.zeros(len(data) + 1, dtype=bool)
    at_start[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | at_start[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | at_start[1:])) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, hash_ranges(data, starts, ends, lower), first)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are in order and do not overlap.

    Each byte has a random number by its value and one by its place in the range, and a range has the sum of their products, so
    that no pattern of bytes makes two ranges alike.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    table = _BYTE_LOWER if lower else _BYTE
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + HASH_BYTES, side="right")), i + 1)
        lo, hi = int(starts[i]), int(ends[j - 1])
        begin, end = starts[i:j] - lo, ends[i:j] - lo
        place = np.arange(hi - lo) - np.repeat(begin, np.diff(begin, append=hi - lo))
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(table[data[lo:hi]] * _places(hi - lo)[place], out=sums[1:])
        out[i:j] = sums[end] - sums[begin]
        i = j
    return mix(out + np.uint64(0x2545F4914F6CDD1D))


def sequence_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the run of hashes in each range, whatever its place; ranges may overlap, none is empty.

    A range has the hashes of the two runs of the largest power of two that begin and end with it, which are mixed at
    every doubling.
    """
    size = ends - starts
    level = np.frexp(size)[1] - 1
    out, part, step = np.empty(len(starts), dtype=np.uint64), hashes, 1
    for k in range(int(level.max(initial=-1)) + 1):
        own = np.flatnonzero(level == k)
        out[own] = mix(part[starts[own]] * np.uint64(_RADIX) + part[ends[own] - step]) + size[own].astype(np.uint64)
        if len(part) > step:
            part = mix(part[:-step] * np.uint64(0xD1342543DE82EF95 + 2 * step) + part[step:])
        step *= 2
    return mix(out)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` hashes (across text borders too), by doubling."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    # parts[k] is the hash of 2**k neighbours; a run of n is put together from the bits of n
    part, size, total, used = hashes, 1, None, 0
    rest = n
    while rest:
        if rest & 1:
            piece = part[used : used + count]
            total = piece.copy() if total is None else total * np.uint64(_RADIX) + piece
            used += size
        rest >>= 1
        if rest:
            part = mix(part[:-size] * np.uint64(0xD1342543DE82EF95 + 2 * size) + part[size:])
            size *= 2
    return mix(total + np.uint64(n))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def valid_runs(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Marks the starts of runs of ``n`` words that stay inside one text, for ``total`` words."""
    ok = np.zeros(max(total - n + 1, 0), dtype=bool)
    lengths = np.diff(first)
    for begin, length in zip(first[:-1][lengths >= n], lengths[lengths >= n]):
        ok[begin : begin + length - n + 1] = True
    return ok

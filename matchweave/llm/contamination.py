"""Benchmark passages in documents: CGK embedding, bit-sampling LSH and exact edit distance."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchweave.llm.words import by_bytes, grams, mix, split_words

#: Edits allowed per word of an item.
EDITS = 0.2
#: Random walks, samples drawn from each, and positions of a sample.
WALKS, SAMPLES, SAMPLED = 8, 6, 3
#: Words of the runs that mark where an item can be.
SEED_WORDS = 3
#: Item text held by the tasks at once; a larger benchmark is looked for block by block.
BLOCK_BYTES = 8 << 20
#: Words of the windows that are embedded, or compared, at once.
WINDOW_WORDS = 1 << 20

#: Everything of ASCII but letters and digits stands between words.
_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[48:58] = _BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False

_FILTER_BITS = 22


def edit_limit(length: int, edits: float = EDITS) -> int:
    return math.floor(edits * length + 1e-9)


def seed_words(length: int, edits: float) -> int:
    """Words of a run that any text within the edit limit of an item shares with it."""
    k = edit_limit(length, edits)
    return min(SEED_WORDS, -(-(length - k) // (k + 1)))


def seeds_needed(length: int, edits: float) -> int:
    """How many of an item's runs survive its edit limit: each edit breaks at most as many as a run has words."""
    q = seed_words(length, edits)
    return max(1, length - q + 1 - q * edit_limit(length, edits))


class ItemIndex:
    """Items as word hashes, their runs, and their LSH buckets."""

    def __init__(self, ids: list[int], texts: list[str], edits: float = EDITS):
        words = split_words(pa.array(texts, pa.string()), lower=True, separator=_BETWEEN)
        lengths = np.diff(words.first)
        kept = np.flatnonzero(lengths > 0)
        self.edits = edits
        self.ids = [ids[i] for i in kept]
        self.words = [words.hashes[words.first[i] : words.first[i + 1]] for i in kept]
        self.lengths = lengths[kept]
        # run hash and item length, by words per run
        self.runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        found: dict[int, set] = {}
        for item in self.words:
            q = seed_words(len(item), edits)
            found.setdefault(q, set()).update((int(h), len(item)) for h in grams(item, q))
        for q, pairs in found.items():
            pairs = sorted(pairs)
            self.runs[q] = (np.array([p[0] for p in pairs], dtype=np.uint64), np.array([p[1] for p in pairs]))
        self.filters = {}
        for q, (hashes, _) in self.runs.items():
            self.filters[q] = np.zeros(1 << _FILTER_BITS, dtype=bool)
            self.filters[q][(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        # buckets: item length, sample number and hash of the sampled positions
        self.buckets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in np.unique(self.lengths).tolist():
            of_length = np.flatnonzero(self.lengths == length)
            keys = sample_keys(np.stack([self.words[i] for i in of_length]))
            owner = np.repeat(of_length, keys.shape[1])
            order = np.argsort(keys.ravel(), kind="stable")
            self.buckets[length] = (keys.ravel()[order], owner[order])


def sample_keys(windows: np.ndarray) -> np.ndarray:
    """LSH keys of windows of one length, ``WALKS * SAMPLES`` for each.

    A walk reads three times as many steps as there are words; at each step it writes the word it stands on and goes
    on or stays by a random bit of step and word (CGK), so two windows that differ by few edits fall into step again
    and write mostly the same. A key is the hash of a few written positions.
    """
    count, length = windows.shape
    steps = 3 * length
    padded = np.concatenate([windows, np.zeros((count, 1), dtype=np.uint64)], axis=1)
    rows = np.arange(count)
    keys = np.empty((count, WALKS * SAMPLES), dtype=np.uint64)
    for walk in range(WALKS):
        rng = np.random.default_rng((walk, length))
        factors = rng.integers(1, 1 << 63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        chosen = [rng.choice(steps, SAMPLED, replace=False) for _ in range(SAMPLES)]
        wanted = {int(step) for sample in chosen for step in sample}
        written: dict[int, np.ndarray] = {}
        place = np.zeros(count, dtype=np.int64)
        for step in range(max(wanted) + 1):
            word = padded[rows, place]
            if step in wanted:
                written[step] = word
            place += ((word * factors[step]) >> np.uint64(63)).astype(np.int64)
            np.minimum(place, length, out=place)
        for number, sample in enumerate(chosen):
            key = np.full(count, walk * SAMPLES + number + 1, dtype=np.uint64)
            for step in sample:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + written[int(step)])
            keys[:, walk * SAMPLES + number] = key
    return keys


def edit_distances(windows: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Levenshtein distances of pairs of equally long word sequences, row by row of the table for all pairs at once."""
    count, length = windows.shape
    kind = np.int16 if length < 1 << 14 else np.int32
    above = np.broadcast_to(np.arange(length + 1, dtype=kind), (count, length + 1))
    ramp = np.arange(length + 1, dtype=kind)
    for i in range(length):
        row = np.empty((count, length + 1), dtype=kind)
        row[:, 0] = i + 1
        row[:, 1:] = np.minimum(above[:, :-1] + (windows[:, i : i + 1] != items), above[:, 1:] + 1)
        # steps to the right: the least value to the left plus the distance
        above = np.minimum.accumulate(row - ramp, axis=1) + ramp
    return above[:, -1]


def _candidates(index: ItemIndex, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Item length, text number and start of every window that shares enough runs with items of that length."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for q, (runs, lengths) in index.runs.items():
        every = grams(hashes, q)
        if not len(every):
            continue
        at = np.flatnonzero(index.filters[q][(every >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        at = at[text[at] == text[at + q - 1]]
        low = np.searchsorted(runs, every[at], side="left")
        high = np.searchsorted(runs, every[at], side="right")
        times = high - low
        at, low = np.repeat(at, times), np.repeat(low, times)
        entry = low + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        of_length = lengths[entry]
        for length in np.unique(of_length).tolist():
            mine = of_length == length
            place = at[mine]
            needed = seeds_needed(length, index.edits)
            # texts with enough places of runs; a run that an item repeats counts each time
            places = np.bincount(text[place], minlength=len(first) - 1)
            place = place[places[text[place]] >= needed]
            if not len(place):
                continue
            # windows of the length with enough runs inside; a short text is one window
            reach = length - q + 1
            begin = np.maximum(place - reach + 1, np.append(0, place[:-1] + 1))
            size = np.maximum(place - begin + 1, 0)
            starts = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            owner = text[starts]
            inside = np.searchsorted(place, starts + reach, side="left") - np.searchsorted(place, starts, side="left")
            fits = (starts + length <= first[owner + 1]) & (inside >= needed)
            yield length, owner[fits], starts[fits]
            # texts of fewer words than the item, and windows that would run over the end
            ends = np.unique(text[place])
            begin = np.maximum(first[ends + 1] - length, first[ends])
            yield length, ends, begin


def _least(index: ItemIndex, pairs: np.ndarray, windows: np.ndarray, limit: int, at_once: int) -> Iterator[tuple[int, int, int, int]]:
    """Text, item, start and edits of the best window within ``limit`` of each text and item (of equal ones the first).

    ``pairs`` are text, item, start and row of ``windows``, in order. Windows that begin ``d`` words apart differ by at most
    ``2 * d`` edits, so from a window with many edits the search goes on behind all that cannot be better; half as many words on
    is where the item would be that it runs into, which is looked at next.
    """
    if not len(pairs):
        return
    begins = np.flatnonzero(np.concatenate([[True], (np.diff(pairs[:, :2], axis=0) != 0).any(axis=1)]))
    ends = np.append(begins[1:], len(pairs))
    # the best edits of each group and their row, and the next row to look at
    best, where = np.full(len(begins), limit + 1), np.full(len(begins), -1)
    place = begins.copy()
    # starts in one rising row over all groups
    apart = int(pairs[:, 2].max()) + int(windows.shape[1]) * 2 + 2
    number = np.repeat(np.arange(len(begins)), ends - begins)
    line = number * apart + pairs[:, 2]

    def further(groups: np.ndarray, rows: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The first row of each group that begins at least so many words behind a row."""
        return np.minimum(np.searchsorted(line, line[rows] + words), ends[groups])

    def look(groups: np.ndarray, rows: np.ndarray) -> np.ndarray:
        edits = np.empty(len(rows), dtype=np.int64)
        for j in range(0, len(rows), at_once):
            part = rows[j : j + at_once]
            edits[j : j + at_once] = edit_distances(windows[pairs[part, 3]], np.stack([index.words[k] for k in pairs[part, 1]]))
        better = (edits < best[groups]) | ((edits == best[groups]) & (edits <= limit) & (rows < where[groups]))
        best[groups[better]], where[groups[better]] = edits[better], rows[better]
        return edits

    while True:
        live = np.flatnonzero(place < ends)
        if not len(live):
            break
        rows = place[live]
        edits = look(live, rows)
        ahead = further(live, rows, edits // 2)
        near = (ahead > rows) & (ahead < ends[live])
        if near.any():
            look(live[near], ahead[near])
        step = np.maximum((edits - np.minimum(best[live], limit) - 1) // 2, 0) + 1
        place[live] = further(live, rows, step)
    for group in np.flatnonzero(where >= 0).tolist():
        text, item, begin, _ = pairs[where[group]].tolist()
        yield text, item, begin, int(best[group])


def _search(index: ItemIndex, hashes: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
    """For each pair of text and item the best window: edits, start in the text, words."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    padded = np.concatenate([hashes, np.zeros(int(index.lengths.max(initial=0)) + 1, dtype=np.uint64)])
    for length, owners, starts in _candidates(index, hashes, first):
        keys, items = index.buckets[length]
        limit = edit_limit(length, index.edits)
        at_once = max(1, WINDOW_WORDS // length)
        for i in range(0, len(starts), at_once):
            owner, start = owners[i : i + at_once], starts[i : i + at_once]
            cells = start[:, None] + np.arange(length)[None, :]
            windows = padded[cells]
            windows[cells >= first[owner + 1][:, None]] = 0  # behind the text
            sampled = sample_keys(windows)
            low = np.searchsorted(keys, sampled.ravel(), side="left")
            times = np.searchsorted(keys, sampled.ravel(), side="right") - low
            window = np.repeat(np.repeat(np.arange(len(start)), sampled.shape[1]), times)
            entry = np.repeat(low, times) + np.arange(len(window)) - np.repeat(np.cumsum(times) - times, times)
            pairs = np.unique(np.stack([owner[window], items[entry], start[window], window], axis=1), axis=0) if len(window) else np.empty((0, 4), dtype=np.int64)
            for text, item, begin, edits in _least(index, pairs, windows, limit, at_once):
                found = (edits, int(begin - first[text]), int(min(length, first[text + 1] - begin)))
                if (text, item) not in best or found < best[text, item]:
                    best[text, item] = found
    return best


HITS = "doc_id bigint, item_id bigint, start_word bigint, n_words bigint, edits bigint"


def _find(index: ItemIndex):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            words = split_words(batch.column("_text"), lower=True, separator=_BETWEEN)
            hits = sorted(_search(index, words.hashes, words.first).items())
            if hits:
                docs = batch.column("_doc").take(pa.array([text for (text, _), _ in hits]))
                items = [index.ids[item] for (_, item), _ in hits]
                columns = [[value[k] for _, value in hits] for k in (1, 2, 0)]
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(items, pa.int64()), *[pa.array(c, pa.int64()) for c in columns]],
                    names=["doc_id", "item_id", "start_word", "n_words", "edits"],
                )

    return find


def find_benchmark(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, start_word, n_words, edits``: documents that hold an item of ``benchmark``.

    Words are runs of letters and digits (bytes above ASCII count as letters), A-Z lower-cased. A document holds an
    item of ``n`` words if one of its windows of ``n`` words (its last words, if there are fewer) is within
    ``edits * n`` word edits of it; the row tells the window with the fewest edits, then the first.

    Windows as long as an item are embedded by CGK random walks, which turn edits into few changed positions;
    repeated samples of positions are the keys under which windows meet items, and pairs that meet are verified by
    their exact edit distance. Only windows are embedded that can be within the limit: every edit breaks at most three of an
    item's three-word runs (repeated runs counted each time), so a window with fewer places of such runs than the rest is none.

    The items of one block of at most about ``block_bytes`` go to all tasks; a larger benchmark takes more passes.
    Null, empty and wordless texts and items give no row. Repeated rows and repeated items are answered each. An
    empty table on either side gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), F.coalesce("text", F.lit("")).alias("_text"))
    found = [rows.mapInArrow(_find(index), HITS) for index in item_blocks(benchmark, edits, block_bytes)]
    return reduce(DataFrame.unionByName, found)


def item_blocks(benchmark: DataFrame, edits: float, block_bytes: int) -> Iterator[ItemIndex]:
    """The items in blocks of about ``block_bytes``, each brought to the driver and indexed by itself."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("_item"), F.col("text").alias("_text")).filter("_text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("_item", "_text"), F.lit(blocks)) == block).orderBy("_item", "_text").collect()
        yield ItemIndex([r._item for r in mine], [r._text for r in mine], edits)


def _leave(index: ItemIndex):
    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            column = batch.column(batch.schema.get_field_index("text"))
            words = split_words(column, lower=True, separator=_BETWEEN)
            kept = np.ones(batch.num_rows, dtype=bool)
            kept[[text for text, _ in _search(index, words.hashes, words.first)]] = False
            yield batch.filter(pa.array(kept))

    return leave


def without_benchmark(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item of ``benchmark`` as ``find_benchmark`` defines it."""
    for index in item_blocks(benchmark, edits, block_bytes):
        docs = docs.mapInArrow(_leave(index), docs.schema)
    return docs
